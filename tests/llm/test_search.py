"""Exact and approximate search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hostlens.llm import hnsw, queries, topk

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, score int, ids string"


def brute(vectors, query_ids, k):
    out = {}
    for q in query_ids:
        s = sorted((-float(np.dot(vectors[q], v)), i) for i, v in vectors.items() if i != q)
        out[q] = [(i, -x) for x, i in s[:k]]
    return out


def got_of(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def drawn(n, dim, seed, hot=0):
    rng = np.random.default_rng(seed)
    v = {i: rng.normal(size=dim).astype(np.float32) for i in range(n)}
    for i in rng.choice(n, hot, replace=False):
        v[int(i)] = v[0].copy()
    return v


def frame(spark, v, extra=()):
    rows = [(i, [float(c) for c in x], 7, "b") for i, x in v.items()]
    return spark.createDataFrame([*rows, *extra], SCHEMA)


ODD = [(1000, None, 1, "x"), (1020, [1.0, None], 1, "x"), (1040, [NAN, 1.0], 1, "x"), (1060, [INF, 1.0], 1, "x"), (None, [1.0, 2.0], 1, "x"), (0, None, 1, "x")]


def test_top_k_with_ties_hot_vector_and_odd_rows(spark):
    v = drawn(400, 6, 3, hot=150)
    ints = {i: np.floor(64 * x.astype(float)) for i, x in v.items()}
    rows = [*ODD, (20, [float(c) for c in v[20]], 7, "b")]  # and a repeated row
    got = got_of(topk.top_k(frame(spark, v, rows), "vec_id % 20 = 0", k=7, query_block=8, row_block=50))
    assert got == brute(ints, [i for i in v if i % 20 == 0], 7)


def test_top_k_large_scores_short_vectors_and_few_rows(spark):
    v = {0: [3e5, -2e5, 1.0], 20: [1.0], 21: [], 22: [0.0, 9.5e4], 40: [-1e5, 5.0, 6.0]}
    df = spark.createDataFrame([(i, x, 1, "") for i, x in v.items()], SCHEMA)
    full = {i: np.array([np.floor(64 * np.float32(c).astype(float)) for c in x] + [0.0] * (3 - len(x))) for i, x in v.items()}
    assert got_of(topk.top_k(df, "vec_id % 20 = 0", k=20)) == brute(full, [0, 20, 40], 20)
    for few in (df.limit(0), df.where("vec_id = 22"), df.where("vec_id = 0")):
        assert topk.top_k(few, "vec_id % 20 = 0").count() == 0


def by_row(rows, k, of=lambda x: x):
    """(query_id, rank, vec_id, score) of all query rows, each row a candidate of every other one."""
    out = []
    for i, (q_id, q) in enumerate(rows):
        if q_id % 20 == 0:
            s = sorted((-sum(of(a) * of(b) for a, b in zip(q, v, strict=True)), c_id) for j, (c_id, v) in enumerate(rows) if j != i)
            out += [(q_id, r + 1, c_id, -x) for r, (x, c_id) in enumerate(s[:k])]
    return sorted(out)


def test_rows_that_share_an_id_are_rows_of_their_own(spark):
    rows = [(i % 37, [float((i * 7) % 11 - 5), float(i % 5 - 2), float(i % 3)]) for i in range(150)] + [(3, [50.0, 0.0, 1.0]), (20, [50.0, 1.0, 0.0]), (20, [-50.0, 1.0, 0.0])]
    rows = list(dict.fromkeys((i, tuple(v)) for i, v in rows))
    df = spark.createDataFrame([(i, list(v), 1, "x") for i, v in rows] * 2, SCHEMA)  # and every row twice
    got = sorted(tuple(r) for r in topk.top_k(df, "vec_id % 20 = 0", k=5, query_block=3, row_block=20).collect())
    assert got == by_row(rows, 5, lambda x: int(64 * x))
    near = sorted(tuple(r) for r in hnsw.nearest(df, "vec_id % 20 = 0", k=5, shard=60).collect())
    want = by_row([r for r in rows if any(r[1])], 5)
    # ties at the end of a list may go to another id, so scores are compared
    assert [r[:2] for r in near] == [r[:2] for r in want]
    assert sum(a[3] == b[3] for a, b in zip(near, want, strict=True)) >= 0.95 * len(want)
    assert any(r[0] == 20 and r[2] == 20 for r in near)
    assert any(r[0] == 20 and r[2] == 20 for r in got)


def test_top_k_of_scores_beyond_53_bits(spark):
    rows = [(0, [3e6, 1.0]), (20, [-3e6, 2.5]), (21, [3e6, 0.5]), (22, [2999999.984375, 4.0]), (40, [0.0, 1.0]), (41, [4e6, -7.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, score int, ids string")
    got = sorted(tuple(r) for r in topk.top_k(df, "vec_id % 20 = 0", k=4).collect())
    assert got == by_row(rows, 4, lambda x: int(np.floor(64 * x))) and max(abs(r[3]) for r in got) > 2**55
    with pytest.raises(ValueError, match="long"):
        topk.top_k(df.unionAll(df.limit(1).withColumn("embedding", F.array(F.lit(1e12), F.lit(0.0)))), "vec_id % 20 = 0")


def test_a_task_of_top_k_gets_one_cell_of_blocks(spark, monkeypatch):
    v, met = drawn(400, 6, 5), []
    df = frame(spark, v)
    run = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, *a, **b: met.append(self) or run(self, *a, **b))
    monkeypatch.setattr(topk, "HELD_BLOCKS", 2)
    monkeypatch.setattr(topk, "CELL_BLOCKS", 3, raising=False)
    got = got_of(topk.top_k(df, "vec_id % 20 = 0", k=7, query_block=4, row_block=20))
    assert got == brute({i: np.floor(64 * x.astype(float)) for i, x in v.items()}, [i for i in v if i % 20 == 0], 7)
    for sent in met:
        size = sum(F.octet_length(c) for c in sent.columns if c.endswith("vecs"))
        parts = sent.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.sum(size).alias("bytes")).collect()
        # 5 blocks of queries by 20 of rows: 3 times each row and 7 times each query, not 20 times each query and 5 times each row; 2 bytes a component
        assert max(r.n for r in parts) <= 2 + 3 and sum(r.bytes for r in parts) <= 2 * 6 * (3 * 400 + 7 * 20)
    assert len(met) == 3


def test_top_k_of_components_of_every_packed_type(spark):
    for scale, dim in ((1, 3), (100, 5), (1e4, 2), (1e7, 3), (3e8, 1)):
        rng = np.random.default_rng(dim)
        v = {i: np.floor(scale * rng.normal(size=dim)) for i in range(70)}
        df = spark.createDataFrame([(i, [float(c) / 64 for c in x], 1, "x") for i, x in v.items()], "vec_id long, embedding array<double>, score int, ids string")
        got = sorted(tuple(r) for r in topk.top_k(df, "vec_id % 20 = 0", k=4, query_block=2, row_block=9).collect())
        assert got == by_row([(i, [64 * (float(c) / 64) for c in x]) for i, x in v.items()], 4, int)


def test_top_k_of_many_equal_vectors_holds_k_of_each_query():
    x = np.ones((50, 2))
    block = lambda at, **more: topk._Block({"block": at, "ids": np.arange(at, at + 50).astype("<i8").tobytes(), "rows": np.arange(at, at + 50).astype("<i8").tobytes(), "vecs": x.astype("<i1").tobytes()} | more, 2, "<i1")
    whole = {k: np.full(50, n).astype("<i8").tobytes() for k, n in (("lo", 2), ("need", 3))}
    best = topk._Best(block(0, **whole), 3)
    for at in range(0, 5000, 50):
        best.meet(block(at))
        assert best.size <= 4 * 3 * 50
    got = best.found().to_pydict()
    assert len(got["row"]) == 150 and set(got["vec_id"]) == {0, 1, 2, 3}


def test_op9_recall_and_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    v = {r.vec_id: np.array(r.embedding, np.float64) for r in df.collect()}
    want = brute(v, [i for i in v if i % 20 == 0], 20)
    got = got_of(queries.op9_hnsw(spark, "/root/testdata/sf0.01"))
    assert got.keys() == want.keys()
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * sum(map(len, want.values()))
    for q, hits in got.items():
        assert np.allclose([s for _, s in hits], [v[q] @ v[i] for i, _ in hits], rtol=0, atol=1e-12)
        assert all(a >= b for (_, a), (_, b) in zip(hits, hits[1:], strict=False))


def test_nearest_over_shards_with_hot_vector_lengths_and_odd_rows(spark):
    v = drawn(900, 8, 4, hot=300)
    for i in v:
        v[i] = v[i] * (1 + i % 3)
    zero = (1080, [0.0] * 8, 1, "x")
    got = got_of(hnsw.nearest(frame(spark, v, [*ODD[:5], zero]), "vec_id % 20 = 0", k=10, shard=150))
    want = brute({i: x.astype(float) for i, x in v.items()}, [i for i in v if i % 20 == 0], 10)
    assert got.keys() == want.keys()
    hit = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]
    assert sum(hit) >= 0.95 * 10 * len(want)


def test_nearest_of_few_or_no_rows(spark):
    df = frame(spark, drawn(3, 4, 1))
    assert df.transform(lambda d: hnsw.nearest(d, "vec_id % 20 = 0")).count() == 2
    assert hnsw.nearest(df.limit(0), "vec_id % 20 = 0").count() == 0
    assert hnsw.nearest(df.where(F.col("vec_id") == 0), "vec_id % 20 = 0").count() == 0


def test_graph_finds_most_true_neighbours():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    g = hnsw.Graph(x)
    found = g.search(x[:200], 64)
    true = np.argsort(-(x[:200] @ x.T), axis=1)[:, :20]
    assert np.mean([len(set(a[:20]) & set(b)) for a, b in zip(found, true, strict=True)]) > 18
    assert len(g.layers) > 2 and all((net[:, 0] >= 0).all() for net in g.layers if len(net) > 1)
