"""Operator behaviour on small hand-made tables, checked by brute force."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hostlens.operators import aggregates as A
from hostlens.operators import clean as C
from hostlens.operators import pricing as PR
from hostlens.operators import sampling as S
from hostlens.operators import text as TX
from hostlens.operators import topk as K
from hostlens.operators import windows as W
from hostlens.sources import io


def test_dedup_is_deterministic_and_skew_safe(spark):
    rows = [("hot", i % 7, f"v{i}") for i in range(3000)] + [("cold", 1, "z"), ("cold", 0, None)]
    df = spark.createDataFrame(rows, "k string, a int, b string")
    for parts in (1, 5, 13):
        out = {r["k"]: (r["a"], r["b"]) for r in C.dedup(df.repartition(parts), ["k"]).collect()}
        assert out == {"hot": (0, "v0"), "cold": (0, None)}
    assert C.dedup(df, ["k"]).columns == ["k", "a", "b"]


def test_cumulative_occupancy(spark):
    df = spark.createDataFrame([("1", "2024-01-01", 1), ("1", "2024-01-02", 0), ("1", "2024-01-03", 1),
                                ("2", "2024-01-01", 0)], "id string, date string, label int")
    out = W.cumulative_occupancy(df.withColumn("date", F.col("date").cast("date")))
    got = {(r["id"], str(r["date"])): r["occupancy_rate"] for r in out.collect()}
    assert got[("1", "2024-01-01")] == 1.0
    assert got[("1", "2024-01-02")] == 0.5
    assert got[("1", "2024-01-03")] == pytest.approx(2 / 3)
    assert got[("2", "2024-01-01")] == 0.0
    from hostlens.functions.numeric import threshold_flag
    flags = out.select(threshold_flag("occupancy_rate", 0.5).alias("f")).collect()
    assert sorted(r["f"] for r in flags) == [0, 0, 1, 1]  # exactly 0.5 is not high demand


def test_rollup_single_row_variance_is_null(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("b", "y", 1.0), ("b", "y", 3.0)], "id string, t string, s double")
    out = {r["id"]: r for r in A.rollup_per_key(df, "id", ["t"], "s", "m", "v").collect()}
    assert out["a"]["v"] is None and out["b"]["v"] == 2.0 and out["b"]["m"] == 2.0


def test_correlation_matrix_symmetric_unit_diagonal(spark):
    rnd = random.Random(3)
    rows = [(rnd.random(), rnd.random(), None if i % 4 == 0 else rnd.random()) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    cells = {(r["x"], r["y"]): r["r"] for r in A.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert len(cells) == 9
    for x in "abc":
        assert cells[(x, x)] == pytest.approx(1.0)
        for y in "abc":
            assert cells[(x, y)] == pytest.approx(cells[(y, x)])
    # pairwise-complete rows, as pandas does
    pairs = [(a, c) for a, _, c in rows if c is not None]
    ma = sum(p[0] for p in pairs) / len(pairs)
    mc = sum(p[1] for p in pairs) / len(pairs)
    cov = sum((a - ma) * (c - mc) for a, c in pairs)
    r = cov / math.sqrt(sum((a - ma) ** 2 for a, _ in pairs) * sum((c - mc) ** 2 for _, c in pairs))
    assert cells[("a", "c")] == pytest.approx(r)


def test_top_k_per_group_matches_brute_force(spark):
    rnd = random.Random(5)
    rows = [(f"g{rnd.randrange(3)}", f"t{rnd.randrange(400)}", rnd.randrange(50)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, term string, n int")
    got = K.top_k_per_group(df, ["g"], [F.col("n").desc(), F.col("term").asc()], 7, spread_on="term", spread=16)
    want = set()
    by = defaultdict(list)
    for g, t, n in rows:
        by[g].append((-n, t))
    for g, items in by.items():
        for negn, t in sorted(items)[:7]:
            want.add((g, t, -negn))
    assert {(r["g"], r["term"], r["n"]) for r in got.collect()} == want


def brute_tfidf(docs, k):
    """Reference TF-IDF keywords written directly from the definition."""
    counts = Counter(t for toks in docs.values() for t in toks)
    vocab = [t for t, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]]
    n = len(docs)
    df = {t: sum(1 for toks in docs.values() if t in toks) for t in vocab}
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in vocab}
    score = defaultdict(float)
    for toks in docs.values():
        w = {t: toks.count(t) * idf[t] for t in vocab if t in toks}
        norm = math.sqrt(sum(v * v for v in w.values()))
        for t, v in w.items():
            score[t] += v / norm
    return dict(score)


def test_tfidf_matches_definition(spark):
    rnd = random.Random(11)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "the"]
    texts = {i: " ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 12))) for i in range(60)}
    df = spark.createDataFrame(list(texts.items()), "doc int, text string")
    got = {r["term"]: r["score"] for r in TX.tfidf_keywords(df, "doc", "text", None, 4, ["the"]).collect()}
    docs = {i: [w for w in t.split() if w != "the"] for i, t in texts.items()}
    want = brute_tfidf(docs, 4)
    assert got.keys() == want.keys()
    for t in want:
        assert got[t] == pytest.approx(want[t])


def test_key_sample_stable_under_repartition(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a = {r["k"] for r in S.key_sample(df, 0.3, ["k"], seed=1).collect()}
    b = {r["k"] for r in S.key_sample(df.repartition(7), 0.3, ["k"], seed=1).collect()}
    assert a == b and 1200 < len(a) < 1800


def test_reward_rule(spark):
    rows = [(100.0, 0.5, 0, 1, 0, 0, 0), (100.0, 0.5, 1, 1, 0, 0, 0),
            (100.0, 0.5, 1, 1, 1, 0, 0), (100.0, 0.5, 1, 0, 1, 0, 0)]
    df = spark.createDataFrame(rows, "price double, action double, label int, prediction int, "
                                     "high_demand int, is_weekend int, hot_region int")
    df = df.withColumn("new_price", F.col("price") * F.col("action"))
    assert [r[0] for r in df.select(PR.reward()).collect()] == [200.0, -200.0, -50.0, -50.0]


def test_next_segment_and_best_action(spark):
    df = spark.createDataFrame([("lowdemand_weekday_hotregion", 1.0), ("lowdemand_weekend_nothotregion", 1.1)],
                               "segment string, action double")
    nxt = [r[0] for r in df.select(PR.next_segment(F.col("segment"), F.col("action"))).collect()]
    assert nxt == ["lowdemand_weekend_hotregion", "highdemand_weekday_nothotregion"]
    grid = spark.createDataFrame([("s", a, 1.0) for a in PR.ACTIONS], "segment string, action double, value double")
    assert PR.best_action(grid).collect()[0]["best_action"] == 0.5


def test_csv_reader_quotes_and_permissive(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text('a,b,c,d\n"say ""hi"", ok\nline2",bad-date,9999999999,2.5\n"plain",2024-01-02,7,8\n')
    df = io.read_csv_table(spark, str(p), "a STRING, b DATE, c INT, d INT")
    rows = df.collect()
    assert rows[0]["a"] == 'say "hi", ok\nline2'
    assert rows[0]["b"] is None and rows[0]["c"] is None and rows[0]["d"] is None
    assert rows[1]["c"] == 7 and str(rows[1]["b"]) == "2024-01-02"


def test_salted_join_equals_plain_join(spark):
    from hostlens.operators.joins import salted_join
    big_rows = [(i, "hot" if i % 3 == 0 else f"k{i % 50}") for i in range(3000)] + [(9999, "missing")]
    big = spark.createDataFrame(big_rows, "rid int, key string")
    small = spark.createDataFrame([("hot", 1.0)] + [(f"k{j}", float(j)) for j in range(50)], "id string, v double")
    plain = {tuple(r) for r in big.join(small, big["key"] == small["id"]).select("rid", "key", "v").collect()}
    salted = salted_join(big, small, "key", "id", "rid", hot_rows=500)
    got = salted.select("rid", "key", "v").collect()
    assert len(got) == len(plain) and {tuple(r) for r in got} == plain


def test_csv_compat_reader_and_reject_column(spark, tmp_path):
    p = tmp_path / "y.csv"
    p.write_text('a,b\n"say ""hi"", x\ny",1\n"ok",2\n"bad",zz\n')
    good = io.read_csv_table(spark, str(p), "a STRING, b INT").collect()
    assert [r["a"] for r in good] == ['say "hi", x\ny', "ok", "bad"]
    assert [r["b"] for r in good] == [1, 2, None]
    # the older reader (no escape option) does not keep the quoted field whole
    compat = io.read_csv_table(spark, str(p), "a STRING, b INT", escape=None).collect()
    assert compat[0]["a"] != 'say "hi", x\ny'
    # rejects can be counted through a corrupt-record column
    with_rejects = io.read_csv_table(spark, str(p), io_schema(), corrupt_column="_bad").cache()
    assert with_rejects.where(F.col("_bad").isNotNull()).count() == 1


def io_schema():
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    return StructType([StructField("a", StringType()), StructField("b", IntegerType())])


def test_correlation_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 0.0), (3.0, 0.0)], "a double, z double")
    cells = {(r["x"], r["y"]): r["r"] for r in A.correlation_matrix(df, ["a", "z"]).collect()}
    assert cells[("a", "z")] is None and cells[("z", "z")] is None and cells[("a", "a")] == pytest.approx(1.0)


def test_bounded_broadcast_falls_back_above_bound(spark):
    from hostlens.operators.joins import bounded_broadcast
    small = spark.range(10)
    side, is_bc = bounded_broadcast(small, max_rows=100)
    assert is_bc and side.count() == 10
    side, is_bc = bounded_broadcast(small, max_rows=5)
    assert not is_bc and side.count() == 10


def test_cluster_settings_sizes_partitions():
    from hostlens.session import cluster_settings
    conf = cluster_settings(100 * 2 ** 40, cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 2 ** 40 // (256 * 2 ** 20)
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(cluster_settings(10, cores=8)["spark.sql.shuffle.partitions"]) == 16


def test_lexicon_table_scores_like_the_mapping(spark):
    from hostlens.operators.text import sentiment_by_join, with_sentiment
    lexicon = {"good": 0.7, "bad": -0.5, "nice": 0.25}
    df = spark.createDataFrame([(1, "Good, not good and BAD bad."), (2, "never nice"), (3, None), (4, ""), (5, "nothing here"), (5, "nothing here"), (6, "nice " * 500)],
                               "id int, text string")
    want = sorted((r["id"], r["s"]) for r in with_sentiment(df, "text", lexicon, ["not", "never"], "s").collect())
    got = sorted((r["id"], r["s"]) for r in sentiment_by_join(df, "text", lexicon, ["not", "never"], "s").collect())
    assert [i for i, _ in got] == [i for i, _ in want]
    assert all(a == b or abs(a - b) < 1e-12 for (_, a), (_, b) in zip(got, want))
    large = lexicon | {f"w{i}": 0.1 for i in range(200)}  # joined by its size
    assert sorted((r["id"], r["s"] and round(r["s"], 9)) for r in with_sentiment(df, "text", large, ["not", "never"], "s").collect()) == [(i, s and round(s, 9)) for i, s in want]


def test_salts_follow_the_count_of_a_key(spark):
    from hostlens.operators.joins import salted_join
    big = spark.range(1000).selectExpr("'k' as key", "id as rid").unionByName(spark.range(5).selectExpr("'c' as key", "id + 2000 as rid"))
    small = spark.createDataFrame([("k", 1), ("c", 2), ("z", 3)], "id string, v int")
    got = salted_join(big, small, "key", "id", "rid", hot_rows=100)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert got.count() == 1005 and "sequence(0, (coalesce(" in plan
