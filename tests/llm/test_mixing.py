"""Source targets and balanced sampling."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from hostlens.llm import mixing, queries

SF = "/root/testdata/sf0.01"


def by_resharing(sizes, weights=(5, 2, 1), most=3.0):
    """Targets by the words of the contract: share by weight, stop at the cap, reshare the excess."""
    names = sorted(k for k in sizes if k is not None) + [k for k in sizes if k is None]
    w = {k: weights[i % len(weights)] for i, k in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        level = left / sum(w[k] for k in free)
        over = {k for k in free if level * w[k] > most * sizes[k]}
        if not over:
            target |= {k: level * w[k] for k in free}
            break
        for k in over:
            target[k] = most * sizes[k]
            left -= target[k]
        free -= over
    return target


def test_op5_meets_its_targets_and_agrees_with_itself(spark):
    rows = queries.op5_cube_mix(spark, SF).collect()
    texts = {r.doc_id: (r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    size, taken, target, largest = {}, {}, {}, {}
    for r in rows:
        text, s = texts[r.doc_id]
        assert r.size == len((text or "").encode().split()) and r.source == s
        assert r.taken == r.copies * r.size <= 3 * r.size
        size[s], taken[s] = size.get(s, 0) + r.size, taken.get(s, 0) + r.taken
        target[s], largest[s] = r.target, max(largest.get(s, 0), r.size)
    want = by_resharing(size)
    for s in size:
        assert target[s] == pytest.approx(want[s]) and {r.source_size for r in rows if r.source == s} == {size[s]}
        assert abs(taken[s] - target[s]) <= largest[s]
        f = target[s] / size[s]
        assert all(int(np.floor(f)) <= r.copies <= int(np.ceil(f)) for r in rows if r.source == s)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    again = queries.op5_cube_mix(spark, SF).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert {(r.doc_id, r.taken) for r in again} == {(r.doc_id, r.taken) for r in rows}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=0, max_size=60), st.integers(0, 2**32), st.floats(0.01, 0.99))
def test_flight_keeps_both_totals(sizes, seed, p):
    size, start = np.array(sizes, float), np.full(len(sizes), p)
    end = mixing.flight(size, start, np.random.default_rng(seed))
    assert ((end >= 0) & (end <= 1)).all() and ((end > 0) & (end < 1)).sum() <= 2
    assert end.sum() == pytest.approx(start.sum(), abs=1e-5) and end @ size == pytest.approx(start @ size, abs=1e-4)
    landed = mixing.landing(size, end, float(end @ size * 0 + (end * size)[(end > 0) & (end < 1)].sum()))
    assert set(landed.tolist()) <= {0.0, 1.0}
    assert abs(landed @ size - start @ size) <= (2 * size.max() if len(size) else 0)


def test_flight_respects_inclusion_probabilities():
    rng, size = np.random.default_rng(0), np.arange(1.0, 13)
    hits = sum(mixing.flight(size, np.full(12, 0.3), np.random.default_rng(rng.integers(2**32))) for _ in range(3000)) / 3000
    assert np.abs(hits - 0.3).max() < 0.04


def test_hot_source_over_many_blocks_and_odd_rows(spark):
    rows = [(i, "w " * (i % 37), "hot" if i % 3 else f"s{i % 5}", 1) for i in range(3000)]
    rows += [(None, "a b", None, 1), (None, None, None, 1), (7, "a b c", None, 2), (7, "a b c", None, 2), (8, "", "empty", 0), (9, "x" * 100_000, "long", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target int")
    got = mixing.balanced_mix(df, block=64).collect()
    assert len(got) == len(rows)
    size, taken = {}, {}
    for r in got:
        size[r.source], taken[r.source] = size.get(r.source, 0) + r.size, taken.get(r.source, 0) + r.taken
    want = by_resharing(size)
    for s in size:
        assert abs(taken[s] - want[s]) <= max(r.size for r in got if r.source == s)
    assert [r.target for r in got if r.source == "empty"] == [0.0]
    assert mixing.balanced_mix(df.limit(0)).count() == 0
    assert mixing.balanced_mix(df.where("source = 'empty'")).first().taken == 0


def test_rows_without_an_id_are_dealt_over_blocks_and_reruns_agree(spark):
    """A third of all rows is one row; however the table is partitioned, the same rows are taken as often."""
    rows = [(None, "a b c", "hot")] * 2000 + [(i, "w " * (i % 50 + 1), "hot" if i % 2 else "cold") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = []
    for parts in (1, 5):
        out = mixing.balanced_mix(df.repartition(parts), block=128)
        taken.append(sorted(map(str, out.groupBy("doc_id", "source", "size", "copies").count().collect())))
    assert taken[0] == taken[1]
    for parts in (1, 4):
        marked = df.repartition(parts).select(F.xxhash64("doc_id", "text", "source").alias("h"), F.spark_partition_id().alias("part"))
        got = mixing.numbered(spark.createDataFrame(marked.collect(), marked.schema))
        per = got.groupBy("h").agg(F.count("*").alias("n"), F.countDistinct("copy").alias("kinds"), F.max("copy").alias("last"))
        assert got.count() == 6000 and per.where("n <> kinds or last <> n - 1").count() == 0
        blocks = got.groupBy(F.pmod(F.xxhash64("h", "copy"), F.lit(32))).count().agg(F.max("count")).first()[0]
        assert blocks < 2 * 6000 / 32
