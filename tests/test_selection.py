"""Medians by selection, label indices as a table, frequent terms by summary and recount."""

import math
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from hostlens.operators import label_index as LI
from hostlens.operators import selection, vocabulary

NAN, INF = float("nan"), float("inf")


def medians(df, value, by):
    return {tuple(r[:-1]): r[-1] for r in df.groupBy(*by).agg(F.median(value)).where(F.col(f"median({value})").isNotNull()).collect()}


@pytest.mark.parametrize("bins", [9, 1024])
def test_exact_median_equals_the_buffered_one(spark, bins):
    rng = random.Random(bins)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2]), rng.choice([rng.uniform(-9, 9), 3.0, 3.0, -0.0, 0.0, None, 1e300, -1e300, 5e-324])) for _ in range(300)]
    rows += [("one", 1, 2.5), ("none", 1, None), ("ties", 1, 4.0), ("ties", 1, 4.0), ("even", 1, 1.0), ("even", 1, 2.0),
             ("next", 1, 1.0), ("next", 1, math.nextafter(1.0, 2)), ("next", 1, math.nextafter(1.0, 0)),
             ("wide", 1, 1.7e308), ("wide", 1, -1.7e308), ("wide", 1, 3.0), ("wide", 1, 4.0), ("wide", 1, 4.5)]
    df = spark.createDataFrame(rows, "g string, h int, x double").repartition(5)
    for by in (["g", "h"], []):
        got = {tuple(r[:-1]): r[-1] for r in selection.exact_median(df, "x", by, bins=bins).collect()}
        assert got == medians(df, "x", by)


def test_exact_median_of_infinite_values_hot_groups_and_nothing(spark):
    rows = [("a", x) for x in (-INF, -INF, 1.0, INF, NAN)] + [("b", x) for x in (INF, INF, 2.0)] + [("c", NAN), ("d", -INF), ("d", 0.0), ("d", 7.0)]
    df = spark.createDataFrame([*rows, *[("hot", float(i % 1000)) for i in range(50_000)]], "g string, x double")
    got = {r["g"]: r["median"] for r in selection.exact_median(df, "x", ["g"]).collect()}
    assert math.isnan(got.pop("c")) and got == {"a": 1.0, "b": INF, "d": 0.0, "hot": 499.5}
    assert selection.exact_median(df.limit(0), "x", ["g"]).count() == 0 and selection.exact_median(df.limit(0), "x").first()["median"] is None
    assert selection.exact_median(df.where("g = 'hot'").select(F.col("x").cast("int").alias("x")), "x").first()["median"] == 499.5


def test_median_of_a_column_of_any_size(spark):
    from hostlens.operators.aggregates import median_of

    df = spark.range(1001).selectExpr("cast(id * id % 613 as double) x")
    assert median_of(df, "x") == median_of(df, "x", small=10) == df.agg(F.median("x")).first()[0]
    assert median_of(df.limit(0), "x") is None and median_of(df.limit(0), "x", small=-1) is None


def labels(spark):
    rng = random.Random(3)
    values = [f"l{int(rng.paretovariate(0.6)) % 400}" for _ in range(3000)] + ["tie1", "tie2", "Tie3", "é", ""] * 4 + [None] * 7
    return spark.createDataFrame([(i, v, "x" if i % 3 else None) for i, v in enumerate(values)], "id int, c string, d string").repartition(6)


def test_label_table_gives_the_indexers_numbers(spark):
    df = labels(spark)
    for mode in ("keep", "skip"):
        want = StringIndexer(inputCols=["c", "d"], outputCols=["c_index", "d_index"], handleInvalid=mode).fit(df).transform(df)
        got = LI.index_by_table(df, ["c", "d"], handle_invalid=mode).select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert LI.label_table(df.limit(0), "c").count() == 0


def test_unseen_labels_fail_or_are_kept(spark):
    df = labels(spark)
    tables = {"c": LI.label_table(df, "c")}
    new = spark.createDataFrame([(1, "l1", "x"), (2, "never seen", "x")], df.schema)
    kept = {r["id"]: r["c_index"] for r in LI.index_by_table(new, ["c"], tables=tables).collect()}
    assert kept[2] == tables["c"].count() and kept[1] < kept[2]
    with pytest.raises(Exception, match="unseen label in c: never seen"):
        LI.index_by_table(new, ["c"], handle_invalid="error", tables=tables).collect()


def test_bounded_indexers_refuse_before_they_collect(spark, monkeypatch):
    df = labels(spark)
    n = df.select("c").where("c is not null").distinct().count()
    for mode, most in (("keep", n + 1), ("error", n)):
        models = LI.bounded_indexers(df, ["c", "d"], most, handle_invalid=mode)
        want = StringIndexer(inputCols=["c", "d"], outputCols=["c_index", "d_index"], handleInvalid="skip").fit(df)
        assert [list(m.labels) for m in models] == [list(x) for x in want.labelsArray]
    rows, frame = [], type(df)
    plain = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: (rows.append(plain(self)), rows[-1])[1])
    with pytest.raises(ValueError, match="column c has more than 20"):
        LI.bounded_indexers(df, ["c"], 20)
    assert [len(r) for r in rows] == [20]
    assert [m.labels for m in LI.bounded_indexers(df.limit(0), ["c"], 5)] == [[]]


def draw_docs(spark, seed, n, groups, vocab):
    rng = random.Random(seed)
    rows = [(rng.choice(groups), [f"t{int(rng.paretovariate(0.7)) % vocab}" for _ in range(rng.randint(0, 30))]) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "g string, toks array<string>").repartition(7)


def top_of(rows, k):
    out = set()
    for g in {r[0] for r in rows}:
        c = Counter(t for r in rows if r[0] == g for t in r[1])
        out |= {(g, t, n) for t, n in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:k]}
    return out


@pytest.mark.parametrize("size,k", [(3, 2), (12, 10), (40, 20), (5000, 20)])
def test_frequent_terms_equal_full_counts(spark, size, k):
    rows, df = draw_docs(spark, size, 600, ["a", "b", None, "c"], 900)
    got = {tuple(r) for r in vocabulary.frequent_terms(df, "g", "toks", k, size=size, widen=4, spread=3).collect()}
    assert got == top_of(rows, k)


def test_flat_counts_widen_until_all_terms_are_held(spark):
    rows = [("g", [f"t{i:03d}"]) for i in range(300) for _ in range(3)] + [("none", []), ("null", [])]
    df = spark.createDataFrame(rows, "g string, toks array<string>").repartition(4)
    got = sorted(tuple(r) for r in vocabulary.frequent_terms(df, "g", "toks", 5, size=10).collect())
    assert got == [("g", f"t{i:03d}", 3) for i in range(5)]
    assert vocabulary.frequent_terms(df.limit(0), "g", "toks", 5).count() == 0


def test_summaries_bound_what_they_leave_out():
    rng = random.Random(8)
    size, held, error, true = 9, pa.table({"term": pa.array([], pa.string()), "n": pa.array([], pa.int64())}), 0, Counter()
    for _ in range(60):
        batch = Counter(f"t{int(rng.paretovariate(0.8)) % 60}" for _ in range(rng.randint(1, 80)))
        true.update(batch)
        new = pa.table({"term": pa.array(list(batch)), "n": pa.array(list(batch.values()), pa.int64())})
        held, error = vocabulary.shrunk(vocabulary._added([held, new]), error, size)
        low = dict(zip(held["term"].to_pylist(), held["n"].to_pylist(), strict=True))
        assert len(low) <= size and all(low.get(t, 0) <= n <= low.get(t, 0) + error for t, n in true.items())
