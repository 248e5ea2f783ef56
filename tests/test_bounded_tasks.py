"""However few partitions the rows come in, no task is given a share that grows with the table."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hostlens.operators import ml as ML
from hostlens.plans import catalog as cat
from hostlens.plans import occupancy_models as OM
from hostlens.plans import price_model as PM
from hostlens.plans.etl import clean_calendar
from hostlens.sources import bindings as B
from hostlens.sources import io


def _tables(spark, root):
    """Reviews, listings and nights, each table one file of one row group."""
    rng = random.Random(3)
    text = lambda: f"x{''.join(rng.choice('abcdefgh ijkl\n,"') for _ in range(3000))}x"
    docs = [(i, text() if i % 50 else None) for i in range(1500)]
    parts = [(i, f"{rng.random()} {rng.random()}", f"Brand#{i % 7}", f'TYPE "{rng.random()}", {rng.random()}', i % 50, 900.0 + i) for i in range(15000)]
    nights = [(rng.randrange(40), 1 + i % 7, float(i % 50), 100.0 * (i % 13), "ARN"[i % 3], f"199{i % 9}-0{1 + i % 9}-11 00:00:00") for i in range(2000)]
    for name, rows, ddl in (("documents", docs, "doc_id long, text string"),
                            ("part", parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
                            ("lineitem", nights, "l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate string")):
        df = spark.createDataFrame(rows, ddl)
        if name == "lineitem":
            df = df.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz"))
        df.coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return str(root)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    return _tables(spark, tmp_path_factory.mktemp("tables"))


@pytest.fixture
def written(monkeypatch):
    """The folders that CSV files were written to."""
    paths, write = [], io.write_csv
    monkeypatch.setattr(io, "write_csv", lambda df, path, **k: paths.append(write(df, path, **k)) or path)
    return paths


def _same(a, b):
    assert a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("key", ["csv_split_multiline", "csv_split_quoted", "csv_scan_plain", "csv_scan_quoted"])
def test_csv_files_stay_small(spark, tables, written, key):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(size)
    spark.conf.set(size, "200k")
    try:
        got = cat.QUERIES[key](spark, tables)
        raw = (B.listings_raw if key.endswith("quoted") else B.reviews_raw)(spark, tables)
        _same(got, raw)
    finally:
        spark.conf.set(size, old)
    sizes = [p.stat().st_size for p in Path(written[0]).glob("part-*")]
    assert sum(sizes) > 2_000_000 and max(sizes) < sum(sizes) / 3


def test_more_drops_files_not_larger_ones(spark, tables, written, monkeypatch):
    monkeypatch.setattr(cat, "ROWS_PER_FILE", 150, raising=False)
    _same(cat.QUERIES["calendar_stream_ingest"](spark, tables), clean_calendar(B.calendar_raw(spark, tables)))
    rows = [len(p.read_text().splitlines()) - 1 for p in Path(written[0]).glob("part-*")]
    assert sum(rows) == 2000 and max(rows) <= 160


class _Forest:
    """Stands in for the pipeline and keeps the numbers of rows of the partitions it is fitted on."""

    def fit(self, train):
        self.sizes = [r["count"] for r in train.groupBy(F.spark_partition_id()).count().collect()]


def _training_rows(spark, n):
    df = spark.range(n).withColumn("label", (F.col("id") % 2).cast("int"))
    return df.withColumns({c: F.lit("x") for c in OM.CATEGORICAL + PM.CATEGORICAL} | {c: F.lit(1.0) for c in OM.NUMERIC + PM.NUMERIC}).coalesce(1)


@pytest.mark.parametrize("fit,stages", [(OM.fit_segment, "occupancy_classifier_stages"), (PM.fit_price_model, "price_regression_stages")])
def test_forests_train_on_partitions_of_bounded_rows(spark, monkeypatch, fit, stages):
    forest = _Forest()
    monkeypatch.setattr(ML, "ROWS_PER_TASK", 100, raising=False)
    monkeypatch.setattr(ML, stages, lambda *a, **k: forest)
    fit(_training_rows(spark, 1200))
    assert sum(forest.sizes) == 1200 and max(forest.sizes) <= 130
    fit(_training_rows(spark, 90))
    assert forest.sizes == [90]


def test_spread_rows_keeps_every_row(spark):
    df = spark.createDataFrame([(i % 3, None if i % 5 else "x") for i in range(500)], "a int, b string").coalesce(1)
    got = ML.spread_rows(df, 60)
    assert got.exceptAll(df).count() == 0 and got.count() == 500
    assert ML.spread_rows(df, 500) is df and ML.spread_rows(df.limit(0), 5).count() == 0


def test_statistics_of_a_forests_nodes_leave_room_for_its_rows(spark):
    for forest in (ML.price_regression_stages(["a"], ["b"], "y"), ML.occupancy_classifier_stages(["a"], ["b"])):
        assert forest.getStages()[-1].getMaxMemoryInMB() <= 64  # a task; an executor of 3000 MB has two and the rows


def test_price_forest_in_several_passes_a_level_is_grown_whole(spark, monkeypatch):
    rows = spark.range(600).withColumn(PM.LABEL, sum((F.col("id") * (i + 3)) % 31 for i in range(3)).cast("double"))
    rows = rows.withColumns({c: ((F.col("id") * (i + 3)) % 31).cast("double") for i, c in enumerate(PM.NUMERIC)} | {c: F.concat(F.lit("x"), (F.col("id") % (i + 2)).cast("string")) for i, c in enumerate(PM.CATEGORICAL)})
    trees = {}
    for mb in (64, 0):
        monkeypatch.setitem(ML.FOREST_TRAINING, "maxMemoryInMB", mb)  # 0: each node has a pass of its own
        model = PM.fit_price_model(rows, trees=2, depth=5)
        trees[mb] = model.stages[-1]
        assert ML.regression_metrics(model.transform(ML.as_double(rows, PM.NUMERIC)), PM.LABEL)["r2"] > 0.3
    assert [t.depth for t in trees[0].trees] == [t.depth for t in trees[64].trees] == [5, 5]
    assert trees[0].totalNumNodes > 0.7 * trees[64].totalNumNodes
