"""Tables published whole, the panel continued by drops, and tables in buckets."""

import os

import pytest
from pyspark.sql import functions as F

from hostlens.plans import catalog as CT
from hostlens.plans import occupancy as occ
from hostlens.plans import occupancy_append
from hostlens.session import materialize
from hostlens.sources import bindings as B
from hostlens.sources import layout, versions

SF = "/root/testdata/sf0.001"


def same_rows(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path / "table")
    assert versions.folder_of(spark, root) is None
    with pytest.raises(ValueError):
        versions.read(spark, root)
    good = spark.range(100).withColumn("x", F.col("id") % 7)
    assert versions.publish(good, root, ["x"]) == 1
    held = versions.read(spark, root)
    # some tasks have written their files when another one fails
    bad = spark.range(0, 1000, 1, 8).withColumn("x", F.when(F.col("id") == 999, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        versions.publish(bad, root)
    assert len(os.listdir(f"{root}/_data")) == 2
    assert same_rows(good, versions.read(spark, root)) and versions.versions(spark, root).count() == 1
    assert versions.publish(good.where("id < 10"), root) == 2
    assert versions.read(spark, root).count() == 10
    # a reader that has begun keeps to its version, and old ones can be asked for
    assert same_rows(good, held) and same_rows(good, versions.read(spark, root, 1))
    with pytest.raises(ValueError):
        versions.read(spark, root, 3)


def test_a_failed_model_save_and_plain_paths(spark, tmp_path):
    root = str(tmp_path / "model")
    versions.publish_with(spark, root, lambda to: spark.range(3).write.parquet(f"{to}/part"))

    def fail(to):
        spark.range(5).write.parquet(f"{to}/part")
        raise OSError("disk full")

    with pytest.raises(OSError):
        versions.publish_with(spark, root, fail)
    assert spark.read.parquet(f"{versions.resolved(spark, root)}/part").count() == 3
    plain = str(tmp_path / "plain")
    spark.range(4).write.parquet(plain)
    assert versions.resolved(spark, plain) == plain


def test_empty_tables_can_be_published(spark, tmp_path):
    root = str(tmp_path / "empty")
    versions.publish(spark.range(0), root)
    assert versions.read(spark, root).count() == 0 and versions.read(spark, root).columns == ["id"]


@pytest.fixture(scope="module")
def tables(spark):
    return [materialize(t(spark, SF)).coalesce(2) for t in (CT.listings_clean, CT.calendar_clean)]


def drops(spark, root, cuts, tables):
    listings, calendar = tables
    late = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        part = calendar.where((F.col("date") > F.lit(a).cast("date")) & (F.col("date") <= F.lit(b).cast("date")))
        late.append(occupancy_append.append(spark, root, listings, part, B.PANEL_START, B.PANEL_END))
    return late


def whole(tables, cut):
    return CT.rounded(occ.occupancy_panel(*tables, start=B.PANEL_START, end=B.PANEL_END, hot_cut=cut))


def test_panel_of_drops_equals_the_panel_of_their_union(spark, tmp_path, tables):
    cuts = ["1900-01-01", "1996-10-31", "1996-10-31", "1997-11-11", "2100-01-01"]  # the second drop is empty
    assert drops(spark, str(tmp_path), cuts, tables) == [0] * 4
    for cut in (None, 0.4):
        assert same_rows(whole(tables, cut), CT.rounded(occupancy_append.read_panel(spark, str(tmp_path), cut)))
    # days that have been appended already are set aside and counted
    n = occupancy_append.read_panel(spark, str(tmp_path), 0.4).count()
    assert drops(spark, str(tmp_path), ["1900-01-01", "2100-01-01"], tables) == [n]
    assert same_rows(whole(tables, 0.4), CT.rounded(occupancy_append.read_panel(spark, str(tmp_path), 0.4)))


def test_a_drop_reads_no_old_day_and_repeats_after_a_failure(spark, tmp_path, monkeypatch, tables):
    cuts = ["1900-01-01", "1997-06-30", "2100-01-01"]
    root = str(tmp_path)
    drops(spark, root, cuts[:2], tables)
    read = []
    plain = spark.read.__class__.parquet
    monkeypatch.setattr(spark.read.__class__, "parquet", lambda self, *paths, **o: (read.extend(paths), plain(self, *paths, **o))[1])
    old = versions.folder_of(spark, f"{root}/days")
    publish = versions.publish

    def failing(df, to, *a):
        if to.endswith("/regions"):
            raise OSError("lost")
        return publish(df, to, *a)

    monkeypatch.setattr(versions, "publish", failing)
    with pytest.raises(OSError):
        drops(spark, root, cuts[1:], tables)
    monkeypatch.setattr(versions, "publish", publish)
    before = occupancy_append.read_panel(spark, root, 0.4).count()
    read.clear()
    drops(spark, root, cuts[1:], tables)
    assert read and not [p for p in read if p.startswith(old)]
    monkeypatch.undo()
    got = occupancy_append.read_panel(spark, root, 0.4)
    assert got.count() > before and same_rows(whole(tables, 0.4), CT.rounded(got))


def bucketed(spark, tmp_path, tables, buckets=8):
    layout.write_bucketed(tables[0], str(tmp_path / "listings"), "id", buckets)
    layout.write_bucketed(tables[1], str(tmp_path / "calendar"), "listing_id", buckets, ["date"])
    return [layout.open_table(spark, str(tmp_path / x)) for x in ("listings", "calendar")]


@pytest.mark.parametrize("threshold", ["-1", "64m"])
def test_buckets_need_no_exchange_between_scan_and_window(spark, tmp_path, threshold, tables):
    listings, calendar = bucketed(spark, tmp_path, tables)
    assert same_rows(tables[0], listings) and same_rows(tables[1], calendar)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        days = occ.with_running_occupancy(occ.rental_days(listings, calendar, B.PANEL_START, B.PANEL_END))
        plan = plan_of(days)
        assert "Window" in plan and "Bucketed: true" in plan and "Exchange hashpartitioning" not in plan
        plain = occ.with_running_occupancy(occ.rental_days(*tables, B.PANEL_START, B.PANEL_END))
        assert "Exchange hashpartitioning(id" in plan_of(plain) or "Exchange hashpartitioning(listing_id" in plan_of(plain)
        assert same_rows(CT.rounded(plain), CT.rounded(days))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_later_session_opens_the_buckets(spark, tmp_path, tables):
    bucketed(spark, tmp_path, tables, buckets=4)
    files = [f for f in os.listdir(tmp_path / "calendar") if f.endswith(".parquet")]
    assert len(files) == 4  # one a bucket
    path = str(tmp_path / "calendar")
    for t in spark.catalog.listTables():
        if t.name.startswith("hostlens_"):
            spark.sql(f"DROP TABLE {t.name}")
    again = layout.open_table(spark, path)
    assert "Exchange" not in plan_of(again.groupBy("listing_id").count()) and same_rows(tables[1], again)
    plain = str(tmp_path / "plain")
    spark.range(4).write.parquet(plain)
    assert layout.open_table(spark, plain).count() == 4
    assert [layout.buckets_for(x << 20) for x in (0, 256, 257, 1025)] == [1, 1, 2, 8]
