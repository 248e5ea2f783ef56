"""Incremental calendar ingest: duplicates spread over several micro-batches
resolve to the same rows as cleaning everything at once."""

import pytest

from hostlens.plans.etl import clean_calendar
from hostlens.sources import io
from hostlens.streaming import current_calendar, ingest_calendar

ROWS_A = [("1", "2024-01-01", "t", "$10.00", None, 1, 3), ("1", "2024-01-02", "f", "$12.00", None, 1, 3),
          ("2", "2024-01-01", "x", "$1,000.00", None, 2, 5)]
ROWS_B = [("1", "2024-01-01", "f", "$9.00", None, 1, 3),      # same key as in drop A, smaller row
          ("2", "2024-01-01", "t", "$8.00", None, 2, 5), ("3", "2024-01-05", "t", "$20.00", None, 1, 1),
          (None, "2024-01-05", "t", "$20.00", None, 1, 1)]   # no listing id: dropped


def _frame(spark, rows):
    df = spark.createDataFrame(rows, "listing_id string, date string, available string, price string, "
                                     "adjusted_price boolean, minimum_nights int, maximum_nights int")
    return df.withColumn("date", df["date"].cast("date"))


def test_stream_equals_batch(spark, tmp_path):
    src, sink = tmp_path / "drops", tmp_path / "sink"
    io.write_csv(_frame(spark, ROWS_A).coalesce(1), str(src / "a"))
    io.write_csv(_frame(spark, ROWS_B).coalesce(1), str(src / "b"))
    q = ingest_calendar(spark, str(src / "*"), str(sink), checkpoint_dir=str(tmp_path / "ckpt"),
                        max_files_per_trigger=1)
    q.awaitTermination()
    assert len([p for p in sink.iterdir() if p.name.startswith("batch_id=")]) == 2
    got = current_calendar(spark, str(sink))
    want = clean_calendar(_frame(spark, ROWS_A + ROWS_B))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    rows = {(r["listing_id"], str(r["date"])): r for r in got.collect()}
    assert rows[("1", "2024-01-01")]["available"] is False and rows[("1", "2024-01-01")]["price"] == 9.0
    assert ("3", "2024-01-05") in rows and len(rows) == 4


def test_stream_restart_is_idempotent(spark, tmp_path):
    src, sink, ckpt = tmp_path / "drops", tmp_path / "sink", tmp_path / "ckpt"
    io.write_csv(_frame(spark, ROWS_A).coalesce(1), str(src / "a"))
    ingest_calendar(spark, str(src / "*"), str(sink), checkpoint_dir=str(ckpt)).awaitTermination()
    # a restart with no new files processes nothing new
    ingest_calendar(spark, str(src / "*"), str(sink), checkpoint_dir=str(ckpt)).awaitTermination()
    assert current_calendar(spark, str(sink)).count() == 3


def test_compaction_snapshot_plus_new_batches(spark, tmp_path):
    from hostlens.streaming import compact_calendar
    src, sink, ckpt, snaps = tmp_path / "drops", tmp_path / "sink", tmp_path / "ckpt", tmp_path / "snap"
    io.write_csv(_frame(spark, ROWS_A).coalesce(1), str(src / "a"))
    ingest_calendar(spark, str(src / "*"), str(sink), checkpoint_dir=str(ckpt)).awaitTermination()
    assert compact_calendar(spark, str(sink), str(snaps)) == 0
    io.write_csv(_frame(spark, ROWS_B).coalesce(1), str(src / "b"))
    ingest_calendar(spark, str(src / "*"), str(sink), checkpoint_dir=str(ckpt)).awaitTermination()
    want = clean_calendar(_frame(spark, ROWS_A + ROWS_B))
    for got in (current_calendar(spark, str(sink), str(snaps)), current_calendar(spark, str(sink))):
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert compact_calendar(spark, str(sink), str(snaps)) == 1
    (tmp_path / "emptied").mkdir()  # a sink whose batches, all covered by the snapshot, have been removed
    for folder in (sink, tmp_path / "emptied"):
        got = current_calendar(spark, str(folder), str(snaps))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_two_drops_across_a_restart(spark, tmp_path):
    src, sink, ckpt = tmp_path / "drops", tmp_path / "sink", tmp_path / "ckpt"
    io.write_csv(_frame(spark, ROWS_A).coalesce(1), str(src / "a"))
    ingest_calendar(spark, str(src / "*"), str(sink), str(ckpt)).awaitTermination()
    io.write_csv(_frame(spark, ROWS_B).coalesce(1), str(src / "b"))
    ingest_calendar(spark, str(src / "*"), str(sink), str(ckpt)).awaitTermination()
    got, want = current_calendar(spark, str(sink)), clean_calendar(_frame(spark, ROWS_A + ROWS_B))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    with pytest.raises(TypeError):
        ingest_calendar(spark, str(src / "*"), str(sink))


def test_unreadable_snapshot_is_an_error(spark, tmp_path):
    from hostlens.streaming import compact_calendar
    src, sink, snaps = tmp_path / "drops", tmp_path / "sink", tmp_path / "snap"
    io.write_csv(_frame(spark, ROWS_A).coalesce(1), str(src / "a"))
    ingest_calendar(spark, str(src / "*"), str(sink), str(tmp_path / "ckpt")).awaitTermination()
    assert current_calendar(spark, str(sink), str(snaps)).count() == 3  # none written yet
    (snaps / "upto=7").mkdir(parents=True)  # one that was never finished
    assert current_calendar(spark, str(sink), str(snaps)).count() == 3
    assert compact_calendar(spark, str(sink), str(snaps)) == 0
    for part in (snaps / "upto=0").glob("part-*"):
        part.write_bytes(b"broken")
    with pytest.raises(Exception):
        current_calendar(spark, str(sink), str(snaps)).count()
