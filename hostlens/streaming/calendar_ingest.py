"""Calendar CSV drops -> cleaned calendar, one micro-batch at a time.

Each micro-batch is cleaned with the batch job's own steps and written to
``<sink>/batch_id=<n>`` with overwrite, so a retried batch replaces its own
output (exactly-once with the checkpointed source offsets).  Deduplication
keeps the smallest row per (listing_id, date); that rule is associative, so
deduplicating the union of already-deduplicated batches at read time gives
exactly the result of cleaning all files at once.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from ..operators.clean import dedup
from ..plans.etl import clean_calendar
from ..sources.schemas import CALENDAR_RAW


def ingest_calendar(spark: SparkSession, source_dir: str, sink_dir: str,
                    checkpoint_dir: str, available_now: bool = True,
                    max_files_per_trigger: int | None = None):
    """Start the ingest; with ``available_now`` it processes what is there
    and stops (call ``awaitTermination``).

    ``checkpoint_dir`` belongs to the sink for good: it numbers the batches,
    and a restart with another one would number them from 0 again and replace
    earlier batches.
    """
    reader = (spark.readStream.schema(CALENDAR_RAW).option("header", True)
              .option("multiLine", False).option("escape", '"'))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(source_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        clean_calendar(batch).write.mode("overwrite").parquet(os.path.join(sink_dir, f"batch_id={batch_id}"))

    writer = (raw.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def _latest_snapshot(spark: SparkSession, snapshot_dir: str | None):
    """The newest whole snapshot (its folder holds ``_SUCCESS``) and the batch it
    reaches to.  Only an absent folder means that there is none; a snapshot
    that cannot be read is an error."""
    if not snapshot_dir:
        return None, None
    path = spark._jvm.org.apache.hadoop.fs.Path(snapshot_dir)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None, None
    tags = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    whole = [int(t[len("upto="):]) for t in tags if t.startswith("upto=")
             and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{snapshot_dir}/{t}/_SUCCESS"))]
    if not whole:
        return None, None
    return spark.read.parquet(os.path.join(snapshot_dir, f"upto={max(whole)}")), max(whole)


def current_calendar(spark: SparkSession, sink_dir: str, snapshot_dir: str | None = None) -> DataFrame:
    """The cleaned calendar over every batch written so far.

    With ``snapshot_dir``: the latest compacted snapshot plus only the
    batches written after it (older batch folders are no longer read).
    """
    snap, upto = _latest_snapshot(spark, snapshot_dir)
    if snap is None:
        staged = spark.read.parquet(sink_dir)
    else:  # the batches up to the snapshot may be gone, all of them even
        staged = spark.read.schema(StructType(snap.schema.fields).add("batch_id", IntegerType())).parquet(sink_dir).where(F.col("batch_id") > upto)
    rows = staged.drop("batch_id")
    if snap is not None:
        rows = snap.unionByName(rows)
    return dedup(rows, ["listing_id", "date"])


def compact_calendar(spark: SparkSession, sink_dir: str, snapshot_dir: str) -> int:
    """Write the current table as a snapshot tagged with the last batch it
    covers (``<snapshot_dir>/upto=<batch>``) and return that batch id.

    Deduplication keeps the smallest row per key, which is associative, so
    snapshot + later batches gives the same table as all batches; nothing is
    deleted here -- batch folders up to the snapshot may be removed later.
    """
    upto = spark.read.parquet(sink_dir).agg(F.max("batch_id")).first()[0]
    if upto is None:
        return -1
    # batches after `upto` may be landing while we compact: leave them out so
    # the tag is exact
    staged = spark.read.parquet(sink_dir).where(F.col("batch_id") <= upto)
    snap, prev = _latest_snapshot(spark, snapshot_dir)
    if snap is not None:
        staged = staged.where(F.col("batch_id") > prev)
    rows = staged.drop("batch_id")
    if snap is not None:
        rows = snap.unionByName(rows)
    table = dedup(rows, ["listing_id", "date"])
    table.write.mode("overwrite").parquet(os.path.join(snapshot_dir, f"upto={upto}"))
    return int(upto)
