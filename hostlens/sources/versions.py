"""Tables and models that are replaced whole.

``mode="overwrite"`` removes the old table first, so a failed job leaves none and a reader in between sees half
of one. Here every version is written to a folder of its own below ``<root>/_data`` and named in the manifest
``<root>/_manifest`` only when it is complete. The manifest is a Parquet table that grows by one file of one row a
version, which appears by a single rename. A reader takes the newest version (or the one it asks for) and keeps
to that folder, whatever is published meanwhile. Nothing is deleted.

One writer at a time: of two that publish the same number the folder name decides, and the other is lost.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import io

MANIFEST = "version long, folder string, at timestamp"


def versions(spark: SparkSession, root: str) -> DataFrame:
    """version, folder, at: one row per published version; empty if there is none."""
    if not io.exists(spark, f"{root}/_manifest"):
        return spark.createDataFrame([], MANIFEST)
    rows = spark.read.schema(MANIFEST).parquet(f"{root}/_manifest")
    return rows.groupBy("version").agg(F.max_by(F.struct("folder", "at"), "folder").alias("x")).select("version", "x.folder", "x.at")


def publish_with(spark: SparkSession, root: str, write: Callable[[str], object]) -> int:
    """``write(folder)`` writes a version (a table, a model); it counts once that has come to its end."""
    folder = f"_data/{uuid.uuid4().hex}"
    write(f"{root}/{folder}")
    number = (versions(spark, root).agg(F.max("version")).first()[0] or 0) + 1
    row = spark.range(1).select(F.lit(number).cast("long").alias("version"), F.lit(folder).alias("folder"), F.current_timestamp().alias("at"))
    row.coalesce(1).write.mode("append").parquet(f"{root}/_manifest")
    return number


def publish(df: DataFrame, root: str, partition_by: Sequence[str] = (), compression: str = "lz4") -> int:
    """Write ``df`` as the next version of the table at ``root``; the number of that version."""
    return publish_with(df.sparkSession, root, lambda folder: df.write.partitionBy(*partition_by).parquet(folder, compression=compression))


def folder_of(spark: SparkSession, root: str, version: int | None = None) -> str | None:
    """The folder of a version (of the newest one); None if nothing has been published at ``root``."""
    rows = versions(spark, root)
    row = (rows.where(F.col("version") == version) if version is not None else rows.orderBy(F.desc("version"))).first()
    if row is None and version is not None:
        raise ValueError(f"{root} has no version {version}")
    return None if row is None else f"{root}/{row['folder']}"


def resolved(spark: SparkSession, path: str) -> str:
    """The newest version's folder, or the path itself if it isn't a versioned table."""
    return folder_of(spark, path) or path


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The newest version of a table, or the one asked for."""
    folder = folder_of(spark, root, version)
    if folder is None:
        raise ValueError(f"nothing has been published at {root}")
    return spark.read.parquet(folder)
