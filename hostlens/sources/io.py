"""Readers and writers (CSV, Parquet, hive-partitioned Parquet).

Scratch output always goes below the cluster's shared checkpoint folder
(see :mod:`hostlens.session`), never to a machine-local temp folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import scratch_path


def read_csv_table(spark: SparkSession, path: str, schema: StructType | str, *,
                   multiline: bool = True, quote: str = '"', escape: str | None = '"',
                   mode: str = "PERMISSIVE", corrupt_column: str | None = None,
                   partitions: int | None = None) -> DataFrame:
    """CSV with a header row and a fixed schema.

    ``escape='"'`` reads doubled quotes inside quoted fields; ``escape=None``
    keeps Spark's backslash default (the older reader).  Multi-line files
    cannot be split, so they arrive as one task per file; ``partitions``
    spreads them out again (round robin) when the next step is CPU heavy.
    PERMISSIVE mode turns a field that does not fit its type into NULL.
    """
    reader = (spark.read.option("header", True).option("multiLine", multiline)
              .option("quote", quote).option("mode", mode))
    if escape is not None:
        reader = reader.option("escape", escape)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        if isinstance(schema, StructType):
            schema = StructType(schema.fields + [StructField(corrupt_column, StringType(), True)])
        else:
            schema = f"{schema}, {corrupt_column} STRING"
    df = reader.schema(schema).csv(path)
    if partitions:
        df = df.repartition(partitions)
    return df


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, in whichever store that is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def own_session(spark: SparkSession, **settings: str) -> SparkSession:
    """A session beside ``spark`` with its settings and ``settings``; tables and cluster are shared."""
    own = spark.newSession()
    for k, v in {**spark.conf.getAll, **settings}.items():
        if own.conf.isModifiable(k):
            own.conf.set(k, v)
    return own


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> str:
    """CSV with header; quotes doubled so the reader above round-trips text."""
    (df.write.mode(mode).option("header", True).option("quote", '"')
       .option("escape", '"').csv(path))
    return path


def write_parquet(df: DataFrame, path: str, *, compression: str = "lz4",
                  mode: str = "overwrite") -> str:
    df.write.parquet(path, mode=mode, compression=compression)
    return path


def write_partitioned(df: DataFrame, path: str, columns: list[str], *,
                      mode: str = "overwrite", compression: str = "lz4") -> str:
    """Hive-style ``col=value/`` folders, one level per column.

    A rebalance on the columns comes first: rows of a folder meet in few
    tasks, and AQE splits a large folder's rows into files of the advisory
    size, instead of one small file per task and folder.
    """
    df.hint("rebalance", *columns).write.partitionBy(*columns).parquet(path, mode=mode, compression=compression)
    return path


def read_segment(spark: SparkSession, root: str, **flags: int) -> DataFrame:
    """One segment of a partitioned table, e.g. ``high_demand=1, is_weekend=0``.

    Reads the root once and filters on the partition columns, so Catalyst
    prunes folders (``PartitionFilters``) and the columns stay in the result.
    """
    df = spark.read.parquet(root)
    for name, value in flags.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def parquet_roundtrip(df: DataFrame, name: str, *, compression: str = "lz4") -> DataFrame:
    """Write ``df`` to a fresh shared scratch folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    write_parquet(df, path, compression=compression)
    return df.sparkSession.read.parquet(path)


def csv_roundtrip(df: DataFrame, name: str, schema: StructType | str, **read_options) -> DataFrame:
    """Write ``df`` as CSV to shared scratch and read it back with ``schema``.

    A file of multi-line CSV is read by one task, so the rows are first dealt out to files of the advisory
    partition size: however few partitions ``df`` has, no file grows with the table.
    """
    path = scratch_path(df.sparkSession, name)
    write_csv(df.hint("rebalance"), path)
    return read_csv_table(df.sparkSession, path, schema, **read_options)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan over the cluster only when it arrived in fewer
    partitions than ``min_partitions`` (default: default parallelism).

    A text table stored as a few large row groups would otherwise run its
    CPU-heavy per-row work (regex filters, tokenizing) on a few cores; a
    large, well-split table is returned unchanged (no shuffle).
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df
