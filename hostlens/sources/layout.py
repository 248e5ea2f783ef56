"""Tables stored in buckets of a key, so that joins and windows on it need no exchange.

A bucketed table's files carry their bucket's number in their names; what the files don't carry (key, number of
buckets, sort order) Spark keeps in its catalog only. It is written beside the table, in ``<path>/_layout``, so
that a later session, without a shared catalog, can open the table with its buckets again.

Two tables with the same number of buckets meet bucket by bucket. The number is chosen once, so it must suit the
table as it will be: about as many as give buckets of 256 MB (see ``buckets_for``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from . import io

LAYOUT = "key string, buckets int, sort array<string>, columns string"


def buckets_for(table_bytes: int, bucket_mb: int = 256) -> int:
    """A power of two, so that tables of different sizes can still be read together (Spark coalesces the larger's)."""
    return 1 << max(0, -(-table_bytes // (bucket_mb << 20)) - 1).bit_length()


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, sort: Sequence[str] = ()) -> str:
    """Write ``df`` in ``buckets`` buckets of ``key``, one file each, sorted by ``key`` and ``sort``. ``path`` is new."""
    spark = df.sparkSession
    name = "hostlens_" + hashlib.md5(path.encode()).hexdigest()
    # the shuffle deals rows out by the hash that also numbers the buckets: each task writes one file
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key, *sort)
       .option("path", path).option("compression", "lz4").mode("error").saveAsTable(name))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.createDataFrame([(key, buckets, list(sort), columns)], LAYOUT).coalesce(1).write.parquet(f"{path}/_layout")
    return path


def open_table(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``, with its buckets if it was written in any."""
    if not io.exists(spark, f"{path}/_layout"):
        return spark.read.parquet(path)
    layout = spark.read.schema(LAYOUT).parquet(f"{path}/_layout").first()
    name = "hostlens_" + hashlib.md5(path.encode()).hexdigest()
    if not spark.catalog.tableExists(name):
        order = ", ".join(f"`{c}`" for c in [layout["key"], *layout["sort"]])
        spark.sql(f"CREATE TABLE {name} ({layout['columns']}) USING parquet "
                  f"CLUSTERED BY (`{layout['key']}`) SORTED BY ({order}) INTO {layout['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name)
