"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

#: Words of a text: runs of anything but ASCII white space. ``bytes.split()`` cuts at the same characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a task holds split into words at a time.
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(x: str | None) -> bytes:
    """UTF-8 of a text; null is empty."""
    return b"" if x is None else x.encode("utf-8", "surrogatepass")


def chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of about ``limit`` bytes, so that memory follows the longest text and not the batch."""
    for b in batches:
        rows = max(1, b.num_rows)
        step = max(1, int(rows * limit / max(b.nbytes, 1)))
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


def doc_key(text: str = "text") -> list[Column]:
    """``_id`` (null ids last) and ``_row``, which tells rows that share an id apart by their text."""
    return [F.coalesce("doc_id", F.lit(2**63 - 1)).alias("_id"), F.xxhash64(F.col("doc_id").isNull(), text).alias("_row")]


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns; maps, which have no order, count by their sorted entries."""
    def plain(f) -> Column:
        c = F.col(f"`{f.name}`")
        return F.array_sort(F.map_entries(c)) if isinstance(f.dataType, MapType) else c

    return F.xxhash64(*[plain(f) for f in docs.schema.fields])


def with_copies(docs: DataFrame, decisions: DataFrame, mark: str = "text") -> DataFrame:
    """The rows of ``docs`` as often as decided: ``decisions`` has doc_id, _row (hash of the column ``mark``, or of all
    columns if that is empty), copies, and times: how many rows that is said of, which then count as one, the one of
    the smallest hash."""
    total = decisions.where("copies > 0").select("doc_id", "_row", "copies", "times")
    keep, mine = [f"`{c}`" for c in docs.columns], F.xxhash64(mark) if mark else row_hash(docs)
    side = total.toDF("__id", "__row", "__copies", "__times")
    rows = docs.withColumn("__mark", mine).join(side, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__mark") == F.col("__row")))
    if not total.where("times > 1").isEmpty():
        shared = rows.where("__times > 1").select("__id", "__row", "__copies", F.struct(*keep).alias("__whole"), row_hash(docs).alias("__hash"))
        shared = shared.groupBy("__id", "__row").agg(F.min_by("__whole", "__hash").alias("__whole"), F.min("__copies").alias("__copies"))
        rows = rows.where("__times = 1").select(*keep, "__copies").unionAll(shared.select("__whole.*", "__copies"))
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(*keep)


def padded(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as a matrix; shorter lists are filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = np.asarray(column.offsets)
    lengths, out = np.diff(offsets), np.zeros((len(column), dim))
    values = column.values.to_numpy(zero_copy_only=False)
    if len(column) and (lengths == dim).all():
        return values[offsets[0] : offsets[-1]].reshape(len(column), dim).astype(np.float64)
    for i, (a, n) in enumerate(zip(offsets[:-1], lengths, strict=True)):
        out[i, :n] = values[a : a + n]
    return out


def arrow_rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)

