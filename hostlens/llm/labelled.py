"""Which documents a classifier may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """Whether a row's label may not be learnt; rows without an id count as held out."""
    return F.coalesce(remainder(doc_id, folds) == fold, F.lit(True))


def training_labels(labels: DataFrame, name: str, folds: int, fold: int, most: int, apart: int = 4) -> DataFrame:
    """doc_id, label (0/1), part (0..apart-1) of ``most`` rows at most, drawn by a hash of the id.

    Null ids and labels don't count; of rows that share an id the smallest label does. ``part`` lets a
    later step of the fit use other rows than an earlier one.
    """
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(name).cast("int").alias("label"))
            .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).where(~held_out("doc_id", folds, fold))
            .groupBy("doc_id").agg(F.min("label").alias("label")))
    n, h = rows.count(), F.xxhash64("doc_id", F.lit(11))
    if n > most:
        # a fixed share by hash, with room for its own spread, and never more than ``most``
        share = max(0.0, most / n - 3 * (most**0.5) / n)
        rows = rows.where(F.pmod(h, F.lit(1 << 40)) < int(share * (1 << 40)))
    return rows.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(apart)).cast("int"))
