"""Ordering operators: exact top-k per group, arg-max per group, k smallest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int,
                    spread_on: str | None = None, spread: int = 64) -> DataFrame:
    """The first ``k`` rows of every group under a total ``order``.

    With ``spread_on`` the selection runs in two rounds: first per
    (group, hash bucket of ``spread_on``) -- many small sorts in parallel --
    then over the at most ``k * spread`` survivors of each group.  The
    result is exact (every global top-k row is in its bucket's top-k) and no
    task ever sorts a whole large group.
    """
    out = df
    if spread_on is not None:
        b = F.pmod(F.xxhash64(F.col(spread_on)), F.lit(spread))
        w_local = Window.partitionBy(*groups, b).orderBy(*order)
        out = out.withColumn("__r", F.row_number().over(w_local)).where(F.col("__r") <= k).drop("__r")
    w = Window.partitionBy(*groups).orderBy(*order) if groups else Window.orderBy(*order)
    return out.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= k).drop("__r")


def arg_max_per_group(df: DataFrame, groups: Sequence[str], value: str, tie: str,
                      name: str | None = None) -> DataFrame:
    """Row with the largest ``value`` per group, ties -> smallest ``tie``.

    A grouped ``max_by`` over a (value, -tie) struct would need the same
    shuffle; the window form keeps the whole row.
    """
    w = Window.partitionBy(*groups).orderBy(F.col(value).desc(), F.col(tie).asc())
    out = df.withColumn("__r", F.row_number().over(w)).where(F.col("__r") == 1).drop("__r")
    return out.withColumnRenamed(tie, name) if name else out


def smallest(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """``orderBy(...).limit(k)``: planned as TakeOrderedAndProject (each
    partition keeps k rows, one merge), never a full sort."""
    return df.orderBy(*order).limit(k)
