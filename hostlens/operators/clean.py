"""Row cleaning: projection, null-key filters, deterministic dedup."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns by name; names that are not present are ignored."""
    return df.drop(*list(names))


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*names)


def filter_not_null(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep rows whose key columns are all present (``dropna`` on a subset)."""
    return df.dropna(how="any", subset=list(keys))


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key; the survivor is the smallest row by ``order_by``
    (default: all other columns in table order, NULLs first).

    Written as ``groupBy(keys).min(struct(rest))``: the aggregation runs a
    partial (map-side) step before the shuffle, so a key holding a large share
    of the rows is reduced to one row per input partition before it moves,
    and the survivor does not depend on partitioning (unlike
    ``dropDuplicates``).
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    order = list(order_by or []) + [c for c in rest if c not in (order_by or [])]
    packed = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(c) for c in order])).alias("__row"))
    return packed.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct (partial aggregation before the shuffle)."""
    return df.distinct()
