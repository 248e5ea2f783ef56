"""Grouped statistics: counts, means, roll-ups, correlation matrix, grids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .selection import exact_median


def count_per_key(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    """Non-NULL key occurrences per key."""
    return df.groupBy(key).agg(F.count(key).alias(name))


def mean_per_key(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Mean of ``value`` per key (NULLs skipped; all-NULL -> NULL)."""
    return df.groupBy(key).agg(F.avg(value).alias(name))


def global_mean(df: DataFrame, value: str, name: str) -> DataFrame:
    """One-row table with the mean of ``value``."""
    return df.agg(F.avg(value).alias(name))


def grouped_means(df: DataFrame, key: str, means: Mapping[str, str],
                  count_col: str | None = None, count_name: str = "count",
                  decimals: int | None = None) -> DataFrame:
    """``{alias: column}`` means per key, plus an optional non-NULL count.

    ``decimals``: the inputs are fixed-point values with that many decimals
    (review scores); the mean is then computed exactly in decimal arithmetic
    and rounded half-up to ``decimals + 4`` places instead of summing doubles.
    """
    def mean(c):
        if decimals is None:
            return F.avg(c)
        return F.avg(F.col(c).cast(f"decimal(18,{decimals})")).cast("double")

    aggs = [mean(c).alias(a) for a, c in means.items()]
    if count_col:
        aggs.append(F.count(count_col).alias(count_name))
    return df.groupBy(key).agg(*aggs)


def rollup_per_key(df: DataFrame, key: str, attributes: Sequence[str], value: str,
                   mean_name: str, variance_name: str) -> DataFrame:
    """Per key: attributes that depend on the key only (taken with ``min``,
    deterministic where ``first`` is not), mean and sample variance of
    ``value`` (a single row gives NULL variance)."""
    return df.groupBy(key).agg(
        *[F.min(a).alias(a) for a in attributes],
        F.avg(value).alias(mean_name),
        F.var_samp(value).alias(variance_name),
    )


def _pair_corr(a: Column, b: Column) -> Column:
    a_ = F.when(b.isNotNull(), a)
    b_ = F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_samp(a_, b_), F.stddev_samp(a_) * F.stddev_samp(b_))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, long form ``(x, y, r)``.

    One pass: a single global aggregate with one correlation per unordered
    pair (pairwise-complete rows, like pandas), each merged map-side, then
    unpivoted into all ordered pairs (symmetric, diagonal included).  The
    correlation is ``covar_samp / (stddev_samp * stddev_samp)`` over the rows
    where both values are present, divided with ``try_divide``: a constant
    column gives NULL (pandas: NaN) instead of an ANSI division error.
    """
    cols = list(columns)
    pair_alias = {}
    aggs = []
    for i, a in enumerate(cols):
        for j in range(i, len(cols)):
            b = cols[j]
            name = f"c{i}_{j}"
            pair_alias[(a, b)] = pair_alias[(b, a)] = name
            aggs.append(_pair_corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(name))
    wide = df.agg(*aggs)
    cells = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(pair_alias[(a, b)]).alias("r"))
             for a in cols for b in cols]
    return wide.select(F.explode(F.array(*cells)).alias("cell")).select("cell.x", "cell.y", "cell.r")


def pivot_counts(df: DataFrame, keys: Sequence[Column | str], pivot: str,
                 values: Sequence[str]) -> DataFrame:
    """Row count per key and pivot value, one column per listed value (0 when absent).

    Explicit pivot values: no extra job to discover them, fixed schema.
    """
    out = df.groupBy(*keys).pivot(pivot, list(values)).count()
    return out.fillna(0, subset=list(values))


def median_of(df: DataFrame, value: str, small: int = 1_000_000) -> float | None:
    """Exact median of a column, as a scalar: in one buffer up to ``small`` rows, by distributed selection beyond."""
    if df.limit(small + 1).count() <= small:
        return df.agg(F.median(value).alias("m")).first()["m"]
    return exact_median(df, value, name="m").first()["m"]
