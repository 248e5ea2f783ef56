"""Joins: listing x calendar, left joins to per-key counts, join-back of a
group statistic, and a broadcast that is only taken behind a size check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# A side is broadcast only when it has at most this many rows (counted).
DEFAULT_BROADCAST_ROWS = 1_000_000


def bounded_broadcast(small: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      *, materialized: bool = False) -> tuple[DataFrame, bool]:
    """Return ``(side, broadcast?)``: the side wrapped in ``broadcast`` when a
    row count proves it small, else unchanged (Spark then shuffles both sides
    and AQE may still switch or split skewed partitions at run time).

    The side is materialised first (unless the caller already did) so the
    count and the join read the same stored rows instead of computing the
    lineage twice.
    """
    side = small if materialized else materialize(small)
    if side.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(side), True
    return side, False


def join_listing_calendar(listings: DataFrame, calendar: DataFrame,
                          listing_columns: Sequence[str] | None = None,
                          calendar_columns: Sequence[str] | None = None) -> DataFrame:
    """Inner join ``listings.id = calendar.listing_id`` (one listing, many days).

    Both sides are projected first (column pruning reaches the scans); the
    calendar key is dropped so a single ``id`` survives.
    """
    l = listings.select(*listing_columns) if listing_columns else listings
    c = calendar.select(*calendar_columns) if calendar_columns else calendar
    return l.join(c, l["id"] == c["listing_id"], "inner").drop(c["listing_id"])


def join_on_key(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on a shared column name so that only one copy of it survives."""
    return left.join(right, on=key, how=how)


def attach_group_stat(df: DataFrame, keys: Sequence[str], stat: Column, name: str,
                      max_groups: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Aggregate per key, then join the statistic back to every detail row.

    The aggregate runs partial-then-final (a hot key is combined map-side),
    and is broadcast when a count proves it has few groups; the detail rows
    then never move.  Beyond the bound it is an ordinary shuffle join.
    """
    agg = df.groupBy(*keys).agg(stat.alias(name))
    side, _ = bounded_broadcast(agg, max_groups)
    return df.join(side, on=list(keys), how="inner")


def attach_group_stat_window(df: DataFrame, keys: Sequence[str], stat: Column, name: str) -> DataFrame:
    """Same result as :func:`attach_group_stat` through a window over the key
    (one shuffle of the detail rows by key; fine when keys are many and even)."""
    return df.withColumn(name, stat.over(Window.partitionBy(*keys)))


def salted_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str,
                spread_key: str, counts: DataFrame | None = None, hot_rows: int = 5_000_000,
                how: str = "inner") -> DataFrame:
    """Equi-join that splits a hot key of the big side into parts of about ``hot_rows`` rows.

    A key is hot when it has at least ``hot_rows`` rows on the big side
    (``counts``: ``(big_key, count)``, computed with a partial aggregate when
    not given).  At most ``total / hot_rows`` keys can be hot, so the hot set
    is small by construction; it is still counted before it is broadcast.
    A hot key has ``ceil(count / hot_rows)`` salts; its rows get one from a
    stable hash of ``spread_key``, and the matching small-side row is repeated
    once per salt.  Other keys use salt 0.
    The result equals the plain join; no task receives more than about
    ``hot_rows`` rows of one key.  ``how`` is applied with the small side on
    the left (``inner`` or ``left`` keep their usual meaning for it).  Given ``counts`` are taken to be stored
    (cheap to re-read); otherwise they are computed and the hot set stored.
    """
    given = counts is not None
    if not given:
        counts = big.groupBy(big_key).agg(F.count(F.lit(1)).alias("count"))
    hot = counts.where(F.col(counts.columns[1]) >= hot_rows).select(
        F.col(counts.columns[0]).alias("__hot_key"), F.ceil(F.col(counts.columns[1]) / hot_rows).cast("int").alias("__salts"))
    hot_side, _ = bounded_broadcast(hot, DEFAULT_BROADCAST_ROWS, materialized=given)
    b = (big.join(hot_side, big[big_key] == F.col("__hot_key"), "left").drop("__hot_key")
            .withColumn("__salt", F.pmod(F.xxhash64(F.col(spread_key)), F.coalesce("__salts", F.lit(1))).cast("int"))
            .drop("__salts"))
    s_ = (small.join(hot_side, small[small_key] == F.col("__hot_key"), "left").drop("__hot_key")
               .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1)))
               .drop("__salts"))
    return s_.join(b, (s_[small_key] == b[big_key]) & (s_["__salt"] == b["__salt"]), how) \
             .drop(s_["__salt"]).drop(b["__salt"])
