"""Per-listing running statistics over dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def cumulative_occupancy(df: DataFrame, key: str = "id", order: str = "date",
                         label: str = "label", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Running rentals, day ordinal and running occupancy per listing.

    ``cumulative_rentout`` sums ``label`` over all rows up to and including
    the current date (RANGE frame: rows on the same date share the value);
    ``total_days`` numbers the rows; ``occupancy_rate`` is their ratio.
    Both windows share the partitioning (one exchange on ``key``) and the
    sort, because the row-number order extends the date order.
    """
    by_date = Window.partitionBy(key).orderBy(order)
    ordinal = Window.partitionBy(key).orderBy(order, *tiebreak)
    return (df.withColumn("total_days", F.row_number().over(ordinal).cast("long"))
              .withColumn("cumulative_rentout", F.sum(label).over(by_date).cast("long"))
              .withColumn("occupancy_rate", F.col("cumulative_rentout") / F.col("total_days")))


def occupancy_state(df: DataFrame, key: str = "id", order: str = "date", label: str = "label") -> DataFrame:
    """What later days need of a listing's days so far: key, rentals, days, last_date."""
    return df.groupBy(key).agg(F.sum(label).cast("long").alias("rentals"), F.count(F.lit(1)).alias("days"), F.max(order).alias("last_date"))


def continued_occupancy(df: DataFrame, state: DataFrame, key: str = "id", order: str = "date",
                        label: str = "label", tiebreak: Sequence[str] = ()) -> DataFrame:
    """:func:`cumulative_occupancy` of rows that follow those behind ``state`` (as of :func:`occupancy_state`).

    The join's partitioning by ``key`` serves the windows; no row of the days so far is read. ``late`` is 1 for
    rows that aren't later than their listing's last date: they count nowhere and have no running numbers.
    """
    before = state.select(key, F.col("rentals").alias("__rentals"), F.col("days").alias("__days"), F.col("last_date").alias("__last"))
    rows = df.join(before, key, "left").withColumn("late", F.coalesce((F.col(order) <= F.col("__last")).cast("int"), F.lit(0)))
    by_date = Window.partitionBy(key, "late").orderBy(order)
    ordinal = Window.partitionBy(key, "late").orderBy(order, *tiebreak)
    on_time = F.col("late") == 0
    rows = (rows.withColumn("total_days", F.when(on_time, F.coalesce("__days", F.lit(0)) + F.row_number().over(ordinal)))
                .withColumn("cumulative_rentout", F.when(on_time, F.coalesce("__rentals", F.lit(0)) + F.sum(label).over(by_date).cast("long")))
                .drop("__rentals", "__days", "__last"))
    return rows.withColumn("occupancy_rate", F.col("cumulative_rentout") / F.col("total_days"))
