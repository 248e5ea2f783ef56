"""Occupancy panel: listing x day rows with running occupancy, demand,
weekend and hot-region flags, written partitioned by the three flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..operators.aggregates import median_of
from ..operators.joins import DEFAULT_BROADCAST_ROWS, bounded_broadcast, join_listing_calendar
from ..operators.windows import cumulative_occupancy
from ..session import materialize
from ..sources import io

# fixed values: the panel's default date window, demand cut and hot-region cut
DEFAULT_START = "2023-10-05"
DEFAULT_END = "2024-09-06"
HIGH_DEMAND_CUT = 0.5
HOT_REGION_CUT = 0.542

LISTING_COLUMNS = ["id", "host_id", "neighbourhood_cleansed", "property_type", "room_type", "accommodates"]
CALENDAR_COLUMNS = ["listing_id", "date", "available", "price", "minimum_nights", "maximum_nights"]
REQUIRED = ["id", "host_id", "neighbourhood_cleansed", "property_type", "room_type", "accommodates",
            "minimum_nights", "maximum_nights", "date", "available", "price"]
SEGMENT_FLAGS = ["high_demand", "is_weekend", "hot_region"]


def rental_days(listings: DataFrame, calendar: DataFrame, start: str = DEFAULT_START,
                end: str = DEFAULT_END) -> DataFrame:
    """Listing attributes joined to calendar days inside [start, end], complete
    rows only, with the rented-out label and the weekend flag."""
    cal = calendar.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    df = join_listing_calendar(listings, cal, LISTING_COLUMNS, CALENDAR_COLUMNS)
    df = df.select(*REQUIRED).dropna(how="any", subset=REQUIRED)
    return df.withColumns({"label": N.rental_label("available"), "is_weekend": N.weekend_flag("date")})


def with_running_occupancy(days: DataFrame, demand_cut: float = HIGH_DEMAND_CUT) -> DataFrame:
    df = cumulative_occupancy(days, key="id", order="date", label="label", tiebreak=["host_id"])
    return df.withColumn("high_demand", N.threshold_flag("occupancy_rate", demand_cut))


def region_occupancy(panel: DataFrame) -> DataFrame:
    """Mean running occupancy per neighbourhood."""
    return panel.groupBy("neighbourhood_cleansed").agg(F.avg("occupancy_rate").alias("avg_occupancy_rate"))


def occupancy_panel(listings: DataFrame, calendar: DataFrame, start: str = DEFAULT_START,
                    end: str = DEFAULT_END, hot_cut: float | None = HOT_REGION_CUT,
                    max_regions: int = DEFAULT_BROADCAST_ROWS, stage: bool = True) -> DataFrame:
    """The full panel.  ``hot_cut=None`` takes the median of the region means.

    Plan: one shuffle of the joined days by listing id (the join's own
    partitioning serves the window); the day-level panel is written once to
    the shared folder so that the region aggregate and the final join read
    it instead of recomputing it; the region table (one row per
    neighbourhood, counted) is broadcast so the panel rows do not move again.
    """
    days = with_running_occupancy(rental_days(listings, calendar, start, end))
    if stage:
        days = materialize(days, "occupancy-days")
    # stored once: the median and the join must see the same doubles, last bits included
    regions, _ = bounded_broadcast(region_occupancy(days), max_regions)
    cut = median_of(regions, "avg_occupancy_rate") if hot_cut is None else hot_cut
    if cut is None:
        cut = 0.0
    out = days.join(regions, on="neighbourhood_cleansed", how="inner")
    return out.withColumn("hot_region", N.threshold_flag("avg_occupancy_rate", cut))


def write_panel(panel: DataFrame, path: str) -> str:
    """Partitioned by the three segment flags (8 leaf folders)."""
    return io.write_partitioned(panel, path, SEGMENT_FLAGS)
