"""The occupancy panel, continued by drops of calendar days.

The running numbers of a day need only its listing's days before it, and these need no more than three numbers a
listing: rentals, days and the last date. So a drop of new days touches its own rows and that state; stored days
are never read again. A region's mean needs the sum and the number of its rates. What does change for old days is
``hot_region``, which is why it isn't stored but joined on when the panel is read.

Below one root, each written aside and then named (:mod:`hostlens.sources.versions`): ``days`` with a folder per
drop, ``state`` (id, rentals, days, last_date), ``regions`` (neighbourhood_cleansed, total, days), and ``drops``,
whose newest version lists the folders of all drops and is what makes a drop count.

A day that isn't later than the listing's last one can't be appended; such rows are stored as ``late`` and take no
part, and ``append`` returns their number. A listing with late rows needs its panel built anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..operators.aggregates import median_of
from ..operators.joins import bounded_broadcast
from ..operators.windows import continued_occupancy, occupancy_state
from ..sources import versions
from . import occupancy as occ

STATE = "id string, rentals long, days long, last_date date"
REGIONS = "neighbourhood_cleansed string, total double, days long"
DROPS = "drop long, days string, state string, regions string"


def _drops(spark: SparkSession, root: str) -> list:
    """The folders of the drops so far, the last one's state and regions being those of the panel."""
    folder = versions.folder_of(spark, f"{root}/drops")
    return [] if folder is None else spark.read.parquet(folder).orderBy("drop").collect()


def append(spark: SparkSession, root: str, listings: DataFrame, calendar: DataFrame, start: str = occ.DEFAULT_START,
           end: str = occ.DEFAULT_END, demand_cut: float = occ.HIGH_DEMAND_CUT) -> int:
    """Add the calendar's days inside [start, end] to the panel at ``root``; the number of rows that came too late.

    A drop that fails on the way leaves the panel as it was and can be repeated.
    """
    drops = _drops(spark, root)
    state = spark.read.parquet(drops[-1]["state"]) if drops else spark.createDataFrame([], STATE)
    regions = spark.read.parquet(drops[-1]["regions"]) if drops else spark.createDataFrame([], REGIONS)

    def stored(df: DataFrame, name: str) -> str:
        return versions.folder_of(spark, f"{root}/{name}", versions.publish(df, f"{root}/{name}"))

    days = continued_occupancy(occ.rental_days(listings, calendar, start, end), state, tiebreak=["host_id"])
    written = stored(days.withColumn("high_demand", N.threshold_flag("occupancy_rate", demand_cut)), "days")
    rows = spark.read.parquet(written)
    new = rows.where("late = 0")
    merged = state.unionByName(occupancy_state(new)).groupBy("id").agg(
        F.sum("rentals").alias("rentals"), F.sum("days").alias("days"), F.max("last_date").alias("last_date"))
    sums = new.groupBy("neighbourhood_cleansed").agg(F.sum("occupancy_rate").alias("total"), F.count(F.lit(1)).alias("days"))
    regions = regions.unionByName(sums).groupBy("neighbourhood_cleansed").agg(F.sum("total").alias("total"), F.sum("days").alias("days"))
    drop = (len(drops) + 1, written, stored(merged, "state"), stored(regions, "regions"))
    versions.publish(spark.createDataFrame([*(tuple(d) for d in drops), drop], DROPS), f"{root}/drops")
    return rows.where("late = 1").count()


def read_panel(spark: SparkSession, root: str, hot_cut: float | None = occ.HOT_REGION_CUT,
               max_regions: int = occ.DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """The panel over all drops; ``hot_cut=None`` takes the median of the region means, as of the last drop."""
    drops = _drops(spark, root)
    if not drops:
        raise ValueError(f"no drop has been appended at {root}")
    days = spark.read.parquet(*[d["days"] for d in drops]).where("late = 0").drop("late")
    means = spark.read.parquet(drops[-1]["regions"]).select("neighbourhood_cleansed", (F.col("total") / F.col("days")).alias("avg_occupancy_rate"))
    regions, _ = bounded_broadcast(means, max_regions)
    cut = median_of(regions, "avg_occupancy_rate") if hot_cut is None else hot_cut
    out = days.join(regions, on="neighbourhood_cleansed", how="inner")
    return out.withColumn("hot_region", N.threshold_flag("avg_occupancy_rate", 0.0 if cut is None else cut))
