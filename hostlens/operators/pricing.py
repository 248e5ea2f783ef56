"""Price-multiplier recommendation as one Spark plan.

Each panel row is expanded into the fixed action set (a generator over a
literal array: no join at all), rewarded, and averaged per segment x action
with a partial (map-side) aggregate, so the shuffle carries at most
``segments x actions`` rows per partition.  The look-ahead value and the
best action are computed on that 88-row grid.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .topk import arg_max_per_group

# --- fixed values: action set, discount, low-demand reward weights ---------
ACTIONS = [0.5, 0.6, 0.7, 0.8, 0.9, 1.0, 1.1, 1.2, 1.3, 1.4, 1.5]
GAMMA = 0.9
# (is_weekend, hot_region) -> weight applied to low-demand rewards
LOW_DEMAND_WEIGHTS = {(0, 0): 4, (0, 1): 3, (1, 0): 3, (1, 1): 2}
# -----------------------------------------------------------------------------


def segment_key(high_demand="high_demand", is_weekend="is_weekend", hot_region="hot_region") -> Column:
    """'highdemand|lowdemand' _ 'weekend|weekday' _ 'hotregion|nothotregion'."""
    def c(x):
        return F.col(x) if isinstance(x, str) else x
    return F.concat_ws(
        "_",
        F.when(c(high_demand) == 1, "highdemand").otherwise("lowdemand"),
        F.when(c(is_weekend) == 1, "weekend").otherwise("weekday"),
        F.when(c(hot_region) == 1, "hotregion").otherwise("nothotregion"))


def next_segment(segment: Column, action: Column) -> Column:
    """Demand follows the price move (up -> high), the day type alternates,
    the location stays."""
    parts = F.split(segment, "_")
    demand = F.when(action > 1.0, "highdemand").otherwise("lowdemand")
    day = F.when(F.element_at(parts, 2) == "weekday", "weekend").otherwise("weekday")
    return F.concat_ws("_", demand, day, F.element_at(parts, 3))


def with_actions(df: DataFrame, actions: Sequence[float] = ACTIONS, price: str = "price") -> DataFrame:
    """One row per (input row, action) with ``new_price = price * action``."""
    arr = F.array(*[F.lit(float(a)) for a in actions])
    return (df.withColumn("action", F.explode(arr))
              .withColumn("new_price", F.col(price).cast("double") * F.col("action")))


def rule_prediction(new_price: str = "new_price", reference_price: str = "region_avg_price") -> Column:
    """Stand-in occupancy model: rented (1) when the new price is not above
    the region's mean price."""
    return F.when(F.col(new_price) <= F.col(reference_price), 1).otherwise(0)


def reward(price="price", new_price="new_price", label="label", prediction="prediction",
           high_demand="high_demand", is_weekend="is_weekend", hot_region="hot_region") -> Column:
    """Reward of one (row, action).

    Low demand: ``new_price * k`` when the night was empty and is predicted
    rented, else ``-new_price * k`` (k by day type and location).
    High demand: ``new_price - price * label`` when predicted rented, else
    ``-new_price``.
    """
    p, np_, y, yh = (F.col(price).cast("double"), F.col(new_price), F.col(label), F.col(prediction))
    k = F.lit(None).cast("int")
    for (wk, hot), w in LOW_DEMAND_WEIGHTS.items():
        k = F.when((F.col(is_weekend) == wk) & (F.col(hot_region) == hot), F.lit(w)).otherwise(k)
    original = p * y
    new_revenue = np_ * yh
    low = F.when((y == 0) & (yh == 1), (new_revenue - original) * k).otherwise(-np_ * k)
    high = F.when(yh == 1, new_revenue - original).otherwise(-np_)
    return F.when(F.col(high_demand) == 1, high).otherwise(low)


def reward_grid(scored: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Mean reward per (extra keys, segment, action)."""
    return (scored.groupBy(*extra_keys, "segment", "action")
                  .agg(F.avg("reward").alias("avg_reward")))


def lookahead_value(grid: DataFrame, extra_keys: Sequence[str] = (), gamma: float = GAMMA) -> DataFrame:
    """``value = avg_reward(s, a) + gamma * max_a' avg_reward(s', a')`` where
    ``s'`` is the segment the action leads to (0 when it has no rows)."""
    best_next = (grid.groupBy(*extra_keys, "segment").agg(F.max("avg_reward").alias("__next_best"))
                     .withColumnRenamed("segment", "next_segment"))
    g = grid.withColumn("next_segment", next_segment(F.col("segment"), F.col("action")))
    # without extra keys at most 8 rows; with them as many times 8 as there are replicates, for Spark to decide on
    out = g.join(best_next if extra_keys else F.broadcast(best_next), on=[*extra_keys, "next_segment"], how="left")
    return out.withColumn("value", F.col("avg_reward") + F.lit(gamma) * F.coalesce(F.col("__next_best"), F.lit(0.0))) \
              .drop("__next_best")


def best_action(values: DataFrame, value: str = "value", extra_keys: Sequence[str] = ()) -> DataFrame:
    """(extra keys, state, best_action): arg-max action per segment, ties ->
    the lowest action."""
    best = arg_max_per_group(values, [*extra_keys, "segment"], value, "action")
    return best.select(*extra_keys, F.col("segment").alias("state"), F.col("action").alias("best_action"))


def median_best_action(per_replicate: DataFrame) -> DataFrame:
    """Median over replicates of the best action per state."""
    return per_replicate.groupBy("state").agg(F.median("best_action").alias("best_action"))
