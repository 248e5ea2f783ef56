"""Price recommendation over the occupancy panel (rule or model predictor)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import pricing as PR
from ..operators.joins import attach_group_stat

REPLICATES = 5


def with_segment(panel: DataFrame) -> DataFrame:
    return panel.withColumn("segment", PR.segment_key())


def with_region_price(panel: DataFrame) -> DataFrame:
    """Mean calendar price per neighbourhood on every row (size-checked broadcast)."""
    return attach_group_stat(panel, ["neighbourhood_cleansed"], F.avg(F.col("price").cast("double")),
                             "region_avg_price")


def rule_scored(panel: DataFrame, actions: Sequence[float] = PR.ACTIONS) -> DataFrame:
    """Every (row, action) with prediction from the rule and its reward."""
    df = PR.with_actions(with_segment(with_region_price(panel)), actions)
    df = df.withColumn("prediction", PR.rule_prediction())
    return df.withColumn("reward", PR.reward())


def model_scored(panel: DataFrame, predict: Callable[[DataFrame], DataFrame],
                 actions: Sequence[float] = PR.ACTIONS) -> DataFrame:
    """Every (row, action) scored by ``predict`` (e.g. a fitted pipeline per
    segment) at the new price, with its reward."""
    df = PR.with_actions(with_segment(panel), actions)
    df = predict(df)
    return df.withColumn("reward", PR.reward())


def replicate_id(n: int = REPLICATES) -> Column:
    """Stable replicate number of a (listing, day) row, integer arithmetic."""
    days = F.datediff(F.col("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return F.pmod(F.col("id").cast("long") * 7919 + days * 104729, F.lit(n))


def recommend(scored: DataFrame) -> DataFrame:
    """(state, best_action) from the look-ahead values of the reward grid."""
    return PR.best_action(PR.lookahead_value(PR.reward_grid(scored)))


def recommend_median(scored: DataFrame, replicates: int = REPLICATES) -> DataFrame:
    """Best action per replicate split of the rows, then the median per state."""
    s = scored.withColumn("replicate", replicate_id(replicates))
    grid = PR.reward_grid(s, ["replicate"])
    best = PR.best_action(PR.lookahead_value(grid, ["replicate"]), extra_keys=["replicate"])
    return PR.median_best_action(best)
