"""Exact medians by distributed selection.

``F.median`` keeps all values of a group in one buffer. Here each pass counts a group's values in bins between two
known bounds, with partial counts on the map side; the bin in which the wanted rank falls gives the next bounds,
its smallest and largest value, until these are equal. A pass moves at most ``BINS`` rows a group and task. The
bounds narrow by the number of bins or more each time, and two neighbouring doubles fall in different bins, so a
few passes reach the value itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .joins import bounded_broadcast

BINS = 1024
INF = float("inf")


def _bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """0 .. bins - 1 from lo to hi, never falling as x grows."""
    near = (x - lo) / (hi - lo)
    far = (x / 2 - lo / 2) / (hi / 2 - lo / 2)  # bounds further apart than the largest double
    part = F.when(hi - lo < INF, near).otherwise(far)
    return F.when(hi > lo, F.least(F.floor(part * bins), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")


def exact_median(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "median", bins: int = BINS) -> DataFrame:
    """One row per group with the median of ``value`` (the mean of the middle two of an even number).

    Nulls don't count, and a group without a value has no row; NaN counts as larger than all numbers. Without
    ``by`` the whole table is the group, with a null if it has no value. The groups' bounds are a table that is broadcast behind a row count.
    """
    keys = list(by)
    rows = materialize(df.select(*keys, F.col(value).cast("double").alias("__x")).where("__x is not null"), "median-values")
    x = F.col("__x")
    finite = ~F.isnan(x) & (F.abs(x) < INF)
    each = {"__n": F.lit(1), "__low": F.when(x == -INF, 1), "__mid": F.when(finite, 1), "__high": F.when(x == INF, 1)}
    start = rows.groupBy(*keys).agg(*[F.count(c).alias(k) for k, c in each.items()], F.min(F.when(finite, x)).alias("__lo"), F.max(F.when(finite, x)).alias("__hi"))
    ranks = F.array_distinct(F.array(F.floor((F.col("__n") - 1) / 2), F.floor(F.col("__n") / 2)))
    rank = F.col("__which") - F.col("__low")
    beyond = F.when(rank < 0, -INF).when(rank < F.col("__mid"), None).when(rank < F.col("__mid") + F.col("__high"), INF).otherwise(float("nan"))
    start = start.where("__n > 0").withColumn("__which", F.explode(ranks)).withColumn("__found", beyond)
    start = materialize(start.select(*keys, "__which", "__lo", "__hi", rank.alias("__rank"), "__found"), "median-bounds")
    done, todo = [start.where("__found is not null").select(*keys, "__found")], start.where("__found is null").drop("__found")
    values = rows.where(finite)
    while not todo.isEmpty():
        # a rank counts from 0 among the values between its bounds
        side, _ = bounded_broadcast(todo, materialized=True)
        match = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys], F.col("l.__x").between(F.col("r.__lo"), F.col("r.__hi")))
        pairs = values.alias("l").join(side.alias("r"), match)
        binned = pairs.select(*[F.col(f"r.{k}").alias(k) for k in keys], "__which", "__rank", "__x", _bin(x, F.col("__lo"), F.col("__hi"), bins).alias("__bin"))
        counted = binned.groupBy(*keys, "__which", "__rank", "__bin").agg(F.count(F.lit(1)).alias("__n"), F.min("__x").alias("__lo"), F.max("__x").alias("__hi"))
        below = F.sum("__n").over(Window.partitionBy(*keys, "__which").orderBy("__bin")) - F.col("__n")
        hit = counted.withColumn("__below", below).where(F.col("__rank").between(F.col("__below"), F.col("__below") + F.col("__n") - 1))
        found = materialize(hit.select(*keys, "__which", "__lo", "__hi", (F.col("__rank") - F.col("__below")).alias("__rank")), "median-bounds")
        done.append(found.where(F.col("__lo") == F.col("__hi")).select(*keys, F.col("__lo").alias("__found")))
        todo = found.where(F.col("__lo") < F.col("__hi"))
    return reduce(DataFrame.unionAll, done).groupBy(*keys).agg(F.avg("__found").alias(name))
