"""Mixing sources to target weights by the cube method (balanced sampling).

A document of a source whose target is f times its size is expected f times in the mix: floor(f) times
for certain, and once more with the inclusion probability f - floor(f). The cube method settles those
probabilities: as long as three documents of a block are undecided, their probabilities move along the
null space of the two balancing constraints (tokens and documents), one way or the other at random, until
one of them is 0 or 1. Two documents of a block stay open at most; open documents of many blocks meet in
new blocks until a source fits into one, where the last two are settled (landing) as near the target as
can be.

Nulls and odd cases: a null text has size 0; a null source is a source of its own, the last in order; rows
that share a doc_id are documents of their own; an empty table gives an empty result; a source of size 0
has target 0 and its documents are taken 0 times.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hostlens.llm.common import WORD
from hostlens.session import materialize

#: Documents of one source that a task settles together.
BLOCK = 2048


def word_count(text: str = "text"):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.0, most: float = 3.0) -> DataFrame:
    """source, source_size, n_docs, target. Sources by code point (null last) weigh ``weights``, repeating.

    min(most * size, level * weight) with the level at which all targets add up is where resharing the excess
    by weight ends. One row per source goes through the windows, never documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*(F.lit(float(x)) for x in weights))
    per = per.withColumn("w", F.element_at(w, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * float(most)).withColumn("r", F.col("cap") / F.col("w"))
    rank = Window.orderBy("r", F.col("source").asc_nulls_last())
    before, every = rank.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(every) * float(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    # From the source on at which the level no longer passes its cap, levels only fall: the first is the largest.
    per = per.withColumn("level", level).withColumn("level", F.max(F.when(F.col("level") <= F.col("r"), F.col("level"))).over(every))
    target = F.least("cap", F.coalesce(F.col("level") * F.col("w"), F.col("cap")))
    return per.select("source", "source_size", "n_docs", target.alias("target"))


def flight(size: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Moves p until two entries at most lie strictly between 0 and 1; sums of p and of p * size stay."""
    p, open_ = p.astype(float).copy(), []
    draws = iter(rng.random(len(p) + 3))
    for i in np.flatnonzero((p > 0) & (p < 1)):
        open_.append(i)
        if len(open_) < 3:
            continue
        a, b, c = (float(size[k]) for k in open_)
        u = [b - c, c - a, a - b]  # sums to 0 and is orthogonal to the sizes
        if not any(u):
            u = [1.0, -1.0, 0.0]
        x = [float(p[k]) for k in open_]
        up = min((1 - v) / d if d > 0 else v / -d for v, d in zip(x, u, strict=True) if d)
        down = min(v / d if d > 0 else (1 - v) / -d for v, d in zip(x, u, strict=True) if d)
        step = up if next(draws) * (up + down) < down else -down
        for k, v, d in zip(open_, x, u, strict=True):
            y = v + step * d
            p[k] = 0.0 if y < 1e-9 else 1.0 if y > 1 - 1e-9 else y
        open_ = [k for k in open_ if 0 < p[k] < 1]
        # at least one entry has come to 0 or 1, up to rounding
        if len(open_) == 3:
            k = min(open_, key=lambda k: min(p[k], 1 - p[k]))
            p[k] = round(p[k])
            open_.remove(k)
    return p


def landing(size: np.ndarray, p: np.ndarray, tokens: float) -> np.ndarray:
    """Settles the entries that are still open (two at most) so that the taken tokens come nearest to ``tokens``."""
    p = p.copy()
    left = np.flatnonzero((p > 0) & (p < 1))
    if len(left):
        ways = np.array(np.meshgrid(*[[0.0, 1.0]] * len(left))).reshape(len(left), -1).T
        miss = np.abs(ways @ size[left] - tokens)
        p[left] = ways[np.lexsort((np.abs(ways.sum(1) - p[left].sum()), miss))[0]]
    return p


def _settle(last: bool, seed: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["h", "doc_id", "size"], kind="stable", na_position="last").reset_index(drop=True)
        rng = np.random.default_rng([seed, int(rows["block"].iat[0]), len(rows)])
        size, p = rows["size"].to_numpy(float), rows["p"].to_numpy(float)
        q = flight(size, p, rng)
        if last:
            left = (q > 0) & (q < 1)
            q = landing(size, q, float((q * size)[left].sum()))
        return rows.assign(p=q)

    return run


def numbered(rows: DataFrame) -> DataFrame:
    """``copy``: 0, 1, ... for the rows of equal ``h``. ``part`` is where a stored row came from; a task sees the rows of
    one h and part, the numbers before a part are sums of counts."""
    local = F.row_number().over(Window.partitionBy("part", "h").orderBy("part")) - 1
    counts = rows.groupBy("h", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("h").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.withColumn("before", F.coalesce(before, F.lit(0))).where("before > 0").select(F.col("h").alias("_h"), F.col("part").alias("_part"), "before")
    out = rows.withColumn("local", local).join(starts, (F.col("h") == F.col("_h")) & (F.col("part") == F.col("_part")), "left")
    return out.withColumn("copy", F.col("local") + F.coalesce("before", F.lit(0))).drop("_h", "_part", "part", "local", "before")


def balanced_mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.0, most: float = 3.0,
                 seed: int = 7, block: int = BLOCK, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken (= copies * size) and the ``carry`` columns.

    Every document gets floor or ceil of target / source_size copies, so none passes ``most`` times its size.
    A hot source is dealt over as many blocks as it has documents for, rows that are equal included, which are
    numbered for that; blocks depend on the rows and their counts only, so reruns agree on any cluster.
    """
    spark = docs.sparkSession
    sizes = docs.select("doc_id", "source", word_count().alias("size"), F.xxhash64("doc_id", "source", "text", F.lit(seed)).alias("row"), *carry)
    sizes = materialize(sizes.withColumn("h", F.xxhash64("row", *carry)).withColumn("part", F.spark_partition_id()), "mix-rows")
    # The carried columns decide only between rows that differ in nothing else.
    torn = sizes.groupBy("row").agg(F.min("h").alias("least"), F.max("h").alias("most")).where("least <> most").select(F.col("row").alias("_row2"))
    sizes = numbered(sizes).join(torn, F.col("row") == F.col("_row2"), "left")
    h = F.when(F.col("_row2").isNull(), F.xxhash64("row", "copy")).otherwise(F.xxhash64("row", "h", "copy"))
    sizes = materialize(sizes.withColumn("h", h).drop("copy", "row", "_row2"), "mix-sizes")
    targets = materialize(source_targets(sizes, weights, share, most), "mix-targets")
    largest = targets.agg(F.max("n_docs")).first()[0] or 0
    f = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    on = sizes.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    rows = on.withColumn("f", f).withColumn("base", F.floor("f")).withColumn("p", F.col("f") - F.col("base")).drop("f")
    n, done = F.ceil(F.col("n_docs") / block), None
    while True:
        last = largest <= block
        rows = rows.withColumn("block", F.pmod(F.xxhash64("h", F.lit(largest)), F.greatest(n, F.lit(1))).cast("long"))
        rows = materialize(rows.groupBy("source", "block").applyInPandas(_settle(last, seed), rows.schema), "mix-flight")
        settled = F.col("p").isin(0.0, 1.0)
        done = rows.where(settled) if done is None else done.unionByName(rows.where(settled))
        if last:
            break
        rows, n, largest = rows.where(~settled), F.ceil(n * 2 / block), -(-largest // block) * 2
    out = done.withColumn("copies", (F.col("base") + F.col("p")).cast("long"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies", *carry)
