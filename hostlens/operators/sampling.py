"""Sampling and train/test splits.

``key_sample`` / ``key_split`` decide per row from a stable hash bucket of
key columns: the same rows are chosen whatever the partitioning, the number
of executors or a retried task (``sample``/``randomSplit`` with a seed are
only reproducible for an identical partitioning).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 10000


def hash_bucket(keys: Sequence[str], seed: int = 0, buckets: int = BUCKETS) -> Column:
    """Stable bucket in ``[0, buckets)`` from the key columns."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), F.lit(buckets))


def key_sample(df: DataFrame, fraction: float, keys: Sequence[str] = (), seed: int = 0,
               bucket: Column | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Rows whose key bucket falls below ``fraction``."""
    b = bucket if bucket is not None else hash_bucket(keys, seed, buckets)
    return df.where(b < F.lit(int(round(fraction * buckets))))


def key_split(df: DataFrame, train_fraction: float, keys: Sequence[str] = (), seed: int = 0,
              bucket: Column | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Adds ``split`` = 'train' / 'test' by key bucket (one pass, no union)."""
    b = bucket if bucket is not None else hash_bucket(keys, seed, buckets)
    cut = F.lit(int(round(train_fraction * buckets)))
    return df.withColumn("split", F.when(b < cut, F.lit("train")).otherwise(F.lit("test")))


def bernoulli_sample(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def random_split(df: DataFrame, weights: Sequence[float], seed: int | None = None) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed=seed)
