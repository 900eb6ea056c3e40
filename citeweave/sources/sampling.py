"""Record sampling: Bernoulli (layout dependent) and by key hash (stable)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the seed of the reference's record sample.
DEFAULT_SEED = 2


def sample_bernoulli(df: DataFrame, fraction: float, seed: int = DEFAULT_SEED) -> DataFrame:
    """Sample without replacement. Repeatable only for the same partition layout."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def key_hash_unit(key: Column, seed: int = DEFAULT_SEED) -> Column:
    """First 32 bits of md5(key || '|' || seed) as a non-negative integer."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def sample_by_hash(df: DataFrame, fraction: float, key: str = "id", seed: int = DEFAULT_SEED) -> DataFrame:
    """Keep a record when the hash of its key falls below ``fraction``.

    Independent of partitioning and of the order records arrive in, so the
    same records are kept on every run and in every engine.
    """
    threshold = float(fraction) * float(1 << 32)
    return df.where(key_hash_unit(F.col(key), seed) < F.lit(threshold))
