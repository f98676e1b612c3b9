"""Train / validation / test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
TRAIN, VALIDATION, TEST = "Train", "Validation", "Test"
# 70 / 10 / 20 percent, as two-stage [0.7, 0.3] then [1/3, 2/3].
DEFAULT_CUTS = (70, 80)
# -----------------------------------------------------------------------------


def hash_bucket(key, buckets: int = 100) -> Column:
    """Stable 0..buckets-1 bucket from the md5 of the key's text form.
    Independent of partitioning, so the split never changes with cluster
    size (``randomSplit`` does)."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(buckets))


def split_column(key, cuts=DEFAULT_CUTS) -> Column:
    """The split name column for a key."""
    b = hash_bucket(key)
    return F.when(b < cuts[0], F.lit(TRAIN)).when(b < cuts[1], F.lit(VALIDATION)).otherwise(F.lit(TEST))


def hash_split(df: DataFrame, key: str, cuts=DEFAULT_CUTS, out: str = "split") -> DataFrame:
    """Add the split name; a narrow projection, no shuffle."""
    return df.withColumn(out, split_column(key, cuts))


def random_split(df: DataFrame, seed: int = 42):
    """X01, reference mode: two-stage ``randomSplit`` (70/30 then 1/3, 2/3).
    Result depends on partitioning; prefer ``hash_split``."""
    train, temp = df.randomSplit([0.7, 0.3], seed=seed)
    val, test = temp.randomSplit([1 / 3, 2 / 3], seed=seed)
    return train, val, test


def split_parts(df: DataFrame, col: str = "split"):
    """The three parts of a hash-split frame (lazy filters of one plan)."""
    return tuple(df.filter(F.col(col) == name) for name in (TRAIN, VALIDATION, TEST))


def split_counts(df: DataFrame, col: str = "split") -> DataFrame:
    """Rows per part in one aggregation (not three count jobs)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
