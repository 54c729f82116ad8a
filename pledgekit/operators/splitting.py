"""Train/test splits and cross-validation folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgekit.functions.columns import hash_bucket, quoted
from pledgekit.runtime import stage
from pledgekit.spec import SplitSpec


def random_split(df: DataFrame, spec: SplitSpec = SplitSpec()) -> tuple[DataFrame, DataFrame]:
    """Seeded row sampling; repeats only while the input keeps its partitioning.

    The input is written once, so both halves sample the same rows and none is lost or doubled.
    """
    share = spec.train_percent / 100
    train, test = stage(df, "random-split").randomSplit([share, 1 - share], seed=spec.seed)
    return train, test


def hash_split(df: DataFrame, key: str, spec: SplitSpec = SplitSpec()) -> DataFrame:
    """Add ``split`` (train or test) from the key alone, the same under any layout or rerun.

    A projection: no shuffle, and copies of one key never straddle the split.
    """
    bucket = hash_bucket(quoted(key), 100, spec.salt)
    return df.withColumn("split", F.when(bucket < spec.train_percent, "train").otherwise("test"))


def assign_folds(df: DataFrame, key: str, spec: SplitSpec = SplitSpec()) -> DataFrame:
    """Add ``fold`` (0-based) from other digits of the key's hash than the split uses."""
    return df.withColumn("fold", hash_bucket(quoted(key), spec.folds, spec.salt, offset=9))
