"""Session-level helpers: shared storage, lineage cuts, scoped caching."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it; a session that names none is refused."""
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if not named:
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    return named.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoints(spark: SparkSession) -> None:
    """Make ``checkpoint()`` (and the checkpoint intervals of tree models) usable."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def stage(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    The result has no lineage to recompute after an executor loss, and each later reader prunes
    columns and partitions. Column metadata (vector slot names) survives the round trip.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(_order(df, partition_by)).parquet(path)


def _order(df: DataFrame, last: Sequence[str]):
    return df.select(*[f"`{c}`" for c in df.columns if c not in last], *[f"`{c}`" for c in last]).schema


def small(report: DataFrame) -> DataFrame:
    """A report of a few rows, computed now and held with the plan, so that its readers do not compute it again."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)


@contextmanager
def persisted(*frames: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Cache frames for the length of a block of repeated reads, then release them."""
    held = [f.persist(StorageLevel.MEMORY_AND_DISK) for f in frames]
    try:
        yield tuple(held)
    finally:
        for f in held:
            f.unpersist()


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` itself, or an error naming every absent column."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df
