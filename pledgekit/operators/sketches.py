"""Quantile sketches that are kept per group and merged, so that a new group does not read the others again."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgekit.functions.columns import quoted, rows_of
from pledgekit.runtime import require_columns

#: Largest and smallest size parameter of a sketch.
SIZES = (8, 65_535)


def sketch_size(relative_error: float) -> int:
    """Size parameter whose rank error is half of ``relative_error``, at 99 in 100 merged quantiles.

    The published error of these sketches is 2.296 / k^0.9723.
    """
    if not 0 < relative_error < 1:
        raise ValueError("the relative error of a sketch lies between 0 and 1")
    wanted = math.ceil((2.296 / (relative_error / 2)) ** (1 / 0.9723))
    if wanted > SIZES[1]:
        raise ValueError(f"a relative error of {relative_error} needs more than the largest sketch; use exact quantiles")
    return max(SIZES[0], wanted)


def quantile_sketches(df: DataFrame, columns: Sequence[str], by: str, relative_error: float = 0.01) -> DataFrame:
    """(column, n, sketch, by): one binary sketch of every column and group, all in one pass.

    Nulls and NaN are left out; a group without a value has no sketch. Sketches are built per task and
    merged by group, so a hot group costs one sketch per task.
    """
    require_columns(df, [*columns, by])
    size = sketch_size(relative_error)
    values = [F.when(~F.isnan(quoted(c).cast("double")), quoted(c).cast("double")) for c in columns]
    row = df.groupBy(quoted(by)).agg(
        *[F.count(v).alias(f"_n{i}") for i, v in enumerate(values)],
        *[F.kll_sketch_agg_double(v, F.lit(size)).alias(f"_s{i}") for i, v in enumerate(values)],
    )
    entries = [{"column": F.lit(c), "n": F.col(f"_n{i}"), "sketch": F.col(f"_s{i}")} for i, c in enumerate(columns)]
    return row.select(quoted(by), F.inline(rows_of(entries))).filter(F.col("n") > 0).select("column", "n", "sketch", quoted(by))


def write_sketches(sketches: DataFrame, path: str, by: str) -> str:
    """Write sketches by group. Groups that are given replace their own files; the others' stay as they are."""
    sketches.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(by).parquet(path)
    return path


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """(column, n, sketch) over all groups of a sketch table; filter it first for a range of groups."""
    return sketches.groupBy("column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def merged_quantiles(sketches: DataFrame, points: Sequence[float]) -> DataFrame:
    """(column, probability, value) over all groups of a sketch table, without reading the data."""
    at = [{"probability": F.lit(float(p)), "value": F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))} for p in points]
    return merged_sketches(sketches).select("column", F.inline(rows_of(at)))
