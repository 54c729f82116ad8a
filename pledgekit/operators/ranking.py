"""Order statistics that never sort a whole table, or one of its groups, in a single task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pledgekit.functions.columns import quoted
from pledgekit.runtime import ensure_checkpoints, stage


def running_totals(df: DataFrame, order: str, amounts: Sequence[str], by: str | None = None) -> DataFrame:
    """Add ``cum_<amount>`` (inclusive, ascending ``order``) and ``total_<amount>`` columns.

    ``df`` holds one row per (``by``, ``order``) value, i.e. it is already pre-aggregated. One sort by (``by``,
    ``order``) over value ranges deals all rows evenly, however many members ``by`` has and however many of the rows one
    member holds. Its ranges are written once and never cut again: each is summed up by member, each sum is
    carried to the later ranges of the same member, and every range adds up its own rows from there. A member has
    at most one carried sum per range. A null member is a member of its own.
    """
    group = F.coalesce(F.concat(F.lit("="), quoted(by).cast("string")), F.lit("")) if by else F.lit("")
    sorted_rows = df.withColumn("_group", group).orderBy("_group", quoted(order)).withColumn("_range", F.spark_partition_id())
    rows = stage(sorted_rows, "running-totals")
    below = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_group")
    starts = (
        rows.groupBy("_group", "_range")
        .agg(*[F.sum(quoted(a)).alias(f"_sum_{a}") for a in amounts])
        .select(
            "_group",
            "_range",
            *[F.coalesce(F.sum(f"_sum_{a}").over(below), F.lit(0)).alias(f"_start_{a}") for a in amounts],
            *[F.sum(f"_sum_{a}").over(whole).alias(f"total_{a}") for a in amounts],
        )
    )
    within = (
        Window.partitionBy("_group", "_range")
        .orderBy(quoted(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rows.join(starts, ["_group", "_range"]).select(
        *[quoted(c) for c in df.columns],
        *[(F.col(f"_start_{a}") + F.sum(quoted(a)).over(within)).alias(f"cum_{a}") for a in amounts],
        *[f"total_{a}" for a in amounts],
    )


def number_rows(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add the 0-based position of each row in a total order, by a range-partitioned sort.

    The sorted rows are checkpointed, so positions within a partition and the partition sizes are
    read from the same files even if executors are lost in between.
    """
    ensure_checkpoints(df.sparkSession)
    ordered = df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ordered.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    position = (F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)).alias(name)
    # Size bound of the broadcast: one row per sort partition.
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .select(*[quoted(c) for c in df.columns], position)
    )


def exact_quantiles(df: DataFrame, columns: Sequence[str], points: Sequence[float]) -> DataFrame:
    """Interpolated quantiles, exact at any size: (column, probability, value).

    Values are counted first, so repeated values cost nothing later. Nulls and NaN are left out.
    """
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), quoted(c).cast("double").alias("value")) for c in columns]
    )
    counts = (
        df.select(F.inline(entries))
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = running_totals(counts, "value", ["n"], by="column")
    picks = []
    for i, p in enumerate(points):
        at = F.lit(float(p)) * (F.col("total_n") - 1)
        low = F.min(F.when(F.col("cum_n") > F.floor(at), F.col("value")))
        high = F.min(F.when(F.col("cum_n") > F.ceil(at), F.col("value")))
        share = F.max(at - F.floor(at))
        picks.append((low + (high - low) * share).alias(f"_q{i}"))
    long = F.array(
        *[
            F.struct(F.lit(float(p)).alias("probability"), F.col(f"_q{i}").alias("value"))
            for i, p in enumerate(points)
        ]
    )
    return ranked.groupBy("column").agg(*picks).select("column", F.inline(long))


def approx_quantiles(
    df: DataFrame, columns: Sequence[str], points: Sequence[float], relative_error: float = 0.01
) -> DataFrame:
    """Sketched quantiles of all columns in one pass: (column, probability, value)."""
    accuracy = max(1, round(1 / relative_error))
    targets = [float(p) for p in points]
    row = df.agg(
        *[
            F.percentile_approx(
                F.when(~F.isnan(quoted(c).cast("double")), quoted(c).cast("double")), targets, accuracy
            ).alias(f"_q{i}")
            for i, c in enumerate(columns)
        ]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(p).alias("probability"),
                F.col(f"_q{i}")[j].alias("value"),
            )
            for i, c in enumerate(columns)
            for j, p in enumerate(targets)
        ]
    )
    return row.select(F.inline(entries))
