"""Profiling and data-quality checks; each report is one aggregate over the table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pledgekit.functions.columns import complete, quoted, rows_of
from pledgekit.operators.cleaning import date_columns, has_final_state
from pledgekit.operators.ranking import approx_quantiles, exact_quantiles
from pledgekit.runtime import require_columns
from pledgekit.spec import CampaignSpec

FLOATING = (T.DoubleType, T.FloatType)


def _is_floating(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, FLOATING)


def _flagged(condition: Column) -> Column:
    """Number of rows where ``condition`` holds (0, not null, for an empty table)."""
    return F.count_if(condition)


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100)


@dataclass(frozen=True)
class Measures:
    """A report as named aggregates of a table, and as a table made of the one row that they give.

    The row may come from a pass of its own (``report``) or from a pass that writes the table (``pledgekit.plans.profile``).
    """

    columns: tuple[Column, ...]
    table: Callable[[DataFrame], DataFrame]

    def report(self, df: DataFrame) -> DataFrame:
        return self.table(df.agg(*self.columns))


def shape_measures(df: DataFrame, expected_rows: int | None, expected_columns: Sequence[str]) -> Measures:
    names_ok = list(df.columns) == list(expected_columns)
    rows_ok = F.lit(True) if expected_rows is None else F.col("n_rows") == expected_rows
    width = len(df.columns)

    def table(row: DataFrame) -> DataFrame:
        return row.select("n_rows", F.lit(width).alias("n_cols"), rows_ok.alias("rows_ok"), F.lit(names_ok).alias("cols_ok"))

    return Measures((F.count(F.lit(1)).alias("n_rows"),), table)


def shape_check(df: DataFrame, expected_rows: int | None, expected_columns: Sequence[str]) -> DataFrame:
    """One row: sizes found, and whether they are the ones expected."""
    return shape_measures(df, expected_rows, expected_columns).report(df)


def assert_shape(df: DataFrame, expected_rows: int | None, expected_columns: Sequence[str]) -> DataFrame:
    """``df`` itself, or an error telling what differs."""
    found = shape_check(df, expected_rows, expected_columns).first()
    if not found.cols_ok:
        raise ValueError(f"columns differ: found {df.columns}, expected {list(expected_columns)}")
    if not found.rows_ok:
        raise ValueError(f"row count differs: found {found.n_rows}, expected {expected_rows}")
    return df


def null_measures(df: DataFrame, columns: Sequence[str] | None = None, with_nan: bool = False) -> Measures:
    names = list(columns or df.columns)
    require_columns(df, names)
    nulls = [_flagged(quoted(c).isNull()).alias(f"_null{i}") for i, c in enumerate(names)]
    nans = []
    if with_nan:
        nans = [
            (_flagged(F.isnan(quoted(c))) if _is_floating(df, c) else F.count_if(F.lit(False))).alias(f"_nan{i}")
            for i, c in enumerate(names)
        ]
    entries = []
    for i, c in enumerate(names):
        entry = {
            "column": F.lit(c),
            "nulls": F.col(f"_null{i}"),
            "pct": _percent(F.col(f"_null{i}"), F.col("_n")),
        }
        if with_nan:
            entry["nans"] = F.col(f"_nan{i}")
        entries.append(entry)
    return Measures((F.count(F.lit(1)).alias("_n"), *nulls, *nans), lambda row: row.select(F.inline(rows_of(entries))))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None, with_nan: bool = False) -> DataFrame:
    """Nulls per column, in rows and percent; optionally NaN apart from null."""
    return null_measures(df, columns, with_nan).report(df)


def summary_measures(df: DataFrame, columns: Sequence[str]) -> Measures:
    require_columns(df, columns)
    measures = {
        "count": lambda c: F.count(c),
        "mean": lambda c: F.avg(c),
        "stddev": lambda c: F.stddev_samp(c),
        "min": lambda c: F.min(c),
        "max": lambda c: F.max(c),
    }
    aggregates = [
        f(quoted(c).cast("double")).alias(f"_{m}{i}") for i, c in enumerate(columns) for m, f in measures.items()
    ]
    entries = [
        {"column": F.lit(c), **{m: F.col(f"_{m}{i}") for m in measures}} for i, c in enumerate(columns)
    ]
    return Measures(tuple(aggregates), lambda row: row.select(F.inline(rows_of(entries))))


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Typed count, mean, sample deviation, minimum and maximum per column, in one pass."""
    return summary_measures(df, columns).report(df)


def range_violations(df: DataFrame, rules: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Rows outside declared inclusive bounds: (column, low, high, below, above)."""
    row = df.agg(
        *[
            agg
            for i, (c, (low, high)) in enumerate(rules.items())
            for agg in (
                _flagged(quoted(c) < low).alias(f"_below{i}"),
                _flagged(quoted(c) > high).alias(f"_above{i}"),
            )
        ]
    )
    entries = [
        {
            "column": F.lit(c),
            "low": F.lit(float(low)),
            "high": F.lit(float(high)),
            "below": F.col(f"_below{i}"),
            "above": F.col(f"_above{i}"),
        }
        for i, (c, (low, high)) in enumerate(rules.items())
    ]
    return row.select(F.inline(rows_of(entries)))


def value_counts(df: DataFrame, column: str, ascending_values: bool = False) -> DataFrame:
    """Rows per value, most frequent first (ties by value), or in order of value."""
    counted = df.groupBy(quoted(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    if ascending_values:
        return counted.orderBy("value")
    return counted.orderBy(F.desc("count"), "value")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys (null is one value), rows in excess, repeated keys, most copies of one."""
    return (
        df.groupBy(quoted(key).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
            F.count(F.lit(1)).alias("distinct_keys"),
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
            _flagged(F.col("_n") > 1).alias("repeated_keys"),
            F.coalesce(F.max("_n"), F.lit(0)).alias("max_copies"),
        )
    )


def audit_measures(df: DataFrame, spec: CampaignSpec = CampaignSpec()) -> Measures:
    has_outcome = has_final_state(spec)
    filled = complete(df.schema, spec.critical)
    dated = reduce(and_, [c.isNotNull() for c in date_columns(spec).values()])
    stages = [
        ("final_state", has_outcome),
        ("complete", has_outcome & filled),
        ("dated", has_outcome & filled & dated),
    ]
    aggregates = [
        F.count(F.lit(1)).alias("_after0"),
        *[_flagged(cond).alias(f"_after{i}") for i, (_, cond) in enumerate(stages, 1)],
    ]
    entries = []
    for i, (name, _) in enumerate(stages, 1):
        before, after = F.col(f"_after{i - 1}"), F.col(f"_after{i}")
        entries.append(
            {
                "step": F.lit(i),
                "stage": F.lit(name),
                "before": before,
                "after": after,
                "removed": before - after,
                "pct": _percent(before - after, before),
            }
        )
    return Measures(tuple(aggregates), lambda row: row.select(F.inline(rows_of(entries))))


def stage_audit(df: DataFrame, spec: CampaignSpec = CampaignSpec()) -> DataFrame:
    """Rows before and after each cleaning step, all steps counted in one pass over the raw table."""
    return audit_measures(df, spec).report(df)


def class_balance(df: DataFrame, label: str = "label", split: str | None = None) -> DataFrame:
    """Rows and percent per label, for the whole table and for each split, in one pass."""
    if split is None:
        counted = df.groupBy(quoted(label).alias("label")).agg(F.count(F.lit(1)).alias("count"))
        counted = counted.select(F.lit("all").alias("split"), "label", "count")
    else:
        frame = df.select(quoted(split).alias("_split"), quoted(label).alias("label"))
        counted = (
            frame.groupingSets([["_split", "label"], ["label"]], "_split", "label")
            .agg(F.count(F.lit(1)).alias("count"), F.grouping("_split").alias("_all"))
            .select(F.when(F.col("_all") == 1, "all").otherwise(F.col("_split")).alias("split"), "label", "count")
        )
    # The window runs over counts: one row per split and label.
    share = F.col("count") / F.sum("count").over(Window.partitionBy("split")) * 100
    return counted.withColumn("pct", share)


def quantiles(
    df: DataFrame, columns: Sequence[str], points: Sequence[float], relative_error: float = 0.01
) -> DataFrame:
    """Sketched quantiles within ``relative_error`` of the rank, or exact ones for an error of 0."""
    if relative_error == 0:
        return exact_quantiles(df, columns, points)
    return approx_quantiles(df, columns, points, relative_error)


def iqr_outliers(
    df: DataFrame,
    columns: Sequence[str],
    multiplier: float = 1.5,
    relative_error: float = 0.01,
    edges: DataFrame | None = None,
) -> DataFrame:
    """Quartiles, bounds and rows outside them per column; a report only, no row is dropped.

    One pass for the quartiles of all columns, one for all the counts. ``edges`` (column, probability, value) gives
    quartiles that are known, such as those of merged sketches, which spares the first pass.
    """
    if edges is None:
        edges = quantiles(df, columns, [0.25, 0.75], relative_error)
    # One row per profiled column, folded into a single-row lookup.
    lookup = (
        edges.groupBy("column")
        .agg(
            F.max(F.when(F.col("probability") == 0.25, F.col("value"))).alias("q1"),
            F.max(F.when(F.col("probability") == 0.75, F.col("value"))).alias("q3"),
        )
        .withColumn("spread", (F.col("q3") - F.col("q1")) * multiplier)
        .select(
            "column",
            F.struct("q1", "q3", (F.col("q1") - F.col("spread")).alias("lower"), (F.col("q3") + F.col("spread")).alias("upper")).alias("b"),
        )
        .agg(F.map_from_entries(F.collect_list(F.struct("column", "b"))).alias("m"))
    )
    row = (
        df.select(*[quoted(c).cast("double").alias(f"_v{i}") for i, c in enumerate(columns)])
        .withColumn("_m", lookup.scalar())
        .agg(
            F.count(F.lit(1)).alias("_n"),
            *[
                _flagged(
                    (F.col(f"_v{i}") < F.col("_m")[c]["lower"]) | (F.col(f"_v{i}") > F.col("_m")[c]["upper"])
                ).alias(f"_out{i}")
                for i, c in enumerate(columns)
            ],
        )
        .withColumn("_m", lookup.scalar())
    )
    entries = [
        {
            "column": F.lit(c),
            "q1": F.col("_m")[c]["q1"],
            "q3": F.col("_m")[c]["q3"],
            "lower": F.col("_m")[c]["lower"],
            "upper": F.col("_m")[c]["upper"],
            "outliers": F.col(f"_out{i}"),
            "pct": _percent(F.col(f"_out{i}"), F.col("_n")),
        }
        for i, c in enumerate(columns)
    ]
    return row.select(F.inline(rows_of(entries)))


def correlation_matrix(df: DataFrame, features: Mapping[str, Column], digits: int | None = 3) -> DataFrame:
    """Long symmetric Pearson matrix from one aggregate: (feature_x, feature_y, corr)."""
    names = list(features)
    frame = df.select(*[features[n].cast("double").alias(f"_f{i}") for i, n in enumerate(names)])
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
    row = frame.agg(*[F.corr(f"_f{i}", f"_f{j}").alias(f"_r{i}_{j}") for i, j in pairs])

    def cell(i: int, j: int) -> Column:
        if i == j:
            return F.lit(1.0)
        c = F.col(f"_r{min(i, j)}_{max(i, j)}")
        return c if digits is None else F.round(c, digits)

    entries = [
        {"feature_x": F.lit(names[i]), "feature_y": F.lit(names[j]), "corr": cell(i, j)}
        for i in range(len(names))
        for j in range(len(names))
    ]
    return row.select(F.inline(rows_of(entries)))


def leakage_screen(
    df: DataFrame,
    candidates: Sequence[str],
    label: str,
    withheld: Sequence[str],
    used_by: Mapping[str, str],
    threshold: float = 0.5,
) -> DataFrame:
    """Correlation of each candidate with the label, against the declared exclusions.

    ``flag`` is ``leaks`` for a column in use above the threshold, ``withheld`` for an excluded one,
    ``ok`` otherwise.
    """
    row = df.agg(
        *[
            F.corr(quoted(c).cast("double"), quoted(label).cast("double")).alias(f"_r{i}")
            for i, c in enumerate(candidates)
        ]
    )
    entries = []
    for i, c in enumerate(candidates):
        excluded = c in withheld
        strong = F.abs(F.col(f"_r{i}")) > threshold
        entries.append(
            {
                "feature": F.lit(c),
                "corr": F.col(f"_r{i}"),
                "excluded": F.lit(excluded),
                "used_by": F.lit(used_by.get(c, "none")),
                "flag": F.lit("withheld") if excluded else F.when(strong, "leaks").otherwise("ok"),
            }
        )
    return row.select(F.inline(rows_of(entries)))
