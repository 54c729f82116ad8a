"""Result tables and dashboard aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pledgekit.functions.columns import amount_from_log, log_bin, positive_probability, quoted, rows_of
from pledgekit.runtime import require_columns

# Column order of the published per-campaign tables.
ENRICHED = (
    "ID",
    "category",
    "main_category",
    "currency",
    "country",
    "state",
    "label",
    "goal",
    "pledged",
    "usd_pledged_real",
    "usd_goal_real",
    "backers",
    "launched_year",
    "launch_month",
    "launch_day_of_week",
    "campaign_duration_days",
    "funding_ratio",
    "goal_bucket",
    "is_overfunded",
    "cluster",
)
ASSIGNMENTS = (
    "ID",
    "cluster",
    "goal",
    "usd_pledged_real",
    "backers",
    "campaign_duration_days",
    "funding_ratio",
)

# Rows and columns of the published correlation matrix.
CORRELATED = {
    "Goal (log)": "log1p(goal)",
    "Pledged (log)": "log1p(pledged)",
    "Backers (log)": "log1p(backers)",
    "Duration (d)": "campaign_duration_days",
    "Funding ratio": "funding_ratio",
    "Success": "label",
}

DIMENSIONS = ("country", "main_category", "launch_month", "launched_year")


def project(df: DataFrame, columns: Sequence[str], aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Named columns in order, some under another name."""
    aliases = aliases or {}
    require_columns(df, columns)
    return df.select(*[quoted(c).alias(aliases.get(c, c)) for c in columns])


def campaigns_enriched(clustered: DataFrame) -> DataFrame:
    """One row per campaign: dimensions, amounts, features and cluster."""
    out = clustered
    if "launched_year" not in out.columns:
        out = out.withColumn("launched_year", F.year("launched_ts"))
    return project(out, ENRICHED)


def clustering_assignments(enriched: DataFrame) -> DataFrame:
    return project(enriched, ASSIGNMENTS)


def classification_results(scored: DataFrame, key: str = "ID", label: str = "label") -> DataFrame:
    return scored.select(
        quoted(key), quoted(label), "prediction", positive_probability(F.col("probability")).alias("prob_success")
    )


def regression_results(scored: DataFrame, key: str = "ID", amount: str = "pledged") -> DataFrame:
    return scored.select(
        quoted(key),
        quoted(amount),
        F.col("prediction").alias("pledged_log_pred"),
        amount_from_log(F.col("prediction")).alias("pledged_pred"),
    )


def _measures() -> dict[str, Column]:
    """The headline figures."""
    return {
        "campaigns": F.count(F.lit(1)),
        "success_rate": F.avg("label"),
        "total_pledged": F.sum("usd_pledged_real"),
        "total_backers": F.sum("backers"),
        "avg_goal": F.avg("usd_goal_real"),
        "avg_funding_ratio": F.avg("funding_ratio"),
    }


def correlated_features(log_ratio: bool = False) -> dict[str, Column]:
    """Columns of the correlation matrix; ``log_ratio`` takes ``log1p`` of the heavy-tailed funding ratio too."""
    out = {name: F.expr(text) for name, text in CORRELATED.items()}
    if log_ratio:
        out["Funding ratio"] = F.log1p("funding_ratio")
    return out


def kpi_overview(df: DataFrame) -> DataFrame:
    """Headline figures, one row."""
    return df.agg(*[m.alias(n) for n, m in _measures().items()])


def success_by(df: DataFrame, *dimensions: str) -> DataFrame:
    """Campaigns and success rate per combination of the dimensions."""
    return df.groupBy(*[quoted(d) for d in dimensions]).agg(
        F.count(F.lit(1)).alias("campaigns"), F.avg("label").alias("success_rate")
    )


def ranked_success_by(df: DataFrame, dimension: str) -> DataFrame:
    """``success_by`` one dimension, with a dense rank from the highest rate.

    The window runs over the aggregate: one row per level of a report dimension.
    """
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("success_rate"))
    return success_by(df, dimension).withColumn("rank", F.dense_rank().over(order))


def campaigns_per_year(df: DataFrame) -> DataFrame:
    return success_by(df, "launched_year")


def goal_vs_pledged(df: DataFrame, by: Sequence[str] = ("state",), per_decade: int = 4) -> DataFrame:
    """Density of goal against pledged in logarithmic bins, split by other columns."""
    return (
        df.withColumns(
            {
                "goal_bin": log_bin(quoted("goal"), per_decade),
                "pledged_bin": log_bin(quoted("pledged"), per_decade),
            }
        )
        .groupBy("goal_bin", "pledged_bin", *[quoted(b) for b in by])
        .agg(F.count(F.lit(1)).alias("campaigns"))
    )


def cluster_dashboard(clustered: DataFrame, per_decade: int = 4) -> DataFrame:
    """Density of goal against pledged per cluster, with mean backers as the mark size."""
    return (
        clustered.withColumns(
            {
                "goal_bin": log_bin(quoted("goal"), per_decade),
                "pledged_bin": log_bin(quoted("usd_pledged_real"), per_decade),
            }
        )
        .groupBy("cluster", "goal_bin", "pledged_bin")
        .agg(F.count(F.lit(1)).alias("campaigns"), F.avg("backers").alias("avg_backers"))
    )


def _sections(
    df: DataFrame, keys: Mapping[str, Column], sections: Mapping[str, tuple[Sequence[str], Sequence[str]]]
) -> DataFrame:
    """Breakdowns as (section, item, measure, value), all from one pass over the table.

    ``keys`` names grouping columns, ``sections`` the (keys, measures) of each breakdown. Rows are narrowed to keys and
    measured columns, expanded once per section, and added up per task before they are shuffled.
    """
    measures = _measures() | {"avg_backers": F.avg("backers")}
    used = {m for _, shown in sections.values() for m in shown}
    frame = df.select(
        *[k.cast("string").alias(n) for n, k in keys.items()],
        "label",
        "usd_pledged_real",
        "usd_goal_real",
        "backers",
        "funding_ratio",
    )
    names = list(keys)
    grouped = frame.groupingSets([list(own) for own, _ in sections.values()], *names).agg(
        *[m.cast("double").alias(n) for n, m in measures.items() if n in used], F.grouping_id(*names).alias("_set")
    )
    section, item, entries = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None)
    for name, (own, shown) in sections.items():
        here = F.col("_set") == sum(1 << (len(names) - 1 - i) for i, n in enumerate(names) if n not in own)
        # A breakdown by one column keeps a missing key as null, in joined keys it shows as ``none``.
        joined = F.concat_ws("/", *[F.coalesce(F.col(k), F.lit("none")) for k in own])
        section = F.when(here, F.lit(name)).otherwise(section)
        item = F.when(here, F.lit("all") if not own else F.col(own[0]) if len(own) == 1 else joined).otherwise(item)
        shown_here = rows_of([{"measure": F.lit(m), "value": F.col(m)} for m in shown])
        entries = F.when(here, shown_here).otherwise(entries)
    return grouped.select(section.alias("section"), item.alias("item"), F.inline(entries))


def dashboard(df: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Overall figures and every one-dimension breakdown in long form: (section, item, measure, value)."""
    every = tuple(_measures())
    sections = {"overview": ((), every), **{d: ((d,), every) for d in dimensions}}
    return _sections(df, {d: quoted(d) for d in dimensions}, sections)


def whole_dashboard(df: DataFrame, clustered: bool = False, per_decade: int = 4) -> DataFrame:
    """``dashboard`` with month by category, the density of goal against pledged, and, of ``clustered`` rows, of clusters.

    All sections are grouping sets of one aggregate, so the campaigns are read once.
    """
    every = tuple(_measures())
    keys = {d: quoted(d) for d in DIMENSIONS}
    keys |= {"goal_bin": log_bin(quoted("goal"), per_decade), "pledged_bin": log_bin(quoted("pledged"), per_decade), "state": quoted("state")}
    sections = {
        "overview": ((), every),
        **{d: ((d,), every) for d in DIMENSIONS},
        "month_category": (("launch_month", "main_category"), ("campaigns", "success_rate")),
        "goal_vs_pledged": (("goal_bin", "pledged_bin", "state"), ("campaigns",)),
    }
    if clustered:
        keys |= {"cluster": quoted("cluster"), "usd_bin": log_bin(quoted("usd_pledged_real"), per_decade)}
        sections["clusters"] = (("cluster", "goal_bin", "usd_bin"), ("campaigns", "avg_backers"))
    return _sections(df, keys, sections)


def run_facts(featured: DataFrame, raw: DataFrame, seed: int, label: str = "label") -> DataFrame:
    """Row counts of a run in long form: (section, item, value). ``featured`` carries ``split``."""
    raw_row = raw.agg(F.count(F.lit(1)).cast("double").alias("n"))
    clean_row = featured.agg(
        F.count(F.lit(1)).cast("double").alias("clean"),
        F.count_if(F.col("split") == "train").cast("double").alias("train"),
        F.count_if(F.col("split") == "test").cast("double").alias("test"),
        F.count_if(quoted(label) == 1).cast("double").alias("successful"),
    )
    entries = [
        {"section": F.lit("run"), "item": F.lit("seed"), "value": F.lit(float(seed))},
        {"section": F.lit("rows"), "item": F.lit("clean"), "value": F.col("clean")},
        {"section": F.lit("rows"), "item": F.lit("successful"), "value": F.col("successful")},
        {"section": F.lit("split"), "item": F.lit("train"), "value": F.col("train")},
        {"section": F.lit("split"), "item": F.lit("test"), "value": F.col("test")},
    ]
    return raw_row.select(F.lit("rows").alias("section"), F.lit("raw").alias("item"), F.col("n").alias("value")).unionByName(
        clean_row.select(F.inline(rows_of(entries)))
    )


def metric_facts(section: str, report: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """A model report as run facts: item ``<model>: <metric>``."""
    entries = [
        {
            "section": F.lit(section),
            "item": F.concat(F.col("model"), F.lit(f": {m}")),
            "value": F.col(m).cast("double"),
        }
        for m in metrics
    ]
    return report.select(F.inline(rows_of(entries)))
