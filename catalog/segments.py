"""Segmentation operators under fixed centers, which SQL can repeat."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.encodings import scaled_sql
from catalog.fixture import featured, with_campaigns
from catalog.registry import register, rounded
from pledgekit.functions.columns import nearest, rows_of
from pledgekit.operators import clustering, encoding, reports
from pledgekit.runtime import stage
from pledgekit.spec import PROFILE, ClusterSpec

FEATURES = ClusterSpec().features
SCALED = [f"{c}_scaled" for c in FEATURES]
DIMS = range(len(FEATURES))
INPUTS = [c for c in reports.ENRICHED if c != "cluster"]

# Four centers in scaled space, for checks that need a known model.
CENTERS = (
    (-0.4, -0.4, -0.8, -1.0, 0.0),
    (-0.4, -0.4, 0.2, 0.8, 0.0),
    (1.0, 0.5, 0.8, -0.6, 0.0),
    (2.0, 2.0, 1.2, 0.6, 0.0),
)


def _distance_sql(center) -> str:
    return " + ".join(f"(z{i} - ({v})) * (z{i} - ({v}))" for i, v in enumerate(center))


ASSIGNED_SQL = (
    scaled_sql("feat", FEATURES),
    "dist AS (SELECT *, "
    + ", ".join(f"{_distance_sql([f'CAST({v} AS DOUBLE)' for v in c])} AS d{i}" for i, c in enumerate(CENTERS))
    + " FROM scaled)",
    """assigned AS (
  SELECT *, CAST(CASE WHEN d0 <= d1 AND d0 <= d2 AND d0 <= d3 THEN 0 WHEN d1 <= d2 AND d1 <= d3 THEN 1
                      WHEN d2 <= d3 THEN 2 ELSE 3 END AS INT) AS cluster,
         LEAST(d0, d1, d2, d3) AS distance FROM dist)""",
)


def scaled(spark, sf_dir):
    """Staged first: scaling and the measures on top read the table two or three times."""
    rows = stage(featured(spark, sf_dir).select(*INPUTS), "segment-input")
    return encoding.standardise(rows, FEATURES)


def assigned(spark, sf_dir):
    return clustering.assign_nearest(scaled(spark, sf_dir), SCALED, CENTERS)


@register(
    "nearest_center",
    with_campaigns(*ASSIGNED_SQL) + 'SELECT "ID", cluster, round(distance, 6) AS cluster_distance FROM assigned',
)
def nearest_center(spark, sf_dir):
    return rounded(assigned(spark, sf_dir).select("ID", "cluster", "cluster_distance"), "cluster_distance")


@register("wcss", with_campaigns(*ASSIGNED_SQL) + "SELECT round(SUM(distance), 6) AS wcss FROM assigned")
def wcss(spark, sf_dir):
    return rounded(clustering.wcss(assigned(spark, sf_dir)), "wcss")


def costs(spark, sf_dir):
    """Cost under the first k fixed centers, every k in one pass: (k, wcss)."""
    columns = [F.col(c) for c in SCALED]
    ks = range(2, len(CENTERS) + 1)
    row = scaled(spark, sf_dir).agg(
        *[F.sum(nearest(columns, CENTERS[:k])["distance"]).alias(f"_k{k}") for k in ks]
    )
    return row.select(F.inline(rows_of([{"k": F.lit(k), "wcss": F.col(f"_k{k}")} for k in ks])))


@register(
    "wcss_drop",
    with_campaigns(
        *ASSIGNED_SQL,
        "costs AS ("
        + "\nUNION ALL\n".join(
            f"SELECT CAST({k} AS INT) AS k, SUM(LEAST({', '.join(f'd{i}' for i in range(k))})) AS wcss FROM dist"
            for k in range(2, len(CENTERS) + 1)
        )
        + ")",
    )
    + """SELECT k, round(wcss, 6) AS wcss,
         round((lag(wcss) OVER (ORDER BY k) - wcss) / lag(wcss) OVER (ORDER BY k) * 100, 6) AS drop_pct FROM costs""",
)
def wcss_drop(spark, sf_dir):
    return rounded(clustering.wcss_drop(costs(spark, sf_dir)), "wcss", "drop_pct")


@register(
    "cluster_sizes",
    with_campaigns(*ASSIGNED_SQL) + "SELECT cluster, COUNT(*) AS size FROM assigned GROUP BY cluster",
)
def cluster_sizes(spark, sf_dir):
    return clustering.cluster_sizes(assigned(spark, sf_dir))


def _silhouette_sql() -> str:
    norm = " + ".join(f"z{i} * z{i}" for i in DIMS)
    means = ", ".join(f"AVG(z{i}) AS m{i}" for i in DIMS)
    dot = " + ".join(f"z{i} * m{i}" for i in DIMS)
    return (
        with_campaigns(
            *ASSIGNED_SQL,
            f"moments AS (SELECT cluster AS c, COUNT(*) AS n, AVG({norm}) AS q, {means} FROM assigned GROUP BY cluster)",
            f"""pairs AS (SELECT "ID", cluster, c, n, {norm} + q - 2 * ({dot}) AS d FROM assigned, moments)""",
            """per_row AS (SELECT "ID", MAX(CASE WHEN cluster = c THEN n END) AS n,
               MAX(CASE WHEN cluster = c THEN d * n / GREATEST(n - 1, 1) END) AS a,
               MIN(CASE WHEN cluster <> c THEN d END) AS b FROM pairs GROUP BY "ID")""",
        )
        + "SELECT round(AVG(CASE WHEN n = 1 OR GREATEST(a, b) <= 0 THEN 0 ELSE (b - a) / GREATEST(a, b) END), 6) AS silhouette FROM per_row"
    )


@register("silhouette", _silhouette_sql())
def silhouette(spark, sf_dir):
    return rounded(clustering.silhouette(assigned(spark, sf_dir), SCALED), "silhouette")


@register(
    "cluster_profiles",
    with_campaigns(*ASSIGNED_SQL)
    + f"""SELECT cluster, COUNT("ID") AS size, {", ".join(f"round_even(AVG({c}), 3) AS {n}" for n, c in PROFILE)}
          FROM assigned GROUP BY cluster""",
)
def cluster_profiles(spark, sf_dir):
    return clustering.cluster_profiles(assigned(spark, sf_dir))


@register(
    "cluster_centers",
    with_campaigns(*ASSIGNED_SQL)
    + f"""SELECT cluster, {", ".join(f"round(AVG(z{i}), 6) AS {c}_scaled" for i, c in enumerate(FEATURES))},
          {", ".join(f"round(AVG({c}), 6) AS {c}" for c in FEATURES)} FROM assigned GROUP BY cluster""",
)
def cluster_centers(spark, sf_dir):
    columns = [*SCALED, *FEATURES]
    return rounded(clustering.center_means(assigned(spark, sf_dir), columns), *columns)


ENRICHED_DOUBLES = ("goal", "pledged", "usd_pledged_real", "usd_goal_real", "funding_ratio")


def _enriched_sql(columns) -> str:
    shown = [f'round("{c}", 6) AS "{c}"' if c in ENRICHED_DOUBLES else f'"{c}"' for c in columns]
    return with_campaigns(*ASSIGNED_SQL) + f"SELECT {', '.join(shown)} FROM assigned"


@register("campaigns_enriched", _enriched_sql(reports.ENRICHED))
def campaigns_enriched(spark, sf_dir):
    return rounded(reports.campaigns_enriched(assigned(spark, sf_dir)), *ENRICHED_DOUBLES)


@register("clustering_assignments", _enriched_sql(reports.ASSIGNMENTS))
def clustering_assignments(spark, sf_dir):
    enriched = reports.campaigns_enriched(assigned(spark, sf_dir))
    return rounded(reports.clustering_assignments(enriched), "goal", "usd_pledged_real", "funding_ratio")


BIN = "CAST(CASE WHEN {0} IS NULL OR isnan({0}) THEN NULL WHEN {0} >= 1 THEN floor(log10({0}) * 4) ELSE -1 END AS INT)"


@register(
    "cluster_dashboard",
    with_campaigns(*ASSIGNED_SQL)
    + f"""SELECT cluster, {BIN.format("goal")} AS goal_bin, {BIN.format("usd_pledged_real")} AS pledged_bin,
          COUNT(*) AS campaigns, round(AVG(backers), 6) AS avg_backers FROM assigned GROUP BY 1, 2, 3""",
)
def cluster_dashboard(spark, sf_dir):
    return rounded(reports.cluster_dashboard(assigned(spark, sf_dir)), "avg_backers")
