"""Dashboard aggregates and run facts."""

from __future__ import annotations


from catalog.fixture import campaigns, featured, split_featured, with_campaigns
from catalog.registry import register, rounded
from catalog.segments import BIN
from pledgekit.operators import reports
from pledgekit.runtime import fresh_path
from pledgekit.sources.tables import write_json

MEASURES_SQL = {
    "campaigns": "CAST(COUNT(*) AS DOUBLE)",
    "success_rate": "AVG(label)",
    "total_pledged": "SUM(usd_pledged_real)",
    "total_backers": "CAST(SUM(backers) AS DOUBLE)",
    "avg_goal": "AVG(usd_goal_real)",
    "avg_funding_ratio": "AVG(funding_ratio)",
}


@register(
    "kpi_overview",
    with_campaigns()
    + """SELECT COUNT(*) AS campaigns, round(AVG(label), 6) AS success_rate,
         round(SUM(usd_pledged_real), 2) AS total_pledged, CAST(SUM(backers) AS BIGINT) AS total_backers,
         round(AVG(usd_goal_real), 6) AS avg_goal, round(AVG(funding_ratio), 6) AS avg_funding_ratio FROM feat""",
)
def kpi_overview(spark, sf_dir):
    out = reports.kpi_overview(featured(spark, sf_dir))
    return rounded(rounded(out, "success_rate", "avg_goal", "avg_funding_ratio"), "total_pledged", digits=2)


def _success_sql(*dimensions: str) -> str:
    names = ", ".join(dimensions)
    return (
        with_campaigns()
        + f"SELECT {names}, COUNT(*) AS campaigns, round(AVG(label), 6) AS success_rate FROM feat GROUP BY {names}"
    )


@register("success_by_country", _success_sql("country"))
def success_by_country(spark, sf_dir):
    return rounded(reports.success_by(featured(spark, sf_dir), "country"), "success_rate")


@register(
    "success_by_category",
    with_campaigns("rates AS (SELECT main_category, COUNT(*) AS campaigns, AVG(label) AS success_rate FROM feat GROUP BY 1)")
    + """SELECT main_category, campaigns, round(success_rate, 6) AS success_rate,
         CAST(dense_rank() OVER (ORDER BY success_rate DESC) AS INT) AS "rank" FROM rates""",
)
def success_by_category(spark, sf_dir):
    return rounded(reports.ranked_success_by(featured(spark, sf_dir), "main_category"), "success_rate")


@register("success_by_month", _success_sql("launch_month", "main_category"))
def success_by_month(spark, sf_dir):
    return rounded(reports.success_by(featured(spark, sf_dir), "launch_month", "main_category"), "success_rate")


@register(
    "goal_vs_pledged",
    with_campaigns()
    + f"""SELECT {BIN.format("goal")} AS goal_bin, {BIN.format("pledged")} AS pledged_bin, state,
          COUNT(*) AS campaigns FROM feat GROUP BY 1, 2, 3""",
)
def goal_vs_pledged(spark, sf_dir):
    return reports.goal_vs_pledged(featured(spark, sf_dir))


@register("campaigns_per_year", _success_sql("launched_year"))
def campaigns_per_year(spark, sf_dir):
    return rounded(reports.campaigns_per_year(featured(spark, sf_dir)), "success_rate")


def _dashboard_sql() -> str:
    parts = []
    for section, item in [("overview", None)] + [(d, d) for d in reports.DIMENSIONS]:
        for name, text in MEASURES_SQL.items():
            shown = f"CAST({item} AS VARCHAR)" if item else "'all'"
            group = f" GROUP BY {item}" if item else ""
            parts.append(
                f"SELECT '{section}' AS section, {shown} AS item, '{name}' AS measure, round({text}, 3) AS value FROM feat{group}"
            )
    return with_campaigns() + "\nUNION ALL\n".join(parts)


@register("dashboard", _dashboard_sql())
def dashboard(spark, sf_dir):
    return rounded(reports.dashboard(featured(spark, sf_dir)), "value", digits=3)


def _item(*keys: str) -> str:
    return " || '/' || ".join(f"COALESCE(CAST({k} AS VARCHAR), 'none')" for k in keys)


WHOLE_SQL = f"""
UNION ALL SELECT 'month_category', {_item("launch_month", "main_category")}, m.measure,
  round(CASE m.measure WHEN 'campaigns' THEN CAST(campaigns AS DOUBLE) ELSE success_rate END, 3)
FROM (SELECT launch_month, main_category, COUNT(*) AS campaigns, AVG(label) AS success_rate FROM feat GROUP BY 1, 2),
     (VALUES ('campaigns'), ('success_rate')) AS m(measure)
UNION ALL SELECT 'goal_vs_pledged', {_item("goal_bin", "pledged_bin", "state")}, 'campaigns', CAST(COUNT(*) AS DOUBLE)
FROM (SELECT {BIN.format("goal")} AS goal_bin, {BIN.format("pledged")} AS pledged_bin, state FROM feat)
GROUP BY goal_bin, pledged_bin, state"""


@register("dashboard_json", _dashboard_sql() + WHOLE_SQL)
def dashboard_json(spark, sf_dir):
    """All sections that need no model, through the JSON writer and back."""
    rows = reports.whole_dashboard(featured(spark, sf_dir))
    path = write_json(rows, fresh_path(spark, "dashboard"), ["section"])
    back = spark.read.schema("item string, measure string, value double, section string").json(path)
    return rounded(back.select(*rows.columns), "value", digits=3)


@register(
    "run_summary",
    with_campaigns()
    + """SELECT 'run' AS section, 'seed' AS item, CAST(42 AS DOUBLE) AS value
         UNION ALL SELECT 'rows', 'raw', CAST(COUNT(*) AS DOUBLE) FROM campaigns
         UNION ALL SELECT 'rows', 'clean', CAST(COUNT(*) AS DOUBLE) FROM parts
         UNION ALL SELECT 'rows', 'successful', CAST(COUNT_IF(label = 1) AS DOUBLE) FROM parts
         UNION ALL SELECT 'split', 'train', CAST(COUNT_IF(split = 'train') AS DOUBLE) FROM parts
         UNION ALL SELECT 'split', 'test', CAST(COUNT_IF(split = 'test') AS DOUBLE) FROM parts""",
)
def run_summary(spark, sf_dir):
    return reports.run_facts(split_featured(spark, sf_dir), campaigns(spark, sf_dir), 42)
