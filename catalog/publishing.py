"""Published sets of tables, refreshed partitions and rejected records."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixture import campaigns, featured, with_campaigns
from catalog.registry import register, rounded
from pledgekit.operators import reports
from pledgekit.runtime import fresh_path, stage
from pledgekit.sources import publication, tables
from pledgekit.spec import CampaignSpec

SPEC = CampaignSpec()
COLUMNS = tuple(c for c in reports.ENRICHED if c != "cluster")


def _published(spark, sf_dir) -> str:
    """A folder with two committed versions, and a third one that died between two of its tables."""
    rows = stage(reports.project(featured(spark, sf_dir), COLUMNS), "to-publish")
    folder = fresh_path(spark, "published")
    for part in (rows.filter(F.col("launched_year") < 1996), rows):
        out = publication.Publication(spark, folder)
        out.add("campaigns", part)
        out.add("success_by_country", reports.success_by(part, "country"), "parquet", single_file=True)
        out.add("dashboard", reports.dashboard(part), "json", partition_by=["section"])
        out.commit()
    publication.Publication(spark, folder).add("campaigns", rows.filter("label = 1"))
    return folder


@register("published_table", with_campaigns() + "SELECT " + ", ".join(f'"{c}"' for c in COLUMNS) + " FROM feat")
def published_table(spark, sf_dir):
    """The latest whole version of a table, read by the list of versions under its published schema."""
    return publication.read_published(spark, _published(spark, sf_dir), "campaigns")


@register(
    "published_versions",
    with_campaigns(
        """versions AS (SELECT CAST(1 AS BIGINT) AS number, * FROM feat WHERE launched_year < 1996
           UNION ALL SELECT CAST(2 AS BIGINT), * FROM feat)"""
    )
    + """SELECT number, 'campaigns' AS name, COUNT(*) AS "rows", COUNT(*) AS found, TRUE AS intact FROM versions GROUP BY number
         UNION ALL SELECT number, 'success_by_country', COUNT(DISTINCT country), COUNT(DISTINCT country), TRUE FROM versions GROUP BY number
         UNION ALL SELECT number, 'dashboard', n, n, TRUE FROM (SELECT number, 6 * (1 + COUNT(DISTINCT country)
           + COUNT(DISTINCT main_category) + COUNT(DISTINCT launch_month) + COUNT(DISTINCT launched_year)) AS n FROM versions GROUP BY number)""",
)
def published_versions(spark, sf_dir):
    """Every table of every committed version against its count and checksum."""
    folder = _published(spark, sf_dir)
    parts = [publication.verify_published(spark, folder, n).withColumn("number", F.lit(n).cast("bigint")) for n in (1, 2)]
    return parts[0].unionByName(parts[1])


@register(
    "refreshed_years",
    with_campaigns()
    + """SELECT launched_year, COUNT(*) AS campaigns, CAST(SUM(backers) AS BIGINT) AS backers, round(SUM(pledged), 2) AS pledged
         FROM feat GROUP BY launched_year""",
)
def refreshed_years(spark, sf_dir):
    """A table by year in which one year is stale and one is absent, after a refresh of these two years."""
    rows = stage(reports.project(featured(spark, sf_dir), COLUMNS), "to-refresh")
    stale = rows.filter((F.col("launched_year") != 1993) & ((F.col("launched_year") != 1995) | (F.col("ID") % 2 == 0)))
    path = tables.write_parquet(stale, fresh_path(spark, "by-year"), ["launched_year"])
    publication.refresh_partitions(rows, path, "launched_year", [1993, 1995])
    back = spark.read.schema(rows.schema).parquet(path)
    out = back.groupBy("launched_year").agg(
        F.count(F.lit(1)).alias("campaigns"), F.sum("backers").alias("backers"), F.sum("pledged").alias("pledged")
    )
    return rounded(out, "pledged", digits=2)


@register(
    "rejected_records",
    with_campaigns(
        """marked AS (SELECT "ID", CASE WHEN "ID" % 97 <> 0 THEN round(goal, 6) END AS goal, "ID" % 97 = 0 OR "ID" % 89 = 0 OR "ID" % 83 = 0 AS odd,
           concat_ws(',', CASE WHEN "ID" % 97 = 0 THEN 'goal' END, CASE WHEN "ID" % 89 = 0 OR backers IS NULL THEN 'backers' END) AS missing
           FROM campaigns)"""
    )
    + """SELECT "ID", goal, CASE WHEN odd AND missing <> '' THEN missing END AS reason,
         odd AND missing <> '' AS has_text FROM marked""",
)
def rejected_records(spark, sf_dir):
    """Campaign files with words in place of goals, backers and (not critical) dollars: both parts of one parse."""
    k = F.col("ID")
    text = campaigns(spark, sf_dir).withColumns(
        {
            "goal": F.when(k % 97 == 0, "much").otherwise(F.col("goal").cast("string")),
            "backers": F.when(k % 89 == 0, "many").otherwise(F.col("backers").cast("string")),
            "usd pledged": F.when(k % 83 == 0, "n/a").otherwise(F.col("usd pledged").cast("string")),
        }
    )
    path = tables.write_csv(text, fresh_path(spark, "junk-csv"))
    records = tables.sort_out(spark, path, SPEC.critical)
    accepted = records.accepted.select("ID", "goal", F.lit(None).cast("string").alias("reason"), F.lit(False).alias("has_text"))
    rejected = records.rejected.select("ID", "goal", "reason", (F.length("record") > 0).alias("has_text"))
    return rounded(accepted.union(rejected), "goal")
