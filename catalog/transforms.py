"""Sources, sinks, filters, scalar columns and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixture import campaigns, featured, split_featured, with_campaigns
from catalog.registry import register, rounded
from pledgekit.functions import columns as C
from pledgekit.operators import cleaning, features, reports, splitting
from pledgekit.runtime import fresh_path
from pledgekit.sources import tables
from pledgekit.spec import CampaignSpec, SplitSpec

SPEC = CampaignSpec()
RAW = tables.CAMPAIGN_SCHEMA.fieldNames()
WALL_CLOCK = "timestamp_ntz"


def _names(columns) -> str:
    return ", ".join(f'"{c}"' for c in columns)


@register("csv_scan", with_campaigns() + f"SELECT {_names(RAW)} FROM campaigns")
def csv_scan(spark, sf_dir):
    """Campaigns written as CSV, read back under the declared schema with header checks."""
    path = tables.write_csv(campaigns(spark, sf_dir), fresh_path(spark, "campaigns-csv"))
    return tables.scan_csv(spark, path)


EXPORTED = tuple(c for c in reports.ENRICHED if c != "cluster")


@register("csv_sink", with_campaigns() + f"SELECT {_names(EXPORTED)} FROM feat")
def csv_sink(spark, sf_dir):
    """Featured campaigns through the CSV writer, read back with their own schema."""
    rows = reports.project(featured(spark, sf_dir), EXPORTED)
    path = tables.write_csv(rows, fresh_path(spark, "featured-csv"))
    return tables.scan_csv(spark, path, rows.schema, multi_line=False)


@register(
    "csv_readback",
    with_campaigns()
    + """SELECT country, COUNT(*) AS campaigns, round(AVG(label), 6) AS success_rate
         FROM feat GROUP BY country""",
)
def csv_readback(spark, sf_dir):
    return rounded(csv_sink(spark, sf_dir).transform(reports.success_by, "country"), "success_rate")


@register("parquet_sink", with_campaigns() + f"SELECT {_names(EXPORTED)} FROM feat")
def parquet_sink(spark, sf_dir):
    """The table partitioned by launch year, read back whole; a filter on the year prunes partitions."""
    rows = reports.project(featured(spark, sf_dir), EXPORTED)
    path = tables.write_parquet(rows, fresh_path(spark, "featured"), ["launched_year"])
    return spark.read.schema(rows.schema).parquet(path).select(*EXPORTED)


@register(
    "filter_states", with_campaigns() + """SELECT "ID", state, goal, pledged FROM kept"""
)
def filter_states(spark, sf_dir):
    return campaigns(spark, sf_dir).transform(cleaning.keep_states).select("ID", "state", "goal", "pledged")


@register(
    "filter_range", with_campaigns() + """SELECT "ID", goal FROM campaigns WHERE goal < 100 OR goal > 50000"""
)
def filter_range(spark, sf_dir):
    return cleaning.outside_range(campaigns(spark, sf_dir), "goal", 100, 50000).select("ID", "goal")


@register(
    "filter_pair",
    with_campaigns()
    + """SELECT "ID", label, goal_bucket FROM feat WHERE label = 1 AND goal_bucket = 'micro'""",
)
def filter_pair(spark, sf_dir):
    rows = cleaning.matching(featured(spark, sf_dir), {"label": 1, "goal_bucket": "micro"})
    return rows.select("ID", "label", "goal_bucket")


@register("binary_label", with_campaigns() + """SELECT "ID", state, label FROM kept""")
def binary_label(spark, sf_dir):
    rows = campaigns(spark, sf_dir).transform(cleaning.keep_states).transform(cleaning.add_label)
    return rows.select("ID", "state", "label")


@register("drop_null_rows", with_campaigns() + f"SELECT {_names(SPEC.critical)} FROM complete")
def drop_null_rows(spark, sf_dir):
    rows = campaigns(spark, sf_dir).transform(cleaning.keep_states)
    return cleaning.drop_incomplete(rows, SPEC.critical).select(*SPEC.critical)


@register(
    "fill_defaults", with_campaigns() + """SELECT "ID", COALESCE(name, 'Unknown') AS name FROM campaigns"""
)
def fill_defaults(spark, sf_dir):
    return campaigns(spark, sf_dir).transform(cleaning.fill_defaults).select("ID", "name")


@register(
    "parse_timestamps",
    with_campaigns()
    + """SELECT "ID", try_strptime(deadline, '%Y-%m-%d') AS deadline_ts,
         try_strptime(launched, '%Y-%m-%d %H:%M:%S') AS launched_ts FROM campaigns""",
)
def parse_timestamps(spark, sf_dir):
    rows = campaigns(spark, sf_dir).transform(cleaning.parse_dates)
    return rows.select(
        "ID", F.col("deadline_ts").cast(WALL_CLOCK).alias("deadline_ts"), F.col("launched_ts").cast(WALL_CLOCK).alias("launched_ts")
    )


def _feature_query(name: str, *columns: str, digits: int | None = None) -> None:
    shown = [f"round({c}, {digits}) AS {c}" if digits else f'"{c}"' for c in columns]

    @register(name, with_campaigns() + f"""SELECT "ID", {", ".join(shown)} FROM feat""")
    def build(spark, sf_dir):
        rows = featured(spark, sf_dir).select("ID", *columns)
        return rounded(rows, *columns, digits=digits) if digits else rows


_feature_query("duration_days", "campaign_duration_days")
_feature_query("launch_month", "launch_month")
_feature_query("launch_weekday", "launch_day_of_week")
_feature_query("launch_year", "launched_year")
_feature_query("funding_ratio", "funding_ratio", digits=6)
_feature_query("goal_bucket", "goal_bucket")
_feature_query("is_overfunded", "is_overfunded")
_feature_query("log_target", "pledged_log", digits=6)


@register(
    "inverse_log",
    with_campaigns()
    + """SELECT "ID", round(exp(pledged_log) - 1, 6) AS pledged_back FROM feat""",
)
def inverse_log(spark, sf_dir):
    rows = features.add_amount_from_log(featured(spark, sf_dir), "pledged_log", "pledged_back")
    return rounded(rows.select("ID", "pledged_back"), "pledged_back")


@register(
    "project_alias",
    with_campaigns()
    + """SELECT "ID", "usd pledged" AS usd_pledged, main_category AS field, country FROM campaigns""",
)
def project_alias(spark, sf_dir):
    return reports.project(
        campaigns(spark, sf_dir),
        ["ID", "usd pledged", "main_category", "country"],
        {"usd pledged": "usd_pledged", "main_category": "field"},
    )


@register(
    "round_values",
    with_campaigns()
    + """SELECT "ID", round_even(funding_ratio, 3) AS funding_ratio, round_even(usd_goal_real, 3) AS usd_goal_real
         FROM feat""",
)
def round_values(spark, sf_dir):
    rows = featured(spark, sf_dir)
    return rows.select(
        "ID", *[C.half_even(F.col(c), 3).alias(c) for c in ("funding_ratio", "usd_goal_real")]
    )


@register(
    "random_split",
    with_campaigns()
    + """SELECT COUNT(*) AS rows_in, COUNT(*) AS rows_out, CAST(0 AS BIGINT) AS keys_in_both,
         COUNT(DISTINCT "ID") AS keys_out FROM feat""",
)
def random_split(spark, sf_dir):
    """Which rows go where depends on the layout; that every row lands once does not."""
    rows = featured(spark, sf_dir).select("ID")
    train, test = splitting.random_split(rows)
    tagged = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    per_key = tagged.groupBy("ID").agg(
        F.count(F.lit(1)).alias("n"), (F.min("part") != F.max("part")).alias("both")
    )
    total = rows.agg(F.count(F.lit(1)).alias("n"))
    return (
        per_key.agg(
            F.sum("n").alias("rows_out"),
            F.count_if(F.col("both")).alias("keys_in_both"),
            F.count(F.lit(1)).alias("keys_out"),
        )
        .withColumn("rows_in", total.scalar())
        .select("rows_in", "rows_out", "keys_in_both", "keys_out")
    )


@register("hash_split", with_campaigns() + """SELECT "ID", split FROM parts""")
def hash_split(spark, sf_dir):
    return splitting.hash_split(featured(spark, sf_dir), "ID").select("ID", "split")


@register(
    "hash_split_salted",
    with_campaigns()
    + """SELECT "ID", CASE WHEN CAST('0x' || substr(md5(CAST("ID" AS VARCHAR) || '-second'), 1, 8) AS BIGINT) % 100 < 70
         THEN 'train' ELSE 'test' END AS split FROM feat""",
)
def hash_split_salted(spark, sf_dir):
    spec = SplitSpec(train_percent=70, salt="-second")
    return splitting.hash_split(featured(spark, sf_dir), "ID", spec).select("ID", "split")


@register("fold_assign", with_campaigns() + """SELECT "ID", split, fold FROM parts""")
def fold_assign(spark, sf_dir):
    return split_featured(spark, sf_dir).select("ID", "split", "fold")
