"""A campaign-shaped view over the order tables, the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pledgekit.plans.campaigns import clean, featurise, with_split


# Columns used, declared so that no job has to look for the schema in file footers.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_quantity double, l_extendedprice double",
}


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15 raw columns, one row per order; lines are summed per order before the join.

    Prices are added up in cents, which is exact in any order. Orders are hashed by key, as the sums
    already are: the join needs that anyway, and a single small file still spreads over all cores.
    """

    def table(name: str) -> DataFrame:
        return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")

    lines = (
        table("lineitem")
        .groupBy("l_orderkey")
        .agg(
            (F.sum(F.rint(F.col("l_extendedprice") * 100).cast("bigint")) / F.lit(100.0)).alias("gross"),
            F.sum("l_quantity").cast("int").alias("qty"),
        )
    )
    joined = (
        table("orders")
        .repartition("o_orderkey")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    k = F.col("o_orderkey")
    gross = F.coalesce("gross", F.lit(0.0))
    qty = F.coalesce("qty", F.lit(0))
    divisor = F.when(k % 4 == 0, 1000.0).when(k % 4 == 1, 100.0).when(k % 4 == 2, 10.0).otherwise(1.0)
    goal = F.when(k % 307 == 0, 0.0).otherwise(F.col("o_totalprice") / divisor)
    rate = (F.lit(10) + F.col("n_regionkey")).cast("double") / F.lit(10.0)
    status = F.col("o_orderstatus")
    ends = F.expr("o_orderdate + make_dt_interval(CAST(1 + o_orderkey % 92 AS INT))")
    starts = F.expr("o_orderdate + make_dt_interval(0, 0, 0, CAST((o_orderkey * 7919) % 86400 AS INT))")
    return joined.select(
        k.alias("ID"),
        F.when(k % 101 != 0, F.col("c_name")).alias("name"),
        F.concat("c_mktsegment", F.lit("/"), "o_orderpriority").alias("category"),
        F.col("c_mktsegment").alias("main_category"),
        F.col("r_name").alias("currency"),
        F.when(k % 211 == 0, "not-a-date").otherwise(F.date_format(ends, "yyyy-MM-dd")).alias("deadline"),
        goal.alias("goal"),
        F.date_format(starts, "yyyy-MM-dd HH:mm:ss").alias("launched"),
        (gross / divisor).alias("pledged"),
        F.when((status == "P") & (k % 2 == 0), "canceled")
        .when((status == "P") & (k % 3 == 0), "live")
        .when(gross >= F.col("o_totalprice"), "successful")
        .otherwise("failed")
        .alias("state"),
        F.when(k % 499 != 0, qty).alias("backers"),
        F.col("n_name").alias("country"),
        F.when(k % 89 != 0, gross / divisor).alias("usd pledged"),
        (gross / divisor * rate).alias("usd_pledged_real"),
        (goal * rate).alias("usd_goal_real"),
    )


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaigns(spark, sf_dir).transform(clean).transform(featurise)


def split_featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return featured(spark, sf_dir).transform(with_split)


CAMPAIGNS_SQL = """
li AS (
  SELECT l_orderkey,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS gross,
         CAST(SUM(l_quantity) AS INT) AS qty
  FROM lineitem GROUP BY l_orderkey),
joined AS (
  SELECT o_orderkey AS k, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         c_name, c_mktsegment, n_name, r_name,
         CAST(10 + n_regionkey AS DOUBLE) / CAST(10 AS DOUBLE) AS rate,
         CASE o_orderkey % 4 WHEN 0 THEN CAST(1000 AS DOUBLE) WHEN 1 THEN CAST(100 AS DOUBLE)
              WHEN 2 THEN CAST(10 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS dv,
         COALESCE(gross, CAST(0 AS DOUBLE)) AS gross, COALESCE(qty, 0) AS qty
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN li ON o_orderkey = l_orderkey),
campaigns AS (
  SELECT k AS "ID",
         CASE WHEN k % 101 = 0 THEN NULL ELSE c_name END AS name,
         CONCAT(c_mktsegment, '/', o_orderpriority) AS category,
         c_mktsegment AS main_category,
         r_name AS currency,
         CASE WHEN k % 211 = 0 THEN 'not-a-date'
              ELSE strftime(o_orderdate + to_days(CAST(1 + k % 92 AS INT)), '%Y-%m-%d') END AS deadline,
         CASE WHEN k % 307 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice / dv END AS goal,
         strftime(o_orderdate + to_seconds((k * 7919) % 86400), '%Y-%m-%d %H:%M:%S') AS launched,
         gross / dv AS pledged,
         CASE WHEN o_orderstatus = 'P' AND k % 2 = 0 THEN 'canceled'
              WHEN o_orderstatus = 'P' AND k % 3 = 0 THEN 'live'
              WHEN gross >= o_totalprice THEN 'successful' ELSE 'failed' END AS state,
         CASE WHEN k % 499 = 0 THEN NULL ELSE qty END AS backers,
         n_name AS country,
         CASE WHEN k % 89 = 0 THEN NULL ELSE gross / dv END AS "usd pledged",
         gross / dv * rate AS usd_pledged_real,
         (CASE WHEN k % 307 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice / dv END) * rate AS usd_goal_real
  FROM joined)"""

FEATURED_SQL = """
kept AS (
  SELECT *, CASE WHEN state = 'successful' THEN 1 ELSE 0 END AS label
  FROM campaigns WHERE state IN ('successful', 'failed')),
complete AS (
  SELECT * FROM kept
  WHERE "ID" IS NOT NULL AND launched IS NOT NULL AND state IS NOT NULL AND backers IS NOT NULL
    AND goal IS NOT NULL AND NOT isnan(goal) AND pledged IS NOT NULL AND NOT isnan(pledged)),
dated AS (
  SELECT * REPLACE (COALESCE(name, 'Unknown') AS name),
         try_strptime(deadline, '%Y-%m-%d') AS deadline_ts,
         try_strptime(launched, '%Y-%m-%d %H:%M:%S') AS launched_ts
  FROM complete),
clean AS (SELECT * FROM dated WHERE deadline_ts IS NOT NULL AND launched_ts IS NOT NULL),
feat AS (
  SELECT *,
         CAST(date_diff('day', CAST(launched_ts AS DATE), CAST(deadline_ts AS DATE)) AS INT)
           AS campaign_duration_days,
         CAST(month(launched_ts) AS INT) AS launch_month,
         CAST(dayofweek(launched_ts) + 1 AS INT) AS launch_day_of_week,
         CASE WHEN goal > 0 THEN pledged / goal ELSE CAST(0 AS DOUBLE) END AS funding_ratio,
         CASE WHEN goal IS NULL OR isnan(goal) THEN NULL WHEN goal < 1000 THEN 'micro'
              WHEN goal < 10000 THEN 'small' WHEN goal < 50000 THEN 'medium'
              WHEN goal < 100000 THEN 'large' ELSE 'mega' END AS goal_bucket,
         CASE WHEN pledged > goal THEN 1 ELSE 0 END AS is_overfunded,
         CAST(year(launched_ts) AS INT) AS launched_year,
         ln(1 + pledged) AS pledged_log
  FROM clean),
parts AS (
  SELECT *,
         CASE WHEN CAST('0x' || substr(md5(CAST("ID" AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80
              THEN 'train' ELSE 'test' END AS split,
         CAST(CAST('0x' || substr(md5(CAST("ID" AS VARCHAR)), 9, 8) AS BIGINT) % 3 AS INT) AS fold
  FROM feat)"""


def with_campaigns(*more: str) -> str:
    """SQL prefix defining the raw and derived views, then further named subqueries."""
    return "WITH " + ",".join([CAMPAIGNS_SQL, FEATURED_SQL, *more]) + "\n"
