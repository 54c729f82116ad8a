"""Campaign CSV in; CSV, JSON and Parquet tables out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pledgekit.functions.columns import quoted
from pledgekit.runtime import require_columns, stage

# The published source schema, in file order.
CAMPAIGN_SCHEMA = T.StructType(
    [
        T.StructField("ID", T.LongType(), True),
        T.StructField("name", T.StringType(), True),
        T.StructField("category", T.StringType(), True),
        T.StructField("main_category", T.StringType(), True),
        T.StructField("currency", T.StringType(), True),
        T.StructField("deadline", T.StringType(), True),
        T.StructField("goal", T.DoubleType(), True),
        T.StructField("launched", T.StringType(), True),
        T.StructField("pledged", T.DoubleType(), True),
        T.StructField("state", T.StringType(), True),
        T.StructField("backers", T.IntegerType(), True),
        T.StructField("country", T.StringType(), True),
        T.StructField("usd pledged", T.DoubleType(), True),
        T.StructField("usd_pledged_real", T.DoubleType(), True),
        T.StructField("usd_goal_real", T.DoubleType(), True),
    ]
)

CORRUPT = "_corrupt_record"


def scan_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = CAMPAIGN_SCHEMA,
    multi_line: bool = True,
    check_header: bool = True,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Read campaign CSV files by position with a declared schema.

    With ``check_header`` every file's header must name the schema's columns in order. A field of the
    wrong type becomes null; ``keep_corrupt`` also keeps the raw text of such rows. ``multi_line``
    allows line breaks in quoted fields but makes each file one task, so give a folder of files
    rather than one large file, or turn it off for data without such breaks.
    """
    if keep_corrupt:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    paths = [path] if isinstance(path, str) else list(path)
    return (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", not check_header)
        .option("mode", "PERMISSIVE")
        .schema(schema)
        .csv(paths)
    )


def convert_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    target: str,
    partition_by: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Parse CSV once into Parquet, which later reads split, prune and filter at the scan.

    Spaces in column names become underscores there.
    """
    scanned = scan_csv(spark, path, **options)
    plain = scanned.select(*[quoted(c).alias(c.replace(" ", "_")) for c in scanned.columns])
    write_parquet(plain, target, partition_by)
    return spark.read.parquet(target)


def header_report(spark: SparkSession, path: str, schema: T.StructType = CAMPAIGN_SCHEMA) -> DataFrame:
    """Header names found against the expected ones: (position, expected, found, ok)."""
    found = spark.read.option("header", True).option("escape", '"').csv(path).columns
    expected = schema.fieldNames()
    rows = [
        (i, e, f, e == f)
        for i in range(max(len(expected), len(found)))
        for e, f in [(expected[i] if i < len(expected) else None, found[i] if i < len(found) else None)]
    ]
    out = T.StructType(
        [
            T.StructField("position", T.IntegerType()),
            T.StructField("expected", T.StringType()),
            T.StructField("found", T.StringType()),
            T.StructField("ok", T.BooleanType()),
        ]
    )
    return spark.createDataFrame(rows, out)


def malformed_count(scanned: DataFrame) -> DataFrame:
    """Rows of a ``keep_corrupt`` scan with at least one unreadable field, one row."""
    require_columns(scanned, [CORRUPT])
    return scanned.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(quoted(CORRUPT).isNotNull()).alias("malformed")
    )


@dataclass(frozen=True)
class Records:
    """The records of a scan: all of them, those to work with, and those set aside with the reason."""

    everything: DataFrame
    accepted: DataFrame
    rejected: DataFrame


def mark_records(
    spark: SparkSession,
    path: str | Sequence[str],
    critical: Sequence[str],
    schema: T.StructType = CAMPAIGN_SCHEMA,
    **options,
) -> DataFrame:
    """Parse CSV, and tell unreadable records (``status``, ``reason``, the text in ``_corrupt_record``) from the rest.

    A record is rejected if the parser could not read it whole and one of its ``critical`` columns has no value; the
    reason names these columns. A record that is odd elsewhere only is accepted with null there, and one
    whose critical value is just missing is left to cleaning.
    """
    scanned = scan_csv(spark, path, schema, keep_corrupt=True, **options)
    require_columns(scanned, critical)
    missing = F.array_compact(F.array(*[F.when(quoted(c).isNull(), F.lit(c)) for c in critical]))
    bad = quoted(CORRUPT).isNotNull() & (F.size(missing) > 0)
    return scanned.withColumns(
        {
            "reason": F.when(bad, F.array_join(missing, ",")),
            "status": F.when(bad, F.lit("rejected")).otherwise(F.lit("accepted")),
        }
    )


def part_records(written: DataFrame, schema: T.StructType = CAMPAIGN_SCHEMA) -> Records:
    """The parts of marked records that were written by ``status``: one parse, and each part a partition of its own.

    Rejected ones carry the ``reason`` and their text as ``record``. Counts of both parts add up to the records of the files.
    """
    names = [quoted(c) for c in schema.fieldNames()]
    status = F.col("status")
    return Records(
        everything=written.select(*names),
        accepted=written.filter(status == "accepted").select(*names),
        rejected=written.filter(status == "rejected").select(*names, "reason", quoted(CORRUPT).alias("record")),
    )


def sort_out(spark: SparkSession, path: str | Sequence[str], critical: Sequence[str], **options) -> Records:
    """``mark_records`` and ``part_records`` by way of the shared folder."""
    return part_records(stage(mark_records(spark, path, critical, **options), "records", ["status"]))


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> str:
    """Write a CSV dataset folder. ``single_file`` funnels into one task: small reports only."""
    out = df.coalesce(1) if single_file else df
    out.write.option("header", True).option("quote", '"').option("escape", '"').mode(mode).csv(path)
    return path


def write_json(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    df.write.mode(mode).partitionBy(*partition_by).json(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    """Write Parquet. Rows of a partitioned table are gathered by partition value, which avoids many
    small files; the rebalance hint lets adaptive execution split a value that is too large."""
    out = df
    if partition_by:
        out = df.hint("rebalance", *partition_by)
    out.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return path


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A typed DataFrame of driver-side report rows."""
    return spark.createDataFrame(list(rows), schema)


def conform(df: DataFrame, schema: T.StructType = CAMPAIGN_SCHEMA) -> DataFrame:
    """Reorder and cast to a schema by name; an absent or incompatible column is an error."""
    require_columns(df, schema.fieldNames())
    return df.to(schema)


def preview(df: DataFrame, order: str, rows: int = 5, columns: Sequence[str] | None = None) -> DataFrame:
    """The first rows by key, the same sample on every run; the limit is the feature."""
    shown = df if columns is None else df.select(*[quoted(c) for c in columns])
    return shown.orderBy(quoted(order)).limit(rows)
