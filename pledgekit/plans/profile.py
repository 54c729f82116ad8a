"""Data-quality reports that are measured while a table is written, not by passes of their own."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pledgekit.functions.columns import quoted
from pledgekit.operators import quality
from pledgekit.operators.quality import Measures
from pledgekit.runtime import fresh_path
from pledgekit.sources.tables import CAMPAIGN_SCHEMA, small_table
from pledgekit.spec import ENGINEERED, CampaignSpec


@dataclass(frozen=True)
class Profiled:
    """A written table and the reports that were measured by its writing tasks."""

    path: str
    schema: T.StructType
    reports: dict[str, DataFrame]

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.path)


def session_apart(spark: SparkSession) -> SparkSession:
    """Another session of the same application with the settings of this one."""
    other = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if other.conf.get(name, None) != value and other.conf.isModifiable(name):
            other.conf.set(name, value)
    return other


def stage_profiled(
    spark: SparkSession,
    build: Callable[[SparkSession], DataFrame],
    label: str,
    measures: Callable[[DataFrame], Mapping[str, Measures]],
    partition_by: Sequence[str] = (),
) -> Profiled:
    """Write the table that ``build`` makes to the shared folder, and report on the rows that the writing tasks saw.

    The aggregates ride on the write as observed metrics: each task adds up its own rows, and only the totals come to
    the driver. They stand directly below the write, in its result stage, so a task that is run again counts once.
    The write has a session of its own: one that has observed metrics holds an object that cannot be shipped, and
    models keep the session of their training summary.
    """
    own = session_apart(spark)
    df = build(own)
    wanted = measures(df)
    seen, path = Observation(), fresh_path(spark, label)
    columns = [c.alias(f"{name}_{i}") for name, m in wanted.items() for i, c in enumerate(m.columns)]
    df.observe(seen, *columns).write.partitionBy(*partition_by).parquet(path)
    values = seen.get
    reports = {}
    for name, m in wanted.items():
        row = tuple(values[f"{name}_{i}"] for i in range(len(m.columns)))
        reports[name] = m.table(small_table(spark, [row], df.agg(*m.columns).schema))
    order = [c for c in df.columns if c not in partition_by] + list(partition_by)
    return Profiled(path, df.select(*[quoted(c) for c in order]).schema, reports)


def raw_measures(raw: DataFrame, spec: CampaignSpec = CampaignSpec()) -> dict[str, Measures]:
    """Shape, nulls, spread and cleaning losses of the raw table, of which only the source's own columns count."""
    own = raw.select(*[quoted(c) for c in CAMPAIGN_SCHEMA.fieldNames()])
    return {
        "shape_check": quality.shape_measures(own, None, own.columns),
        "null_profile": quality.null_measures(own, with_nan=True),
        "numeric_summary": quality.summary_measures(raw, spec.amounts),
        "stage_audit": quality.audit_measures(raw, spec),
    }


def feature_measures(featured: DataFrame) -> dict[str, Measures]:
    """Nulls and ranges of the engineered columns."""
    numeric = [c for c in ENGINEERED if featured.schema[c].dataType.simpleString() != "string"]
    return {
        "feature_nulls": quality.null_measures(featured, ENGINEERED),
        "feature_ranges": quality.summary_measures(featured, numeric),
    }


def counted_reports(raw: DataFrame, featured: DataFrame, spec: CampaignSpec = CampaignSpec()) -> dict[str, DataFrame]:
    """Reports that need a shuffle of their own; ``featured`` carries ``split``."""
    return {
        "duplicate_keys": quality.duplicate_keys(raw, spec.key),
        "state_counts": quality.value_counts(raw, spec.state),
        "class_balance": quality.class_balance(featured, split="split"),
        "outliers": quality.iqr_outliers(featured, spec.amounts),
    }


def long_report(name: str, report: DataFrame) -> DataFrame:
    """A report as (report, item, measure, value), its first column being the item."""
    item, *measures = [c for c in report.columns if report.schema[c].dataType.simpleString() != "boolean"]
    numeric = [m for m in measures if report.schema[m].dataType.simpleString() != "string"]
    entries = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"`{m}`").cast("double").alias("value")) for m in numeric])
    return report.select(F.lit(name).alias("report"), F.col(f"`{item}`").cast("string").alias("item"), F.inline(entries))
