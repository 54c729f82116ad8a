"""Derived columns; each group is one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgekit.functions.columns import amount_from_log, exceeds, funding_ratio, quoted, size_band
from pledgekit.spec import CampaignSpec


def timing_columns() -> dict[str, Column]:
    """Length in calendar days, launch month (1-12) and weekday (1 = Sunday)."""
    return {
        "campaign_duration_days": F.datediff("deadline_ts", "launched_ts"),
        "launch_month": F.month("launched_ts"),
        "launch_day_of_week": F.dayofweek("launched_ts"),
    }


def funding_columns(spec: CampaignSpec = CampaignSpec()) -> dict[str, Column]:
    """Pledged over goal (0 without a goal), size band of the goal, and the overfunded flag."""
    goal, pledged = quoted(spec.goal), quoted(spec.pledged)
    return {
        "funding_ratio": funding_ratio(pledged, goal),
        "goal_bucket": size_band(goal, spec.goal_bands, spec.top_band),
        "is_overfunded": exceeds(pledged, goal),
    }


def year_columns() -> dict[str, Column]:
    return {"launched_year": F.year("launched_ts")}


def target_columns(spec: CampaignSpec = CampaignSpec(), name: str = "pledged_log") -> dict[str, Column]:
    return {name: F.log1p(quoted(spec.pledged))}


def add_timing(df: DataFrame) -> DataFrame:
    return df.withColumns(timing_columns())


def add_launch_year(df: DataFrame) -> DataFrame:
    return df.withColumns(year_columns())


def add_funding(df: DataFrame, spec: CampaignSpec = CampaignSpec()) -> DataFrame:
    return df.withColumns(funding_columns(spec))


def add_log_target(df: DataFrame, spec: CampaignSpec = CampaignSpec(), name: str = "pledged_log") -> DataFrame:
    return df.withColumns(target_columns(spec, name))


def add_amount_from_log(df: DataFrame, logged: str, name: str) -> DataFrame:
    return df.withColumn(name, amount_from_log(quoted(logged)))
