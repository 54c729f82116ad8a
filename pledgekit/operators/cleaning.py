"""Row filters, labels, defaults and date parsing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgekit.functions.columns import complete, lenient_timestamp, outcome_label, quoted
from pledgekit.runtime import require_columns
from pledgekit.spec import CampaignSpec


def has_final_state(spec: CampaignSpec = CampaignSpec()) -> Column:
    return quoted(spec.state).isin(*spec.final_states)


def label_columns(spec: CampaignSpec = CampaignSpec(), name: str = "label") -> dict[str, Column]:
    return {name: outcome_label(quoted(spec.state), spec.success_state)}


def date_columns(spec: CampaignSpec = CampaignSpec()) -> dict[str, Column]:
    """Parsed deadline and launch; text that does not parse becomes null."""
    return {
        "deadline_ts": lenient_timestamp(quoted(spec.deadline), spec.deadline_format),
        "launched_ts": lenient_timestamp(quoted(spec.launched), spec.launched_format),
    }


def default_columns(spec: CampaignSpec = CampaignSpec()) -> dict[str, Column]:
    return {c: F.coalesce(quoted(c), F.lit(value)) for c, value in spec.defaults}


def keep_states(df: DataFrame, spec: CampaignSpec = CampaignSpec()) -> DataFrame:
    """Campaigns with a definitive outcome."""
    return df.filter(has_final_state(spec))


def outside_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows strictly below ``low`` or above ``high``."""
    return df.filter((quoted(column) < low) | (quoted(column) > high))


def matching(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Rows where every named column equals its value."""
    condition = F.lit(True)
    for column, value in values.items():
        condition = condition & (quoted(column) == F.lit(value))
    return df.filter(condition)


def add_label(df: DataFrame, spec: CampaignSpec = CampaignSpec(), name: str = "label") -> DataFrame:
    return df.withColumns(label_columns(spec, name))


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a null or NaN in any named column."""
    require_columns(df, columns)
    return df.filter(complete(df.schema, columns))


def fill_defaults(df: DataFrame, spec: CampaignSpec = CampaignSpec()) -> DataFrame:
    return df.withColumns(default_columns(spec))


def parse_dates(df: DataFrame, spec: CampaignSpec = CampaignSpec()) -> DataFrame:
    """Add ``deadline_ts`` and ``launched_ts``."""
    return df.withColumns(date_columns(spec))
