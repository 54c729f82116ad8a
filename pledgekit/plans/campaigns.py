"""Raw campaigns to cleaned and featured campaigns, as one lazy projection over the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pledgekit.functions.columns import complete
from pledgekit.operators.cleaning import (
    date_columns,
    default_columns,
    drop_incomplete,
    has_final_state,
    label_columns,
)
from pledgekit.operators.features import funding_columns, target_columns, timing_columns, year_columns
from pledgekit.operators.splitting import assign_folds, hash_split
from pledgekit.runtime import require_columns
from pledgekit.spec import CampaignSpec, SplitSpec


def clean(raw: DataFrame, spec: CampaignSpec = CampaignSpec()) -> DataFrame:
    """Final outcomes only, labelled, complete, with parsed dates.

    One filter that scans can push down, one projection, and one filter on the parsed dates.
    """
    require_columns(raw, spec.critical + (spec.deadline,))
    kept = raw.filter(has_final_state(spec) & complete(raw.schema, spec.critical))
    derived = kept.withColumns({**label_columns(spec), **default_columns(spec), **date_columns(spec)})
    return drop_incomplete(derived, ["deadline_ts", "launched_ts"])


def featurise(cleaned: DataFrame, spec: CampaignSpec = CampaignSpec()) -> DataFrame:
    """Add the engineered features, the launch year and the regression target in one projection."""
    return cleaned.withColumns(
        {**timing_columns(), **funding_columns(spec), **year_columns(), **target_columns(spec)}
    )


def with_split(featured: DataFrame, key: str = "ID", split: SplitSpec = SplitSpec()) -> DataFrame:
    return featured.transform(hash_split, key, split).transform(assign_folds, key, split)
