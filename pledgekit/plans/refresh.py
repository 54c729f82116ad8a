"""The enriched campaigns as a table by launch year, of which single years are made anew."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame

from pledgekit.functions.columns import quoted
from pledgekit.operators import reports
from pledgekit.plans.campaigns import clean, featurise
from pledgekit.plans.segmentation import Segments
from pledgekit.sources.publication import refresh_partitions
from pledgekit.sources.tables import write_parquet
from pledgekit.spec import CampaignSpec

YEAR = "launched_year"


def enrich(featured: DataFrame, segments: Segments) -> DataFrame:
    """Featured campaigns with the cluster that fitted segments give them; a projection, no row moves."""
    scaled = segments.scaling.transform(featured)
    return reports.campaigns_enriched(segments.model.transform(scaled).withColumnRenamed("prediction", "cluster"))


def write_enriched(featured: DataFrame, segments: Segments, path: str) -> str:
    return write_parquet(enrich(featured, segments), path, [YEAR])


def launched_in(years: Sequence[int], spec: CampaignSpec = CampaignSpec()):
    """Whether the launch text begins with one of the years: a filter on prefixes, which scans can push down."""
    return reduce(or_, [quoted(spec.launched).startswith(f"{year:04d}") for year in years])


def refresh_years(
    raw: DataFrame, segments: Segments, path: str, years: Sequence[int], spec: CampaignSpec = CampaignSpec()
) -> DataFrame:
    """Clean, featurise and assign the campaigns of some years anew, and replace these years only: (value, rows).

    Only their records are read from ``raw`` as far as it can filter by the launch text. The models are those of
    the last whole run, so the other years' rows stay what a whole run with these models would give.
    """
    if not years:
        raise ValueError("name the years to refresh")
    part = raw.filter(launched_in(years, spec)) if spec.launched_format.startswith("yyyy") else raw
    fresh = enrich(part.transform(clean, spec).transform(featurise, spec), segments)
    return refresh_partitions(fresh, path, YEAR, list(years))
