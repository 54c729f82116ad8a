"""One run from campaign CSV files to a published set of result tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from pledgekit.plans.campaigns import clean, featurise, with_split
from pledgekit.plans.export import add_results, run_summary
from pledgekit.plans.profile import counted_reports, feature_measures, raw_measures, stage_profiled
from pledgekit.plans.segmentation import segment
from pledgekit.plans.supervised import train_and_evaluate
from pledgekit.sources.publication import Publication
from pledgekit.sources.tables import mark_records, part_records
from pledgekit.spec import CampaignSpec, ClusterSpec, FeatureSpec, ModelSpec, SplitSpec


def run(
    spark: SparkSession,
    source: str,
    folder: str,
    models: ModelSpec = ModelSpec(),
    clusters: ClusterSpec = ClusterSpec(),
    features: FeatureSpec = FeatureSpec(),
    split: SplitSpec = SplitSpec(),
    campaign: CampaignSpec = CampaignSpec(),
) -> list[str]:
    """Scan, check, clean, featurise, fit, segment and publish; returns the paths of the tables.

    The files are parsed once: that write parts unreadable records from the rest and measures the raw reports, and
    the write of the featured table measures its own. All tables, set-aside records included, appear under
    ``folder`` as one version when the run is through; until then readers see the version before.
    """
    raw = stage_profiled(
        spark,
        lambda session: mark_records(session, source, campaign.critical),
        "run-raw",
        lambda df: raw_measures(df, campaign),
        ["status"],
    )
    derived = stage_profiled(
        spark,
        lambda session: part_records(raw.read(session)).accepted.transform(clean, campaign).transform(featurise, campaign),
        "run-featured",
        feature_measures,
    )
    records, featured = part_records(raw.read(spark)), derived.read(spark)
    parts = with_split(featured, split=split)
    supervised = train_and_evaluate(featured, features, models, split)
    segments = segment(featured, clusters)
    reports = raw.reports | derived.reports | counted_reports(records.everything, parts, campaign)
    reports["run_summary"] = run_summary(records.everything, parts, supervised, segments, models.seed)

    out = Publication(spark, folder)
    paths = [out.add(name, df, single_file=True) for name, df in reports.items()]
    paths.append(out.add("rejected_records", records.rejected))
    paths += add_results(out, supervised, segments)
    out.commit()
    return paths
