"""Publish every result table of a run as one version."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pledgekit.operators import evaluation, quality, reports
from pledgekit.plans.segmentation import Segments
from pledgekit.plans.supervised import Supervised
from pledgekit.sources.publication import Publication

CLASSIFIER_METRICS = ("model", "accuracy", "f1", "auc", "precision", "recall", "tp", "tn", "fp", "fn")


def result_tables(supervised: Supervised, segments: Segments) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Tables by name: per-campaign ones, and small reports."""
    metrics = supervised.classifier_metrics
    large = {
        "campaigns_enriched": segments.enriched,
        "clustering_assignments": segments.assignments,
        "classification_results": supervised.classification_results,
        "regression_results": supervised.regression_results,
    }
    small = {
        "classification_metrics": metrics.select(*CLASSIFIER_METRICS),
        "classification_metrics_long": evaluation.metrics_long(metrics),
        "confusion_matrix": evaluation.confusion_long(metrics.select("model", *evaluation.CONFUSION)),
        "classification_feature_importance": supervised.classifier_importance,
        "regression_metrics": supervised.regressor_metrics,
        "regression_feature_importance": supervised.regressor_importance,
        "cluster_profiles": segments.profiles,
        "cluster_centers": segments.centers,
        "clustering_elbow": segments.elbow,
        "correlation_matrix": quality.correlation_matrix(segments.enriched, reports.correlated_features()),
    }
    return large, small


def add_results(out: Publication, supervised: Supervised, segments: Segments, single_files: bool = True) -> list[str]:
    """Write CSV folders for all tables and JSON for the dashboard into a publication; returns the paths.

    Per-campaign tables are always written in parallel; ``single_files`` concerns the reports only.
    """
    large, small = result_tables(supervised, segments)
    paths = [out.add(name, df) for name, df in large.items()]
    paths += [out.add(name, df, single_file=single_files) for name, df in small.items()]
    dashboard = reports.whole_dashboard(segments.enriched, clustered=True)
    paths.append(out.add("dashboard_data", dashboard, "json", partition_by=["section"]))
    return paths


def export(supervised: Supervised, segments: Segments, folder: str, single_files: bool = True) -> list[str]:
    """Publish all result tables under ``folder`` as one new version; returns the paths.

    Readers go by ``pledgekit.sources.publication.read_published`` and see all old tables or all new ones.
    """
    out = Publication(segments.enriched.sparkSession, folder)
    paths = add_results(out, supervised, segments, single_files)
    out.commit()
    return paths


def model_changes(supervised: Supervised, classifier_baseline: str, regressor_baseline: str) -> tuple[DataFrame, DataFrame]:
    """Accuracy and AUC in points, and R2, against the baseline models."""
    return (
        evaluation.compare_models(
            supervised.classifier_metrics, classifier_baseline, {"accuracy": 100, "auc": 100}
        ),
        evaluation.compare_models(supervised.regressor_metrics, regressor_baseline, {"r2_log": 1}),
    )


def run_summary(raw: DataFrame, featured: DataFrame, supervised: Supervised, segments: Segments, seed: int) -> DataFrame:
    """Everything a run reports, in long form: (section, item, value)."""
    width = supervised.prepared.table.schema["features"].metadata["ml_attr"]["num_attrs"]
    spark = raw.sparkSession
    shape = spark.createDataFrame(
        [("vector", "slots", float(width)), ("clusters", "k", float(segments.model.getK()))],
        "section string, item string, value double",
    )
    fit = segments.silhouette.selectExpr("'clusters' AS section", "'silhouette' AS item", "silhouette AS value")
    out = reports.run_facts(featured, raw, seed).unionByName(shape)
    for part in (
        reports.metric_facts("classification", supervised.classifier_metrics, ["accuracy", "f1", "auc"]),
        reports.metric_facts("regression", supervised.regressor_metrics, ["r2_log", "rmse_orig"]),
        fit,
    ):
        out = out.unionByName(part)
    return out
