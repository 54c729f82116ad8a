"""K-means segmentation from featured campaigns to profiles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

from pledgekit.functions.columns import quoted
from pledgekit.operators import clustering, reports
from pledgekit.operators.encoding import cluster_preparation
from pledgekit.runtime import persisted, small, stage
from pledgekit.spec import ClusterSpec


@dataclass(frozen=True)
class Segments:
    scaling: PipelineModel
    model: KMeansModel
    elbow: DataFrame
    silhouette: DataFrame
    sizes: DataFrame
    profiles: DataFrame
    centers: DataFrame
    raw_centers: DataFrame
    enriched: DataFrame
    assignments: DataFrame


def fit_segments(vectors: DataFrame, spec: ClusterSpec = ClusterSpec()) -> tuple[DataFrame, KMeansModel]:
    """Elbow table of the search, and its model of the chosen k, over one cached vector column."""
    with persisted(vectors.select("features")) as (held,):
        fitted = clustering.search_clusters(held, spec)
        return small(clustering.elbow(held, {k: fitted[k] for k in spec.search})), fitted[spec.k]


def segment(featured: DataFrame, spec: ClusterSpec = ClusterSpec(), key: str = "ID") -> Segments:
    """Scale, search k, fit the chosen k, and describe the clusters.

    The enriched table (campaigns with their cluster) is staged once, so profiles, sizes and exports
    read columns of it instead of assigning every campaign again. Rows are sorted within partitions,
    since the seeded choice of initial centers depends on their order. ``key`` is published as ``ID``.
    """
    columns = [quoted(key if c == "ID" else c).alias(c) for c in reports.ENRICHED if c != "cluster"]
    rows = stage(featured.select(*columns).sortWithinPartitions("ID"), "segment-input")
    scaling = cluster_preparation(spec).fit(rows)
    prepared = scaling.transform(rows).drop("clust_vec")
    elbow, model = fit_segments(prepared, spec)

    dims = [f"_s{i}" for i in range(len(spec.features))]
    slots = vector_to_array("features")
    assigned = model.transform(prepared).withColumnRenamed("prediction", "cluster")
    scored = stage(
        assigned.withColumns({d: slots[i] for i, d in enumerate(dims)}).drop("features"), "segments"
    )
    moments = scaling.stages[-1]
    enriched = reports.campaigns_enriched(scored)
    return Segments(
        scaling=scaling,
        model=model,
        elbow=elbow,
        silhouette=clustering.silhouette(scored, dims),
        sizes=clustering.cluster_sizes(enriched),
        profiles=clustering.cluster_profiles(enriched),
        centers=clustering.model_centers(rows, model, spec.features),
        raw_centers=clustering.model_centers(rows, model, spec.features, moments.mean, moments.std),
        enriched=enriched,
        assignments=reports.clustering_assignments(enriched),
    )
