"""Segmentation: assignment, quality measures and profiles, without pairwise distances."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pledgekit.functions.columns import half_even, nearest, quoted, rows_of, square, total
from pledgekit.operators.models import kmeans
from pledgekit.sources.tables import small_table
from pledgekit.spec import PROFILE, ClusterSpec

PROFILE_DIGITS = 3


def assign_nearest(
    df: DataFrame, columns: Sequence[str], centers: Sequence[Sequence[float]], name: str = "cluster"
) -> DataFrame:
    """Add the closest center's index and its squared distance (``<name>_distance``)."""
    picked = nearest([quoted(c) for c in columns], centers)
    return (
        df.withColumn("_near", picked)
        .withColumns({name: F.col("_near.cluster"), f"{name}_distance": F.col("_near.distance")})
        .drop("_near")
    )


def wcss(assigned: DataFrame, distance: str = "cluster_distance") -> DataFrame:
    """Within-cluster sum of squared distances, one row."""
    return assigned.agg(F.sum(quoted(distance)).alias("wcss"))


def search_clusters(prepared: DataFrame, spec: ClusterSpec = ClusterSpec()) -> dict[int, KMeansModel]:
    """A model for each k of the search and for the chosen k. Pass a cached or staged table.

    Fits are independent; ``spec.parallelism`` of them share the cluster at a time.
    """
    sizes = sorted({*spec.search, spec.k})
    with ThreadPool(min(spec.parallelism, len(sizes))) as pool:
        fitted = pool.map(inheritable_thread_target(prepared.sparkSession)(lambda k: kmeans(k, spec).fit(prepared)), sizes)
    return dict(zip(sizes, fitted))


def elbow(prepared: DataFrame, models: Mapping[int, KMeansModel]) -> DataFrame:
    """Cost of each model under its final centers: (k, wcss), in one pass over ``features`` for all models."""
    slots = vector_to_array("features")
    costs = []
    for k, model in models.items():
        centers = model.clusterCenters()
        columns = [slots[i] for i in range(len(centers[0]))]
        costs.append({"k": F.lit(k), "wcss": F.sum(nearest(columns, centers)["distance"])})
    sums = prepared.agg(*[c["wcss"].alias(f"_{i}") for i, c in enumerate(costs)])
    return sums.select(F.inline(rows_of([{"k": c["k"], "wcss": F.col(f"_{i}")} for i, c in enumerate(costs)])))


def wcss_drop(costs: DataFrame) -> DataFrame:
    """Percent drop of the cost against the next smaller k (one row per k)."""
    previous = F.lag("wcss").over(Window.partitionBy(F.lit(0)).orderBy("k"))
    return costs.select("k", "wcss", ((previous - F.col("wcss")) / previous * 100).alias("drop_pct"))


def cluster_sizes(assigned: DataFrame, cluster: str = "cluster") -> DataFrame:
    return assigned.groupBy(quoted(cluster).alias("cluster")).agg(F.count(F.lit(1)).alias("size"))


def silhouette(assigned: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Mean silhouette with squared Euclidean distance, one row.

    The mean squared distance of a point to a cluster follows from the cluster's count, means and
    mean squared norm, so two passes suffice: one for those moments, one over the points. The moments
    are one small struct per cluster of the model, read as a single-row subquery.
    """
    frame = assigned.select(
        quoted(cluster).alias("_own"),
        *[quoted(c).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)],
    )
    dims = range(len(columns))
    norm = total([square(F.col(f"_x{i}")) for i in dims])
    moments = (
        frame.groupBy("_own")
        .agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.avg(norm).alias("q"),
            *[F.avg(f"_x{i}").alias(f"m{i}") for i in dims],
        )
        .agg(F.collect_list(F.struct(F.col("_own").alias("c"), "n", "q", *[f"m{i}" for i in dims])).alias("m"))
    )

    def mean_distance(m):
        return norm + m["q"] - total([F.col(f"_x{i}") * m[f"m{i}"] for i in dims]) * 2

    distances = F.transform(
        "_moments", lambda m: F.struct(m["c"].alias("c"), m["n"].alias("n"), mean_distance(m).alias("d"))
    )
    own = F.filter("_distances", lambda m: m["c"] == F.col("_own"))[0]
    other = F.array_min(
        F.transform(F.filter("_distances", lambda m: m["c"] != F.col("_own")), lambda m: m["d"])
    )
    scored = (
        frame.withColumn("_moments", moments.scalar())
        .withColumn("_distances", distances)
        .select(own.alias("_mine"), other.alias("_b"))
        .select(
            F.col("_mine.n").alias("_n"),
            (F.col("_mine.d") * F.col("_mine.n") / F.greatest(F.col("_mine.n") - 1, F.lit(1.0))).alias("_a"),
            "_b",
        )
    )
    value = (
        F.when(F.col("_n") == 1, F.lit(0.0))
        .when(F.greatest("_a", "_b") > 0, (F.col("_b") - F.col("_a")) / F.greatest("_a", "_b"))
        .otherwise(F.lit(0.0))
    )
    return scored.agg(F.avg(value).alias("silhouette"))


def cluster_profiles(
    assigned: DataFrame,
    cluster: str = "cluster",
    key: str = "ID",
    averages: Sequence[tuple[str, str]] = PROFILE,
) -> DataFrame:
    """Size, averages and success rate per cluster, rounded half-even."""
    return assigned.groupBy(quoted(cluster).alias("cluster")).agg(
        F.count(quoted(key)).alias("size"),
        *[half_even(F.avg(quoted(c)), PROFILE_DIGITS).alias(name) for name, c in averages],
    )


def center_means(assigned: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Average of each column per cluster: the centers of a converged assignment."""
    return assigned.groupBy(quoted(cluster).alias("cluster")).agg(
        *[F.avg(quoted(c)).alias(c) for c in columns]
    )


def model_centers(
    prepared: DataFrame, model: KMeansModel, columns: Sequence[str], means=None, deviations=None
) -> DataFrame:
    """A fitted model's centers, one row per cluster; given the scaler's moments, in raw units."""
    rows = []
    for i, center in enumerate(model.clusterCenters()):
        values = [float(v) for v in center]
        if means is not None:
            values = [v * float(s) + float(m) for v, m, s in zip(values, means, deviations)]
        rows.append((i, *values))
    schema = T.StructType(
        [T.StructField("cluster", T.IntegerType())] + [T.StructField(c, T.DoubleType()) for c in columns]
    )
    return small_table(prepared.sparkSession, rows, schema)
