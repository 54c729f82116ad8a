import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pledgekit.operators import clustering, encoding
from pledgekit.runtime import persisted
from pledgekit.spec import ClusterSpec

COLUMNS = ["x", "y"]

# Published costs for k = 2..10 and their percent drops.
ELBOW = [1386733.3414790581, 1089260.8064255076, 1001955.1612590533, 637434.557171986, 502621.7452084139, 456933.95802261966, 415227.91728950373, 372071.79027047526, 356019.2468663471]
DROPS = [None, 21.5, 8.0, 36.4, 21.1, 9.1, 9.1, 10.4, 4.3]


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(1)
    blobs = [rng.normal(c, 1.0, (60, 2)) for c in ((0, 0), (8, 0), (0, 9))]
    data = np.vstack([*blobs, [[50.0, 50.0]], np.zeros((3, 2))])
    return spark.createDataFrame([(float(a), float(b)) for a, b in data], "x double, y double").persist()


CENTERS = [[0.0, 0.0], [8.0, 0.0], [0.0, 9.0], [50.0, 50.0]]


def brute_silhouette(data, labels):
    out = []
    for i in range(len(data)):
        d = ((data - data[i]) ** 2).sum(axis=1)
        own = labels == labels[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[own].sum() / (own.sum() - 1)
        b = min(d[labels == c].mean() for c in set(labels) - {labels[i]})
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(out))


def test_silhouette_matches_brute_force_and_the_evaluator(points):
    assigned = clustering.assign_nearest(points, COLUMNS, CENTERS)
    got = clustering.silhouette(assigned, COLUMNS).first().silhouette
    rows = np.array([(r.x, r.y, r.cluster) for r in assigned.collect()])
    assert abs(got - brute_silhouette(rows[:, :2], rows[:, 2])) < 1e-9
    vectors = encoding.assembler(COLUMNS, "features").transform(assigned).withColumn("prediction", F.col("cluster").cast("double"))
    assert abs(got - ClusteringEvaluator().evaluate(vectors)) < 1e-9


def test_assignment_and_cost_match_a_converged_model(points):
    vectors = encoding.assembler(COLUMNS, "features").transform(points)
    model = KMeans(k=3, seed=42, maxIter=50, tol=0.0).fit(vectors)
    centers = [list(map(float, c)) for c in model.clusterCenters()]
    assigned = clustering.assign_nearest(model.transform(vectors), COLUMNS, centers)
    assert assigned.filter("cluster <> prediction").isEmpty()
    cost = clustering.wcss(assigned).first().wcss
    assert abs(cost - model.summary.trainingCost) < 1e-6 * cost
    means = {r.cluster: (r.x, r.y) for r in clustering.center_means(assigned, COLUMNS).collect()}
    for i, c in enumerate(centers):
        assert np.allclose(means[i], c, atol=1e-9)


def test_cost_of_a_stopped_fit_is_not_below_the_relational_sum(points):
    vectors = encoding.assembler(COLUMNS, "features").transform(points)
    model = KMeans(k=3, seed=1, maxIter=1).fit(vectors)
    assigned = clustering.assign_nearest(vectors, COLUMNS, model.clusterCenters())
    assert model.summary.trainingCost >= clustering.wcss(assigned).first().wcss - 1e-9


def test_ties_go_to_the_lower_cluster(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "x double, y double")
    assert clustering.assign_nearest(df, COLUMNS, [[0.0, 0.0], [2.0, 0.0]]).first().cluster == 0


def test_published_drops(spark):
    costs = spark.createDataFrame(list(zip(range(2, 11), ELBOW)), "k int, wcss double")
    got = [r.drop_pct for r in clustering.wcss_drop(costs).orderBy("k").collect()]
    assert [None if d is None else round(d, 1) for d in got] == DROPS


@pytest.mark.parametrize("parallelism", [1, 3])
def test_elbow_repeats_and_falls(points, parallelism):
    spec = ClusterSpec(search=(2, 3, 4), parallelism=parallelism)
    with persisted(encoding.assembler(COLUMNS, "features").transform(points)) as (held,):
        costs = [r.wcss for r in clustering.elbow(held, clustering.search_clusters(held, spec)).orderBy("k").collect()]
        again = [r.wcss for r in clustering.elbow(held, clustering.search_clusters(held, spec)).orderBy("k").collect()]
    assert np.allclose(costs, again, rtol=1e-9) and costs[0] > costs[-1]


def test_profiles(spark):
    rows = [(i, i % 2, 10.0 * i, 1.0, i, 30, 0.5, i % 2) for i in range(4)]
    df = spark.createDataFrame(rows, "ID bigint, cluster int, goal double, usd_pledged_real double, backers int, campaign_duration_days int, funding_ratio double, label int")
    got = {r.cluster: r for r in clustering.cluster_profiles(df).collect()}
    assert (got[1].size, got[1].avg_goal, got[1].success_rate) == (2, 20.0, 1.0)
    assert df.columns and got[0].asDict().keys() == {"cluster", "size", "avg_goal", "avg_pledged", "avg_backers", "avg_duration_days", "avg_funding_ratio", "success_rate"}


def test_scaled_slots_have_mean_zero_and_unit_deviation(featured):
    spec = ClusterSpec()
    prepared = encoding.cluster_preparation(spec).fit(featured).transform(featured)
    slots = vector_to_array("features")
    row = prepared.agg(*[f(slots[i]) for i in range(5) for f in (F.avg, F.stddev_samp)]).first()
    assert np.allclose(row[0::2], 0, atol=1e-9) and np.allclose(row[1::2], 1, atol=1e-9)
