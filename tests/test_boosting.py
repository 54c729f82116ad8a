"""Boosted trees on blocks of binned rows against Spark's own fit."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from pledgekit.operators import boosting, encoding, models


def mixed(spark, n=1500):
    """Two ordered slots, one of six levels, and eleven of two levels (two bytes); some rows come twice."""

    def code(salt, size):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(size))

    rows = spark.range(n).select(
        "id",
        (code(1, 1009) / 7 - 50).alias("a"),
        (code(2, 5) * 1.0).alias("b"),
        code(3, 6).cast("string").alias("level"),
        code(4, 12).cast("string").alias("kind"),
    )
    rows = encoding.string_indexer(["level", "kind"]).fit(rows).transform(rows)
    rows = encoding.one_hot_encoder(["kind_idx"], ["one_hot"]).fit(rows).transform(rows)
    rows = encoding.assembler(["a", "one_hot", "level_idx", "b"], "features").transform(rows)
    effect = F.col("a") * F.col("b") / 40 + F.when(F.col("level").isin("1", "5"), 4.0).otherwise(0.0)
    effect += F.when(F.col("kind") == "3", 6.0).when(F.col("kind") == "10", -7.0).otherwise(0.0)
    rows = rows.withColumn("pledged_log", effect + code(5, 1000) / 1000)
    return rows.unionByName(rows.filter("id % 9 = 0")).select("features", "pledged_log", F.pmod("id", F.lit(3)).cast("int").alias("fold"))


def nodes(model):
    """(gain, rows, prediction) of every node of every tree, in order."""

    def walk(node):
        inner = node.numDescendants() > 0
        yield (node.gain() if inner else 0.0, node.impurityStats().count(), node.prediction())
        if inner:
            yield from walk(node.leftChild())
            yield from walk(node.rightChild())

    return [x for tree in model.trees for x in walk(tree._call_java("rootNode"))]


@pytest.mark.parametrize("depth, least_rows, least_gain", [(1, 1, 0.0), (4, 1, 0.0), (4, 60, 0.02)])
def test_the_model_is_sparks(spark, depth, least_rows, least_gain):
    rows = mixed(spark).repartition(4).cache()
    estimator = models.boosted({}).setMaxDepth(depth).setMaxIter(4).setMinInstancesPerNode(least_rows).setMinInfoGain(least_gain)
    plain, ours = estimator.fit(rows), boosting.in_blocks(estimator).fit(rows)
    assert ours.uid == plain.uid and ours.treeWeights == plain.treeWeights and ours.numFeatures == plain.numFeatures
    assert [p.name for p in ours.extractParamMap()] == [p.name for p in plain.extractParamMap()]
    assert np.allclose(nodes(ours), nodes(plain), rtol=1e-9, atol=1e-9)
    assert np.allclose(ours.featureImportances.toArray(), plain.featureImportances.toArray(), atol=1e-9)
    assert np.allclose(ours.evaluateEachIteration(rows, "squared"), plain.evaluateEachIteration(rows, "squared"), rtol=1e-9)
    both = plain.transform(rows).select("features", F.col("prediction").alias("wanted"))
    both = ours.transform(both.withColumn("pledged_log", F.lit(0.0)))
    assert both.filter(F.abs(F.col("prediction") - F.col("wanted")) > 1e-9).isEmpty()


def test_blocks_hold_every_row_once(spark, monkeypatch):
    """Several blocks a task, tasks of several partitions, one of them empty, and several passes a level."""
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    monkeypatch.setattr(boosting, "SUM_BYTES", 1)
    monkeypatch.setattr(boosting, "PASS_ROWS", 1)
    rows = mixed(spark).repartitionByRange(12, "pledged_log").filter("pledged_log > 0.2").cache()
    estimator = models.boosted({}).setMaxDepth(3).setMaxIter(3)
    plain, ours = estimator.fit(rows), boosting.in_blocks(estimator).fit(rows)
    assert np.allclose(nodes(ours), nodes(plain), rtol=1e-9, atol=1e-9)


def test_one_value_and_no_rows(spark):
    rows = mixed(spark, 60)
    estimator = boosting.in_blocks(models.boosted({}).setMaxDepth(2).setMaxIter(2))
    model = estimator.fit(rows.withColumn("pledged_log", F.lit(3.5)))
    assert [t.numNodes for t in model.trees] == [1, 1]
    assert model.transform(rows).select("prediction").distinct().collect() == [(3.5,)]
    with pytest.raises(Exception, match="empty|0 examples|size"):
        estimator.fit(rows.limit(0))
    with pytest.raises(Exception, match="(?i)nan|null"):
        estimator.fit(rows.withColumn("pledged_log", F.lit(float("nan"))))


def test_large_tables_are_cross_validated_on_blocks(spark, monkeypatch):
    """Metrics, choice and refit are those of Spark's own fits, but no fit is."""
    estimator = models.boosted({})
    grid = models.ParamGridBuilder().addGrid(estimator.maxIter, [1, 3]).addGrid(estimator.maxDepth, [2, 3]).build()
    rows = mixed(spark).repartition(3).cache()
    plain = models.cross_validate(estimator, grid, models.rmse_evaluator(), rows, 2)
    monkeypatch.setattr(models, "BLOCK_ROWS", rows.count() - 1)
    monkeypatch.setattr(GBTRegressor, "_fit", None)
    ours = models.cross_validate(estimator, grid, models.rmse_evaluator(), rows, 2)
    assert np.allclose(ours.model.avgMetrics, plain.model.avgMetrics, rtol=1e-9)
    assert [r.best for r in ours.table.collect()] == [r.best for r in plain.table.collect()]
    assert np.allclose(nodes(ours.best), nodes(plain.best), rtol=1e-9, atol=1e-9)


def test_a_level_out_of_range_is_an_error(spark):
    rows = mixed(spark, 90)
    held = rows.schema["features"].metadata
    odd = rows.withColumn("features", F.when(F.col("fold") == 1, array_to_vector(F.array(*[F.lit(9.0)] * held["ml_attr"]["num_attrs"]))).otherwise(F.col("features")))
    odd = odd.withColumn("features", F.col("features").alias("features", metadata=held))
    with pytest.raises(Exception, match="levels, found"):
        boosting.in_blocks(models.boosted({}).setMaxIter(1)).fit(odd)


def test_fits_that_draw_rows_or_weigh_them_stay_with_spark():
    plain = models.boosted({})
    assert type(boosting.in_blocks(plain)) is boosting.BlockGBT
    for other in (plain.copy().setSubsamplingRate(0.5), plain.copy().setLossType("absolute"), plain.copy().setWeightCol("w"), models.forest({})):
        assert boosting.in_blocks(other) is other
