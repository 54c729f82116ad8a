import math

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from pledgekit.operators import evaluation

# Published confusion counts and metrics of two models.
PUBLISHED = [
    ("Logistic Regression", 13768, 34027, 5561, 13054, 0.7196958289414245, 0.7090578678888938, 0.7122975839412282, 0.5133099694280814),
    ("Random Forest (tuned)", 23630, 32886, 6702, 3192, 0.8510164131907845, 0.8521356487035534, 0.7790452327574838, 0.8809932145253896),
]


@pytest.fixture(scope="module")
def counts(spark):
    return spark.createDataFrame([r[:5] for r in PUBLISHED], "model string, tp bigint, tn bigint, fp bigint, fn bigint")


def test_published_metrics_follow_from_their_counts(counts):
    out = counts.select(
        "model",
        evaluation.accuracy().alias("accuracy"),
        evaluation.f1_weighted().alias("f1"),
        evaluation.precision().alias("precision"),
        evaluation.recall().alias("recall"),
        evaluation.f1_positive().alias("f1_positive"),
    )
    got = {r.model: r for r in out.collect()}
    for model, _, _, _, _, accuracy, f1, precision, recall in PUBLISHED:
        r = got[model]
        for found, wanted in ((r.accuracy, accuracy), (r.f1, f1), (r.precision, precision), (r.recall, recall)):
            assert abs(found - wanted) < 1e-15
    assert abs(got["Logistic Regression"].f1_positive - 0.59665) < 1e-5


def test_confusion_long_form(counts):
    rows = {(r.model, r.type): (r.actual, r.predicted, r["count"]) for r in evaluation.confusion_long(counts).collect()}
    assert len(rows) == 8
    assert rows["Logistic Regression", "FP"] == ("Failed", "Successful", 5561)
    assert rows["Random Forest (tuned)", "FN"] == ("Successful", "Failed", 3192)


def predictions(spark, rows):
    return spark.createDataFrame([("m", *r) for r in rows], "model string, label int, prediction double, score double")


def test_undefined_metrics_are_zero_and_auc_null(spark):
    none_predicted = evaluation.classifier_report(predictions(spark, [(1, 0.0, 0.1), (0, 0.0, 0.2)])).first()
    assert (none_predicted.precision, none_predicted.recall) == (0.0, 0.0)
    no_positives = evaluation.classifier_report(predictions(spark, [(0, 0.0, 0.1), (0, 1.0, 0.2)])).first()
    assert no_positives.auc is None and no_positives.recall == 0.0 and no_positives.accuracy == 0.5


def test_tied_scores_count_half(spark):
    assert evaluation.auc_roc(predictions(spark, [(1, 1.0, 0.5), (0, 1.0, 0.5), (0, 1.0, 0.5)])).first().auc == 0.5


def test_report_matches_the_evaluators(spark, featured):
    """A third of the rows share one score."""
    scored = featured.select(
        F.lit("m").alias("model"),
        "label",
        (F.col("backers") >= 100).cast("double").alias("prediction"),
        F.when(F.col("ID") % 3 == 0, 50.0).otherwise(F.col("backers") / (F.col("goal") + 1)).alias("score"),
    ).persist()
    r = evaluation.classifier_report(scored).first()
    multi = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    assert abs(r.accuracy - multi.setMetricName("accuracy").evaluate(scored)) < 1e-12
    assert abs(r.f1 - multi.setMetricName("f1").evaluate(scored)) < 1e-12
    area = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0).evaluate(scored)
    assert abs(r.auc - area) < 1e-12
    assert abs(evaluation.auc_roc(scored).first().auc - area) < 1e-12
    scored.unpersist()


def test_regression_report_matches_the_evaluator(featured):
    scored = featured.select(
        F.lit("m").alias("model"), "pledged", "pledged_log", F.log1p("goal").alias("prediction")
    ).withColumn("amount", F.expm1("prediction"))
    r = evaluation.regressor_report(scored).first()
    log = RegressionEvaluator(labelCol="pledged_log", predictionCol="prediction")
    for name, found in (("rmse", r.rmse_log), ("r2", r.r2_log), ("mae", r.mae_log)):
        assert abs(log.setMetricName(name).evaluate(scored) - found) < 1e-9
    amounts = RegressionEvaluator(labelCol="pledged", predictionCol="amount")
    for name, found in (("rmse", r.rmse_orig), ("mae", r.mae_orig)):
        assert math.isclose(amounts.setMetricName(name).evaluate(scored), found, rel_tol=1e-9)


def test_runaway_prediction_is_an_infinite_error(spark):
    df = spark.createDataFrame([("m", 1.0, math.log1p(1.0), 800.0)], "model string, pledged double, pledged_log double, prediction double")
    report = evaluation.regressor_report(df).first()
    assert report.mae_orig == report.rmse_orig == math.inf and math.isfinite(report.rmse_log)


def test_changes_against_the_baseline(spark):
    report = spark.createDataFrame([("a", 0.5, 0.6), ("b", 0.75, 0.5)], "model string, accuracy double, auc double")
    got = {r.model: (r.accuracy_change, round(r.auc_change, 9)) for r in evaluation.compare_models(report, "a", {"accuracy": 100, "auc": 100}).collect()}
    assert got == {"a": (0.0, 0.0), "b": (25.0, -10.0)}


def test_metrics_long_names(spark):
    report = spark.createDataFrame([("a", 0.1, 0.2, 0.3, 0.4, 0.5)], "model string, accuracy double, f1 double, auc double, precision double, recall double")
    rows = {r.metric: r.value for r in evaluation.metrics_long(report).collect()}
    assert rows == {"ACCURACY": 0.1, "F1-Score": 0.2, "AUC-ROC": 0.3, "PRECISION": 0.4, "RECALL": 0.5}


def test_all_models_in_one_scan(featured):
    frame = featured.select("label", F.inline(F.array(
        F.struct(F.lit("a").alias("model"), F.lit(1.0).alias("prediction"), F.col("goal").alias("score")),
        F.struct(F.lit("b").alias("model"), F.lit(0.0).alias("prediction"), F.col("backers").cast("double").alias("score")),
    )))
    plan = evaluation.confusion_counts(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
