"""Evaluation operators over rule-based predictions, which SQL can repeat."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixture import featured, split_featured, with_campaigns
from catalog.registry import register, rounded
from pledgekit.operators import evaluation

RULES_SQL = """
rules AS (
  SELECT 'goal rule' AS model, label, CAST(goal < 5000 AS DOUBLE) AS prediction,
         CAST(1 AS DOUBLE) / (1 + goal) AS score FROM parts WHERE split = 'test'
  UNION ALL
  SELECT 'backers rule', label, CAST(backers >= 100 AS DOUBLE), CAST(backers AS DOUBLE)
  FROM parts WHERE split = 'test'),
cells AS (
  SELECT model,
         CAST(COUNT_IF(label = 1 AND prediction = 1) AS BIGINT) AS tp,
         CAST(COUNT_IF(label = 0 AND prediction = 0) AS BIGINT) AS tn,
         CAST(COUNT_IF(label = 0 AND prediction = 1) AS BIGINT) AS fp,
         CAST(COUNT_IF(label = 1 AND prediction = 0) AS BIGINT) AS fn
  FROM rules GROUP BY model),
ranks AS (
  SELECT model, label,
         rank() OVER (PARTITION BY model ORDER BY score)
           + (COUNT(*) OVER (PARTITION BY model, score) - 1) / CAST(2 AS DOUBLE) AS r
  FROM rules),
areas AS (
  SELECT model, (SUM(CASE WHEN label = 1 THEN r ELSE 0 END) - SUM(label) * (SUM(label) + 1) / CAST(2 AS DOUBLE))
                / (CAST(SUM(label) AS DOUBLE) * SUM(1 - label)) AS auc
  FROM ranks GROUP BY model),
per_class AS (
  SELECT *, (tp + tn) / (tp + tn + fp + fn) AS accuracy,
         CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1_positive,
         CASE WHEN 2 * tn + fp + fn = 0 THEN 0 ELSE 2 * tn / (2 * tn + fp + fn) END AS f1_negative,
         CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS "precision",
         CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall
  FROM cells),
report AS (
  SELECT model, accuracy,
         (f1_positive * (tp + fn) + f1_negative * (tn + fp)) / (tp + tn + fp + fn) AS f1,
         f1_positive, auc, "precision", recall, tp, tn, fp, fn
  FROM per_class JOIN areas USING (model))"""

LOG_RULES_SQL = """
guesses AS (
  SELECT 'goal echo' AS model, pledged, pledged_log, ln(1 + goal) AS prediction FROM parts WHERE split = 'test'
  UNION ALL
  SELECT 'backers rule', pledged, pledged_log, ln(1 + backers * CAST(100 AS DOUBLE)) FROM parts WHERE split = 'test'),
errors AS (
  SELECT model, sqrt(AVG((pledged_log - prediction) * (pledged_log - prediction))) AS rmse_log,
         1 - AVG((pledged_log - prediction) * (pledged_log - prediction)) / var_pop(pledged_log) AS r2_log,
         AVG(abs(pledged_log - prediction)) AS mae_log,
         sqrt(AVG((pledged - (exp(prediction) - 1)) * (pledged - (exp(prediction) - 1)))) AS rmse_orig,
         AVG(abs(pledged - (exp(prediction) - 1))) AS mae_orig
  FROM guesses GROUP BY model)"""


def rule_predictions(spark, sf_dir):
    """Two rules applied to the test rows in one pass: (model, label, prediction, score)."""
    rules = F.array(
        F.struct(
            F.lit("goal rule").alias("model"),
            (F.col("goal") < 5000).cast("double").alias("prediction"),
            (F.lit(1.0) / (F.col("goal") + 1)).alias("score"),
        ),
        F.struct(
            F.lit("backers rule").alias("model"),
            (F.col("backers") >= 100).cast("double").alias("prediction"),
            F.col("backers").cast("double").alias("score"),
        ),
    )
    test = split_featured(spark, sf_dir).filter(F.col("split") == "test")
    return test.select("label", F.inline(rules))


def log_predictions(spark, sf_dir):
    rules = F.array(
        F.struct(F.lit("goal echo").alias("model"), F.log1p("goal").alias("prediction")),
        F.struct(F.lit("backers rule").alias("model"), F.log1p(F.col("backers") * 100.0).alias("prediction")),
    )
    test = split_featured(spark, sf_dir).filter(F.col("split") == "test")
    return test.select("pledged", "pledged_log", F.inline(rules))


def _counts(spark, sf_dir):
    return evaluation.confusion_counts(rule_predictions(spark, sf_dir))


@register(
    "accuracy",
    with_campaigns(RULES_SQL) + "SELECT model, round(accuracy, 6) AS accuracy FROM report",
)
def accuracy(spark, sf_dir):
    return rounded(_counts(spark, sf_dir).select("model", evaluation.accuracy().alias("accuracy")), "accuracy")


@register(
    "f1_weighted",
    with_campaigns(RULES_SQL)
    + "SELECT model, round(f1, 6) AS f1, round(f1_positive, 6) AS f1_positive FROM report",
)
def f1_weighted(spark, sf_dir):
    out = _counts(spark, sf_dir).select(
        "model", evaluation.f1_weighted().alias("f1"), evaluation.f1_positive().alias("f1_positive")
    )
    return rounded(out, "f1", "f1_positive")


@register("auc_roc", with_campaigns(RULES_SQL) + "SELECT model, round(auc, 6) AS auc FROM areas")
def auc_roc(spark, sf_dir):
    return rounded(evaluation.auc_roc(rule_predictions(spark, sf_dir)), "auc")


@register(
    "auc_by_member",
    with_campaigns(
        """members AS (SELECT "ID" % 5003 AS member, label, CAST(1 AS DOUBLE) / (1 + goal) AS score FROM feat),
        places AS (SELECT member, label, rank() OVER (PARTITION BY member ORDER BY score)
          + (COUNT(*) OVER (PARTITION BY member, score) - 1) / CAST(2 AS DOUBLE) AS r FROM members)"""
    )
    + """SELECT member AS model, round((SUM(CASE WHEN label = 1 THEN r ELSE 0 END) - SUM(label) * (SUM(label) + 1) / CAST(2 AS DOUBLE))
         / NULLIF(CAST(SUM(label) AS DOUBLE) * SUM(1 - label), 0), 6) AS auc FROM places GROUP BY member""",
)
def auc_by_member(spark, sf_dir):
    """One area per member of a key of thousands, not of a handful of models."""
    rows = featured(spark, sf_dir).select(
        (F.col("ID") % 5003).alias("member"), "label", (F.lit(1.0) / (F.col("goal") + 1)).alias("score")
    )
    return rounded(evaluation.auc_roc(rows, by="member"), "auc")


@register("confusion_counts", with_campaigns(RULES_SQL) + "SELECT model, tp, tn, fp, fn FROM cells")
def confusion_counts(spark, sf_dir):
    return _counts(spark, sf_dir)


@register(
    "precision_recall",
    with_campaigns(RULES_SQL)
    + 'SELECT model, round("precision", 6) AS "precision", round(recall, 6) AS recall FROM report',
)
def precision_recall(spark, sf_dir):
    return rounded(evaluation.precision_recall(_counts(spark, sf_dir)), "precision", "recall")


SHARES = ("accuracy", "f1", "f1_positive", "auc", "precision", "recall")


@register(
    "classifier_report",
    with_campaigns(RULES_SQL)
    + f"""SELECT model, {", ".join(f'round("{c}", 6) AS "{c}"' for c in SHARES)}, tp, tn, fp, fn FROM report""",
)
def classifier_report(spark, sf_dir):
    return rounded(evaluation.classifier_report(rule_predictions(spark, sf_dir)), *SHARES)


@register(
    "regression_log",
    with_campaigns(LOG_RULES_SQL)
    + """SELECT model, round(rmse_log, 6) AS rmse_log, round(r2_log, 6) AS r2_log, round(mae_log, 6) AS mae_log
         FROM errors""",
)
def regression_log(spark, sf_dir):
    out = evaluation.regressor_report(log_predictions(spark, sf_dir)).select("model", "rmse_log", "r2_log", "mae_log")
    return rounded(out, "rmse_log", "r2_log", "mae_log")


@register(
    "regression_orig",
    with_campaigns(LOG_RULES_SQL)
    + "SELECT model, round(rmse_orig, 4) AS rmse_orig, round(mae_orig, 4) AS mae_orig FROM errors",
)
def regression_orig(spark, sf_dir):
    out = evaluation.regressor_report(log_predictions(spark, sf_dir)).select("model", "rmse_orig", "mae_orig")
    return rounded(out, "rmse_orig", "mae_orig", digits=4)


ERRORS = ("rmse_log", "r2_log", "mae_log", "rmse_orig", "mae_orig")


@register(
    "regressor_report",
    with_campaigns(LOG_RULES_SQL)
    + f"SELECT model, {', '.join(f'round({c}, 4) AS {c}' for c in ERRORS)} FROM errors",
)
def regressor_report(spark, sf_dir):
    return rounded(evaluation.regressor_report(log_predictions(spark, sf_dir)), *ERRORS, digits=4)


@register(
    "model_comparison",
    with_campaigns(RULES_SQL)
    + """SELECT model, round(accuracy, 6) AS accuracy, round(auc, 6) AS auc,
         round((accuracy - (SELECT accuracy FROM report WHERE model = 'goal rule')) * 100, 6) AS accuracy_change,
         round((auc - (SELECT auc FROM report WHERE model = 'goal rule')) * 100, 6) AS auc_change
         FROM report""",
)
def model_comparison(spark, sf_dir):
    report = evaluation.classifier_report(rule_predictions(spark, sf_dir))
    out = evaluation.compare_models(report, "goal rule", {"accuracy": 100, "auc": 100})
    return rounded(out, "accuracy", "auc", "accuracy_change", "auc_change")


@register(
    "model_comparison_regression",
    with_campaigns(LOG_RULES_SQL)
    + """SELECT model, round(r2_log, 6) AS r2_log,
         round(r2_log - (SELECT r2_log FROM errors WHERE model = 'goal echo'), 6) AS r2_log_change FROM errors""",
)
def model_comparison_regression(spark, sf_dir):
    report = evaluation.regressor_report(log_predictions(spark, sf_dir))
    return rounded(evaluation.compare_models(report, "goal echo", {"r2_log": 1}), "r2_log", "r2_log_change")


@register(
    "metrics_long",
    with_campaigns(RULES_SQL)
    + "\nUNION ALL\n".join(
        f"""SELECT model, '{name}' AS metric, round("{c}", 6) AS value FROM report"""
        for c, name in evaluation.LONG_METRICS
    ),
)
def metrics_long(spark, sf_dir):
    return rounded(evaluation.metrics_long(evaluation.classifier_report(rule_predictions(spark, sf_dir))), "value")


@register(
    "confusion_long",
    with_campaigns(RULES_SQL)
    + "\nUNION ALL\n".join(
        f"""SELECT model, '{a}' AS actual, '{p}' AS predicted, {cell} AS "count", '{cell.upper()}' AS "type" FROM cells"""
        for cell, a, p in (
            ("tn", "Failed", "Failed"),
            ("fp", "Failed", "Successful"),
            ("fn", "Successful", "Failed"),
            ("tp", "Successful", "Successful"),
        )
    ),
)
def confusion_long(spark, sf_dir):
    return evaluation.confusion_long(_counts(spark, sf_dir))
