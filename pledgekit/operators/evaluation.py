"""Model reports from tables of (label, prediction, score), all models in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pledgekit.functions.columns import amount_from_log, quoted, rows_of, square
from pledgekit.operators.ranking import running_totals

CONFUSION = ("tp", "tn", "fp", "fn")

# Metric names of the published long table.
LONG_METRICS = (
    ("accuracy", "ACCURACY"),
    ("f1", "F1-Score"),
    ("auc", "AUC-ROC"),
    ("precision", "PRECISION"),
    ("recall", "RECALL"),
)
ACTUAL_NAMES = ("Failed", "Successful")


def _ratio(part: Column, whole: Column) -> Column:
    """0.0 where undefined."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _cells(label: Column, prediction: Column) -> dict[str, Column]:
    return {
        "tp": F.count_if((label == 1) & (prediction == 1)),
        "tn": F.count_if((label == 0) & (prediction == 0)),
        "fp": F.count_if((label == 0) & (prediction == 1)),
        "fn": F.count_if((label == 1) & (prediction == 0)),
    }


def confusion_counts(
    df: DataFrame, by: str = "model", label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Four cells per model, one aggregate: (model, tp, tn, fp, fn)."""
    cells = _cells(quoted(label), quoted(prediction))
    return df.groupBy(quoted(by).alias("model")).agg(*[c.alias(n) for n, c in cells.items()])


def accuracy() -> Column:
    return _ratio(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"))


def precision() -> Column:
    return _ratio(F.col("tp"), F.col("tp") + F.col("fp"))


def recall() -> Column:
    return _ratio(F.col("tp"), F.col("tp") + F.col("fn"))


def f1_positive() -> Column:
    return _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))


def f1_negative() -> Column:
    return _ratio(2 * F.col("tn"), 2 * F.col("tn") + F.col("fp") + F.col("fn"))


def f1_weighted() -> Column:
    """Per-class F1 weighted by the number of rows of each actual class."""
    positives, negatives = F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")
    return _ratio(f1_positive() * positives + f1_negative() * negatives, positives + negatives)


def precision_recall(counts: DataFrame) -> DataFrame:
    """Positive-class precision and recall from confusion counts, 0.0 when undefined."""
    return counts.select("model", precision().alias("precision"), recall().alias("recall"))


def _ranked_scores(df: DataFrame, by: str, label: str, prediction: str | None, score: str) -> DataFrame:
    """One row per model and distinct score, with class counts and negatives at or below it."""
    actual = quoted(label)
    cells = _cells(actual, quoted(prediction)) if prediction else {}
    per_score = df.groupBy(quoted(by).alias("model"), quoted(score).alias("score")).agg(
        F.count_if(actual == 1).alias("positives"),
        F.count_if(actual == 0).alias("negatives"),
        *[c.alias(n) for n, c in cells.items()],
    )
    return running_totals(per_score, "score", ["negatives"], by="model")


def _auc() -> Column:
    """Share of (positive, negative) pairs ranked rightly, ties counting half."""
    positives = F.col("positives").cast("double")
    wins = F.sum(positives * (F.col("cum_negatives") - F.col("negatives") * F.lit(0.5)))
    pairs = F.sum(positives) * F.max("total_negatives")
    return F.when(pairs > 0, wins / pairs)


def auc_roc(df: DataFrame, by: str = "model", label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve per model; null when a class is absent.

    Scores are counted per distinct value first and ranked range by range, so neither ties on a hot
    score nor many distinct scores pile up in one task.
    """
    return _ranked_scores(df, by, label, None, score).groupBy("model").agg(_auc().alias("auc"))


def classifier_report(
    df: DataFrame,
    by: str = "model",
    label: str = "label",
    prediction: str = "prediction",
    score: str = "score",
) -> DataFrame:
    """All classifier metrics, one row per model, from one pass over the predictions."""
    counts = (
        _ranked_scores(df, by, label, prediction, score)
        .groupBy("model")
        .agg(_auc().alias("auc"), *[F.sum(c).alias(c) for c in CONFUSION])
    )
    return counts.select(
        "model",
        accuracy().alias("accuracy"),
        f1_weighted().alias("f1"),
        f1_positive().alias("f1_positive"),
        "auc",
        precision().alias("precision"),
        recall().alias("recall"),
        *CONFUSION,
    )


def regressor_report(
    df: DataFrame,
    by: str = "model",
    target: str = "pledged_log",
    amount: str = "pledged",
    prediction: str = "prediction",
) -> DataFrame:
    """RMSE, R2 and MAE on the log scale, RMSE and MAE in amounts; one aggregate for all models."""
    y, p = quoted(target), quoted(prediction)
    miss, miss_amount = y - p, quoted(amount) - amount_from_log(p)
    sums = df.groupBy(quoted(by).alias("model")).agg(
        F.avg(square(miss)).alias("_mse"),
        F.avg(F.abs(miss)).alias("mae_log"),
        F.var_pop(y).alias("_var"),
        F.avg(square(miss_amount)).alias("_mse_amount"),
        F.avg(F.abs(miss_amount)).alias("mae_orig"),
    )
    return sums.select(
        "model",
        F.sqrt("_mse").alias("rmse_log"),
        F.when(F.col("_var") > 0, 1 - F.col("_mse") / F.col("_var")).alias("r2_log"),
        "mae_log",
        F.sqrt("_mse_amount").alias("rmse_orig"),
        "mae_orig",
    )


def compare_models(report: DataFrame, baseline: str, metrics: Mapping[str, float]) -> DataFrame:
    """Each metric's change against the baseline model, times its factor (100 for points).

    The window runs over the report, one row per model.
    """
    every = Window.partitionBy(F.lit(0))
    changes = [
        (
            (F.col(m) - F.max(F.when(F.col("model") == baseline, F.col(m))).over(every)) * F.lit(float(factor))
        ).alias(f"{m}_change")
        for m, factor in metrics.items()
    ]
    return report.select("model", *metrics, *changes)


def metrics_long(report: DataFrame, metrics: Sequence[tuple[str, str]] = LONG_METRICS) -> DataFrame:
    """Wide report to (model, metric, value)."""
    entries = [{"metric": F.lit(name), "value": F.col(column)} for column, name in metrics]
    return report.select("model", F.inline(rows_of(entries)))


def confusion_long(counts: DataFrame) -> DataFrame:
    """Confusion counts to (model, actual, predicted, count, type); empty cells stay as zero rows."""
    failed, successful = ACTUAL_NAMES
    cells = (("tn", failed, failed), ("fp", failed, successful), ("fn", successful, failed), ("tp", successful, successful))
    entries = [
        {
            "actual": F.lit(actual),
            "predicted": F.lit(predicted),
            "count": F.col(cell),
            "type": F.lit(cell.upper()),
        }
        for cell, actual, predicted in cells
    ]
    return counts.select("model", F.inline(rows_of(entries)))
