"""Classification and regression from featured campaigns to reports."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgekit.functions.columns import positive_probability, quoted
from pledgekit.operators import evaluation, models, reports
from pledgekit.operators.encoding import arities, fit_preparation, prepare, slot_names
from pledgekit.plans.campaigns import with_split
from pledgekit.runtime import small, stage
from pledgekit.spec import FeatureSpec, ModelSpec, SplitSpec

# Published model names.
LOGISTIC, FOREST = "Logistic Regression", "Random Forest (tuned)"
LINEAR, BOOSTED = "Linear Regression", "GBT Regressor (tuned)"


# Training rows of one task. Fits hold about 700 bytes of each (binned rows and errors of boosted trees).
TASK_ROWS = 100_000


@dataclass(frozen=True)
class Prepared:
    """Vectors of both splits, written once; each reader takes only its columns and split."""

    table: DataFrame
    model: PipelineModel
    tasks: int = 1
    key: str = "ID"

    @property
    def train(self) -> DataFrame:
        """Training rows, dealt evenly to ``tasks`` if these are several, since a fit keeps the rows of a task in memory.

        How the files were written does not bound a task: it reads whole row groups, of any number of small rows.
        """
        rows = self.table.filter(F.col("split") == "train")
        return rows if self.tasks == 1 else rows.repartition(self.tasks).sortWithinPartitions(quoted(self.key))

    @property
    def test(self) -> DataFrame:
        return self.table.filter(F.col("split") == "test")

    @property
    def levels(self) -> dict[str, int]:
        return arities(self.model)


@dataclass(frozen=True)
class Supervised:
    prepared: Prepared
    models: dict[str, Model]
    classifier_tuning: DataFrame
    regressor_tuning: DataFrame
    classifier_metrics: DataFrame
    regressor_metrics: DataFrame
    classifier_importance: DataFrame
    regressor_importance: DataFrame
    classification_results: DataFrame
    regression_results: DataFrame


def prepare_splits(
    featured: DataFrame,
    features: FeatureSpec = FeatureSpec(),
    split: SplitSpec = SplitSpec(),
    key: str = "ID",
    amount: str = "pledged",
) -> Prepared:
    """Split, fit the encoders on the training rows, and stage the encoded rows.

    The narrow featured table is staged first: fitting and encoding then read it three times without
    repeating whatever joins produced it. A sort within each partition, which moves no rows, fixes the
    row order that seeded sampling (tree bagging) depends on.
    """
    used = [key, *features.inputs, *features.engagement, features.label, features.target, amount]
    narrow = with_split(featured, key, split).select(*[quoted(c) for c in dict.fromkeys(used)], "split", "fold")
    rows = stage(narrow.sortWithinPartitions(key), "featured", ["split"])
    fitted = fit_preparation(rows.filter(F.col("split") == "train"), features)
    vectors = list(dict.fromkeys(["features", features.classifier_vector]))
    encoded = prepare(rows, fitted, features).select(
        quoted(key), quoted(features.label), quoted(features.target), quoted(amount), "fold", *vectors, "split"
    )
    table = stage(encoded, "encoded", ["split"])
    whole = math.ceil(table.filter(F.col("split") == "train").count() / TASK_ROWS)
    tasks = max(whole, table.sparkSession.sparkContext.defaultParallelism) if whole > 1 else 1
    return Prepared(table, fitted, tasks, key)


def classification_long(scored: dict[str, DataFrame], label: str = "label") -> DataFrame:
    """Predictions of several classifiers as one table: (model, label, prediction, score)."""
    parts = [
        df.select(
            F.lit(name).alias("model"),
            quoted(label).alias("label"),
            "prediction",
            positive_probability(F.col("probability")).alias("score"),
        )
        for name, df in scored.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def regression_long(scored: dict[str, DataFrame], target: str = "pledged_log", amount: str = "pledged") -> DataFrame:
    parts = [
        df.select(F.lit(name).alias("model"), quoted(target), quoted(amount), "prediction")
        for name, df in scored.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def train_and_evaluate(
    featured: DataFrame,
    features: FeatureSpec = FeatureSpec(),
    spec: ModelSpec = ModelSpec(),
    split: SplitSpec = SplitSpec(),
    key: str = "ID",
    amount: str = "pledged",
) -> Supervised:
    """Fit both baselines, tune both tree models, and report on the test split.

    Fits run here, and the two-row metric reports are computed once; per-campaign results stay lazy.
    """
    prepared = prepare_splits(featured, features, split, key, amount)
    train, test = prepared.train, prepared.test

    logistic = models.logistic(features, spec).fit(train)
    forest = models.forest(prepared.levels, features, spec)
    tuned_forest = models.cross_validate(
        forest,
        models.forest_grid(forest, spec),
        models.auc_evaluator(features),
        train.select(quoted(features.label), features.classifier_vector, "fold"),
        spec.parallelism,
        split,
    )
    linear = models.linear(features, spec).fit(train)
    boosted = models.boosted(prepared.levels, features, spec)
    tuned_boosted = models.cross_validate(
        boosted,
        models.boosted_grid(boosted, spec),
        models.rmse_evaluator(features),
        train.select(quoted(features.target), "features", "fold"),
        spec.parallelism,
        split,
    )

    classified = {LOGISTIC: logistic.transform(test), FOREST: tuned_forest.best.transform(test)}
    regressed = {LINEAR: linear.transform(test), BOOSTED: tuned_boosted.best.transform(test)}
    return Supervised(
        prepared=prepared,
        models={LOGISTIC: logistic, FOREST: tuned_forest.best, LINEAR: linear, BOOSTED: tuned_boosted.best},
        classifier_tuning=tuned_forest.table,
        regressor_tuning=tuned_boosted.table,
        classifier_metrics=small(evaluation.classifier_report(classification_long(classified, features.label))),
        regressor_metrics=small(
            evaluation.regressor_report(regression_long(regressed, features.target, amount), target=features.target, amount=amount)
        ),
        classifier_importance=models.feature_importance(
            tuned_forest.best, slot_names(prepared.table, features.classifier_vector)
        ),
        regressor_importance=models.feature_importance(
            tuned_boosted.best, slot_names(prepared.table, "features")
        ),
        classification_results=reports.classification_results(classified[FOREST], key, features.label),
        regression_results=reports.regression_results(regressed[BOOSTED], key, amount),
    )
