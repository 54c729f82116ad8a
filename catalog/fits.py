"""Model fits, tuning and scoring, with the published parameters and grids.

SQL cannot repeat a fit. Closed-form cases have a twin of their values; per-row results have a twin of their keys and of
invariants that are computed from the model's output.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.encodings import TRAIN_ROWS, labels_sql, slots_sql
from catalog.fixture import campaigns, featured, split_featured, with_campaigns
from catalog.registry import register, rounded
from pledgekit.functions.columns import positive_probability, square, total
from pledgekit.operators import clustering, encoding, evaluation, models, reports
from pledgekit.plans.campaigns import clean, featurise, with_split
from pledgekit.plans.export import run_summary
from pledgekit.plans.segmentation import segment
from pledgekit.plans.supervised import (
    BOOSTED,
    FOREST,
    LINEAR,
    LOGISTIC,
    classification_long,
    prepare_splits,
    regression_long,
    train_and_evaluate,
)
from pledgekit.runtime import ensure_checkpoints, persisted, small, stage
from pledgekit.spec import ClusterSpec, FeatureSpec, ModelSpec

PUBLISHED = ModelSpec()
CLUSTERS = ClusterSpec()


def prepared(spark, sf_dir):
    return prepare_splits(featured(spark, sf_dir))


def vectors(spark, sf_dir):
    """Scaled vectors, staged, so that no fit repeats the joins or the scaling."""
    rows = stage(featured(spark, sf_dir).select("ID", *CLUSTERS.features), "cluster-input")
    return stage(encoding.cluster_preparation().fit(rows).transform(rows).select("ID", "features"), "cluster-vectors")


# Slots of the two vectors by name; the classifier's second assembly puts its parts' names before their own.
SLOTS_SQL = with_campaigns(
    TRAIN_ROWS,
    *labels_sql("train_rows", FeatureSpec().low_card),
    slots_sql(),
    """plain AS (SELECT CAST(row_number() OVER (ORDER BY g, p) - 1 AS INT) AS slot, name FROM names),
    classifier AS (SELECT slot, 'features_' || name AS name FROM plain
      UNION ALL SELECT CAST((SELECT COUNT(*) FROM plain) AS INT), 'engagement_scaled_0')""",
)


def largest_forest(levels):
    """The largest forest of the published grid."""
    return models.forest(levels).setNumTrees(max(PUBLISHED.forest_trees)).setMaxDepth(max(PUBLISHED.forest_depths))


def largest_boosted(levels):
    return models.boosted(levels).setMaxIter(max(PUBLISHED.boost_rounds)).setMaxDepth(max(PUBLISHED.boost_depths))


def _coefficient_flags(table):
    """Each slot once, with a coefficient but for the intercept, and no slope left in the penalised loss."""
    flat = F.abs(F.col("gradient")) < 1e-4
    named = F.col("coefficient").isNotNull() & ~F.isnan("coefficient")
    return table.select("slot", "feature", (named | (F.col("slot") == -1)).alias("fitted"), flat.alias("stationary"))


def _coefficients_sql(view: str) -> str:
    return SLOTS_SQL + f"""SELECT slot, name AS feature, TRUE AS fitted, TRUE AS stationary FROM {view}
        UNION ALL SELECT CAST(-1 AS INT), '{models.INTERCEPT}', TRUE, TRUE"""


@register("logistic_fit", _coefficients_sql("classifier"))
def logistic_fit(spark, sf_dir):
    """The penalised loss has no slope at the fitted coefficients, recomputed from the training rows."""
    ready = prepared(spark, sf_dir)
    names = encoding.slot_names(ready.table, "features_clf")
    return _coefficient_flags(models.logistic_gradient(models.logistic().fit(ready.train), ready.train, names))


@register(
    "logistic_levels",
    with_campaigns()
    + """SELECT main_category, round(AVG(label), 4) AS prob_success FROM parts
         WHERE split = 'train' GROUP BY main_category""",
)
def logistic_levels(spark, sf_dir):
    """An unpenalised logistic model of one categorical feature must return the rate of each level."""
    train = split_featured(spark, sf_dir).filter(F.col("split") == "train").select("main_category", "label")
    rows = encoding.string_indexer(["main_category"]).fit(train).transform(train)
    rows = encoding.one_hot_encoder(["main_category_idx"], ["features"]).fit(rows).transform(rows)
    model = LogisticRegression(regParam=0.0, tol=1e-9, fitIntercept=False).fit(rows)
    scored = model.transform(rows).select(
        "main_category", positive_probability(F.col("probability")).alias("p")
    )
    return rounded(scored.groupBy("main_category").agg(F.avg("p").alias("prob_success")), "prob_success", digits=4)


def _importance_rows(model, names):
    """Every slot once, with its importance between 0 and 1, and all of them adding up to 1."""
    table = models.slot_importance(model, names)
    whole = Window.partitionBy()  # one row per slot of the vector
    share = F.col("importance")
    return table.select(
        "slot", "feature", share.between(0, 1).alias("is_share"), (F.abs(F.sum(share).over(whole) - 1) < 1e-9).alias("adds_up")
    )


def _importance_sql(view: str) -> str:
    return SLOTS_SQL + f"SELECT slot, name AS feature, TRUE AS is_share, TRUE AS adds_up FROM {view}"


@register("forest_fit", _importance_sql("classifier"))
def forest_fit(spark, sf_dir):
    """The largest published forest: an importance for every slot."""
    ready = prepared(spark, sf_dir)
    model = largest_forest(ready.levels).fit(ready.train)
    return _importance_rows(model, encoding.slot_names(ready.table, "features_clf"))


@register("linear_fit", _coefficients_sql("plain"))
def linear_fit(spark, sf_dir):
    ready = prepared(spark, sf_dir)
    names = encoding.slot_names(ready.table, "features")
    return _coefficient_flags(models.linear_gradient(models.linear().fit(ready.train), ready.train, names))


@register(
    "linear_single",
    with_campaigns()
    + """SELECT round(regr_slope(pledged_log, campaign_duration_days), 6) AS slope,
         round(regr_intercept(pledged_log, campaign_duration_days), 6) AS intercept
         FROM parts WHERE split = 'train'""",
)
def linear_single(spark, sf_dir):
    """The unpenalised model of one feature is the least-squares line."""
    train = split_featured(spark, sf_dir).filter(F.col("split") == "train")
    rows = encoding.assembler(["campaign_duration_days"], "features").transform(train)
    model = LinearRegression(labelCol="pledged_log", regParam=0.0, solver="normal").fit(rows)
    line = spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))], "slope double, intercept double")
    return rounded(line, "slope", "intercept")


STUMP_ROWS = "SELECT CAST(backers >= 150 AS INT) AS many_backers, label, pledged_log FROM parts WHERE split = 'train'"


def stump_rows(spark, sf_dir):
    """Training rows with one binary feature, on which a tree of depth 1 can only split one way."""
    train = split_featured(spark, sf_dir).filter(F.col("split") == "train")
    rows = train.select((F.col("backers") >= 150).cast("int").alias("many_backers"), "label", "pledged_log")
    return stage(encoding.assembler(["many_backers"], "features").transform(rows), "stump-input")


@register(
    "forest_stump",
    with_campaigns(f"stump AS ({STUMP_ROWS})")
    + "SELECT many_backers, round(AVG(label), 6) AS prob_success FROM stump GROUP BY many_backers",
)
def forest_stump(spark, sf_dir):
    """A forest of one stump, fitted on every row once, returns the success rate of each side."""
    rows = stump_rows(spark, sf_dir)
    forest = models.forest({}).setFeaturesCol("features").setNumTrees(1).setMaxDepth(1)
    stump = forest.setBootstrap(False).fit(rows)
    sides = stump.transform(rows).groupBy("many_backers")
    return rounded(sides.agg(F.avg(positive_probability(F.col("probability"))).alias("prob_success")), "prob_success")


@register(
    "gbt_stump",
    with_campaigns(f"stump AS ({STUMP_ROWS})")
    + "SELECT many_backers, round(AVG(pledged_log), 6) AS prediction FROM stump GROUP BY many_backers",
)
def gbt_stump(spark, sf_dir):
    """One boosting round of depth 1 returns the mean target of each side."""
    rows = stump_rows(spark, sf_dir)
    stump = models.boosted({}).setMaxIter(1).setMaxDepth(1).fit(rows)
    sides = stump.transform(rows).groupBy("many_backers")
    return rounded(sides.agg(F.avg("prediction").alias("prediction")), "prediction")


@register("gbt_fit", _importance_sql("plain"))
def gbt_fit(spark, sf_dir):
    """The largest published boosted trees: an importance for every slot."""
    ready = prepared(spark, sf_dir)
    ensure_checkpoints(spark)
    model = largest_boosted(ready.levels).fit(ready.train)
    return _importance_rows(model, encoding.slot_names(ready.table, "features"))


@register(
    "kmeans_fit",
    " UNION ALL ".join(
        f"SELECT CAST(cluster AS INT) AS cluster, '{c}' AS feature, TRUE AS is_mean FROM range({CLUSTERS.k}) AS r(cluster)"
        for c in CLUSTERS.features
    ),
)
def kmeans_fit(spark, sf_dir):
    """Every coordinate of every center is the mean of the campaigns assigned to it, in standard deviations."""
    rows = vectors(spark, sf_dir)
    model = models.kmeans(CLUSTERS.k).fit(rows)
    centers = clustering.model_centers(rows, model, CLUSTERS.features)
    slots = vector_to_array("features")
    assigned = model.transform(rows).select("prediction", *[slots[i].alias(c) for i, c in enumerate(CLUSTERS.features)])
    means = clustering.center_means(assigned, CLUSTERS.features, "prediction")
    both = centers.alias("c").join(means.alias("m"), "cluster")
    near = [F.struct(F.lit(c).alias("feature"), (F.abs(F.col(f"c.{c}") - F.col(f"m.{c}")) < 0.01).alias("is_mean")) for c in CLUSTERS.features]
    return both.select("cluster", F.inline(F.array(*near)))


def _grid_sql() -> str:
    sizes = {
        FOREST: len(PUBLISHED.forest_trees) * len(PUBLISHED.forest_depths),
        BOOSTED: len(PUBLISHED.boost_rounds) * len(PUBLISHED.boost_depths),
    }
    return " UNION ALL ".join(
        f"SELECT '{m}' AS model, CAST(combo AS INT) AS combo, TRUE AS best_is_best, TRUE AS measured FROM range({n}) AS r(combo)"
        for m, n in sizes.items()
    )


@register("cross_validate", _grid_sql())
def cross_validate(spark, sf_dir):
    """Both published grids, one row per combination: the chosen one, and no other, has the best metric."""
    ready = prepared(spark, sf_dir)
    forest, boosted = models.forest(ready.levels), models.boosted(ready.levels)
    tables = [
        models.cross_validate(
            forest, models.forest_grid(forest, PUBLISHED), models.auc_evaluator(), ready.train, 2
        ).table.withColumn("model", F.lit(FOREST)),
        models.cross_validate(
            boosted, models.boosted_grid(boosted, PUBLISHED), models.rmse_evaluator(), ready.train, 2
        ).table.withColumn("model", F.lit(BOOSTED)),
    ]
    both = tables[0].unionByName(tables[1])
    model = Window.partitionBy("model")  # 3 and 4 rows
    best = F.when(F.col("model") == FOREST, F.max("avg_metric").over(model)).otherwise(F.min("avg_metric").over(model))
    first = F.min(F.when(F.col("avg_metric") == F.col("_best"), F.col("combo"))).over(model)
    return both.withColumn("_best", best).select(
        "model",
        "combo",
        (F.col("best") == (F.col("combo") == first)).alias("best_is_best"),
        (F.col("avg_metric").isNotNull() & ~F.isnan("avg_metric") & (F.col("std_metric") >= 0)).alias("measured"),
    )


# Every test row once, with its invariants.
TEST_ROWS = """SELECT "ID", {0} FROM parts WHERE split = 'test'"""


@register("score", with_campaigns() + TEST_ROWS.format("label, TRUE AS is_class, TRUE AS has_scores"))
def score(spark, sf_dir):
    """Every test row is scored once: its class is 0 or 1, and its class scores add up to 0 (log odds)."""
    ready = prepared(spark, sf_dir)
    scored = models.score(models.logistic().fit(ready.train), ready.test)
    odds = vector_to_array("rawPrediction")
    return scored.select(
        "ID",
        "label",
        F.col("prediction").isin(0.0, 1.0).alias("is_class"),
        (F.abs(odds[0] + odds[1]) < 1e-9).alias("has_scores"),
    )


@register("prob_success", with_campaigns() + TEST_ROWS.format("TRUE AS in_range, TRUE AS agrees, TRUE AS complements"))
def prob_success(spark, sf_dir):
    """The probability of each test row lies in 0..1, decides its class, and complements the other class."""
    ready = prepared(spark, sf_dir)
    scored = models.score(models.logistic().fit(ready.train), ready.test)
    both = scored.withColumns(
        {"prob_success": positive_probability(F.col("probability")), "other": vector_to_array("probability")[0]}
    )
    return both.select(
        "ID",
        F.col("prob_success").between(0, 1).alias("in_range"),
        ((F.col("prediction") == 1) == (F.col("prob_success") > 0.5)).alias("agrees"),
        (F.abs(F.col("prob_success") + F.col("other") - 1) < 1e-9).alias("complements"),
    )


def _two_models(first: str, second: str, columns: str) -> str:
    return with_campaigns() + f"""SELECT m.model, {columns} FROM parts, (VALUES ('{first}'), ('{second}')) AS m(model)
        WHERE split = 'test' GROUP BY m.model"""


@register("fitted_classifiers", _two_models(LOGISTIC, FOREST, "COUNT(*) AS n_test, TRUE AS accuracy_agrees, TRUE AS auc_in_range"))
def fitted_classifiers(spark, sf_dir):
    """The classifier report over fitted models: cells add up to the test rows, and accuracy is that of the predictions."""
    ready = prepared(spark, sf_dir)
    fitted = {LOGISTIC: models.logistic(), FOREST: largest_forest(ready.levels)}
    scored = {n: e.fit(ready.train).transform(ready.test) for n, e in fitted.items()}
    long = stage(classification_long(scored), "fitted-classifiers")
    direct = long.groupBy("model").agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("own"))
    return (
        evaluation.classifier_report(long)
        .join(direct, "model")
        .select(
            "model",
            (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).alias("n_test"),
            (F.abs(F.col("accuracy") - F.col("own")) < 1e-9).alias("accuracy_agrees"),
            F.col("auc").between(0.5, 1).alias("auc_in_range"),
        )
    )


@register("fitted_regressors", _two_models(LINEAR, BOOSTED, "TRUE AS errors_agree, TRUE AS better_than_mean"))
def fitted_regressors(spark, sf_dir):
    """The regressor report over fitted models against errors recomputed from stored predictions."""
    ready = prepared(spark, sf_dir)
    fitted = {LINEAR: models.linear(), BOOSTED: largest_boosted(ready.levels)}
    scored = {n: e.fit(ready.train).transform(ready.test) for n, e in fitted.items()}
    long = stage(regression_long(scored), "fitted-regressors")
    miss = F.col("pledged_log") - F.col("prediction")
    direct = long.groupBy("model").agg(F.sqrt(F.avg(miss * miss)).alias("rmse"), F.avg(F.abs(miss)).alias("mae"))
    return (
        evaluation.regressor_report(long)
        .join(direct, "model")
        .select(
            "model",
            ((F.abs(F.col("rmse_log") - F.col("rmse")) < 1e-9) & (F.abs(F.col("mae_log") - F.col("mae")) < 1e-9)).alias("errors_agree"),
            (F.col("r2_log") > 0).alias("better_than_mean"),
        )
    )


@register(
    "feature_importance",
    SLOTS_SQL + """SELECT CAST(r AS INT) AS "rank", TRUE AS is_slot, TRUE AS descending, TRUE AS none_larger_left_out
        FROM range(1, (SELECT least(15, COUNT(*)) FROM classifier) + 1) AS t(r)""",
)
def feature_importance(spark, sf_dir):
    """The 15 largest importances in order, against those of all slots; the limit is the feature."""
    ready = prepared(spark, sf_dir)
    model = largest_forest(ready.levels).fit(ready.train)
    names = encoding.slot_names(ready.table, "features_clf")
    everything = {r.feature: r.importance for r in models.slot_importance(model, names).collect()}
    top = models.feature_importance(model, names, top=15).collect()
    rest = [v for f, v in everything.items() if f not in {r.feature for r in top}]
    rows = [
        (
            k + 1,
            everything.get(r.feature) == r.importance,
            k == 0 or top[k - 1].importance >= r.importance,
            r.importance >= max(rest, default=0.0),
        )
        for k, r in enumerate(top)
    ]
    return spark.createDataFrame(rows, "rank int, is_slot boolean, descending boolean, none_larger_left_out boolean")


@register("classification_results", with_campaigns() + TEST_ROWS.format("label, TRUE AS in_range, TRUE AS agrees"))
def classification_results(spark, sf_dir):
    ready = prepared(spark, sf_dir)
    out = reports.classification_results(largest_forest(ready.levels).fit(ready.train).transform(ready.test))
    return out.select(
        "ID",
        "label",
        F.col("prob_success").between(0, 1).alias("in_range"),
        ((F.col("prediction") == 1) == (F.col("prob_success") > 0.5)).alias("agrees"),
    )


@register("regression_results", with_campaigns() + TEST_ROWS.format("round(pledged, 6) AS pledged, TRUE AS inverts"))
def regression_results(spark, sf_dir):
    """The predicted amount of each test row is the inverse of its predicted log."""
    ready = prepared(spark, sf_dir)
    out = reports.regression_results(largest_boosted(ready.levels).fit(ready.train).transform(ready.test))
    back = F.abs(F.log1p("pledged_pred") - F.col("pledged_log_pred")) < 1e-9
    return rounded(out.select("ID", "pledged", back.alias("inverts")), "pledged")


@register(
    "elbow",
    "SELECT CAST(k AS INT) AS k, TRUE AS is_sum_of_squares, TRUE AS drop_follows FROM range(2, 11) AS r(k)",
)
def elbow(spark, sf_dir):
    """Each k of the search once: its cost against the distances that the model's own assignment gives, and the drop."""
    rows = vectors(spark, sf_dir)
    with persisted(rows) as (held,):
        fitted = clustering.search_clusters(held, CLUSTERS)
        costs = small(clustering.elbow(held, fitted))
        slots = vector_to_array("features")
        sums = []
        for k, model in fitted.items():
            center = F.element_at(F.array(*[F.array(*map(F.lit, map(float, c))) for c in model.clusterCenters()]), F.col("prediction") + 1)
            gaps = F.zip_with(slots, center, lambda a, b: (a - b) * (a - b))
            own = model.transform(held).agg(F.sum(F.aggregate(gaps, F.lit(0.0), lambda t, x: t + x)).alias("own"))
            sums.append((k, own.first()["own"]))
    own = spark.createDataFrame(sums, "k int, own double")
    before = own.select((F.col("k") + 1).alias("k"), F.col("own").alias("before"))
    wanted = (F.col("before") - F.col("own")) / F.col("before") * 100
    return (
        clustering.wcss_drop(costs)
        .join(own, "k")
        .join(before, "k", "left")
        .select(
            "k",
            (F.abs(F.col("wcss") - F.col("own")) <= 1e-9 * F.col("own")).alias("is_sum_of_squares"),
            F.when(F.col("before").isNull(), F.col("drop_pct").isNull())
            .otherwise(F.abs(F.col("drop_pct") - wanted) < 1e-6)
            .alias("drop_follows"),
        )
    )


@register("assign_clusters", with_campaigns() + """SELECT "ID", TRUE AS nearest FROM feat""")
def assign_clusters(spark, sf_dir):
    """Every campaign is assigned once, to the center nearest to it."""
    rows = vectors(spark, sf_dir)
    model = models.kmeans(CLUSTERS.k).fit(rows)
    return model.transform(rows).select("ID", _is_nearest(model).alias("nearest"))


def _is_nearest(model):
    """Whether the assigned center is as near as any, by distances computed anew."""
    slots = vector_to_array("features")
    distances = F.array(
        *[
            total([square(slots[i] - F.lit(float(v))) for i, v in enumerate(center)])
            for center in model.clusterCenters()
        ]
    )
    own = F.element_at(distances, F.col("prediction") + 1)
    return own <= F.array_min(distances) * (1 + 1e-9) + 1e-9


@register("embedding_clusters", "SELECT vec_id, TRUE AS nearest FROM embeddings WHERE embedding IS NOT NULL")
def embedding_clusters(spark, sf_dir):
    """K-means over another vector table: every vector is assigned once, to its nearest center."""
    from pyspark.ml.functions import array_to_vector

    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").filter(F.col("embedding").isNotNull())
    rows = vectors.select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    model = models.kmeans(CLUSTERS.k).fit(rows)
    return model.transform(rows).select("vec_id", _is_nearest(model).alias("nearest"))


def _run_report_sql() -> str:
    facts = {
        ("run", "seed"): str(PUBLISHED.seed),
        ("rows", "raw"): "(SELECT COUNT(*) FROM campaigns)",
        ("rows", "clean"): "(SELECT COUNT(*) FROM parts)",
        ("rows", "successful"): "(SELECT COUNT(*) FROM parts WHERE label = 1)",
        ("split", "train"): "(SELECT COUNT(*) FROM parts WHERE split = 'train')",
        ("split", "test"): "(SELECT COUNT(*) FROM parts WHERE split = 'test')",
        ("vector", "slots"): "(SELECT COUNT(*) FROM plain)",
        ("clusters", "k"): str(CLUSTERS.k),
    }
    learned = [("classification", f"{m}: {x}") for m in (LOGISTIC, FOREST) for x in ("accuracy", "f1", "auc")]
    learned += [("regression", f"{m}: {x}") for m in (LINEAR, BOOSTED) for x in ("r2_log", "rmse_orig")]
    learned.append(("clusters", "silhouette"))
    parts = [f"SELECT '{s}' AS section, '{i}' AS item, CAST({v} AS DOUBLE) AS value, TRUE AS in_range" for (s, i), v in facts.items()]
    parts += [f"SELECT '{s}', '{i}', CAST(NULL AS DOUBLE), TRUE" for s, i in learned]
    return SLOTS_SQL + " UNION ALL ".join(parts)


@register("run_report", _run_report_sql())
def run_report(spark, sf_dir):
    """The whole run: both tasks, segmentation, and the summary of all of them.

    Counts are returned as they are, learned figures as whether they lie where such a figure can. The joined campaigns
    are written once, as a run writes its parsed files, since training, segmentation and both counts read them.
    """
    raw = stage(campaigns(spark, sf_dir), "report-raw")
    rows = raw.transform(clean).transform(featurise)
    supervised = train_and_evaluate(rows)
    report = run_summary(raw, with_split(rows), supervised, segment(rows), PUBLISHED.seed)
    value, item = F.col("value"), F.col("item")
    low = F.when(item == "silhouette", -1.0).when(item.endswith("auc"), 0.5).otherwise(0.0)
    high = F.when(item.endswith("rmse_orig"), float("inf")).otherwise(1.0)
    learned = F.col("section").isin("classification", "regression") | (item == "silhouette")
    return report.select(
        "section",
        "item",
        F.when(~learned, value).alias("value"),
        F.when(learned, value.between(low, high)).otherwise(F.lit(True)).alias("in_range"),
    )
