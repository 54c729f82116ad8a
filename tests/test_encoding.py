"""Spark ML stages and their relational forms must agree."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pledgekit.operators import encoding, splitting
from pledgekit.spec import FeatureSpec, SplitSpec


@pytest.fixture(scope="module")
def words(spark):
    train = spark.createDataFrame([(w,) for w in ["b", "b", "a", "a", "c", None, "d"]], "w string")
    test = spark.createDataFrame([(i, w) for i, w in enumerate(["a", "b", "c", "d", "new", None])], "i int, w string")
    return train, test


def test_index_ties_unseen_and_null(words):
    train, test = words
    labels = encoding.fit_labels(train, ["w"])
    assert [(r.value, r.n, r.idx) for r in labels.orderBy("idx").collect()] == [("a", 2, 0), ("b", 2, 1), ("c", 1, 2), ("d", 1, 3)]
    relational = [r.w_idx for r in encoding.apply_labels(test, labels, ["w"]).orderBy("i").collect()]
    staged = encoding.string_indexer(["w"]).fit(train).transform(test)
    assert relational == [r.w_idx for r in staged.orderBy("i").collect()] == [0, 1, 2, 3, 4, 4]


def test_labels_do_not_depend_on_the_layout(featured):
    columns = ["category", "country"]
    one = encoding.fit_labels(featured, columns)
    other = encoding.fit_labels(featured.repartition(7, "ID"), columns)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))
    a = encoding.apply_labels(featured, one, columns).select("ID", "category_idx", "country_idx")
    b = encoding.apply_labels(featured, other, columns).select("ID", "category_idx", "country_idx")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_preparation_of_many_labels(spark):
    """50,000 labels, one of them on a third of all rows: indexes equal those of a plain ranking, and only counts are metadata."""
    n = 150_000
    label = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1_000 == 1, None).otherwise(F.concat(F.lit("s"), F.col("id") % 50_021))
    df = spark.range(n).select(
        "id", label.alias("category"), F.lit("u").alias("currency"), F.concat(F.lit("n"), F.col("id") % 7).alias("country"),
        F.lit("m").alias("main_category"), F.lit("b").alias("goal_bucket"), (1 + F.col("id") % 12).cast("int").alias("launch_month"),
        (1 + F.col("id") % 7).cast("int").alias("launch_day_of_week"), *[(F.col("id") % 90).cast("double").alias(c) for c in
        ("goal", "usd_goal_real", "campaign_duration_days", "backers")],
    )
    train = df.filter("id < 140000")
    model = encoding.fit_preparation(train)
    counts = {}
    for i in range(140_000):
        v = "hot" if i % 3 == 0 else None if i % 1_000 == 1 else f"s{i % 50_021}"
        if v is not None:
            counts[v] = counts.get(v, 0) + 1
    order = {v: k for k, v in enumerate(sorted(counts, key=lambda v: (-counts[v], v)))}
    assert len(order) > 49_000 and encoding.arities(model)["category"] == len(order) + 1
    prepared = encoding.prepare(df, model)
    attrs = prepared.schema["features"].metadata["ml_attr"]["attrs"]["nominal"]
    assert [a for a in attrs if a["name"] == "category_idx"][0] == {"idx": attrs[0]["idx"], "name": "category_idx", "num_vals": len(order) + 1}
    slot = [a["idx"] for a in attrs if a["name"] == "category_idx"][0]
    got = prepared.select("id", "category", "category_idx", vector_to_array("features")[slot].alias("x")).collect()
    assert len(got) == n
    assert all(r.category_idx == r.x == order.get(r.category, len(order)) for r in got)


def test_table_indexer_is_a_string_indexer(featured, tmp_path):
    """Same indexes and levels as the driver-side indexer, also after a saved model is read again."""
    columns = ["category", "country", "goal_bucket"]
    stage = encoding.string_indexer(columns).fit(featured).transform(featured)
    model = encoding.TableIndexer(columns, ["goal_bucket"]).fit(featured)
    model.write().overwrite().save(str(tmp_path / "model"))
    again = encoding.TableIndexerModel.load(str(tmp_path / "model"))
    for m in (model, again):
        out = m.transform(featured)
        assert out.select("ID", *[f"{c}_idx" for c in columns]).exceptAll(stage.select("ID", *[f"{c}_idx" for c in columns])).isEmpty()
        assert out.schema["goal_bucket_idx"].metadata["ml_attr"]["vals"] == stage.schema["goal_bucket_idx"].metadata["ml_attr"]["vals"]
        levels = len(stage.schema["category_idx"].metadata["ml_attr"]["vals"])
        assert out.schema["category_idx"].metadata["ml_attr"] == {"type": "nominal", "num_vals": levels}


def test_preparation_of_an_empty_column(spark):
    """A column without any label puts all rows into the slot of unknown values."""
    df = spark.createDataFrame([(i, None) for i in range(5)], "i int, w string")
    out = encoding.TableIndexer(["w"]).fit(df).transform(df)
    assert {r.w_idx for r in out.collect()} == {0.0} and out.schema["w_idx"].metadata["ml_attr"]["num_vals"] == 1


def test_one_hot_widths(featured):
    model = encoding.fit_preparation(featured.filter("split = 'train'"))
    names = [r.name for r in encoding.slot_names(encoding.prepare(featured, model), "features").orderBy("slot").collect()]
    levels = {c: featured.filter("split = 'train'").select(c).distinct().count() for c in ("main_category", "goal_bucket")}
    groups = {p: sum(n.startswith(p + "_ohe_") for n in names) for p in ("main_category", "goal_bucket", "launch_month", "launch_day_of_week")}
    assert groups == {
        "main_category": levels["main_category"] + 1,
        "goal_bucket": levels["goal_bucket"] + 1,
        "launch_month": 13,
        "launch_day_of_week": 8,
    }
    assert names[:3] == ["cont_scaled_0", "cont_scaled_1", "cont_scaled_2"]
    assert names[-3:] == ["category_idx", "currency_idx", "country_idx"]
    wide = encoding.prepare(featured, model).select(F.size(vector_to_array("features_clf")).alias("n")).distinct().collect()
    assert [r.n for r in wide] == [len(names) + 1]


def test_published_widths(spark):
    """15 main categories and 5 goal bands give 49 and 50 slots."""
    rows = [
        (float(i), 2.0 * i, i % 60, f"c{i % 40}", f"u{i % 5}", f"n{i % 7}", f"m{i % 15}", f"b{i % 5}", 1 + i % 3, 1 + i % 7, i)
        for i in range(120)
    ]
    df = spark.createDataFrame(
        rows,
        "goal double, usd_goal_real double, campaign_duration_days int, category string, currency string, country string, "
        "main_category string, goal_bucket string, launch_month int, launch_day_of_week int, backers int",
    )
    prepared = encoding.prepare(df, encoding.fit_preparation(df))
    assert encoding.slot_names(prepared, "features").count() == 49
    assert encoding.slot_names(prepared, "features_clf").count() == 50
    compact = FeatureSpec(compact_temporal=True)
    prepared = encoding.prepare(df, encoding.fit_preparation(df, compact), compact)
    assert encoding.slot_names(prepared, "features").count() == 47
    hot = FeatureSpec(high_card_encoding="onehot")
    prepared = encoding.prepare(df, encoding.fit_preparation(df, hot), hot)
    assert encoding.slot_names(prepared, "features").count() == 46 + 41 + 6 + 8


def test_relational_one_hot_matches_the_stage(featured):
    rows = featured.select("ID", "goal_bucket")
    indexed = encoding.apply_labels(rows, encoding.fit_labels(rows, ["goal_bucket"]), ["goal_bucket"])
    staged = encoding.string_indexer(["goal_bucket"]).fit(rows).transform(rows)
    staged = encoding.one_hot_encoder(["goal_bucket_idx"], ["v"]).fit(staged).transform(staged)
    width = len(staged.select(vector_to_array("v").alias("a")).first().a)
    wide = indexed.select("ID", F.array(*encoding.one_hot_columns(F.col("goal_bucket_idx"), width, "b")).alias("a"))
    assert wide.exceptAll(staged.select("ID", vector_to_array("v").alias("a"))).isEmpty()


def test_relational_scaling_matches_the_stage(featured):
    columns = ["goal", "backers"]
    stage = encoding.assembler(columns, "v").transform(featured)
    stage = encoding.scaler("v", "z").fit(stage).transform(stage)
    both = encoding.standardise(stage, columns).select(vector_to_array("z").alias("z"), "goal_scaled", "backers_scaled")
    gap = both.agg(F.max(F.abs(F.col("z")[0] - F.col("goal_scaled")) + F.abs(F.col("z")[1] - F.col("backers_scaled")))).first()[0]
    assert gap < 1e-9


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double")
    assert [r.x_scaled for r in encoding.standardise(df, ["x"]).collect()] == [0.0, 0.0, None]


def test_assembled_null_is_nan(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    v = encoding.assembler(["a", "b"], "v").transform(df).first().v
    assert v[0] == 1.0 and v[1] != v[1]


def test_statistics_come_from_the_training_rows(spark):
    train = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    other = spark.createDataFrame([(1001.0,)], "x double")
    got = encoding.standardise(other, ["x"], fit_on=train).first().x_scaled
    assert abs(got - (1001 - 2) / 2**0.5) < 1e-9


def test_feature_groups(featured):
    rows = encoding.feature_groups(featured).collect()
    assert all(r.present for r in rows)
    assert {r.group for r in rows} == {"continuous", "high_card", "low_card", "temporal", "engagement", "withheld"}
    shared = set(FeatureSpec().inputs)
    assert not shared & set(FeatureSpec().withheld)


def test_hash_split_is_the_same_under_any_layout(featured):
    def parts(df):
        split = splitting.assign_folds(splitting.hash_split(df.select("ID"), "ID"), "ID")
        return sorted(map(tuple, split.collect()))

    assert parts(featured.repartition(1)) == parts(featured.repartition(8))
    share = featured.filter("split = 'train'").count() / featured.count()
    assert 0.75 < share < 0.85
    assert {r.fold for r in featured.select("fold").distinct().collect()} == {0, 1, 2}


def test_split_keeps_copies_together_and_handles_null_keys(spark):
    df = spark.createDataFrame([(k,) for k in [1, 1, 1, 2, None, None]], "ID bigint")
    out = splitting.hash_split(df, "ID", SplitSpec(salt="x"))
    assert out.groupBy("ID").agg(F.count_distinct("split").alias("n")).filter("n <> 1").isEmpty()
    assert out.filter("split IS NULL").isEmpty()


def test_random_split_is_a_partition(featured):
    train, test = splitting.random_split(featured.select("ID"))
    assert train.intersect(test).isEmpty()
    assert train.count() + test.count() == featured.count()
