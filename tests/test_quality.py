import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from pledgekit.operators import quality, ranking, reports
from pledgekit.plans.campaigns import clean, featurise


def pairs(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_null_profile_counts_null_apart_from_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, None), (math.nan, "b")], "`x y` double, s string")
    rows = {r.column: r for r in quality.null_profile(df, with_nan=True).collect()}
    assert (rows["x y"].nulls, rows["x y"].nans) == (1, 1)
    assert (rows["s"].nulls, rows["s"].nans) == (1, 0)
    assert abs(rows["s"].pct - 100 / 3) < 1e-9


def test_null_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int")
    assert [tuple(r) for r in quality.null_profile(df).collect()] == [("a", 0, None)]


def test_numeric_summary(spark):
    df = spark.createDataFrame([(1,), (2,), (4,), (None,)], "a int")
    r = quality.numeric_summary(df, ["a"]).first()
    assert (r["count"], r.min, r.max) == (3, 1.0, 4.0)
    assert abs(r["stddev"] - statistics.stdev([1, 2, 4])) < 1e-12


def test_duplicates_count_null_as_one_value(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "ID bigint")
    r = quality.duplicate_keys(df, "ID").first()
    assert (r.n_rows, r.distinct_keys, r.duplicates, r.repeated_keys, r.max_copies) == (5, 3, 2, 2, 2)


def test_value_counts_break_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "s string")
    assert [tuple(r) for r in quality.value_counts(df, "s").collect()] == [("c", 2), ("a", 1), ("b", 1)]


def test_shape_check(spark):
    df = spark.range(3)
    assert quality.shape_check(df, 3, ["id"]).first().asDict() == {"n_rows": 3, "n_cols": 1, "rows_ok": True, "cols_ok": True}
    assert quality.assert_shape(df, 3, ["id"]) is df
    with pytest.raises(ValueError, match="row count"):
        quality.assert_shape(df, 4, ["id"])
    with pytest.raises(ValueError, match="columns differ"):
        quality.assert_shape(df, 3, ["ID"])


def raw_rows(spark):
    base = ("n", "c", "m", "USD", "2015-10-09", 100.0, "2015-08-11 12:12:28", 5.0, "failed", 3, "US", 5.0, 5.0, 100.0)
    columns = "name category main_category currency deadline goal launched pledged state backers country usd usd_pledged_real usd_goal_real".split()
    cases = [
        {},
        {"state": "live"},
        {"state": None},
        {"backers": None},
        {"goal": math.nan},
        {"deadline": "junk"},
        {"launched": None},
        {"state": "successful", "name": None},
    ]
    rows = [(i, *{**dict(zip(columns, base)), **c}.values()) for i, c in enumerate(cases)]
    schema = "ID bigint, name string, category string, main_category string, currency string, deadline string, goal double, launched string, pledged double, state string, backers int, country string, usd double, usd_pledged_real double, usd_goal_real double"
    return spark.createDataFrame(rows, schema)


def test_stage_audit_agrees_with_the_cleaning_itself(spark):
    raw = raw_rows(spark)
    audit = [(r.before, r.after, r.removed) for r in quality.stage_audit(raw).orderBy("step").collect()]
    assert audit == [(8, 6, 2), (6, 3, 3), (3, 2, 1)]
    cleaned = clean(raw)
    assert cleaned.count() == 2
    assert pairs(cleaned, "ID", "name") == {0: "n", 7: "Unknown"}
    assert pairs(cleaned, "ID", "label") == {0: 0, 7: 1}
    assert len(featurise(cleaned).columns) == 15 + 3 + 6 + 2


def test_stage_audit_is_one_scan(spark, featured):
    raw = spark.read.parquet(featured.inputFiles()[0])
    plan = quality.stage_audit(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_class_balance_by_split(spark):
    df = spark.createDataFrame([("train", 1), ("train", 0), ("train", 0), ("test", 1)], "split string, label int")
    got = {(r.split, r.label): (r["count"], round(r.pct, 3)) for r in quality.class_balance(df, split="split").collect()}
    assert got == {
        ("train", 1): (1, 33.333),
        ("train", 0): (2, 66.667),
        ("test", 1): (1, 100.0),
        ("all", 1): (2, 50.0),
        ("all", 0): (2, 50.0),
    }


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all values are one and the same."""
    rng = np.random.default_rng(0)
    data = np.concatenate([np.full(1000, 7.0), rng.lognormal(5, 2, 2001)])
    df = spark.createDataFrame([(float(x), i) for i, x in enumerate(data)], "x double, y int")
    return df.repartition(8).persist(), data


def test_exact_quantiles_on_skewed_data(skewed):
    df, data = skewed
    got = {(r.column, r.probability): r.value for r in ranking.exact_quantiles(df, ["x", "y"], [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]).collect()}
    for p in (0.0, 0.1, 0.25, 0.5, 0.99, 1.0):
        assert abs(got["x", p] - np.quantile(data, p)) < 1e-9 * max(1, data.max())
        assert abs(got["y", p] - np.quantile(np.arange(len(data)), p)) < 1e-9


def test_sketched_quantiles_keep_their_rank_error(skewed):
    df, data = skewed
    for r in quality.quantiles(df, ["x"], [0.25, 0.75], 0.01).collect():
        low, high = np.searchsorted(np.sort(data), [r.value, r.value], side="left")[0], np.searchsorted(np.sort(data), r.value, side="right")
        wanted = r.probability * len(data)
        assert low - 0.01 * len(data) <= wanted <= high + 0.01 * len(data)


@pytest.mark.parametrize("ranges", ["1", "3", "16"])
def test_running_totals_do_not_depend_on_the_ranges(spark, ranges):
    """Ranges within a member, across members, and of many members at once; a null member and an empty name."""
    rows = [(g, float(v), v % 5) for g in ("a", "b", "", None) for v in range(-20, 60)]
    rows += [(f"m{i:04d}", float(v), i + v) for i in range(1_200) for v in range(2)]
    df = spark.createDataFrame(rows, "g string, v double, n bigint")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = ranking.running_totals(df, "v", ["n"], "g").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = {(r.g, r.v): (r.cum_n, r.total_n) for r in out}
    assert len(out) == len(rows)
    for g in ("a", "b", "", None):
        run = 0
        for v in range(-20, 60):
            run += v % 5
            assert got[g, float(v)] == (run, 160)
    for i in range(1_200):
        assert got[f"m{i:04d}", 0.0] == (i, 2 * i + 1) and got[f"m{i:04d}", 1.0] == (2 * i + 1, 2 * i + 1)


def test_number_rows_is_a_total_order(spark):
    df = spark.createDataFrame([(f"v{i % 97:02d}", i) for i in range(500)], "s string, i int").repartition(7)
    out = ranking.number_rows(df, [F.desc("s"), F.col("i")], "at").collect()
    wanted = sorted(((r.s, r.i) for r in out), key=lambda t: ([-ord(c) for c in t[0]], t[1]))
    assert [(r.s, r.i) for r in sorted(out, key=lambda r: r["at"])] == wanted
    assert sorted(r["at"] for r in out) == list(range(500))


def test_iqr_outliers(spark):
    data = [float(x) for x in list(range(1, 101)) + [1000, -1000]]
    df = spark.createDataFrame([(x,) for x in data], "x double")
    r = quality.iqr_outliers(df, ["x"], relative_error=0).first()
    q1, q3 = np.quantile(data, [0.25, 0.75])
    assert (r.q1, r.q3, r.outliers) == (q1, q3, 2)
    assert quality.iqr_outliers(df, ["x"], multiplier=1e6, relative_error=0).first().outliers == 0


def test_correlation_matrix_is_symmetric(featured):
    rows = quality.correlation_matrix(featured, reports.correlated_features(), digits=None).collect()
    cells = {(r.feature_x, r.feature_y): r["corr"] for r in rows}
    assert len(cells) == 36
    assert all(cells[a, b] == cells[b, a] for a, b in cells)
    assert all(cells[a, a] == 1.0 for a, _ in cells)


def test_leakage_screen_flags_strong_columns_in_use(spark):
    df = spark.createDataFrame([(i % 2, i % 2 * 10, (i * 7) % 5, i % 2) for i in range(100)], "label int, twin int, noise int, gone int")
    out = pairs(quality.leakage_screen(df, ["twin", "noise", "gone"], "label", ["gone"], {"twin": "both"}), "feature", "flag")
    assert out == {"twin": "leaks", "noise": "ok", "gone": "withheld"}


def test_reports_do_not_depend_on_the_layout(featured):
    def reports_of(df):
        return (
            sorted(map(str, quality.value_counts(df, "goal_bucket").collect())),
            sorted(map(str, ranking.exact_quantiles(df, ["goal"], [0.3]).collect())),
            sorted((r.label, r["count"]) for r in quality.class_balance(df).collect()),
        )

    assert reports_of(featured.repartition(1)) == reports_of(featured.repartition(8))
