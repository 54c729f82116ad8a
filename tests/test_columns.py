"""Scalar semantics, with ANSI mode on as Spark 4 has it."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pledgekit.functions import columns as C
from pledgekit.operators import cleaning, features
from pledgekit.spec import GOAL_BANDS, TOP_BAND


def values(df):
    return [r[0] for r in df.collect()]


def test_ansi_is_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_unparseable_dates_become_null(spark):
    df = spark.createDataFrame(
        [("2015-08-11", "2015-08-11 10:20:30"), ("junk", "2015-13-01 00:00:00"), ("", None), ("2015-02-30", "2015-01-01")],
        "deadline string, launched string",
    )
    rows = cleaning.parse_dates(df).collect()
    assert rows[0].deadline_ts is not None and rows[0].launched_ts is not None
    assert all(r.deadline_ts is None and r.launched_ts is None for r in rows[1:])


def test_duration_counts_calendar_days_and_weekday_starts_sunday(spark):
    df = spark.createDataFrame(
        [("2015-08-10", "2015-08-09 23:59:59"), ("2015-08-09", "2015-08-09 00:00:00"), ("2015-08-01", "2015-08-09 12:00:00")],
        "deadline string, launched string",
    )
    rows = df.transform(cleaning.parse_dates).transform(features.add_timing).collect()
    assert [r.campaign_duration_days for r in rows] == [1, 0, -8]
    assert {r.launch_day_of_week for r in rows} == {1}
    assert {r.launch_month for r in rows} == {8}


def test_goal_edges(spark):
    goals = [0.0, 999.99, 1000.0, 9999.99, 10000.0, 50000.0, 100000.0, None, math.nan]
    df = spark.createDataFrame([(g, 10.0) for g in goals], "goal double, pledged double")
    rows = features.add_funding(df).collect()
    assert [r.goal_bucket for r in rows] == ["micro", "micro", "small", "small", "medium", "large", "mega", None, None]
    assert rows[0].funding_ratio == 0.0
    assert rows[7].funding_ratio == 0.0
    assert rows[2].funding_ratio == 0.01


def test_meeting_the_goal_exactly_is_not_overfunded(spark):
    df = spark.createDataFrame([(5.0, 5.0), (5.0, 5.01), (5.0, None)], "goal double, pledged double")
    assert [r.is_overfunded for r in features.add_funding(df).collect()] == [0, 1, 0]


def test_drop_incomplete_drops_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (math.nan,)], "goal double")
    assert values(cleaning.drop_incomplete(df, ["goal"])) == [1.0]


def test_fill_defaults_only_fills_the_named_column(spark):
    df = spark.createDataFrame([(None, None), ("a", "b")], "name string, country string")
    assert [tuple(r) for r in cleaning.fill_defaults(df).collect()] == [("Unknown", None), ("a", "b")]


def test_inverse_log_keeps_what_is_no_number(spark):
    df = spark.createDataFrame([(800.0,), (0.0,), (None,), (2.0,), (float("nan"),)], "p double")
    out = values(df.select(C.amount_from_log(F.col("p"))))
    assert out[0] == math.inf and out[1] == 0.0 and out[2] is None and math.isnan(out[4])
    assert abs(out[3] - math.expm1(2.0)) < 1e-12


def test_log1p_below_minus_one_is_null(spark):
    df = spark.createDataFrame([(-2.0,), (0.0,)], "pledged double")
    assert [r.pledged_log for r in features.add_log_target(df).collect()] == [None, 0.0]


def test_half_even_follows_binary_scaling(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,), (2.0005,)], "x double")
    assert values(df.select(C.half_even(F.col("x"), 0))) == [0.0, 2.0, 2.0, 0.0, 2.0]
    assert values(df.select(C.half_even(F.col("x"), 3)))[4] == round(2.0005 * 1000) / 1000


def test_hash_bucket_matches_md5(spark):
    import hashlib

    df = spark.range(50)
    got = values(df.select(C.hash_bucket(F.col("id"), 100)))
    assert got == [int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % 100 for i in range(50)]


def test_log_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.99,), (1.0,), (10.0,), (1000.0,), (999.0,)], "x double")
    assert values(df.select(C.log_bin(F.col("x"), 1))) == [-1, -1, 0, 1, 3, 2]
    missing = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert values(missing.select(C.log_bin(F.col("x"), 1))) == [None, None]


def test_filters(spark):
    df = spark.createDataFrame([(1, 5.0), (0, 50.0), (1, 500.0)], "label int, goal double")
    assert [r.goal for r in cleaning.outside_range(df, "goal", 10, 100).collect()] == [5.0, 500.0]
    assert [r.goal for r in cleaning.matching(df, {"label": 1, "goal": 500.0}).collect()] == [500.0]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.floats(0, 1e9), min_size=1, max_size=20))
def test_bands_partition_amounts(spark, amounts):
    df = spark.createDataFrame([(a,) for a in amounts], "x double")
    for amount, band in df.select("x", C.size_band(F.col("x"), GOAL_BANDS, TOP_BAND).alias("b")).collect():
        below = [name for name, bound in GOAL_BANDS if amount < bound]
        assert band == (below[0] if below else TOP_BAND)
