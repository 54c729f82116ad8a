"""Lookups that spread hot and null keys give the rows of a plain left join."""

import collections

import pytest
from pyspark.sql import functions as F

from pledgekit.operators import lookups
from pledgekit.runtime import stage


@pytest.mark.parametrize("share", [1, 3, 256])
def test_spread_lookup(spark, monkeypatch, share):
    monkeypatch.setattr(lookups, "HOT_SHARE", share)
    keys = ["hot"] * 200 + [None] * 50 + [f"k{i % 40}" for i in range(120)] + ["absent"] * 5
    rows = spark.createDataFrame(list(enumerate(keys)), "i int, k string")
    counts = collections.Counter(k for k in keys if k not in (None, "absent", "k7"))
    table = stage(spark.createDataFrame([(k, n, len(k)) for k, n in counts.items()], "k string, n bigint, v int"), "lookup")
    got = lookups.spread_lookup(rows, F.col("k"), table, "k", "n", F.xxhash64("i"), ("v",)).collect()
    assert sorted((r.i, r.k, r.v) for r in got) == [(i, k, len(k) if k in counts else None) for i, k in enumerate(keys)]
    assert rows.columns + ["v"] == lookups.spread_lookup(rows, F.col("k"), table, "k", "n", F.xxhash64("i"), ("v",)).columns


def test_spread_lookup_in_an_empty_table(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "i int, k string")
    table = spark.createDataFrame([], "k string, n bigint, v int")
    got = lookups.spread_lookup(rows, F.col("k"), table, "k", "n", F.xxhash64("i"), ("v",)).collect()
    assert sorted((r.i, r.v) for r in got) == [(1, None), (2, None)]
    assert lookups.spread_lookup(rows.limit(0), F.col("k"), table, "k", "n", F.xxhash64("i"), ("v",)).collect() == []


def test_hot_and_null_keys_are_dealt_over_tasks(spark):
    """Rows of one hot key and of none reach the join's shuffle under many partition keys."""
    rows = spark.range(4_000).select("id", F.when(F.col("id") % 2 == 0, "hot").alias("k"))
    table = stage(spark.createDataFrame([("hot", 2_000, 7), ("cold", 1, 8)], "k string, n bigint, v int"), "lookup")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = lookups.spread_lookup(rows, F.col("k"), table, "k", "n", F.xxhash64("id"), ("v",))
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) == 8 and max(sizes) < 800
