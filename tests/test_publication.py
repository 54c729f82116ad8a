"""Published sets, refreshed partitions, rejected records and mergeable sketches."""

import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from pledgekit.operators import quality, sketches
from pledgekit.runtime import fresh_path, stage
from pledgekit.sources import publication, tables

GOOD = '1,"A ""quoted"" name",c,m,USD,2015-10-09,1000.0,2015-08-11 12:12:28,5.5,failed,3,US,5.5,5.5,1000.0'
ODD_ELSEWHERE = '2,"two\nlines",c,m,USD,2015-10-09,7.0,2015-08-11 12:12:28,5.5,failed,3,US,n/a,5.5,1000.0'
JUST_MISSING = '3,x,c,m,USD,2015-10-09,,2015-08-11 12:12:28,5.5,failed,3,US,5.5,5.5,1000.0'
UNREADABLE = '4,x,c,m,USD,2015-10-09,much,2015-08-11 12:12:28,5.5,failed,several,US,5.5,5.5,1000.0'
SHIFTED = '5,no,quotes,here,c,m,USD,2015-10-09,7.0,2015-08-11 12:12:28,5.5,failed,3,US,5.5,5.5,1000.0'
SHORT = "6,x,c"
CRITICAL = ("ID", "goal", "launched", "pledged", "state", "backers")


# Sets


def rows(spark, n, start=0):
    made = [(start + i, None if i % 5 == 0 else "" if i % 5 == 1 else f'n "{i}",\nx', i / 7, i % 2 == 0) for i in range(n)]
    return spark.createDataFrame(made, "i bigint, name string, x double, even boolean").repartition(3)


@pytest.mark.parametrize("kind", ["csv", "json", "parquet"])
def test_a_published_table_is_read_back_as_it_was(spark, kind):
    root = fresh_path(spark, "published")
    df = rows(spark, 40)
    out = publication.Publication(spark, root)
    out.add("t", df, kind)
    assert out.commit() == 1
    back = publication.read_published(spark, root, "t")
    assert back.schema.names == df.schema.names and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert [tuple(r) for r in publication.verify_published(spark, root).collect()] == [("t", 40, 40, True)]


def test_a_version_is_read_as_a_whole(spark):
    """A run that ends between two tables leaves the old set; the next commit replaces all of it."""
    root = fresh_path(spark, "published")
    with pytest.raises(LookupError, match="nothing"):
        publication.published(spark, root)
    first = publication.Publication(spark, root)
    first.add("a", rows(spark, 10))
    first.add("b", rows(spark, 20), single_file=True)
    first.commit()
    dead = publication.Publication(spark, root)
    dead.add("a", rows(spark, 99))
    assert publication.read_published(spark, root, "a").count() == 10
    second = publication.Publication(spark, root)
    second.add("a", rows(spark, 11))
    with pytest.raises(ValueError, match="twice"):
        second.add("a", rows(spark, 11))
    assert second.commit() == 2
    assert publication.read_published(spark, root, "a").count() == 11
    with pytest.raises(LookupError, match="no table b"):
        publication.read_published(spark, root, "b")
    assert publication.read_published(spark, root, "b", 1).count() == 20
    with pytest.raises(LookupError, match="version 3"):
        publication.published(spark, root, 3)


def test_an_unfinished_list_is_not_a_version(spark):
    """A commit that dies while it writes leaves a temporary file, which readers do not see."""
    root = fresh_path(spark, "published")
    out = publication.Publication(spark, root)
    out.add("a", rows(spark, 10))
    out.commit()
    half = f"{root.removeprefix('file:')}/manifest/_temporary/0/part-00000.json"
    os.makedirs(os.path.dirname(half))
    with open(half, "w") as f:
        f.write('{"number": 9, "version": "x", "tab')
    assert publication.versions(spark, root).count() == 1
    assert publication.read_published(spark, root, "a").count() == 10


def test_damaged_files_are_told(spark):
    root = fresh_path(spark, "published")
    out = publication.Publication(spark, root)
    out.add("a", rows(spark, 10))
    path = out.add("b", rows(spark, 10), single_file=True)
    out.add("none", rows(spark, 10).limit(0), single_file=True)
    out.commit()
    part = glob.glob(f"{path.removeprefix('file:')}/part-*.csv")[0]
    text = open(part).read()
    for name in glob.glob(f"{os.path.dirname(part)}/.*.crc"):
        os.remove(name)
    with open(part, "w") as f:
        f.write(text.replace("true", "false", 1))
    assert {r.name: r.intact for r in publication.verify_published(spark, root).collect()} == {"a": True, "b": False, "none": True}


# Partitions


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path.removeprefix('file:')}/**/part-*", recursive=True)}


def test_refresh_touches_its_partitions_only(spark):
    df = stage(spark.range(400).select("id", (F.col("id") % 4).cast("int").alias("year"), F.lit("x").alias("v")), "refresh")
    path = tables.write_parquet(df.withColumn("v", F.lit("old")), fresh_path(spark, "by-year"), ["year"])
    before = files(path)
    report = publication.refresh_partitions(df.filter("id < 396"), path, "year", [2, 2, 3])
    assert sorted(map(tuple, report.collect())) == [(2, 99), (3, 99)]
    after = files(path)
    untouched = {f: t for f, t in before.items() if "year=0" in f or "year=1" in f}
    assert untouched.items() <= after.items() and not any(f in after for f in before if "year=2" in f or "year=3" in f)
    back = spark.read.schema(df.schema).parquet(path)
    assert {(r.year, r.v): r["count"] for r in back.groupBy("year", "v").count().collect()} == {
        (0, "old"): 100, (1, "old"): 100, (2, "x"): 99, (3, "x"): 99,
    }


def test_a_rerun_of_one_year_equals_a_full_run(spark):
    df = stage(spark.range(300).select("id", (F.col("id") % 3).cast("int").alias("year"), (F.col("id") * 2).alias("v")), "refresh")
    path = tables.write_parquet(df.withColumn("v", F.when(F.col("year") == 1, -1).otherwise(F.col("v"))), fresh_path(spark, "by-year"), ["year"])
    publication.refresh_partitions(df, path, "year", [1])
    back = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


def test_a_year_without_rows_is_emptied(spark):
    df = spark.createDataFrame([(1, "a/b"), (2, "c")], "id int, k string")
    path = tables.write_parquet(df, fresh_path(spark, "by-key"), ["k"])
    report = publication.refresh_partitions(df.filter("id = 2"), path, "k", ["a/b", "new"])
    assert sorted(map(tuple, report.collect())) == [("a/b", 0), ("new", 0)]
    assert [tuple(r) for r in spark.read.schema(df.schema).parquet(path).collect()] == [(2, "c")]
    for values in ([], [None]):
        with pytest.raises(ValueError, match="name the partition"):
            publication.refresh_partitions(df, path, "k", values)


def test_rows_that_differ_from_the_source_are_an_error(spark, monkeypatch):
    df = spark.createDataFrame([(i, 1) for i in range(10)], "id int, year int")
    path, read = fresh_path(spark, "by-year"), type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *paths: read(self, *paths).filter("id <> 3"))
    with pytest.raises(RuntimeError, match="year in \\[1\\]"):
        publication.refresh_partitions(df, path, "year", [1])


def test_the_filter_reaches_the_source(spark):
    source = tables.write_parquet(spark.range(90).select("id", (F.col("id") % 3).cast("int").alias("year")), fresh_path(spark, "source"), ["year"])
    part = spark.read.schema("id bigint, year int").parquet(source).filter(F.col("year").isin(1, 2))
    assert "PartitionFilters: [year" in part._jdf.queryExecution().executedPlan().toString()


# Records


def test_records_are_parted_with_reasons(spark, tmp_path):
    header = ",".join(tables.CAMPAIGN_SCHEMA.fieldNames())
    (tmp_path / "a.csv").write_text("\n".join([header, GOOD, ODD_ELSEWHERE, JUST_MISSING]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join([header, UNREADABLE, SHIFTED, SHORT]) + "\n")
    records = tables.sort_out(spark, str(tmp_path), CRITICAL)
    assert records.everything.count() == 6
    accepted = {r.ID: r for r in records.accepted.collect()}
    assert set(accepted) == {1, 2, 3}
    assert accepted[2]["usd pledged"] is None and accepted[2].name == "two\nlines" and accepted[3].goal is None
    rejected = {r.ID: r for r in records.rejected.collect()}
    assert rejected[4].reason == "goal,backers" and rejected[4].record == UNREADABLE
    assert set(rejected) == {4, 5, 6} and "goal" in rejected[5].reason and rejected[6].reason == "goal,launched,pledged,state,backers"
    assert records.everything.schema.names == records.accepted.schema.names == tables.CAMPAIGN_SCHEMA.fieldNames()


def test_no_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(tables.CAMPAIGN_SCHEMA.fieldNames()) + "\n")
    records = tables.sort_out(spark, str(tmp_path), CRITICAL)
    assert records.everything.isEmpty() and records.accepted.isEmpty() and records.rejected.isEmpty()


# Sketches


def test_merged_sketches_keep_their_rank_error(spark):
    r = np.random.default_rng(4)
    data = np.concatenate([r.lognormal(3, 2, 20_000), np.full(20_000, 7.0)])  # half of all rows are one value
    made = [(float(x), int(i % 7)) for i, x in enumerate(data)] + [(None, 1), (float("nan"), 2), (None, 9)]
    df = spark.createDataFrame(made, "x double, year int").repartition(8)
    table = sketches.quantile_sketches(df, ["x"], "year", 0.01)
    assert {r.year for r in table.collect()} == set(range(7))  # the year without values has no sketch
    path = fresh_path(spark, "sketches")
    for years in ("year < 5", "year >= 5", "year = 2"):  # a group that comes again replaces itself
        sketches.write_sketches(table.filter(years), path, "year")
    kept = spark.read.schema(table.schema).parquet(path)
    assert sketches.merged_sketches(kept).first().n == len(data)
    ordered = np.sort(data)
    for q in sketches.merged_quantiles(kept, [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]).collect():
        low, high = np.searchsorted(ordered, q.value, "left") / len(data), np.searchsorted(ordered, q.value, "right") / len(data)
        assert low - 0.01 <= q.probability <= high + 0.01
    edges = sketches.merged_quantiles(kept, [0.25, 0.75])
    found = quality.iqr_outliers(df.filter(~F.isnan("x")), ["x"], edges=edges).first()
    assert found.outliers == int(((data < found.lower) | (data > found.upper)).sum())


def test_sketch_sizes():
    assert 190 < sketches.sketch_size(0.0266) < 210
    assert sketches.sketch_size(0.9) == 8
    for error in (0, 1, -1):
        with pytest.raises(ValueError, match="between"):
            sketches.sketch_size(error)
    with pytest.raises(ValueError, match="exact"):
        sketches.sketch_size(1e-6)
