import pytest
from pyspark.sql import types as T

from pledgekit.runtime import fresh_path, require_columns, stage
from pledgekit.sources import tables

HEADER = ",".join(tables.CAMPAIGN_SCHEMA.fieldNames())
GOOD = '1,"A ""quoted"" name",c,m,USD,2015-10-09,1000.0,2015-08-11 12:12:28,5.5,failed,3,US,5.5,5.5,1000.0'
BROKEN = '2,"two\nlines",c,m,USD,2015-10-09,xyz,2015-08-11 12:12:28,5.5,failed,3,US,,5.5,1000.0'


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "part.csv").write_text("\n".join([HEADER, GOOD, BROKEN]) + "\n")
    return str(tmp_path)


def test_scan_reads_quotes_newlines_and_bad_fields(spark, folder):
    rows = tables.scan_csv(spark, folder).orderBy("ID").collect()
    assert [r.name for r in rows] == ['A "quoted" name', "two\nlines"]
    assert rows[0].goal == 1000.0 and rows[1].goal is None
    assert rows[1]["usd pledged"] is None and rows[1].backers == 3


def test_malformed_rows_are_counted(spark, folder):
    scanned = tables.scan_csv(spark, folder, keep_corrupt=True).persist()
    assert tables.malformed_count(scanned).first().asDict() == {"n_rows": 2, "malformed": 1}
    scanned.unpersist()


def test_header_mismatch_is_an_error(spark, tmp_path):
    (tmp_path / "part.csv").write_text("\n".join([HEADER.replace("goal", "target", 1), GOOD]) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.scan_csv(spark, str(tmp_path)).collect()
    assert tables.scan_csv(spark, str(tmp_path), check_header=False).count() == 1
    wrong = tables.header_report(spark, str(tmp_path)).filter("NOT ok").collect()
    assert [(r.expected, r.found) for r in wrong] == [("goal", "target")]


def test_csv_round_trip(spark, folder):
    df = tables.scan_csv(spark, folder)
    path = tables.write_csv(df, fresh_path(spark, "test-csv"))
    assert sorted(map(str, tables.scan_csv(spark, path).collect())) == sorted(map(str, df.collect()))


def test_single_file_report(spark):
    import glob

    path = tables.write_csv(spark.range(100).repartition(4), fresh_path(spark, "test-one"), single_file=True)
    assert len(glob.glob(path.removeprefix("file:") + "/part-*.csv")) == 1


def test_partitioned_parquet_prunes(spark, featured):
    path = tables.write_parquet(featured.select("ID", "launched_year"), fresh_path(spark, "test-pq"), ["launched_year"])
    back = spark.read.parquet(path).filter("launched_year = 1995")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(launched_year" in plan
    assert back.count() == featured.filter("launched_year = 1995").count()


def test_stage_keeps_vector_slot_names(spark, featured):
    from pledgekit.operators.encoding import assembler, slot_names

    vec = assembler(["goal", "backers"], "v").transform(featured).select("ID", "v", "split")
    staged = stage(vec, "test-stage", ["split"])
    assert staged.schema == vec.schema
    assert [r.name for r in slot_names(staged, "v").collect()] == ["goal", "backers"]


def test_preview_is_deterministic(spark):
    df = spark.range(100).withColumnRenamed("id", "ID").repartition(7)
    assert [r.ID for r in tables.preview(df, "ID", 3).collect()] == [0, 1, 2]


def test_conform_and_required_columns(spark):
    df = spark.createDataFrame([(1, "x")], "b int, a string")
    out = tables.conform(df, T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType())]))
    assert out.columns == ["a", "b"] and dict(out.dtypes)["b"] == "bigint"
    with pytest.raises(ValueError, match="missing columns: c"):
        require_columns(df, ["a", "c"])


def test_converted_csv_filters_at_the_scan(spark, folder):
    from pledgekit.plans.campaigns import clean, featurise

    df = tables.convert_csv(spark, folder, fresh_path(spark, "test-convert"))
    assert "usd_pledged" in df.columns and df.count() == 2
    rows = df.transform(clean).transform(featurise).select("ID", "launched_year")
    assert [tuple(r) for r in rows.collect()] == [(1, 2015)]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(state, [failed,successful]), IsNotNull(ID), IsNotNull(goal)" in plan
    schema = plan[plan.index("ReadSchema") :].splitlines()[0]
    assert "deadline" in schema and "country" not in schema and "usd_goal_real" not in schema


def test_year_partitions_are_pruned(spark, featured):
    path = tables.write_parquet(featured.select("ID", "launched_year"), fresh_path(spark, "pruned"), ["launched_year"])
    back = spark.read.parquet(path)
    year = back.filter("launched_year = 1995")
    assert "PartitionFilters: [isnotnull(launched_year" in year._jdf.queryExecution().executedPlan().toString()
    assert len(year.inputFiles()) < len(back.inputFiles()) or year.count() == featured.filter("launched_year = 1995").count()
