"""End to end on the smoke tables, with small grids."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from catalog.fixture import campaigns, featured as build_featured
from pledgekit.operators import clustering, models, quality, reports
from pledgekit.plans import profile, refresh
from pledgekit.plans.campaigns import with_split
from pledgekit.plans.export import export, model_changes, result_tables, run_summary
from pledgekit.plans.run import run
from pledgekit.plans.segmentation import segment
from pledgekit.plans.supervised import BOOSTED, FOREST, LINEAR, LOGISTIC, prepare_splits, train_and_evaluate
from pledgekit.runtime import fresh_path
from pledgekit.sources.publication import read_published, verify_published
from pledgekit.sources.tables import CAMPAIGN_SCHEMA, write_csv, write_parquet
from pledgekit.spec import CampaignSpec, ClusterSpec, FeatureSpec, ModelSpec

SPEC = ModelSpec(max_iter=20, forest_trees=(3, 5), boost_rounds=(2,), boost_depths=(2, 3))


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return build_featured(spark, sf_dir)


@pytest.fixture(scope="module")
def supervised(rows):
    return train_and_evaluate(rows, spec=SPEC)


@pytest.fixture(scope="module")
def segments(rows):
    return segment(rows, ClusterSpec(search=(2, 3, 4)))


def test_reports_cover_both_models(supervised):
    metrics = {r.model: r for r in supervised.classifier_metrics.collect()}
    assert set(metrics) == {LOGISTIC, FOREST}
    n_test = supervised.prepared.test.count()
    for r in metrics.values():
        assert r.tp + r.tn + r.fp + r.fn == n_test
        assert 0.5 < r.auc <= 1
    assert {r.model for r in supervised.regressor_metrics.collect()} == {LINEAR, BOOSTED}
    assert all(r.r2_log > 0 for r in supervised.regressor_metrics.collect())


def test_tuning_tables(supervised):
    forest = supervised.classifier_tuning.collect()
    assert len(forest) == 2 and sum(r.best for r in forest) == 1
    assert max(forest, key=lambda r: r.avg_metric).best
    boosted = supervised.regressor_tuning.collect()
    assert len(boosted) == 2 and min(boosted, key=lambda r: r.avg_metric).best
    assert set(boosted[0].params) == {"maxIter", "maxDepth"}


def test_importances(supervised):
    for table, width in ((supervised.classifier_importance, "features_clf"), (supervised.regressor_importance, "features")):
        found = table.collect()
        assert len(found) == supervised.prepared.table.schema[width].metadata["ml_attr"]["num_attrs"]
        assert abs(sum(r.importance for r in found) - 1) < 1e-9
        assert [r.importance for r in found] == sorted((r.importance for r in found), reverse=True)


def test_per_campaign_results(supervised):
    out = supervised.classification_results
    assert out.filter("prob_success < 0 OR prob_success > 1 OR (prediction = 1) <> (prob_success > 0.5)").isEmpty()
    assert out.count() == supervised.prepared.test.count()
    assert supervised.regression_results.filter(F.abs(F.expm1("pledged_log_pred") - F.col("pledged_pred")) > 1e-6).isEmpty()


def test_levels_cover_every_label(supervised, rows):
    assert supervised.prepared.levels["category"] == rows.select("category").distinct().count() + 1


def test_bins_must_cover_the_levels():
    assert models.forest({"a": 200}).getMaxBins() == models.boosted({}).getMaxBins() == 256
    with pytest.raises(ValueError, match="b \\(300\\)"):
        models.forest({"a": 200, "b": 300})


def test_seeded_fits_repeat(rows):
    def importances():
        ready = prepare_splits(rows)
        model = models.forest(ready.levels).setNumTrees(3).setMaxDepth(2).fit(ready.train)
        return list(model.featureImportances.toArray())

    assert importances() == importances()


def test_engagement_can_be_switched_off(rows):
    features = FeatureSpec(engagement=())
    ready = prepare_splits(rows, features)
    assert "features_clf" not in ready.table.columns
    model = models.logistic(features, SPEC).fit(ready.train)
    assert model.numFeatures == ready.table.schema["features"].metadata["ml_attr"]["num_attrs"]


def test_withheld_columns_are_refused():
    with pytest.raises(ValueError, match="pledged"):
        FeatureSpec(continuous=("goal", "pledged"))


def test_segments(segments, rows):
    assert sum(r["size"] for r in segments.sizes.collect()) == rows.count()
    assert segments.centers.count() == 4 and segments.elbow.count() == 3
    value = segments.silhouette.first().silhouette
    assert -1 <= value <= 1
    means = {r.cluster: r for r in clustering.center_means(segments.enriched, ["goal"]).collect()}
    raw = {r.cluster: r for r in segments.raw_centers.collect()}
    assert all(abs(means[c].goal - raw[c].goal) < 0.02 * (1 + abs(raw[c].goal)) for c in means)


def test_export_publishes_every_table(spark, supervised, segments):
    large, small = result_tables(supervised, segments)
    folder = fresh_path(spark, "test-export")
    paths = export(supervised, segments, folder)
    assert len(paths) == len(large) + len(small) + 1 == 15
    back = read_published(spark, folder, "campaigns_enriched")
    assert back.schema.names == large["campaigns_enriched"].schema.names
    assert back.exceptAll(large["campaigns_enriched"]).isEmpty() and back.count() == large["campaigns_enriched"].count()
    where = {p.rsplit("/", 1)[1]: p.removeprefix("file:") for p in paths}
    assert len(glob.glob(f"{where['cluster_profiles']}/part-*")) == 1
    line = open(glob.glob(f"{where['dashboard_data']}/section=overview/part-*")[0]).readline()
    assert set(json.loads(line)) == {"item", "measure", "value"}
    assert all(r.intact for r in verify_published(spark, folder).collect())


JUNK = '9{0},"x",c,m,USD,2015-10-09,lots,2015-08-11 12:12:28,5.5,failed,3,US,5.5,5.5,1000.0'


def test_run_from_files_to_a_published_set(spark, sf_dir):
    source, folder = fresh_path(spark, "run-csv"), fresh_path(spark, "run-out")
    write_csv(campaigns(spark, sf_dir), source)
    lines = "\n".join([",".join(CAMPAIGN_SCHEMA.fieldNames()), *[JUNK.format(i) for i in range(3)]])
    with open(f"{source.removeprefix('file:')}/part-junk.csv", "w") as f:
        f.write(lines + "\n")
    small_search = ClusterSpec(search=(2, 3))
    paths = run(spark, source, folder, ModelSpec(max_iter=5, forest_trees=(2,), boost_rounds=(1,), boost_depths=(2,)), small_search)
    names = {p.rsplit("/", 1)[1] for p in paths}
    assert len(paths) == len(names) == 27
    assert {"shape_check", "null_profile", "stage_audit", "run_summary", "rejected_records", "dashboard_data", "campaigns_enriched"} <= names
    summary = read_published(spark, folder, "run_summary")
    assert summary.filter("section = 'rows' AND item = 'raw'").first()["value"] == 1503
    assert read_published(spark, folder, "shape_check").first()["n_rows"] == 1503
    rejected = read_published(spark, folder, "rejected_records").orderBy("ID").collect()
    assert [(r.ID, r.reason) for r in rejected] == [(90, "goal"), (91, "goal"), (92, "goal")]
    assert rejected[0].record == JUNK.format(0)
    audit = {r.stage: r.removed for r in read_published(spark, folder, "stage_audit").collect()}
    clean_rows = summary.filter("section = 'rows' AND item = 'clean'").first()["value"]
    assert 1503 - sum(audit.values()) == clean_rows == read_published(spark, folder, "campaigns_enriched").count()
    sections = {r.section for r in read_published(spark, folder, "dashboard_data").select("section").distinct().collect()}
    assert {"overview", "country", "month_category", "goal_vs_pledged", "clusters"} <= sections


def test_one_pass_dashboard_equals_its_parts(spark, segments):
    """Every section of the one aggregate against the report of its own, and one scan in the plan."""
    rows = segments.enriched
    whole = reports.whole_dashboard(rows, clustered=True)
    got = {(r.section, r.item, r.measure): r.value for r in whole.collect()}

    def shown(value):
        return "none" if value is None else str(value)

    want = {(r.section, r.item, r.measure): r.value for r in reports.dashboard(rows).collect()}
    for r in reports.success_by(rows, "launch_month", "main_category").collect():
        want |= {("month_category", f"{shown(r[0])}/{shown(r[1])}", m): float(r[m]) for m in ("campaigns", "success_rate")}
    for r in reports.goal_vs_pledged(rows).collect():
        want["goal_vs_pledged", "/".join(map(shown, (r.goal_bin, r.pledged_bin, r.state))), "campaigns"] = float(r.campaigns)
    for r in reports.cluster_dashboard(rows).collect():
        want |= {("clusters", "/".join(map(shown, r[:3])), m): float(r[m]) for m in ("campaigns", "avg_backers")}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - v) <= 1e-9 * max(1, abs(v)) for k, v in want.items())
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.count("Expand") == 1


def test_reports_ride_on_the_write(spark, sf_dir):
    """Observed reports equal those of the operators, and reading them starts no job that scans the table."""
    made = profile.stage_profiled(spark, lambda session: campaigns(session, sf_dir), "test-profile", profile.raw_measures)
    staged, found = made.read(spark), made.reports
    assert staged.count() == 1500 and staged.columns == CAMPAIGN_SCHEMA.fieldNames()
    got = {name: sorted(map(str, report.collect())) for name, report in found.items()}
    assert all("FileScan" not in r._jdf.queryExecution().executedPlan().toString() for r in found.values())
    own = {
        "shape_check": quality.shape_check(staged, None, staged.columns),
        "null_profile": quality.null_profile(staged, with_nan=True),
        "numeric_summary": quality.numeric_summary(staged, CampaignSpec().amounts),
        "stage_audit": quality.stage_audit(staged),
    }
    rounded = {"numeric_summary"}
    for name, report in own.items():
        if name in rounded:
            a = {r["column"]: r for r in found[name].collect()}
            for r in report.collect():
                assert all(abs(a[r["column"]][m] - r[m]) <= 1e-9 * max(1, abs(r[m])) for m in ("count", "mean", "stddev", "min", "max"))
        else:
            assert got[name] == sorted(map(str, report.collect()))


def test_settings_reach_the_session_apart(spark):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "17")
    try:
        other = profile.session_apart(spark)
        assert other.conf.get("spark.sql.files.maxRecordsPerFile") == "17"
        assert other.conf.get("spark.checkpoint.dir") == spark.conf.get("spark.checkpoint.dir")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")


def test_reports_of_an_empty_table(spark, sf_dir):
    made = profile.stage_profiled(spark, lambda session: campaigns(session, sf_dir).limit(0), "test-empty", profile.raw_measures)
    found = made.reports
    assert made.read(spark).isEmpty()
    assert found["shape_check"].first().n_rows == 0
    assert {(r.nulls, r.pct) for r in found["null_profile"].collect()} == {(0, None)}
    assert {r["mean"] for r in found["numeric_summary"].collect()} == {None}


def test_refreshed_years_equal_a_whole_run(spark, sf_dir, rows, segments):
    """One year is stale and another absent; both are made anew from the raw table, files of other years stay."""
    years = sorted(r[0] for r in rows.select("launched_year").distinct().collect())
    whole = refresh.enrich(rows, segments)
    assert whole.select("ID", "cluster").exceptAll(segments.enriched.select("ID", "cluster")).isEmpty()
    path = fresh_path(spark, "test-years")
    write_parquet(whole.filter((F.col("launched_year") != years[1]) & ((F.col("launched_year") != years[2]) | (F.col("ID") % 3 == 0))), path, ["launched_year"])
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path.removeprefix('file:')}/*/part-*")}
    raw = write_parquet(campaigns(spark, sf_dir).withColumnRenamed("usd pledged", "usd_pledged"), fresh_path(spark, "test-raw"))
    source = spark.read.parquet(raw)
    report = refresh.refresh_years(source, segments, path, [years[1], years[2]])
    counts = {r["launched_year"]: r["count"] for r in whole.groupBy("launched_year").count().collect()}
    assert {r.value: r.rows for r in report.collect()} == {y: counts[y] for y in years[1:3]}
    back = spark.read.schema(whole.schema).parquet(path).select(*whole.columns)
    assert back.exceptAll(whole).isEmpty() and whole.exceptAll(back).isEmpty()
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path.removeprefix('file:')}/*/part-*")}
    assert {f: t for f, t in before.items() if f"={years[2]}" not in f}.items() <= after.items()
    plan = source.filter(refresh.launched_in([1995, 1996]))._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(launched,1995)" in plan
    with pytest.raises(ValueError, match="years"):
        refresh.refresh_years(source, segments, path, [])


def test_run_summary_and_changes(spark, sf_dir, rows, supervised, segments):
    facts = run_summary(campaigns(spark, sf_dir), with_split(rows), supervised, segments, 42)
    found = {(r.section, r.item): r.value for r in facts.collect()}
    assert found["rows", "raw"] == 1500
    assert found["split", "train"] + found["split", "test"] == found["rows", "clean"]
    assert found["clusters", "k"] == 4
    classifier, regressor = model_changes(supervised, LOGISTIC, LINEAR)
    assert {r.model: r.accuracy_change for r in classifier.collect()}[LOGISTIC] == 0
    assert {r.model: r.r2_log_change for r in regressor.collect()}[LINEAR] == 0
