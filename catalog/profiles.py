"""Profiling and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixture import campaigns, featured, split_featured, with_campaigns
from catalog.registry import register, rounded
from pledgekit.functions.columns import rows_of
from pledgekit.operators import quality, ranking, reports, sketches
from pledgekit.plans import profile
from pledgekit.plans.campaigns import clean, featurise
from pledgekit.runtime import fresh_path, stage
from pledgekit.sources.tables import CAMPAIGN_SCHEMA, preview as first_rows
from pledgekit.spec import ENGINEERED, CampaignSpec, FeatureSpec

SPEC = CampaignSpec()
FEATURES = FeatureSpec()
RAW = CAMPAIGN_SCHEMA.fieldNames()
NUMERIC_FEATURES = tuple(c for c in ENGINEERED if c != "goal_bucket")
FLOATING = ("goal", "pledged", "usd pledged", "usd_pledged_real", "usd_goal_real")


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _nulls_sql(view: str, columns, nan: bool = False) -> str:
    parts = []
    for c in columns:
        nans = ""
        if nan:
            count = f'COUNT_IF(isnan("{c}"))' if c in FLOATING else "0"
            nans = f", CAST({count} AS BIGINT) AS nans"
        parts.append(
            f"""SELECT '{c}' AS "column", CAST(COUNT_IF("{c}" IS NULL) AS BIGINT) AS nulls,
                round(COUNT_IF("{c}" IS NULL) / COUNT(*) * 100, 6) AS pct{nans} FROM {view}"""
        )
    return with_campaigns() + _union(parts)


def _summary_sql(view: str, columns) -> str:
    parts = [
        f"""SELECT '{c}' AS "column", COUNT({c}) AS "count", round(AVG({c}), 6) AS mean,
            round(stddev_samp({c}), 6) AS stddev, round(CAST(MIN({c}) AS DOUBLE), 6) AS "min",
            round(CAST(MAX({c}) AS DOUBLE), 6) AS "max" FROM {view}"""
        for c in columns
    ]
    return with_campaigns() + _union(parts)


@register(
    "shape_check",
    with_campaigns()
    + """SELECT COUNT(*) AS n_rows, CAST(15 AS INT) AS n_cols,
         COUNT(*) = (SELECT COUNT(*) FROM orders) AS rows_ok, TRUE AS cols_ok FROM campaigns""",
)
def shape_check(spark, sf_dir):
    expected = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    return quality.shape_check(campaigns(spark, sf_dir), expected, RAW)


@register("null_profile", _nulls_sql("campaigns", RAW, nan=True))
def null_profile(spark, sf_dir):
    return rounded(quality.null_profile(campaigns(spark, sf_dir), with_nan=True), "pct")


@register("null_recheck", _nulls_sql("clean", SPEC.critical))
def null_recheck(spark, sf_dir):
    return rounded(quality.null_profile(clean(campaigns(spark, sf_dir)), SPEC.critical), "pct")


@register("feature_nulls", _nulls_sql("feat", ENGINEERED))
def feature_nulls(spark, sf_dir):
    return rounded(quality.null_profile(featured(spark, sf_dir), ENGINEERED), "pct")


@register("numeric_summary", _summary_sql("campaigns", SPEC.amounts))
def numeric_summary(spark, sf_dir):
    out = quality.numeric_summary(campaigns(spark, sf_dir), SPEC.amounts)
    return rounded(out, "mean", "stddev", "min", "max")


@register("feature_ranges", _summary_sql("feat", NUMERIC_FEATURES))
def feature_ranges(spark, sf_dir):
    out = quality.numeric_summary(featured(spark, sf_dir), NUMERIC_FEATURES)
    return rounded(out, "mean", "stddev", "min", "max")


RULES = {"launch_month": (1, 12), "launch_day_of_week": (1, 7), "campaign_duration_days": (1, 92), "funding_ratio": (0, 1)}


@register(
    "range_violations",
    with_campaigns()
    + _union(
        [
            f"""SELECT '{c}' AS "column", CAST({low} AS DOUBLE) AS low, CAST({high} AS DOUBLE) AS high,
                CAST(COUNT_IF({c} < {low}) AS BIGINT) AS below, CAST(COUNT_IF({c} > {high}) AS BIGINT) AS above
                FROM feat"""
            for c, (low, high) in RULES.items()
        ]
    ),
)
def range_violations(spark, sf_dir):
    return quality.range_violations(featured(spark, sf_dir), RULES)


@register(
    "value_counts",
    with_campaigns() + """SELECT state AS value, COUNT(*) AS "count" FROM campaigns GROUP BY state""",
)
def value_counts(spark, sf_dir):
    return quality.value_counts(campaigns(spark, sf_dir), "state")


@register(
    "bucket_counts",
    with_campaigns() + """SELECT goal_bucket AS value, COUNT(*) AS "count" FROM feat GROUP BY goal_bucket""",
)
def bucket_counts(spark, sf_dir):
    return quality.value_counts(featured(spark, sf_dir), "goal_bucket")


@register(
    "overfunded_counts",
    with_campaigns() + """SELECT is_overfunded AS value, COUNT(*) AS "count" FROM feat GROUP BY is_overfunded""",
)
def overfunded_counts(spark, sf_dir):
    return quality.value_counts(featured(spark, sf_dir), "is_overfunded", ascending_values=True)


@register(
    "duplicate_keys",
    """SELECT CAST(SUM(n) AS BIGINT) AS n_rows, COUNT(*) AS distinct_keys,
       CAST(SUM(n - 1) AS BIGINT) AS duplicates, CAST(COUNT_IF(n > 1) AS BIGINT) AS repeated_keys,
       CAST(MAX(n) AS BIGINT) AS max_copies
       FROM (SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey)""",
)
def duplicate_keys(spark, sf_dir):
    """Over the line items, whose order key does repeat."""
    return quality.duplicate_keys(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), "l_orderkey")


@register(
    "duplicate_campaigns",
    with_campaigns()
    + """SELECT CAST(SUM(n) AS BIGINT) AS n_rows, COUNT(*) AS distinct_keys,
         CAST(SUM(n - 1) AS BIGINT) AS duplicates, CAST(COUNT_IF(n > 1) AS BIGINT) AS repeated_keys,
         CAST(MAX(n) AS BIGINT) AS max_copies
         FROM (SELECT "ID", COUNT(*) AS n FROM campaigns GROUP BY "ID")""",
)
def duplicate_campaigns(spark, sf_dir):
    return quality.duplicate_keys(campaigns(spark, sf_dir), "ID")


@register(
    "stage_audit",
    with_campaigns(
        """counts AS (SELECT (SELECT COUNT(*) FROM campaigns) AS c0, (SELECT COUNT(*) FROM kept) AS c1,
           (SELECT COUNT(*) FROM complete) AS c2, (SELECT COUNT(*) FROM clean) AS c3)"""
    )
    + _union(
        [
            f"""SELECT CAST({i} AS INT) AS step, '{name}' AS stage, c{i - 1} AS "before", c{i} AS "after",
                c{i - 1} - c{i} AS removed, round((c{i - 1} - c{i}) / c{i - 1} * 100, 6) AS pct FROM counts"""
            for i, name in enumerate(("final_state", "complete", "dated"), 1)
        ]
    ),
)
def stage_audit(spark, sf_dir):
    return rounded(quality.stage_audit(campaigns(spark, sf_dir)), "pct")


@register(
    "class_balance",
    with_campaigns(
        """counted AS (SELECT split, label, COUNT(*) AS n FROM parts GROUP BY split, label
           UNION ALL SELECT 'all', label, COUNT(*) FROM parts GROUP BY label)"""
    )
    + """SELECT split, label, n AS "count", round(n / SUM(n) OVER (PARTITION BY split) * 100, 6) AS pct
         FROM counted""",
)
def class_balance(spark, sf_dir):
    return rounded(quality.class_balance(split_featured(spark, sf_dir), split="split"), "pct")


QUARTILES = (0.25, 0.75)
SKETCH_ERROR = 0.01


def _within(rows, found):
    """Which sketched quantiles (column, probability, value) have a rank within the error bound, counted over ``rows``."""
    n = F.count(F.lit(1))
    flags = [
        {
            "column": F.lit(c),
            "probability": F.lit(p),
            "within_error": (F.count_if(F.col(c) < v) <= (p + SKETCH_ERROR) * n)
            & (F.count_if(F.col(c) <= v) >= (p - SKETCH_ERROR) * n),
        }
        for c, p, v in found
    ]
    sums = rows.agg(*[f["within_error"].alias(f"_{i}") for i, f in enumerate(flags)])
    return sums.select(F.inline(rows_of([f | {"within_error": F.col(f"_{i}")} for i, f in enumerate(flags)])))


QUARTILES_SQL = _union(
    [
        f"""SELECT '{c}' AS "column", CAST({p} AS DOUBLE) AS probability, TRUE AS within_error"""
        for c in SPEC.amounts
        for p in QUARTILES
    ]
)


@register("approx_quantiles", QUARTILES_SQL)
def approx_quantiles(spark, sf_dir):
    """The sketched quartiles, each with its rank checked against the bound."""
    rows = stage(featured(spark, sf_dir).select(*SPEC.amounts), "quantile-input")
    found = quality.quantiles(rows, SPEC.amounts, QUARTILES, SKETCH_ERROR).collect()
    return _within(rows, [(r["column"], r["probability"], r["value"]) for r in found])


@register(
    "merged_quantiles",
    with_campaigns()
    + _union(
        [
            f"""SELECT '{c}' AS "column", CAST({p} AS DOUBLE) AS probability, TRUE AS within_error, COUNT({c}) AS n, TRUE AS same_sketches
                FROM feat"""
            for c in SPEC.amounts
            for p in QUARTILES
        ]
    ),
)
def merged_quantiles(spark, sf_dir):
    """Quartiles merged from one sketch per launch year, the last year's added to those of the others."""
    rows = stage(featured(spark, sf_dir).select("launched_year", *SPEC.amounts), "sketch-input")
    path = fresh_path(spark, "sketches")
    last = rows.agg(F.max("launched_year")).first()[0]
    for part in (rows.filter(F.col("launched_year") < last), rows.filter(F.col("launched_year") == last)):
        made = sketches.quantile_sketches(part, SPEC.amounts, "launched_year", SKETCH_ERROR)
        sketches.write_sketches(made, path, "launched_year")
    kept = spark.read.schema(made.schema).parquet(path)
    found = sketches.merged_quantiles(kept, QUARTILES).collect()
    years = rows.select("launched_year").distinct().count()
    per = kept.groupBy("column").agg(F.sum("n").alias("n"), (F.count(F.lit(1)) == years).alias("same_sketches"))
    return _within(rows, [(r["column"], r["probability"], r["value"]) for r in found]).join(per, "column")


def _long_sql(report: str, item: str, measures: tuple[str, ...], sql: str) -> str:
    body = sql.removeprefix(with_campaigns())
    return _union(
        [
            f"""SELECT '{report}' AS report, CAST("{item}" AS VARCHAR) AS item, '{m}' AS measure, CAST("{m}" AS DOUBLE) AS value
                FROM ({body}) AS {report}"""
            for m in measures
        ]
    )


SUMMARY = ("count", "mean", "stddev", "min", "max")


@register(
    "profile_on_write",
    with_campaigns(
        """counts AS (SELECT (SELECT COUNT(*) FROM campaigns) AS c0, (SELECT COUNT(*) FROM kept) AS c1,
           (SELECT COUNT(*) FROM complete) AS c2, (SELECT COUNT(*) FROM clean) AS c3)"""
    )
    + _union(
        [
            "SELECT 'shape_check' AS report, CAST(COUNT(*) AS VARCHAR) AS item, 'n_cols' AS measure, CAST(15 AS DOUBLE) AS value FROM campaigns",
            _long_sql("null_profile", "column", ("nulls", "pct", "nans"), _nulls_sql("campaigns", RAW, nan=True)),
            _long_sql("numeric_summary", "column", SUMMARY, _summary_sql("campaigns", SPEC.amounts)),
            _long_sql("feature_nulls", "column", ("nulls", "pct"), _nulls_sql("feat", ENGINEERED)),
            _long_sql("feature_ranges", "column", SUMMARY, _summary_sql("feat", NUMERIC_FEATURES)),
            *[
                f"SELECT 'stage_audit', '{i}', '{m}', round(CAST({v} AS DOUBLE), 6) FROM counts"
                for i in (1, 2, 3)
                for m, v in (
                    ("before", f"c{i - 1}"),
                    ("after", f"c{i}"),
                    ("removed", f"c{i - 1} - c{i}"),
                    ("pct", f"(c{i - 1} - c{i}) / c{i - 1} * 100"),
                )
            ],
        ]
    ),
)
def profile_on_write(spark, sf_dir):
    """All reports that ride on the writes of the raw and the featured table, in long form."""
    raw = profile.stage_profiled(spark, lambda session: campaigns(session, sf_dir), "profile-raw", profile.raw_measures)
    derived = profile.stage_profiled(
        spark, lambda session: raw.read(session).transform(clean).transform(featurise), "profile-featured", profile.feature_measures
    )
    parts = [profile.long_report(name, report) for name, report in (raw.reports | derived.reports).items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return rounded(out, "value")


POINTS = (0.25, 0.5, 0.75)


@register(
    "exact_quantiles",
    with_campaigns()
    + _union(
        [
            f"""SELECT '{c}' AS "column", CAST({p} AS DOUBLE) AS probability,
                round(quantile_cont(CAST({c} AS DOUBLE), {p}), 6) AS value FROM feat"""
            for c in SPEC.amounts
            for p in POINTS
        ]
    ),
)
def exact_quantiles(spark, sf_dir):
    return rounded(ranking.exact_quantiles(featured(spark, sf_dir), SPEC.amounts, POINTS), "value")


@register(
    "iqr_outliers",
    with_campaigns()
    + _union(
        [
            f"""SELECT '{c}' AS "column", round(q1, 6) AS q1, round(q3, 6) AS q3,
                round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper,
                CAST(COUNT_IF({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS outliers,
                round(COUNT_IF({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) / COUNT(*) * 100, 6) AS pct
                FROM feat, (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1,
                                   quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM feat)
                GROUP BY q1, q3"""
            for c in SPEC.amounts
        ]
    ),
)
def iqr_outliers(spark, sf_dir):
    out = quality.iqr_outliers(featured(spark, sf_dir), SPEC.amounts, relative_error=0)
    return rounded(out, "q1", "q3", "lower", "upper", "pct")


@register("iqr_outliers_sketch", QUARTILES_SQL.replace("AS within_error", "AS within_error, TRUE AS counts_agree"))
def iqr_outliers_sketch(spark, sf_dir):
    """Outliers by sketched quartiles: ranks within the bound, and the counts as the reported bounds give them."""
    rows = stage(featured(spark, sf_dir).select(*SPEC.amounts), "outlier-input")
    found = quality.iqr_outliers(rows, SPEC.amounts, relative_error=SKETCH_ERROR).collect()
    quartiles = [(r["column"], p, r[q]) for r in found for p, q in zip(QUARTILES, ("q1", "q3"))]
    outside = rows.agg(
        *[F.count_if((F.col(r["column"]) < r["lower"]) | (F.col(r["column"]) > r["upper"])).alias(f"_{i}") for i, r in enumerate(found)]
    )
    agree = outside.select(
        F.inline(
            rows_of(
                [{"column": F.lit(r["column"]), "counts_agree": F.col(f"_{i}") == r["outliers"]} for i, r in enumerate(found)]
            )
        )
    )
    return _within(rows, quartiles).join(agree, "column")


def _correlation_sql(log_ratio: bool = False) -> str:
    texts = {name: text.replace("log1p(", "ln(1 + ") for name, text in reports.CORRELATED.items()}
    if log_ratio:
        texts["Funding ratio"] = "ln(1 + funding_ratio)"
    parts = []
    for x, a in texts.items():
        for y, b in texts.items():
            value = "CAST(1 AS DOUBLE) AS corr" if x == y else f"round(corr({a}, {b}), 3) AS corr FROM feat"
            parts.append(f"SELECT '{x}' AS feature_x, '{y}' AS feature_y, {value}")
    return with_campaigns() + _union(parts)


@register("correlation_matrix", _correlation_sql())
def correlation_matrix(spark, sf_dir):
    return quality.correlation_matrix(featured(spark, sf_dir), reports.correlated_features())


@register("correlation_matrix_log_ratio", _correlation_sql(True))
def correlation_matrix_log_ratio(spark, sf_dir):
    return quality.correlation_matrix(featured(spark, sf_dir), reports.correlated_features(True))


CANDIDATES = (
    "goal",
    "usd_goal_real",
    "campaign_duration_days",
    "backers",
    "launch_month",
    "launch_day_of_week",
    "pledged",
    "usd_pledged_real",
    "funding_ratio",
    "is_overfunded",
)


def _used_by() -> dict[str, str]:
    used = {c: "both" for c in FEATURES.inputs}
    used.update({c: "classifier" for c in FEATURES.engagement})
    return used


@register(
    "leakage_screen",
    with_campaigns()
    + _union(
        [
            f"""SELECT '{c}' AS feature, round(corr({c}, label), 6) AS corr,
                {c in FEATURES.withheld} AS excluded, '{_used_by().get(c, "none")}' AS used_by,
                {"'withheld'" if c in FEATURES.withheld else f"CASE WHEN abs(corr({c}, label)) > 0.5 THEN 'leaks' ELSE 'ok' END"} AS flag
                FROM feat"""
            for c in CANDIDATES
        ]
    ),
)
def leakage_screen(spark, sf_dir):
    out = quality.leakage_screen(
        featured(spark, sf_dir), CANDIDATES, FEATURES.label, FEATURES.withheld, _used_by()
    )
    return rounded(out, "corr")


@register(
    "preview",
    with_campaigns()
    + 'SELECT "ID", name, category, goal, state FROM campaigns ORDER BY "ID" LIMIT 5',
)
def preview(spark, sf_dir):
    return first_rows(campaigns(spark, sf_dir), "ID", 5, ["ID", "name", "category", "goal", "state"])
