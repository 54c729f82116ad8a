"""Feature encoding: Spark ML stages against SQL, slot by slot."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog.fixture import featured, split_featured, with_campaigns
from catalog.registry import register, rounded
from pledgekit.operators import encoding
from pledgekit.runtime import stage
from pledgekit.spec import ClusterSpec, FeatureSpec

FEATURES = FeatureSpec()
CLUSTERS = ClusterSpec()
INDEXED = FEATURES.indexed
NUMERIC = FEATURES.continuous + FEATURES.engagement
# Slots after one-hot encoding: 5 observed levels and one for unknown values, months 0-12, weekdays 0-7.
HOT_WIDTHS = {"main_category": 6, "goal_bucket": 6, "launch_month": 13, "launch_day_of_week": 8}


def labels_sql(view: str, columns=INDEXED, prefix: str = "idx") -> list[str]:
    """One subquery per column: value, count, index by descending frequency then value."""
    return [
        f"""{prefix}_{c} AS (SELECT {c} AS v, COUNT(*) AS n,
            row_number() OVER (ORDER BY COUNT(*) DESC, {c}) - 1 AS idx
            FROM {view} WHERE {c} IS NOT NULL GROUP BY {c})"""
        for c in columns
    ]


def indexed_sql(rows: str, columns=INDEXED, prefix: str = "idx", name: str = "indexed") -> str:
    joins = " ".join(f"LEFT JOIN {prefix}_{c} ON {rows}.{c} = {prefix}_{c}.v" for c in columns)
    picks = ", ".join(
        f"CAST(COALESCE({prefix}_{c}.idx, (SELECT COUNT(*) FROM {prefix}_{c})) AS DOUBLE) AS {c}_idx"
        for c in columns
    )
    return f"{name} AS (SELECT {rows}.*, {picks} FROM {rows} {joins})"


@register(
    "string_index",
    with_campaigns(*labels_sql("feat"), indexed_sql("feat"))
    + f"""SELECT "ID", {", ".join(f"{c}_idx" for c in INDEXED)} FROM indexed""",
)
def string_index(spark, sf_dir):
    """Indexer fitted in one pass for all five columns, over a staged table."""
    rows = stage(featured(spark, sf_dir).select("ID", *INDEXED), "index-input")
    model = encoding.string_indexer(INDEXED).fit(rows)
    return model.transform(rows).select("ID", *[f"{c}_idx" for c in INDEXED])


@register(
    "string_index_labels",
    with_campaigns(*labels_sql("feat"))
    + "\nUNION ALL\n".join(f"""SELECT '{c}' AS "column", v AS value, n, idx FROM idx_{c}""" for c in INDEXED),
)
def string_index_labels(spark, sf_dir):
    return encoding.fit_labels(featured(spark, sf_dir), INDEXED)


@register(
    "string_index_lookup",
    with_campaigns(*labels_sql("train_rows"), indexed_sql("parts")).replace(
        "idx_category AS", "train_rows AS (SELECT * FROM parts WHERE split = 'train'),\nidx_category AS", 1
    )
    + f"""SELECT "ID", split, {", ".join(f"{c}_idx" for c in INDEXED)} FROM indexed""",
)
def string_index_lookup(spark, sf_dir):
    """Labels of the training rows looked up for all rows, without Spark ML."""
    rows = split_featured(spark, sf_dir).select("ID", "split", *INDEXED)
    labels = encoding.fit_labels(rows.filter(F.col("split") == "train"), INDEXED)
    return encoding.apply_labels(rows, labels, INDEXED).select("ID", "split", *[f"{c}_idx" for c in INDEXED])


def _hot_sql() -> str:
    picks = []
    for c, width in HOT_WIDTHS.items():
        source = f"{c}_idx" if c in INDEXED else c
        picks += [f"CAST({source} = {i} AS INT) AS {c}_{i}" for i in range(width)]
    return f"""SELECT "ID", {", ".join(picks)} FROM indexed"""


@register("one_hot", with_campaigns(*labels_sql("feat"), indexed_sql("feat")) + _hot_sql())
def one_hot(spark, sf_dir):
    rows = encoding.declare_domains(featured(spark, sf_dir)).select("ID", *HOT_WIDTHS)
    rows = encoding.string_indexer(FEATURES.low_card).fit(rows).transform(rows)
    inputs = [f"{c}_idx" if c in INDEXED else c for c in HOT_WIDTHS]
    outputs = [f"{c}_ohe" for c in HOT_WIDTHS]
    encoded = encoding.one_hot_encoder(inputs, outputs).fit(rows).transform(rows)
    arrays = encoded.select("ID", *[vector_to_array(o).alias(o) for o in outputs])
    return arrays.select(
        "ID",
        *[F.get(f"{c}_ohe", F.lit(i)).cast("int").alias(f"{c}_{i}") for c, w in HOT_WIDTHS.items() for i in range(w)],
    )


@register(
    "one_hot_columns",
    with_campaigns(*labels_sql("feat"), indexed_sql("feat"))
    + f"""SELECT "ID", {", ".join(f"CAST(goal_bucket_idx = {i} AS DOUBLE) AS bucket_{i}" for i in range(6))} FROM indexed""",
)
def one_hot_columns(spark, sf_dir):
    """Indicator columns without vectors."""
    rows = featured(spark, sf_dir).select("ID", "goal_bucket")
    indexed = encoding.apply_labels(rows, encoding.fit_labels(rows, ["goal_bucket"]), ["goal_bucket"])
    return indexed.select("ID", *encoding.one_hot_columns(F.col("goal_bucket_idx"), 6, "bucket"))


@register(
    "assemble",
    with_campaigns()
    + f"""SELECT "ID", {", ".join(f"round(CAST({c} AS DOUBLE), 6) AS v{i}" for i, c in enumerate(NUMERIC))} FROM feat""",
)
def assemble(spark, sf_dir):
    rows = encoding.assembler(NUMERIC, "vec").transform(featured(spark, sf_dir))
    slots = vector_to_array("vec")
    names = [f"v{i}" for i in range(len(NUMERIC))]
    return rounded(rows.select("ID", *[slots[i].alias(n) for i, n in enumerate(names)]), *names)


def scaled_sql(view: str, columns, fit_on: str | None = None) -> str:
    fit_on = fit_on or view
    stats = ", ".join(f"AVG({c}) AS m{i}, stddev_samp({c}) AS s{i}" for i, c in enumerate(columns))
    picks = ", ".join(f"({c} - m{i}) / s{i} AS z{i}" for i, c in enumerate(columns))
    return f"scaled AS (SELECT {view}.*, {picks} FROM {view}, (SELECT {stats} FROM {fit_on}) AS st)"


@register(
    "standard_scale",
    with_campaigns(scaled_sql("feat", NUMERIC))
    + f"""SELECT "ID", {", ".join(f"round(z{i}, 6) AS {c}_scaled" for i, c in enumerate(NUMERIC))} FROM scaled""",
)
def standard_scale(spark, sf_dir):
    names = [f"{c}_scaled" for c in NUMERIC]
    return rounded(encoding.standardise(featured(spark, sf_dir), NUMERIC).select("ID", *names), *names)


@register(
    "cluster_prep",
    with_campaigns(scaled_sql("feat", CLUSTERS.features))
    + f"""SELECT "ID", {", ".join(f"round(z{i}, 6) AS s{i}" for i in range(len(CLUSTERS.features)))} FROM scaled""",
)
def cluster_prep(spark, sf_dir):
    rows = featured(spark, sf_dir).select("ID", *CLUSTERS.features)
    prepared = encoding.cluster_preparation().fit(rows).transform(rows)
    slots = vector_to_array("features")
    names = [f"s{i}" for i in range(len(CLUSTERS.features))]
    return rounded(prepared.select("ID", *[slots[i].alias(n) for i, n in enumerate(names)]), *names)


def staged_splits(spark, sf_dir):
    """Model inputs written once: labels, moments and encoding each read them."""
    columns = ["ID", *FEATURES.inputs, *FEATURES.engagement, "split"]
    return stage(split_featured(spark, sf_dir).select(*columns), "featured", ["split"])


TRAIN_ROWS = "train_rows AS (SELECT * FROM parts WHERE split = 'train')"


@register(
    "prep_pipeline",
    with_campaigns(
        TRAIN_ROWS, *labels_sql("train_rows"), indexed_sql("parts"), scaled_sql("indexed", NUMERIC, "train_rows")
    )
    + f"""SELECT "ID", split,
          CAST({len(NUMERIC) + 3 + 21} + (SELECT COUNT(*) FROM idx_main_category) + 1
               + (SELECT COUNT(*) FROM idx_goal_bucket) + 1 AS INT) AS n_slots,
          {", ".join(f"round(z{i}, 6) AS {c}_scaled" for i, c in enumerate(NUMERIC))},
          CAST(main_category_idx AS INT) AS main_category_slot, CAST(goal_bucket_idx AS INT) AS goal_bucket_slot,
          launch_month AS launch_month_slot, launch_day_of_week AS launch_day_of_week_slot,
          category_idx, currency_idx, country_idx FROM scaled""",
)
def prep_pipeline(spark, sf_dir):
    """The fitted preparation taken apart again: every statistic comes from the training rows."""
    rows = staged_splits(spark, sf_dir)
    model = encoding.fit_preparation(rows.filter(F.col("split") == "train"))
    prepared = encoding.prepare(rows, model)
    attrs = prepared.schema["features_clf"].metadata["ml_attr"]
    names = [n for _, n in sorted((a["idx"], a["name"]) for g in attrs["attrs"].values() for a in g)]

    def hot(column: str):
        at = [i for i, n in enumerate(names) if n.startswith(f"features_{column}_ohe_")]
        return (F.array_position(F.slice("v", at[0] + 1, len(at)), 1.0) - 1).cast("int")

    def slot(name: str):
        return F.col("v")[names.index(name)]

    scaled = [slot(f"features_cont_scaled_{i}") for i in range(3)] + [slot("engagement_scaled_0")]
    out = prepared.withColumn("v", vector_to_array("features_clf")).select(
        "ID",
        "split",
        F.size("v").alias("n_slots"),
        *[s.alias(f"{c}_scaled") for c, s in zip(NUMERIC, scaled)],
        *[hot(c).alias(f"{c}_slot") for c in HOT_WIDTHS],
        *[slot(f"features_{c}_idx").alias(f"{c}_idx") for c in FEATURES.high_card],
    )
    return rounded(out, *[f"{c}_scaled" for c in NUMERIC])


def slots_sql() -> str:
    """Slot names in vector order: (kind order, position, name)."""
    parts = [f"SELECT 0 AS g, {i} AS p, 'cont_scaled_{i}' AS name" for i in range(3)]
    for g, c in enumerate(FEATURES.low_card, 1):
        parts.append(f"SELECT {g}, idx, '{c}_ohe_' || v FROM idx_{c}")
        parts.append(f"SELECT {g}, (SELECT COUNT(*) FROM idx_{c}), '{c}_ohe___unknown'")
    for g, (c, levels) in enumerate(FEATURES.temporal, 3):
        parts += [f"SELECT {g}, {i}, '{c}_ohe_{i}'" for i in range(levels)]
    parts += [f"SELECT 5, {i}, '{c}_idx'" for i, c in enumerate(FEATURES.high_card)]
    return "names AS (" + "\nUNION ALL\n".join(parts) + ")"


@register(
    "slot_names",
    with_campaigns(TRAIN_ROWS, *labels_sql("train_rows", FEATURES.low_card), slots_sql())
    + "SELECT CAST(row_number() OVER (ORDER BY g, p) - 1 AS INT) AS slot, name FROM names",
)
def slot_names(spark, sf_dir):
    rows = staged_splits(spark, sf_dir)
    model = encoding.fit_preparation(rows.filter(F.col("split") == "train"))
    return encoding.slot_names(encoding.prepare(rows, model), "features")


SERIAL = FeatureSpec(high_card=("serial",))


@register(
    "prep_many_labels",
    with_campaigns(
        """serials AS (SELECT *, CASE WHEN "ID" % 10 = 0 THEN 'hot' ELSE concat('S', "ID" % 100003) END AS serial FROM parts)""",
        "train_rows AS (SELECT * FROM serials WHERE split = 'train')",
        *labels_sql("train_rows", SERIAL.indexed),
        indexed_sql("serials", SERIAL.indexed),
    )
    + """SELECT "ID", split, serial, serial_idx, (SELECT COUNT(*) FROM idx_serial) + 1 AS serial_levels,
         CAST(main_category_idx AS INT) AS main_category_slot FROM indexed""",
)
def prep_many_labels(spark, sf_dir):
    """The preparation over a column with nearly as many labels as rows, one label on a tenth of them."""
    serial = F.when(F.col("ID") % 10 == 0, "hot").otherwise(F.concat(F.lit("S"), F.col("ID") % 100003))
    columns = ["ID", *[c for c in SERIAL.inputs if c != "serial"], *SERIAL.engagement, "split"]
    rows = stage(split_featured(spark, sf_dir).select(*columns, serial.alias("serial")), "serials")
    model = encoding.fit_preparation(rows.filter(F.col("split") == "train"), SERIAL)
    prepared = encoding.prepare(rows, model, SERIAL)
    attrs = prepared.schema["features"].metadata["ml_attr"]["attrs"]
    at = {a["name"]: a["idx"] for group in attrs.values() for a in group}
    levels = [a["num_vals"] for a in attrs["nominal"] if a["name"] == "serial_idx"][0]
    hot = [i for name, i in sorted(at.items(), key=lambda x: x[1]) if name.startswith("main_category_ohe_")]
    out = prepared.withColumn("v", vector_to_array("features"))
    return out.select(
        "ID",
        "split",
        "serial",
        F.col("v")[at["serial_idx"]].alias("serial_idx"),
        F.lit(levels).cast("bigint").alias("serial_levels"),
        (F.array_position(F.slice("v", hot[0] + 1, len(hot)), 1.0) - 1).cast("int").alias("main_category_slot"),
    )
