"""Feature encoding: Spark ML stages for the models, and the same encodings as plain aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pledgekit.functions.columns import quoted
from pledgekit.operators.lookups import row_hash, spread_lookup
from pledgekit.operators.ranking import number_rows
from pledgekit.runtime import fresh_path, require_columns
from pledgekit.sources.tables import small_table
from pledgekit.spec import ClusterSpec, FeatureSpec

LABELS = "column string, value string, n bigint, idx bigint"


def label_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column, all columns in one pass: (column, value, n). Nulls are left out."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.inline(entries))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def fit_labels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Index every label by descending frequency, ties by value: (column, value, n, idx).

    Runs once, like the fit of an indexer, and is written to the shared folder by column. Labels are numbered by a
    range-partitioned sort, so a column of near-unique values does not end up in one task, nor on the driver.
    """
    return read_labels(df, _write_labels(df, columns))


def read_labels(df: DataFrame, path: str) -> DataFrame:
    return df.sparkSession.read.schema(LABELS).parquet(path).select("column", "value", "n", "idx")


def _write_labels(df: DataFrame, columns: Sequence[str]) -> str:
    numbered = number_rows(label_counts(df, columns), [F.col("column"), F.desc("n"), F.col("value")], "_at")
    # Size bound of the broadcast: one row per indexed column.
    firsts = numbered.groupBy("column").agg(F.min("_at").alias("_first"))
    labels = numbered.join(F.broadcast(firsts), "column").select(
        "value", "n", (F.col("_at") - F.col("_first")).alias("idx"), "column"
    )
    path = fresh_path(df.sparkSession, "labels")
    labels.write.partitionBy("column").parquet(path)
    return path


def label_sizes(labels: DataFrame) -> dict[str, tuple[int, int]]:
    """Labels and rows of each column; one row per column reaches the driver."""
    per = labels.groupBy("column").agg(F.count(F.lit(1)).alias("levels"), F.sum("n").alias("rows"))
    return {r["column"]: (r["levels"], r["rows"]) for r in per.collect()}


def apply_labels(
    df: DataFrame, labels: DataFrame, columns: Sequence[str], sizes: dict[str, tuple[int, int]] | None = None
) -> DataFrame:
    """Add ``<column>_idx``; null and unseen values share the slot after the last label.

    Hot labels are broadcast (their number is bounded), rows of other labels are joined by shuffle unless
    Spark sees that the label table is small, and rows without a label are dealt evenly.
    """
    sizes = label_sizes(labels) if sizes is None else sizes
    out = df
    for c in columns:
        levels, rows = sizes.get(c, (0, 0))
        own = labels.filter(F.col("column") == c).select("value", "n", F.col("idx").alias("_idx"))
        found = spread_lookup(out, quoted(c).cast("string"), own, "value", "n", row_hash(df), ("_idx",), rows)
        out = found.withColumn(f"{c}_idx", F.coalesce("_idx", F.lit(levels)).cast("double")).drop("_idx")
    return out


class TableIndexer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Indexes text columns of any number of labels: ``StringIndexer`` under ``keep``, without its driver-side labels.

    The fit writes the label table (``fit_labels``, one pass for all columns). The model looks labels up by joins and
    puts the number of levels into the column's metadata. ``namedCols`` also put their labels there, for the names of
    one-hot slots; a vector has a slot for each of these anyway.
    """

    namedCols = Param(Params._dummy(), "namedCols", "columns whose labels name slots", TypeConverters.toListString)

    def __init__(self, columns: Sequence[str] = (), named: Sequence[str] = ()):
        super().__init__()
        self._set(inputCols=list(columns), namedCols=list(named))

    def _fit(self, dataset: DataFrame) -> TableIndexerModel:
        columns = self.getInputCols()
        path = _write_labels(dataset, columns)
        sizes = label_sizes(read_labels(dataset, path))
        levels, rows = zip(*[sizes.get(c, (0, 0)) for c in columns], strict=True) if columns else ((), ())
        return self._copyValues(TableIndexerModel(path, levels, rows))


class TableIndexerModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``<column>_idx`` from a written label table. It names the table by path, so keep that as long as the model."""

    namedCols = TableIndexer.namedCols
    labelsPath = Param(Params._dummy(), "labelsPath", "written label table", TypeConverters.toString)
    levels = Param(Params._dummy(), "levels", "labels per column", TypeConverters.toListInt)
    rows = Param(Params._dummy(), "rows", "labelled rows per column", TypeConverters.toListInt)

    def __init__(self, path: str = "", levels: Sequence[int] = (), rows: Sequence[int] = ()):
        super().__init__()
        self._set(labelsPath=path, levels=list(levels), rows=list(rows))

    def sizes(self) -> dict[str, tuple[int, int]]:
        both = zip(self.getOrDefault("levels"), self.getOrDefault("rows"), strict=True)
        return dict(zip(self.getInputCols(), both, strict=True))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        named, sizes = self.getOrDefault("namedCols"), self.sizes()
        labels = read_labels(dataset, self.getOrDefault("labelsPath"))
        plain = [c for c in self.getInputCols() if c not in named]
        out = apply_labels(dataset, labels, plain, sizes)
        for c in plain:
            out = out.withMetadata(f"{c}_idx", {"ml_attr": {"type": "nominal", "num_vals": sizes[c][0] + 1}})
        ordered = labels.filter(F.col("column").isin(*named)).orderBy("idx").select("column", "value").collect()
        for c in named:
            values = [r.value for r in ordered if r["column"] == c]
            out = StringIndexerModel.from_labels(values, c, f"{c}_idx", "keep").transform(out)
        return out


def string_indexer(columns: Sequence[str]) -> StringIndexer:
    """One estimator, hence one pass, for all columns."""
    return StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_idx" for c in columns], handleInvalid="keep"
    )


def one_hot_encoder(columns: Sequence[str], outputs: Sequence[str], drop_last: bool = True) -> OneHotEncoder:
    """Under ``keep``, ``drop_last`` drops the slot of invalid values; every real level keeps its own."""
    return OneHotEncoder(
        inputCols=list(columns), outputCols=list(outputs), dropLast=drop_last, handleInvalid="keep"
    )


def one_hot_columns(index: Column, width: int, prefix: str) -> list[Column]:
    """Indicator columns ``<prefix>_0 ..``; an index at or past ``width`` sets none of them."""
    return [F.when(index == i, 1.0).otherwise(0.0).alias(f"{prefix}_{i}") for i in range(width)]


def standardise(
    df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None, suffix: str = "_scaled"
) -> DataFrame:
    """Add (x - mean) / sample deviation per column; a constant column becomes 0.

    The statistics are one aggregate over ``fit_on`` (default ``df``), read as a single-row subquery.
    """
    require_columns(df, columns)
    source = df if fit_on is None else fit_on
    stats = source.agg(
        F.struct(
            *[F.avg(quoted(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)],
            *[F.stddev_samp(quoted(c).cast("double")).alias(f"s{i}") for i, c in enumerate(columns)],
        ).alias("s")
    )
    scaled = {}
    for i, c in enumerate(columns):
        mean, dev = F.col(f"_stats.m{i}"), F.col(f"_stats.s{i}")
        scaled[f"{c}{suffix}"] = F.when(dev > 0, (quoted(c) - mean) / dev).when(
            quoted(c).isNotNull(), F.lit(0.0)
        )
    return df.withColumn("_stats", stats.scalar()).withColumns(scaled).drop("_stats")


def assembler(columns: Sequence[str], output: str) -> VectorAssembler:
    """Null inputs become NaN slots, so clean before scaling."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="keep")


def scaler(column: str, output: str) -> StandardScaler:
    return StandardScaler(inputCol=column, outputCol=output, withMean=True, withStd=True)


def declare_domains(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """Attach the number of levels of each calendar column, which spares the encoder a pass."""
    out = df
    for c, levels in spec.temporal:
        size = levels - 1 if spec.compact_temporal else levels
        if spec.compact_temporal:
            out = out.withColumn(c, quoted(c) - 1)
        out = out.withMetadata(c, {"ml_attr": {"type": "nominal", "num_vals": size}})
    return out


def preparation(spec: FeatureSpec = FeatureSpec()) -> Pipeline:
    """Stages producing ``features`` (launch-time columns) and ``features_clf`` (plus engagement).

    Fitting takes two passes, one for all means and deviations and one for all labels: continuous and engagement
    columns are scaled together and then sliced apart, before any label is looked up.
    """
    one_hot = list(spec.low_card)
    plain = list(spec.high_card)
    if spec.high_card_encoding == "onehot":
        one_hot, plain = plain + one_hot, []
    hot_inputs = [f"{c}_idx" for c in one_hot] + [c for c, _ in spec.temporal]
    hot_outputs = [f"{c}_ohe" for c in one_hot] + [f"{c}_ohe" for c, _ in spec.temporal]
    n, m = len(spec.continuous), len(spec.engagement)
    scaled = [
        assembler(spec.continuous + spec.engagement, "numeric_vec"),
        scaler("numeric_vec", "numeric_scaled"),
        VectorSlicer(inputCol="numeric_scaled", outputCol="cont_scaled", indices=list(range(n))),
    ]
    if m:
        scaled.append(
            VectorSlicer(inputCol="numeric_scaled", outputCol="engagement_scaled", indices=list(range(n, n + m)))
        )
    stages = [
        *scaled,
        TableIndexer(spec.indexed, one_hot),
        one_hot_encoder(hot_inputs, hot_outputs, spec.drop_last),
        assembler(["cont_scaled", *hot_outputs, *[f"{c}_idx" for c in plain]], "features"),
    ]
    if m:
        stages.append(assembler(["features", "engagement_scaled"], "features_clf"))
    return Pipeline(stages=stages)


def feature_groups(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """Declared role of each column and whether the table has it: (column, group, present)."""
    rows = [(c, g, c in df.columns) for c, g in spec.groups()]
    return df.sparkSession.createDataFrame(rows, "column string, group string, present boolean")


def fit_preparation(train: DataFrame, spec: FeatureSpec = FeatureSpec()) -> PipelineModel:
    """Fit on the training rows only; columns may have any number of labels."""
    require_columns(train, spec.inputs + spec.engagement)
    return preparation(spec).fit(declare_domains(train, spec))


def prepare(df: DataFrame, model: PipelineModel, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    return model.transform(declare_domains(df, spec))


def cluster_preparation(spec: ClusterSpec = ClusterSpec()) -> Pipeline:
    return Pipeline(stages=[assembler(spec.features, "clust_vec"), scaler("clust_vec", "features")])


def arities(model: PipelineModel) -> dict[str, int]:
    """Levels of each indexed column, the invalid slot included."""
    return {
        c: levels + 1 for stage in model.stages if isinstance(stage, TableIndexerModel) for c, (levels, _) in stage.sizes().items()
    }


def slot_names(df: DataFrame, vector: str) -> DataFrame:
    """Name of every slot of an assembled vector, from column metadata alone: (slot, name)."""
    found = df.schema[vector].metadata.get("ml_attr", {})
    names = {i: f"f{i}" for i in range(found.get("num_attrs", 0))}
    for group in found.get("attrs", {}).values():
        names.update({a["idx"]: a["name"] for a in group if "name" in a})
    schema = T.StructType([T.StructField("slot", T.IntegerType()), T.StructField("name", T.StringType())])
    return small_table(df.sparkSession, sorted(names.items()), schema)
