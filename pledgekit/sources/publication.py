"""Sets of result tables that become readable as a whole, and tables that are refreshed by partition."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pledgekit.functions.columns import quoted
from pledgekit.sources.tables import small_table

MANIFEST = (
    "number bigint, version string, "
    "tables array<struct<name:string,path:string,format:string,rows:bigint,schema:string,checksum:string>>"
)


def _options(kind: str, use: str) -> dict:
    """Reader and writer settings under which a table comes back as it was, nulls, empty texts and line breaks included.

    Missing values are written as nothing and empty texts as two quotes. The reader needs a name for missing
    values that no text has, since it would take empty texts for them otherwise.
    """
    if kind != "csv":
        return {}
    both = {"header": True, "quote": '"', "escape": '"'}
    if use == "write":
        return both | {"emptyValue": '""', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return both | {"emptyValue": "", "nullValue": "\u0001", "multiLine": True}


def _load(spark: SparkSession, path: str, kind: str, schema: T.StructType) -> DataFrame:
    back = spark.read.schema(schema).options(**_options(kind, "read")).format(kind).load(path)
    return back.select(*[quoted(c) for c in schema.names])


def _sums(df: DataFrame) -> Row:
    """Number of rows and the sum of their hashes, which do not depend on their order.

    Map columns, which have no order, are left out of the hash.
    """
    hashed = F.xxhash64(*[quoted(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()])
    total = F.coalesce(F.sum(hashed.cast("decimal(20,0)")), F.lit(0)).cast("string")
    return df.agg(F.count(F.lit(1)).alias("rows"), total.alias("checksum")).first()


@dataclass
class Publication:
    """One version of a set of tables under ``root``.

    Every table is written into a folder of the new version, and the written files are counted and summed up.
    ``commit`` then adds one line to the list of versions, as one file that appears by a rename. Readers go by that
    list, so a run that dies before its commit, or between two tables, leaves the last version as it is. Folders of
    versions that never came to a commit, and of old versions, are left to the folder's retention.
    """

    spark: SparkSession
    root: str
    version: str = field(default_factory=lambda: uuid.uuid4().hex)
    entries: list[tuple] = field(default_factory=list)

    @property
    def folder(self) -> str:
        return f"{self.root}/version-{self.version}"

    def add(
        self, name: str, df: DataFrame, kind: str = "csv", single_file: bool = False, partition_by: Sequence[str] = ()
    ) -> str:
        """Write one table; ``single_file`` funnels into one task, for small reports only."""
        if any(name == e[0] for e in self.entries):
            raise ValueError(f"table {name} is published twice")
        path = f"{self.folder}/{name}"
        out = df.coalesce(1) if single_file else df
        out.write.options(**_options(kind, "write")).mode("errorifexists").partitionBy(*partition_by).format(kind).save(path)
        found = _sums(_load(self.spark, path, kind, df.schema))
        self.entries.append((name, path, kind, found["rows"], df.schema.json(), found["checksum"]))
        return path

    def commit(self) -> int:
        """Make the version the latest one; returns its number."""
        known = versions(self.spark, self.root)
        last = known.agg(F.max("number")).first()[0] if known is not None else None
        number = 1 + (last or 0)
        row = self.spark.createDataFrame([(number, self.version, self.entries)], MANIFEST)
        row.coalesce(1).write.mode("append").json(f"{self.root}/manifest")
        return number


def versions(spark: SparkSession, root: str) -> DataFrame | None:
    """Committed versions, one row each; None where there is none."""
    try:
        return spark.read.schema(MANIFEST).json(f"{root}/manifest")
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def published(spark: SparkSession, root: str, number: int | None = None) -> list[Row]:
    """Tables of a version, by default of the latest (of versions that committed at once, one and the same)."""
    known = versions(spark, root)
    if known is not None and number is not None:
        known = known.filter(F.col("number") == number)
    row = known.orderBy(F.desc("number"), "version").first() if known is not None else None
    if row is None:
        raise LookupError(f"nothing is published under {root}" + ("" if number is None else f" as version {number}"))
    return row.tables


def read_published(spark: SparkSession, root: str, name: str, number: int | None = None) -> DataFrame:
    """One table of a version, with the schema that it was written with."""
    for entry in published(spark, root, number):
        if entry.name == name:
            return _read(spark, entry)
    raise LookupError(f"no table {name} is published under {root}")


def _read(spark: SparkSession, entry: Row) -> DataFrame:
    return _load(spark, entry.path, entry.format, T.StructType.fromJson(json.loads(entry.schema)))


def verify_published(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """(name, rows, found, intact): the files of every table against the counts and checksums of the list."""
    out = []
    for entry in published(spark, root, number):
        found = _sums(_read(spark, entry))
        out.append((entry.name, entry.rows, found["rows"], (found["rows"], found["checksum"]) == (entry.rows, entry.checksum)))
    return spark.createDataFrame(out, "name string, rows bigint, found bigint, intact boolean")


# Characters that stand escaped in the folder name of a partition, besides control characters.
ESCAPED = "\"#%'*/:=?\\{[]^\x7f"


def partition_folder(path: str, column: str, value) -> str:
    """Folder of one partition value, as the partitioned writer names it."""

    def plain(text: str) -> str:
        return "".join(f"%{ord(c):02X}" if c in ESCAPED or c < " " else c for c in text)

    return f"{path}/{plain(column)}={plain(str(value))}"


def refresh_partitions(df: DataFrame, path: str, column: str, values: Sequence) -> DataFrame:
    """Replace some partitions of a Parquet table by their rows of ``df``: (value, rows) of each, after a check.

    The filter on ``column`` is part of the plan, so a source that can prune or filter reads only these rows. Files of
    other partitions are not touched. A value that has no rows any more keeps an empty partition. Rows are counted
    in the source, of which that needs one column, and in the written files; a difference is an error.
    """
    wanted = list(dict.fromkeys(values))
    if not wanted or None in wanted:
        raise ValueError("name the partition values to refresh; null is not one")
    spark, value = df.sparkSession, quoted(column)
    part = df.filter(value.isin(*wanted))

    def counted(rows: DataFrame) -> dict:
        found = {r.value: r["count"] for r in rows.groupBy(value.alias("value")).count().collect()}
        return {v: found.get(v, 0) for v in wanted}

    def written() -> dict:
        return counted(spark.read.schema(df.schema).parquet(path).filter(value.isin(*wanted)))

    part.hint("rebalance", column).write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(column).parquet(path)
    counts, there = counted(part), written()
    if stale := [v for v in wanted if there[v] and not counts[v]]:
        for v in stale:
            df.limit(0).drop(column).write.mode("overwrite").parquet(partition_folder(path, column, v))
        there = written()
    if odd := [v for v in wanted if there[v] != counts[v]]:
        raise RuntimeError(f"partitions of {path} hold other rows than their source: {column} in {odd}")
    schema = T.StructType([T.StructField("value", df.schema[column].dataType), T.StructField("rows", T.LongType())])
    return small_table(spark, list(counts.items()), schema)
