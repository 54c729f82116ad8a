"""Column -> Column building blocks, all inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

def quoted(name: str) -> Column:
    """Column by its exact name, which may hold spaces or dots."""
    return F.col(f"`{name}`")


def is_missing(c: Column, floating: bool) -> Column:
    """Null, or NaN where the type has one (``isnan`` of null is false)."""
    return c.isNull() | F.isnan(c) if floating else c.isNull()


def complete(schema: T.StructType, names: Sequence[str]) -> Column:
    """True where no named column is null or NaN, as separate conditions that scans can push down."""
    floating = (T.DoubleType, T.FloatType)
    present = F.lit(True)
    for name in names:
        present = present & ~is_missing(quoted(name), isinstance(schema[name].dataType, floating))
    return present


def outcome_label(state: Column, success: str) -> Column:
    return F.when(state == success, 1).otherwise(0)


def lenient_timestamp(text: Column, fmt: str) -> Column:
    """Parse, or null where the text does not match (ANSI mode would raise)."""
    return F.try_to_timestamp(text, F.lit(fmt))


def funding_ratio(pledged: Column, goal: Column) -> Column:
    return F.when(goal > 0, pledged / goal).otherwise(F.lit(0.0))


def size_band(amount: Column, bounds: Sequence[tuple[str, float]], top: str) -> Column:
    """Half-open bands ``[.., bound)`` in ascending order; missing amounts get no band."""
    band = F.when(amount.isNull() | F.isnan(amount), F.lit(None).cast("string"))
    for name, bound in bounds:
        band = band.when(amount < bound, name)
    return band.otherwise(top)


def exceeds(amount: Column, bound: Column) -> Column:
    """1 where strictly above; meeting the bound exactly is 0."""
    return F.when(amount > bound, 1).otherwise(0)


def amount_from_log(logged: Column) -> Column:
    """Inverse of ``log1p``; NaN stays NaN, and predictions above 709 are infinite amounts."""
    return F.expm1(logged)


def hash_bucket(key: Column, buckets: int, salt: str = "", offset: int = 1) -> Column:
    """Layout-independent bucket in ``[0, buckets)`` from eight md5 hex digits of the key.

    Rows sharing a key share a bucket; ``offset`` picks other digits for an independent draw.
    """
    text = F.coalesce(key.cast("string"), F.lit(""))
    if salt:
        text = F.concat(text, F.lit(salt))
    digits = F.substring(F.md5(text), offset, 8)
    return (F.conv(digits, 16, 10).cast("bigint") % buckets).cast("int")


def half_even(c: Column, digits: int) -> Column:
    """Round binary halves to even, as scaling, rounding to an integer and scaling back does.

    Decimal rounding (``bround``) would look at the shortest decimal form instead and differ on ties.
    """
    scale = float(10**digits)
    return F.rint(c * scale) / scale


def log_bin(amount: Column, per_decade: int) -> Column:
    """Index of the logarithmic bin; amounts below 1 share bin -1, and missing amounts have none."""
    known = F.when(amount >= 1, F.floor(F.log10(amount) * per_decade)).otherwise(F.lit(-1)).cast("int")
    return F.when(amount.isNotNull() & ~F.isnan(amount), known)


def positive_probability(probability: Column) -> Column:
    return vector_to_array(probability)[1]


def square(c: Column) -> Column:
    return c * c


def total(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def squared_distance(columns: Sequence[Column], center: Sequence[float | Column]) -> Column:
    return total([square(c - v) for c, v in zip(columns, center)])


def nearest(columns: Sequence[Column], centers: Sequence[Sequence[float]]) -> Column:
    """Struct (distance, cluster) of the closest center; ties go to the lower cluster.

    Centers are a fitted model's few rows, so they become literals and no join is needed.
    """
    options = [
        F.struct(
            squared_distance(columns, [F.lit(float(v)) for v in center]).alias("distance"),
            F.lit(i).alias("cluster"),
        )
        for i, center in enumerate(centers)
    ]
    return F.array_min(F.array(*options))


def rows_of(entries: Sequence[Mapping[str, Column]]) -> Column:
    """Array of structs, for turning one wide aggregate row into a long table with ``inline``."""
    return F.array(*[F.struct(*[c.alias(n) for n, c in e.items()]) for e in entries])
