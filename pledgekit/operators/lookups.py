"""Left joins with a table of one row per key that stay even when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgekit.functions.columns import quoted

#: A key counts as hot if it has one in so many of all rows; there are so many hot keys at most.
HOT_SHARE = 256


def row_hash(df: DataFrame) -> Column:
    """A hash of a whole row, but for columns that hold maps."""
    return F.xxhash64(*[quoted(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()])


def spread_lookup(
    rows: DataFrame,
    key: Column,
    table: DataFrame,
    on: str,
    weight: str,
    spread: Column,
    values: tuple[str, ...],
    total: int | None = None,
) -> DataFrame:
    """``rows`` with the ``values`` columns of the row of ``table`` whose ``on`` equals ``key``; null where there is none.

    ``table`` has one row per ``on``, and ``weight`` says how many rows are expected to ask for it. Hot keys, one in
    ``HOT_SHARE`` of all rows or more, are ``HOT_SHARE`` at most; they are broadcast. Other rows are joined by shuffle.
    Rows of a hot or null key need no partner there, so they are dealt by ``spread`` (a column that differs between
    rows) instead of meeting in one task. ``rows`` must have none of the ``values`` columns. Weights steer the work
    only; wrong ones do not change the result. ``table`` is read twice, so give it staged; it is summed up
    where the ``total`` of its weights is not given.
    """
    if total is None:
        total = table.agg(F.coalesce(F.sum(quoted(weight)), F.lit(0))).first()[0]
    hot = table.filter(quoted(weight) * HOT_SHARE >= total)
    # Size bound of the broadcast: weights add up to the total, so HOT_SHARE rows reach that share at most.
    first = hot.select(F.lit(True).alias("_hot"), quoted(on).alias("_hot_key"), *[quoted(v).alias(f"_hot_{v}") for v in values])
    rest = table.filter(~(quoted(weight) * HOT_SHARE >= total))
    # One struct as the join key: a constant of its own would be taken out of the shuffle's keys.
    second = rest.select(F.struct(quoted(on).alias("k"), F.lit(0).alias("s")).alias("_cold_key"), *[quoted(v).alias(f"_cold_{v}") for v in values])
    kept = [quoted(c) for c in rows.columns]
    marked = rows.withColumn("_key", key).join(F.broadcast(first), F.col("_key") == F.col("_hot_key"), "left")
    asks = F.col("_hot").isNull() & F.col("_key").isNotNull()
    place = F.when(asks, 0).otherwise(F.pmod(spread, F.lit(1 << 20)).cast("int") + 1)
    dealt = marked.withColumn("_asked", F.struct(F.when(asks, F.col("_key")).alias("k"), place.alias("s")))
    found = dealt.join(second, F.col("_asked") == F.col("_cold_key"), "left")
    return found.select(*kept, *[F.coalesce(quoted(f"_hot_{v}"), quoted(f"_cold_{v}")).alias(v) for v in values])
