"""Mixing sources to target weights: capped water-filling and seeded repetitions, as DataFrame operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pledgekit.operators.ranking import number_rows, running_totals

# Weights by rank of the source, share of all sizes the mix holds, most epochs of a source.
WEIGHTS = (5, 2, 1)
TOTAL_PERCENT = 150
MAX_EPOCHS = 2
SEED = 42
#: About so many documents of a source stand in one hash range; a source has 4,096 ranges at least.
RANGE_ROWS = 50_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    total_percent: float = TOTAL_PERCENT,
    max_epochs: float = MAX_EPOCHS,
) -> DataFrame:
    """(source, source_size, target): targets proportional to weights, none above its cap.

    ``sizes`` holds one row per source (source, source_size). Weights follow the sources in code point
    order, null last, and repeat. Clamping and resharing until no target is above its cap ends at one level:
    every target is ``min(cap, level * weight)``. Sources reach their cap in the order of cap / weight, so
    the level follows from running sums in that order and no loop is needed. If the caps together hold less
    than asked for, every target is its cap. Sources are numbered and summed up by value ranges, so there may be any
    number of them; an empty table gives no rows.
    """
    ranked = number_rows(sizes.select("source", "source_size"), [F.col("source").asc_nulls_last()], "rank")
    given = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    weighed = ranked.withColumns({"weight": given, "cap": F.col("source_size") * F.lit(float(max_epochs))})
    ordered = number_rows(weighed, [F.col("cap") / F.col("weight"), F.col("rank")], "place")
    # Sums of whole numbers, exact in any order.
    summed = running_totals(ordered, "place", ["source_size", "cap", "weight"])
    below = F.col("cum_cap") - F.col("cap")
    free = F.col("total_source_size") * F.lit(total_percent / 100.0) - below
    steps = summed.withColumn("level", free / (F.col("total_weight") - F.col("cum_weight") + F.col("weight")))
    # Below the first source that is not clamped all are; its level is the level of all above it.
    open_ones = steps.filter(F.col("level") * F.col("weight") < F.col("cap"))
    first = open_ones.agg(F.min(F.struct("place", "level")).alias("first")).select(F.col("first.level").alias("level"))
    steps = steps.withColumn("final", first.scalar())
    target = F.when(F.col("final").isNull(), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.col("final") * F.col("weight"))
    )
    return steps.select("source", "source_size", target.alias("target"))


def mix(
    df: DataFrame,
    size: Column,
    source: str = "source",
    key: str = "doc_id",
    weights: Sequence[float] = WEIGHTS,
    total_percent: float = TOTAL_PERCENT,
    max_epochs: float = MAX_EPOCHS,
    seed: int = SEED,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per document: key, ``carry`` columns, source, size, source_size, target and ``repeats``.

    Every document is taken ``floor(target / source_size)`` times whole; the rest of the target is met by one
    more repetition of some documents. For that the documents of a source stand in the order of a seeded
    hash of their key, and those are repeated whose middle lies below the rest, so that a source misses its
    target by half a document at most and reruns agree, whatever the layout.

    A source is dealt into hash ranges: sums per range are added up, and rows are ordered within their
    range only, so a source with a third of all rows is many small groups. Null sources form one source;
    a source of size 0 has target 0 and its documents are taken once at most with nothing in them. A null
    key hashes to a value of its own; repeated rows count each. An empty table gives no rows. Carried columns whose
    names the mix uses itself are refused (carry them as one struct).
    """
    if clash := set(carry) & {key, "source", "size", "source_size", "target", "repeats"}:
        raise ValueError(f"carried columns have names of the mix itself: {', '.join(sorted(clash))}")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("null"))))
    n, digits = df.count(), 3
    while RANGE_ROWS << 4 * digits < n:  # finer ranges change no sum
        digits += 1
    docs = df.select(
        F.col(f"`{key}`").alias(key),
        *[F.col(f"`{c}`") for c in carry],
        F.col(f"`{source}`").alias("source"),
        # A key that is never null, so that the windows and the join below deal rows alike and move them once.
        F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit("")).alias("_from"),
        size.alias("size"),
        digest.alias("_hash"),
        F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint").alias("_range"),
    )
    ranges = docs.groupBy("_from", "source", "_range").agg(F.sum("size").alias("_range_size"))
    sizes = ranges.groupBy("source").agg(F.sum("_range_size").alias("source_size"))
    targets = source_targets(sizes, weights, total_percent, max_epochs)
    ahead = Window.partitionBy("_from").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(
        "_from",
        "_range",
        F.col("source").alias("_s"),
        F.coalesce(F.sum("_range_size").over(ahead), F.lit(0)).alias("_start"),
    )
    within = (
        Window.partitionBy("_from", "_range")
        .orderBy("_hash", key, F.col("size"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    plan = starts.join(targets.withColumnRenamed("source", "_t"), F.col("_s").eqNullSafe(F.col("_t"))).drop("_t", "_s")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - whole * F.col("source_size")
    middle = F.col("_start") + F.col("_sum") - F.col("size") / 2.0
    return (
        docs.withColumn("_sum", F.sum("size").over(within))
        .join(plan, ["_from", "_range"])
        .withColumn("repeats", (whole + F.when(middle < rest, 1).otherwise(0)).cast("bigint"))
        .select(key, *carry, "source", "size", "source_size", "target", "repeats")
    )


def repeat_rows(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mix itself: every row as often as it is repeated; rows repeated 0 times or a null number of times go."""
    times = F.when(F.col("repeats") > 0, F.sequence(F.lit(1), F.col("repeats").cast("int"))).otherwise(
        F.array().cast("array<int>")
    )
    return mixed.select(*[F.col(f"`{c}`") for c in columns], F.explode(times).alias("_copy")).drop("_copy")


def mixed_sizes(df: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """Key, size, source_size, target and ``taken`` (words the mix takes) of every document.

    A null or empty text has size 0 and is taken with 0 words; null keys and sources stay null, repeated rows count
    each, an empty table gives no rows. Columns other than key, source and text are not read.
    """
    mixed = mix(df, word_count(F.col(f"`{text}`")), source, key)
    return mixed.select(key, "size", "source_size", "target", (F.col("repeats") * F.col("size")).alias("taken"))


SQL = rf"""
WITH docs AS (
  SELECT doc_id, source, md5('{SEED}:' || COALESCE(CAST(doc_id AS VARCHAR), 'null')) AS h,
         CAST(len(regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
ranked AS (
  SELECT source, source_size, source_size * CAST({float(MAX_EPOCHS)} AS DOUBLE) AS cap,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(WEIGHTS)}
           {' '.join(f'WHEN {i} THEN CAST({float(w)} AS DOUBLE)' for i, w in enumerate(WEIGHTS))} END AS weight,
         CAST(sum(source_size) OVER () AS BIGINT) * CAST({TOTAL_PERCENT / 100.0} AS DOUBLE) AS wanted
  FROM sizes),
levels AS (
  SELECT *,
         (wanted - COALESCE(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), CAST(0 AS DOUBLE)))
         / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked),
chosen AS (SELECT arg_min(level, cap / weight) AS level FROM levels WHERE level * weight < cap),
targets AS (
  SELECT source, source_size,
         CASE WHEN chosen.level IS NULL THEN cap ELSE LEAST(cap, chosen.level * weight) END AS target
  FROM levels, chosen),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS whole,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY h, d.doc_id, d.size
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
           - d.size / CAST(2 AS DOUBLE) AS middle
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (whole + CASE WHEN middle < target - whole * source_size THEN 1 ELSE 0 END) * size AS taken
FROM placed
"""
