"""Quality rules: a threshold table compiled into one projection, without user functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What separates words, which characters count as symbols, and how often n-grams may repeat.
SPACE = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
BULLETS = ("-", "*", "•")
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Frequent function words of the corpus languages, lower case.
STOP_WORDS = (
    # English
    "the of and to in a is that for it as was with be by on not he this are or his from at which but have an had"
    " they you were their one all we can her has there been if more when will would who so no she other its may"
    # German
    " der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat"
    " dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur"
    # French
    " le la les et des en un une du dans que est pour qui sur par au ce il pas plus avec son se sont ou aux mais"
    " comme être sa ses cette été nous vous elle"
    # Spanish
    " el los las y del se por con para su lo más pero sus este ya muy sin sobre también me hasta hay donde quien"
    " desde todo nos durante uno ni contra otros ese eso ante ellos esto antes"
).split()


@dataclass(frozen=True)
class Rule:
    """A ratio must lie within ``low`` and ``high``; an absent bound does not bind."""

    ratio: str
    low: float | None = None
    high: float | None = None


# The threshold table. Bounds are wide: prose of any of the languages passes with room to spare.
RULES = (
    Rule("chars_per_word", 2.0, 14.0),
    Rule("symbols_per_word", None, 0.25),
    Rule("shouts_per_word", None, 0.25),
    Rule("stop_word_share", 0.02, None),
    Rule("dup_line_share", None, 0.5),
    Rule("bullet_line_share", None, 0.9),
    Rule("open_line_share", None, 0.5),
)

# Ratios as (numerator, denominator) over the counted columns.
RATIOS = {
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "shouts_per_word": ("n_shouts", "n_words"),
    "stop_word_share": ("n_stop_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "bullet_line_share": ("n_bullet_lines", "n_lines"),
    "open_line_share": ("n_open_lines", "n_lines"),
}

COUNTS = (
    "n_words word_chars n_symbols n_shouts n_stop_words n_lines n_dup_lines n_bullet_lines n_open_lines n_repeat_words"
).split()


def _repeat_positions(ordered: str) -> Column:
    """Positions, ascending, of the windows whose words stand in another window too.

    ``ordered`` names an array of (hash, position) sorted by hash, so equal windows are neighbours.
    """

    def again(x: Column, i: Column) -> Column:
        return (x["h"] == F.get(ordered, i + 1)["h"]) | (x["h"] == F.get(ordered, i - 1)["h"])

    return F.array_sort(F.transform(F.filter(ordered, again), lambda x: x["p"]))


def _covered(positions: Column) -> Column:
    """Number of words under three-word windows that start at the given ascending positions."""
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(
        positions,
        start,
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )


def count_rules(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and one long column per counted feature of the whole text.

    A null or empty text counts 0 everywhere. Repeated rows are counted one by one. Windows are compared by
    64-bit hashes within one text; only texts with a repeated window are sorted. One narrow projection:
    nothing is shuffled, so neither a hot source nor a group of copies matters.
    """
    kept = [F.col(f"`{c}`") for c in keep]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = df.select(
        *kept,
        body.alias("_text"),
        F.regexp_extract_all(body, F.lit(f"[^{SPACE}]+"), F.lit(0)).alias("_words"),
        F.filter(F.split(body, "\n", -1), lambda line: line.rlike(f"[^{SPACE}]")).alias("_lines"),
    )
    n = F.size("_words")
    hashes = F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)))
    none = F.array().cast("array<bigint>")
    # One projection per step: what a later step names several times is then computed once.
    grams = words.withColumn("_grams", F.when(n >= 3, F.slice(hashes, F.lit(1), n - 2)).otherwise(none))
    placed = F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("p")))
    ordered = grams.withColumn(
        "_ordered", F.when(F.size(F.array_distinct("_grams")) < F.size("_grams"), F.sort_array(placed))
    )
    repeats = F.when(F.col("_ordered").isNotNull(), _covered(_repeat_positions("_ordered"))).otherwise(0)

    def lines_that(test) -> Column:
        return F.size(F.filter("_lines", test))

    counted = {
        "n_words": n,
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": F.regexp_count("_text", F.lit(f"[{SYMBOLS}]")),
        "n_shouts": F.regexp_count("_text", F.lit("!")),
        "n_stop_words": F.size(F.filter("_words", lambda w: F.lower(w).isin(*STOP_WORDS))),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_bullet_lines": lines_that(lambda line: F.substring(F.ltrim(line), 1, 1).isin(*BULLETS)),
        "n_open_lines": lines_that(lambda line: F.rtrim(line).endswith("...") | F.rtrim(line).endswith("…")),
        "n_repeat_words": repeats,
    }
    return ordered.select(*kept, *[counted[c].cast("bigint").alias(c) for c in COUNTS])


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """The threshold table as one condition over the counted columns; compared as products, so nothing is divided."""
    parts = []
    for rule in rules:
        top, bottom = (F.col(c) for c in RATIOS[rule.ratio])
        if rule.low is not None:
            parts.append(top >= bottom * F.lit(rule.low))
        if rule.high is not None:
            parts.append(top <= bottom * F.lit(rule.high))
    passed = F.lit(True)
    for part in parts:
        passed = passed & part
    return passed


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def quality_rules(
    df: DataFrame, text: str = "text", key: str = "doc_id", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Key, all counts, ``base_failed`` and ``kept`` (false if the base fails, else the threshold table's verdict).

    A null key stays null; a null text fails for want of words; an empty table gives no rows. Columns other
    than the key and the text are not read, whatever their names.
    """
    return (
        count_rules(df, text, (key,))
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & verdict(rules))
    )


def _sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _sql_verdict(rules: tuple[Rule, ...]) -> str:
    parts = []
    for rule in rules:
        top, bottom = RATIOS[rule.ratio]
        if rule.low is not None:
            parts.append(f"{top} >= {bottom} * CAST({rule.low} AS DOUBLE)")
        if rule.high is not None:
            parts.append(f"{top} <= {bottom} * CAST({rule.high} AS DOUBLE)")
    return " AND ".join(parts)


SQL = rf"""
WITH d AS (
  SELECT doc_id, COALESCE(text, '') AS text,
         regexp_extract_all(COALESCE(text, ''), '[^{SPACE}]+') AS words,
         list_filter(string_split(COALESCE(text, ''), chr(10)), lambda l: regexp_matches(l, '[^{SPACE}]')) AS lines
  FROM documents),
spots AS (SELECT doc_id, words, unnest(generate_series(1, len(words) - 2)) AS i FROM d),
grams AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram FROM spots),
again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams) WHERE n >= 2),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, i + o AS p FROM again, (VALUES (0), (1), (2)) AS offs(o)) GROUP BY doc_id),
counted AS (
  SELECT d.doc_id,
         CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[{SPACE}]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[{SYMBOLS}]')) AS BIGINT) AS n_symbols,
         CAST(len(regexp_extract_all(text, '!')) AS BIGINT) AS n_shouts,
         CAST(len(list_filter(words, lambda w: lower(w) IN ({_sql_list(STOP_WORDS)}))) AS BIGINT) AS n_stop_words,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(len(list_filter(lines, lambda l: substr(ltrim(l, ' '), 1, 1) IN ({_sql_list(BULLETS)}))) AS BIGINT) AS n_bullet_lines,
         CAST(len(list_filter(lines, lambda l: suffix(rtrim(l, ' '), '...') OR suffix(rtrim(l, ' '), '…'))) AS BIGINT) AS n_open_lines,
         CAST(COALESCE(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN covered ON d.doc_id = covered.doc_id),
based AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counted)
SELECT *, NOT base_failed AND {_sql_verdict(RULES)} AS kept FROM based
"""
