"""License scan: fixed phrases, and an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pledgekit.llm.text import field_type
from pledgekit.runtime import stage

# Words of a text whose A-Z are lower case, what separates them, phrases and their labels, and the least
# containment in percent.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
CONTAINMENT = 90


@dataclass(frozen=True)
class Template:
    """Words that a notice of a license holds; their order does not count."""

    label: str
    text: str

    @property
    def words(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(self.text.split()))

    def need(self, percent: int) -> int:
        """Fewest words of the template that a block holds."""
        return max(1, -(-percent * len(self.words) // 100))

    @property
    def stride(self) -> int:
        """Words from one block to the next: a power of two not below the template's length; blocks are twice as long."""
        return 1 << max(0, len(self.text.split()) - 1).bit_length()


# Sentences of well-known notices, lower case, words only.
TEMPLATES = (
    Template("agpl", "licensed under the gnu affero general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-nd", "licensed under cc by nd 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("cc-by-sa", "licensed under the creative commons attribution sharealike license"),
    Template("cc0", "waived all copyright and related or neighboring rights to this work"),
    Template("gpl-2.0", "licensed under the gnu general public license version 2"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("lgpl", "licensed under the gnu lesser general public license"),
    Template("mit", "released under the mit license"),
    Template("mit", "licensed under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)


def lowered(text: str) -> Column:
    """The text in lower case, as far as words of ASCII letters and digits are concerned.

    The Kelvin sign is the one other character that becomes such a letter; it stays a character of its own.
    """
    return F.lower(F.replace(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit("\u212a"), F.lit("\u00e6")))


def words_of(low: str) -> Column:
    """The words of a lowered text in order."""
    return F.array_remove(F.split(low, BETWEEN, -1), "")


def phrase_starts(words: str, phrase: str) -> Column:
    """Positions, ascending, where the words of the phrase stand consecutively."""

    def here(w: Column, i: Column) -> Column:
        first, *rest = phrase.split()
        same = w == first
        for k, word in enumerate(rest, 1):
            same = same & (F.get(words, i + k) == word)
        return F.when(same, i)

    return F.filter(F.transform(words, here), lambda i: i.isNotNull())


def token_order(df: DataFrame, text: str, vocabulary: tuple[str, ...]) -> list[str]:
    """The vocabulary from rare to frequent by the number of texts that hold a word, ties by word.

    Tasks count before anything is shuffled, and only the vocabulary's counts (a parameter) reach the driver.
    """
    held = F.array_intersect(F.array(*[F.lit(w) for w in vocabulary]), "_words")
    words = df.select(lowered(text).alias("_low")).select(words_of("_low").alias("_words"))
    seen = words.select(F.explode(held).alias("w")).groupBy("w").count()
    counts = {r.w: r["count"] for r in seen.collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def _index(spark: SparkSession, templates: tuple[Template, ...], order: list[str], percent: int) -> DataFrame:
    """(token, place, label, stride, need, tokens): one row for every token of a template's prefix.

    A block that holds ``need`` of n tokens holds one of the n - need + 1 rarest.
    """
    rank = {w: k for k, w in enumerate(order)}
    rows = []
    for t in templates:
        tokens = sorted(t.words, key=rank.__getitem__)
        need = t.need(percent)
        rows += [(w, i, t.label, t.stride, need, tokens) for i, w in enumerate(tokens[: len(tokens) - need + 1])]
    return spark.createDataFrame(rows, "token string, place int, label string, stride int, need int, tokens array<string>")


def _prefix(templates: Iterable[Template], order: list[str], percent: int) -> list[str]:
    """The words under which blocks meet the templates."""
    rank = {w: k for k, w in enumerate(order)}
    rare = (sorted(t.words, key=rank.__getitem__)[: len(t.words) - t.need(percent) + 1] for t in templates)
    return sorted({w for words in rare for w in words})


def _stride_blocks(stride: int, prefix: list[str], vocabulary: Column) -> Column:
    places = F.transform(F.filter("_rare", lambda x: x["w"].isin(*prefix)), lambda x: x["i"])
    around = F.flatten(F.transform(places, lambda i: F.array(F.floor(i / stride) - 1, F.floor(i / stride))))

    def held(b: Column) -> Column:
        words = F.slice("_words", (b * stride + 1).cast("int"), F.lit(2 * stride))
        return F.struct(F.lit(stride).alias("stride"), b.alias("block"), F.array_intersect(vocabulary, words).alias("held"))

    return F.transform(F.filter(F.array_distinct(around), lambda b: b >= 0), held)


def _blocks(templates: tuple[Template, ...], order: list[str], percent: int) -> Column:
    """(stride, block, held) of the blocks of ``_words`` around a prefix token; ``held`` is their vocabulary, rare first.

    Block b of a stride s holds the words from b * s on, 2 * s of them, so a run of up to s words lies within one.
    """
    vocabulary = F.array(*[F.lit(w) for w in order])
    strides = sorted({t.stride for t in templates})
    return F.concat(
        *[_stride_blocks(s, _prefix([t for t in templates if t.stride == s], order, percent), vocabulary) for s in strides]
    )


def scan_table(
    df: DataFrame, text: str, key: str, templates: tuple[Template, ...] = TEMPLATES, percent: int = CONTAINMENT
) -> tuple[DataFrame, list[str]]:
    """``at`` (a row's number), ``id``, ``n_words``, phrase places and candidate blocks of every row; and the token order."""
    order = token_order(df, text, tuple(sorted({w for t in templates for w in t.words})))
    rare = _prefix(templates, order, percent)
    # One projection per step: what a later step names several times is then computed once. Words are looked at one by
    # one only in texts that hold a rare word, and for a phrase only in texts that hold the letters of all its words.
    low = df.select(F.col(f"`{key}`").alias("id"), lowered(text).alias("_low"))
    words = low.select("*", words_of("_low").alias("_words"))
    marked = F.transform("_words", lambda w, i: F.when(w.isin(*rare), F.struct(i.alias("i"), w.alias("w"))))
    some = F.arrays_overlap("_words", F.array(*[F.lit(w) for w in rare]))
    none = F.array().cast("array<struct<i:int,w:string>>")
    found = words.select(
        "*",
        F.when(some, F.filter(marked, lambda x: x.isNotNull())).otherwise(none).alias("_rare"),
        *[
            F.when(
                reduce(and_, [F.col("_low").contains(w) for w in p.split()]), phrase_starts("_words", p)
            ).otherwise(F.array().cast("array<int>")).alias(f"_p{k}")
            for k, p in enumerate(PHRASES)
        ],
    )
    starts = [F.col(f"_p{k}") for k in range(len(PHRASES))]
    named = [F.when(F.size(s) > 0, F.lit(label)) for s, label in zip(starts, PHRASES.values(), strict=True)]
    table = found.select(
        F.monotonically_increasing_id().alias("at"),
        "id",
        F.size("_words").cast("bigint").alias("n_words"),
        sum((F.size(s) for s in starts), F.lit(0)).cast("bigint").alias("n_base"),
        F.array_min(F.concat(*starts)).cast("bigint").alias("first_word"),
        F.array_max(F.concat(*starts)).cast("bigint").alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*named)))).alias("base"),
        _blocks(templates, order, percent).alias("blocks"),
    )
    return table, order


def template_matches(
    scanned: DataFrame, order: list[str], templates: tuple[Template, ...] = TEMPLATES, percent: int = CONTAINMENT
) -> DataFrame:
    """(at, stride, block, label, common, n): all blocks of a scanned table that hold enough of a template's n tokens.

    A block and a template meet under a token of the template's prefix. Length filter: the block has as many
    tokens of the vocabulary as are needed. Positional filter: so many tokens follow in the global order on both sides.
    A pair that meets under several tokens counts where the first common one is, so nothing is shuffled or
    repeated. The template table is a parameter, so its size is known before it is broadcast.
    """
    index = _index(scanned.sparkSession, templates, order, percent)
    block = scanned.select("at", F.explode("blocks").alias("b")).select("at", "b.*")
    tokens = block.select("*", F.posexplode("held").alias("spot", "token"))
    met = tokens.join(F.broadcast(index), ["token", "stride"])
    long_enough = F.size("held") >= F.col("need")
    far_enough = F.least(F.size("tokens") - F.col("place"), F.size("held") - F.col("spot")) >= F.col("need")
    pairs = met.filter(long_enough & far_enough).withColumn("both", F.array_intersect("tokens", "held"))
    kept = pairs.filter((F.size("both") >= F.col("need")) & (F.get("both", F.lit(0)) == F.col("token")))
    return kept.select("at", "stride", "block", "label", F.size("both").alias("common"), F.size("tokens").alias("n"))


def scan_licenses(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    templates: tuple[Template, ...] = TEMPLATES,
    percent: int = CONTAINMENT,
) -> DataFrame:
    """Key, n_words, phrase places (n_base, first_word, last_word, base_labels), ``labels``, ``score`` and ``n_blocks``.

    ``labels`` are those of the phrases and of all templates of whose words a block of the text holds ``percent``
    in a hundred or more; ``n_blocks`` counts the pairs of such blocks and templates. ``score`` is 1 where a phrase
    stands, else the greatest containment found, else 0. Two passes read the texts: one counts the templates'
    words over the whole table, one finds phrases and the blocks around rare template words; only matches are shuffled.

    A null or empty text has no words, no label (an empty string), a null ``first_word`` and ``last_word``, and score 0.
    Whole texts are scanned, however long. Repeated rows, rows of one key and different texts, and null keys each
    have a row of their own. An empty table gives no rows. Columns other than the key and the text are not read.
    """
    kind = field_type(df, key)
    table, order = scan_table(df, text, key, templates, percent)
    scanned = stage(table, "license-blocks")
    best = (
        template_matches(scanned, order, templates, percent)
        .groupBy("at")
        .agg(
            F.collect_set("label").alias("more"),
            F.max(F.col("common") / F.col("n")).alias("share"),
            F.count(F.lit(1)).alias("n_blocks"),
        )
    )
    own = scanned.drop("blocks").join(best, "at", "left")
    every = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    return own.select(
        F.col("id").cast(kind).alias(key),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
        F.coalesce("n_blocks", F.lit(0)).cast("bigint").alias("n_blocks"),
    )


def _sql_starts(phrase: str) -> str:
    words = phrase.split()
    same = " AND ".join(f"words[i + {k}] = '{w}'" if k else f"words[i] = '{w}'" for k, w in enumerate(words))
    return f"list_filter(range(1, len(words) + 1), lambda i: {same})"


def _sql_templates() -> str:
    rows = (
        f"({k}, '{t.label}', {t.stride}, {t.need(CONTAINMENT)}, [{', '.join(repr(w) for w in t.words)}])"
        for k, t in enumerate(TEMPLATES)
    )
    return ", ".join(rows)


SQL = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS n, doc_id,
         regexp_extract_all(translate(COALESCE(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words
  FROM documents),
p AS (SELECT n, doc_id, words, {", ".join(f"{_sql_starts(p)} AS p{k}" for k, p in enumerate(PHRASES))} FROM d),
based AS (
  SELECT n, doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST({" + ".join(f"len(p{k})" for k in range(len(PHRASES)))} AS BIGINT) AS n_base,
         list_min({" || ".join(f"p{k}" for k in range(len(PHRASES)))}) - 1 AS first_word,
         list_max({" || ".join(f"p{k}" for k in range(len(PHRASES)))}) - 1 AS last_word,
         {" || ".join(f"CASE WHEN len(p{k}) > 0 THEN ['{x}'] ELSE CAST([] AS VARCHAR[]) END" for k, x in enumerate(PHRASES.values()))} AS base
  FROM p),
templates(t, label, stride, need, tokens) AS (VALUES {_sql_templates()}),
spots AS (SELECT n, words, s.stride, unnest(range(0, len(words), s.stride)) AS a FROM d, (SELECT DISTINCT stride FROM templates) AS s),
blocks AS (SELECT n, stride, words[a + 1 : a + 2 * stride] AS held FROM spots),
met AS (
  SELECT n, label, len(list_intersect(tokens, held)) AS common, len(tokens) AS size, need
  FROM blocks JOIN templates ON blocks.stride = templates.stride),
best AS (
  SELECT n, list(DISTINCT label) AS more, max(CAST(common AS DOUBLE) / size) AS share, count(*) AS n_blocks
  FROM met WHERE common >= need GROUP BY n)
SELECT doc_id, n_words, n_base, first_word, last_word,
       COALESCE(array_to_string(list_sort(base), ','), '') AS base_labels,
       COALESCE(array_to_string(list_sort(list_distinct(base || COALESCE(more, CAST([] AS VARCHAR[])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN CAST(1 AS DOUBLE) ELSE COALESCE(share, 0) END AS score,
       CAST(COALESCE(n_blocks, 0) AS BIGINT) AS n_blocks
FROM based LEFT JOIN best ON based.n = best.n
"""
