"""Language identification: known words by their log frequency, unseen words by backing off to shorter n-grams."""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgekit.llm.text import field_type, map_texts
from pledgekit.runtime import stage

#: The model is learned from about so many documents of each language, chosen by a hash of their key.
FIT_DOCUMENTS = 2_000
#: Most entries of the word table and of the n-gram table. Each language has an equal share for its most frequent
#: ones; what shares leave goes to the most frequent of all.
MAX_WORDS, MAX_GRAMS = 50_000, 100_000
LONGEST_GRAM = 5
#: Added to every count.
SMOOTHING = 0.5
#: Unseen words whose scores a task remembers; a longer text is scored in slices of so many words.
REMEMBERED = 200_000
UNDETERMINED = "und"

WORD = re.compile(r"[^\W\d_]+")
_WORD_JAVA = r"\p{L}+"


@dataclass
class LanguageModel:
    """Log frequencies per language (rows: entries; columns: languages) of words and of n-grams by length."""

    languages: list[str]
    words: dict[str, int]
    word_scores: np.ndarray
    grams: dict[str, int]
    gram_scores: np.ndarray


def _in_share(tiers: list[tuple[int, int]], share: int) -> Column:
    """Whether an (entry, n) of a language is among about ``share`` most frequent, by its (n, entries with n).

    Of the entries that tie at the end of the share, a hash chooses as many as fit.
    """
    chosen = F.lit(False)
    for n, entries in sorted(tiers, reverse=True):
        if entries > share:
            part = int(share / entries * (1 << 20))
            return chosen | ((F.col("n") == n) & (F.pmod(F.xxhash64("entry"), F.lit(1 << 20)) < part))
        share -= entries
        chosen = F.col("n") >= n
    return chosen


def _table(counts: DataFrame, languages: list[str], limit: int) -> tuple[dict[str, int], np.ndarray]:
    """Entries of (entry, lang, n) in the share of a language, then the most frequent, and their smoothed log frequency.

    Entries that occur once are kept in a share only.
    """
    per = [F.sum(F.when(F.col("lang") == g, F.col("n")).otherwise(0)).alias(f"_{i}") for i, g in enumerate(languages)]
    tiers: dict[str, list[tuple[int, int]]] = {g: [] for g in languages}
    for r in counts.groupBy("lang", "n").agg(F.count(F.lit(1)).alias("entries")).collect():  # distinct counts only
        tiers[r["lang"]].append((r["n"], r["entries"]))
    own = F.lit(False)
    for g, found in tiers.items():
        own = F.when(F.col("lang") == g, _in_share(found, limit // len(languages))).otherwise(own)
    wide = counts.groupBy("entry").agg(*per, F.sum("n").alias("_all"), F.max(own).alias("_own"))
    wide = wide.filter(F.col("_own") | (F.col("_all") > 1))
    rows = wide.orderBy(F.col("_own").desc(), F.col("_all").desc(), "entry").limit(limit).collect()  # bounded by `limit`
    entries = {r["entry"]: i for i, r in enumerate(rows)}
    found = np.array([[r[f"_{i}"] for i in range(len(languages))] for r in rows], float).reshape(-1, len(languages))
    size = np.array([float(sum(n * k for n, k in tiers[g])) for g in languages]) + SMOOTHING * (len(rows) + 1)
    return entries, np.log((found + SMOOTHING) / size)


def learn_languages(
    df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", fit_documents: int = FIT_DOCUMENTS
) -> LanguageModel:
    """Count words and n-grams per language over about ``fit_documents`` documents of each language.

    Rows without text or language teach nothing. Without any, the model knows no language. Counting is
    distributed; the tables that come to the driver are bounded by ``MAX_WORDS`` and ``MAX_GRAMS``.
    """
    rows = df.select(
        F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], {}, np.zeros((0, 0)), {}, np.zeros((0, 0)))
    share = F.lit(0.0)
    for g, n in sizes.items():
        share = F.when(F.col("lang") == g, F.lit(fit_documents / n)).otherwise(share)
    chosen = rows.filter(F.pmod(F.xxhash64("key", F.lit("fit")), F.lit(1 << 20)) < share * (1 << 20))
    words = (
        chosen.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(_WORD_JAVA), F.lit(0))).alias("entry"))
        .groupBy("entry", "lang")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    words = stage(words, "language-words")
    padded = F.concat(F.lit("<"), "entry", F.lit(">"))
    places = F.sequence(F.lit(1), F.length("entry") + 2)
    every = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.lit(LONGEST_GRAM)),
            lambda size: F.transform(places, lambda at: F.substr(padded, at, size)),
        )
    )
    # Each distinct word counts once: common words are known, and n-grams are for the others.
    grams = (
        words.select("lang", F.explode(every).alias("entry"))
        .groupBy("entry", "lang")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grams = stage(grams, "language-grams")
    known, word_scores = _table(words, languages, MAX_WORDS)
    pieces, gram_scores = _table(grams, languages, MAX_GRAMS)
    return LanguageModel(languages, known, word_scores, pieces, gram_scores)


class Identifier:
    """Scores texts with a model; remembers the rows of unseen words, up to a bound."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.fresh = len(model.words)
        self.rows = dict(model.words)
        self.scores = np.zeros((self.fresh + REMEMBERED, len(model.languages)))
        self.scores[: self.fresh] = model.word_scores

    def _known_grams(self, word: str) -> list[int]:
        """Entries of the longest n-grams of a word of which any is known; none if none is."""
        padded, entry = f"<{word}>", self.model.grams.get
        for size in range(min(LONGEST_GRAM, len(padded)), 0, -1):
            found = [e for i in range(len(padded) - size + 1) if (e := entry(padded[i : i + size])) is not None]
            if found:
                return found
        return []

    def backoff(self, words: list[str]) -> np.ndarray:
        """Mean log frequency of the longest known n-grams of each unseen word; 0 if none is known."""
        found = [self._known_grams(w) for w in words]
        counts = np.array([len(f) for f in found], np.int64)
        scores = np.zeros((len(words), len(self.model.languages)))
        some = np.flatnonzero(counts)
        if len(some):
            starts = np.cumsum(counts[some]) - counts[some]
            rows = self.model.gram_scores[np.fromiter(chain.from_iterable(found), np.int64)]
            scores[some] = np.add.reduceat(rows, starts, axis=0) / counts[some, None]
        return scores

    def _total(self, words: list[str]) -> np.ndarray:
        """Sum of the scores of at most ``REMEMBERED`` words; what is remembered makes room for them if needed."""
        missing = list(set(words).difference(self.rows))
        if len(self.rows) + len(missing) > self.fresh + REMEMBERED:
            self.rows = dict(self.model.words)
            missing = list(set(words).difference(self.rows))
        if missing:
            at = len(self.rows)
            self.scores[at : at + len(missing)] = self.backoff(missing)
            self.rows.update(zip(missing, range(at, at + len(missing)), strict=True))
        return self.scores[list(map(self.rows.__getitem__, words))].sum(axis=0)

    def identify(self, text: str | None) -> tuple[str, float]:
        words = WORD.findall(text.lower()) if text else []
        lettered = any(c.isalpha() for w in words for c in w)  # a word of other numerals has none
        if not lettered or not self.model.languages:
            return UNDETERMINED, 0.0
        total = self._total(words[:REMEMBERED])
        for at in range(REMEMBERED, len(words), REMEMBERED):
            total = total + self._total(words[at : at + REMEMBERED])
        best = int(np.argmax(total))
        return self.model.languages[best], float(1.0 / np.exp(total - total[best]).sum())


def identify_languages(df: DataFrame, model: LanguageModel, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key, ``lang_pred`` and ``score`` of every whole text, from the text alone.

    The prediction is the language with the highest sum over the words: a known word adds its log frequency, an
    unseen one the mean log frequency of its longest known n-grams. The score is its posterior share under equal
    priors. A null text, one without letters, or a model without languages gives ``und`` with score 0; ties go
    to the first language by name. Repeated rows are judged each, null keys stay null. One narrow pass.
    """
    fields = tuple(vars(model).values())
    shared = df.sparkSession.sparkContext.broadcast(fields)  # bounded by MAX_WORDS and MAX_GRAMS
    judges: list[Identifier] = []

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        if not judges:
            judges.append(Identifier(LanguageModel(*shared.value)))
        found = [judges[0].identify(t) for t in part.column("text").to_pylist()]
        columns = [part.column("key"), pa.array([g for g, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())]
        return pa.RecordBatch.from_arrays(columns, names=["key", "lang_pred", "score"])

    schema = f"key {field_type(df, key)}, lang_pred string, score double"
    return map_texts(df, {"key": key, "text": text}, schema, work).withColumnRenamed("key", key)


def held_out(key: Column, parts: int, part: int) -> Column:
    """Whether a key belongs to the rows kept apart for measuring; a null key counts as the text ``null``."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("null"))) % parts == part
