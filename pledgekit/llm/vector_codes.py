"""Vector code compression: codebooks of vector parts, learned and applied with exact integer products."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgekit.llm.limbs import exact_dot, peak, whole_matrix
from pledgekit.llm.text import field_type
from pledgekit.runtime import stage

# How components become integers, parts of a vector, entries of a codebook, and rounds of learning.
SCALE = 1_024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Vectors whose distances a task holds at a time.
SLICE_ROWS = 4_096
#: Ranges that the rows of one label are dealt into where label sums come back to them.
LABEL_RANGES = 64


@dataclass(frozen=True)
class Codebooks:
    """Entries of every part, each an integer matrix (entry x position)."""

    parts: tuple[np.ndarray, ...]

    @property
    def width(self) -> int:
        return sum(p.shape[1] for p in self.parts)

    def digest(self) -> str:
        numbers = (str(x) for part in self.parts for x in part.ravel().tolist())
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the entry nearest to each row, ties to the lower index."""
    if entries.shape[1] * (peak(rows) + peak(entries)) ** 2 >= 1 << 63:
        raise OverflowError("squared distances of these vectors do not fit 64 bits")
    distances = (rows * rows).sum(axis=1)[:, None] - 2 * exact_dot(rows, entries) + (entries * entries).sum(axis=1)[None, :]
    first = distances.argmin(axis=1)
    return first, distances[np.arange(len(rows)), first]


def encode(rows: np.ndarray, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """Code (row x part) and squared error of every row, a slice of rows at a time."""
    codes = np.zeros((len(rows), len(books.parts)), np.int64)
    errors = np.zeros(len(rows), np.int64)
    for start in range(0, len(rows), SLICE_ROWS):
        part, at = rows[start : start + SLICE_ROWS], 0
        for p, entries in enumerate(books.parts):
            found, off = nearest(part[:, at : at + entries.shape[1]], entries)
            codes[start : start + SLICE_ROWS, p] = found
            errors[start : start + SLICE_ROWS] += off
            at += entries.shape[1]
    return codes, errors


def whole_vectors(df: DataFrame, vector: str, scale: int) -> Column:
    """``floor(scale * x)`` of every component; null where the vector is null, empty, or holds null, NaN or infinity."""
    v = F.col(f"`{vector}`").cast("array<double>")
    usable = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(usable, F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x).cast("bigint")))


def seeds(data: DataFrame, entries: int = ENTRIES) -> list[list[int]]:
    """Vectors of the least distinct ids; of an id's several vectors, the least."""
    ids = data.filter(F.col("id").isNotNull()).select("id").distinct().orderBy("id").limit(entries)
    known = data.join(F.broadcast(ids), "id", "left_semi").groupBy("id").agg(F.min("v").alias("v"))
    return [list(r.v) for r in sorted(known.collect(), key=lambda r: r.id)]


def _sums(data: DataFrame, books: Codebooks) -> DataFrame:
    """(part, entry, position, total, n) over all rows; a task sends one row per used entry and position."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(p.shape, np.int64) for p in books.parts]
        used = np.zeros((len(books.parts), max(len(p) for p in books.parts)), np.int64)
        held = [0] * len(books.parts)
        for batch in batches:
            rows = whole_matrix(batch.column(0), books.width)
            codes, _ = encode(rows, books)
            at = 0
            for p, entries in enumerate(books.parts):
                own = rows[:, at : at + entries.shape[1]]
                at += entries.shape[1]
                held[p] += peak(own) * len(own)
                if held[p] >= 1 << 63:
                    raise OverflowError("sums of these vectors do not fit 64 bits")
                np.add.at(totals[p], codes[:, p], own)
                used[p] += np.bincount(codes[:, p], minlength=used.shape[1])
        for p, total in enumerate(totals):
            entry, position = np.nonzero(np.broadcast_to(used[p, : len(total), None] > 0, total.shape))
            columns = [np.full(len(entry), p), entry, position, total[entry, position], used[p, entry]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "position", "total", "n"])

    found = data.select("v").mapInArrow(add, "part bigint, entry bigint, position bigint, total bigint, n bigint")
    return found.groupBy("part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def learn_codebooks(data: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of a table (id, v) of equally long integer vectors; None of an empty table.

    Entries start as the parts of the vectors with the least ids. Every round, each task assigns its rows and adds
    them up by entry, so a table of any size sends ``entries`` rows of sums per task and position, and the driver sees
    the totals only: ``entries`` times the vector's length. Entries without rows stay as they are.
    """
    start = seeds(data, entries)
    if not start:
        return None
    first = np.array(start, np.int64)
    books = Codebooks(tuple(np.split(first, parts, axis=1)))
    for _ in range(rounds):
        after = [p.copy() for p in books.parts]
        for r in _sums(data, books).collect():
            after[r.part][r.entry, r.position] = r.total // r.n
        books = Codebooks(tuple(after))
    return books


def vector_codes(
    df: DataFrame,
    vector: str = "embedding",
    key: str = "vec_id",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Key, ``code`` (two hex digits a part), ``error``, ``label_error`` and ``codebooks_sha256`` of every vector.

    Components are ``floor(1024 * x)`` and vectors are cut into ``parts`` equal parts; a code is the list of the
    nearest entries of the parts' codebooks. ``label_error`` adds up the errors of the label's rows; it is summed per
    task before anything is shuffled, and comes back over ranges of a label's rows, so a hot label is no hot task.

    Rows whose vector is null, empty, or holds null, NaN or infinity take no part, nor do vectors of another length
    than the vector of the least id (of an id's several vectors, the least; without any id, the least vector).
    Repeated rows count each and get a row each; a repeated id starts one entry. Null keys get codes but start no
    entry, so a table without any key gives no rows; null labels are one label. A length that cannot be cut into equal
    parts is refused; distances and sums beyond 63 bits raise ``OverflowError``. An empty table gives no rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("two hex digits name 256 entries at most")
    kind, marked = field_type(df, key), field_type(df, label)
    named = df.select(
        F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").alias("label"), whole_vectors(df, vector, SCALE).alias("v")
    )
    data = stage(named.filter(F.col("v").isNotNull()), "code-vectors")
    leader = data.filter(F.col("id").isNotNull()).agg(F.min(F.struct("id", "v")).alias("m")).first().m
    width = len(leader.v) if leader else 0
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    data = data.filter(F.size("v") == width)
    books = learn_codebooks(data, parts, entries, rounds)
    shape = f"`{key}` {kind}, code string, error bigint, label_error bigint, codebooks_sha256 string"
    if books is None:
        return df.sparkSession.createDataFrame([], shape)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = encode(whole_matrix(batch.column(2), books.width), books)
            text = [row.tobytes().hex() for row in codes.astype(np.uint8)]
            columns = [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(errors)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "code", "error"])

    coded = data.select("id", "label", "v").mapInArrow(name, f"id {kind}, label {marked}, code string, error bigint")
    coded = stage(coded, "codes")
    ranges = F.explode(F.sequence(F.lit(0), F.lit(LABEL_RANGES - 1))).alias("range")
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).select(F.col("label").alias("of"), "label_error", ranges)
    own = coded.withColumn("own", F.pmod(F.xxhash64("id", "code", "error"), F.lit(LABEL_RANGES)).cast("int"))
    whole = own.join(sums, F.col("label").eqNullSafe(F.col("of")) & (F.col("own") == F.col("range")))
    return whole.select(
        F.col("id").alias(key), "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256")
    )


def _sql_round(n: int) -> str:
    """Entries after a round: of every entry's parts the floor of the mean, of unused entries what they were."""
    return f"""
near{n} AS MATERIALIZED (
  SELECT r.n, r.p, min(CAST(r.vv + b.cc - 2 * list_inner_product(r.v, b.c) AS HUGEINT) * {ENTRIES} + b.e) AS best
  FROM parts AS r JOIN book{n} AS b ON r.p = b.p GROUP BY r.n, r.p),
mean{n} AS (
  SELECT p, e, i, CAST((s - ((s % k) + k) % k) AS HUGEINT) // k AS x
  FROM (SELECT r.p, CAST(best % {ENTRIES} AS INT) AS e, i, CAST(sum(CAST(r.v[i] AS BIGINT)) AS HUGEINT) AS s, CAST(count(*) AS HUGEINT) AS k
        FROM near{n} AS a JOIN parts AS r ON a.n = r.n AND a.p = r.p, range(1, r.w + 1) AS g(i)
        GROUP BY r.p, best % {ENTRIES}, i)),
fresh{n} AS (SELECT p, e, list(CAST(x AS DOUBLE) ORDER BY i) AS c FROM mean{n} GROUP BY p, e),
book{n + 1} AS MATERIALIZED (
  SELECT p, e, c, list_inner_product(c, c) AS cc
  FROM (SELECT b.p, b.e, COALESCE(f.c, b.c) AS c FROM book{n} AS b LEFT JOIN fresh{n} AS f ON b.p = f.p AND b.e = f.e)),"""


SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, label,
         list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT n, vec_id, p, w, v[p * w + 1 : p * w + w] AS v, list_inner_product(v[p * w + 1 : p * w + w], v[p * w + 1 : p * w + w]) AS vv
  FROM (SELECT n, vec_id, v, p, len(v) // {PARTS} AS w FROM kept, range({PARTS}) AS g(p))),
first AS (SELECT vec_id, min(v) AS v FROM kept WHERE vec_id IS NOT NULL GROUP BY vec_id ORDER BY vec_id LIMIT {ENTRIES}),
book0 AS MATERIALIZED (
  SELECT p, e, c, list_inner_product(c, c) AS cc
  FROM (SELECT p, CAST(row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS INT) AS e,
               v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS c
        FROM first, range({PARTS}) AS g(p))),{"".join(_sql_round(n) for n in range(ROUNDS))}
last AS (
  SELECT r.n, r.p, min(CAST(r.vv + b.cc - 2 * list_inner_product(r.v, b.c) AS HUGEINT) * {ENTRIES} + b.e) AS best
  FROM parts AS r JOIN book{ROUNDS} AS b ON r.p = b.p GROUP BY r.n, r.p),
coded AS MATERIALIZED (
  SELECT n, string_agg(printf('%02x', CAST(best % {ENTRIES} AS INT)), '' ORDER BY p) AS code,
         CAST(sum(best // {ENTRIES}) AS BIGINT) AS error FROM last GROUP BY n),
digest AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT p, e, i, c[i] AS x FROM book{ROUNDS}, range(1, len(c) + 1) AS g(i))),
totals AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM coded JOIN kept ON coded.n = kept.n GROUP BY label)
SELECT kept.vec_id, code, error, label_error, codebooks_sha256
FROM coded JOIN kept ON coded.n = kept.n JOIN totals ON kept.label IS NOT DISTINCT FROM totals.label, digest
"""
