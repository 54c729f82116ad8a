"""Exact top-k search by integer inner product, in three phases with a uniform threshold."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pledgekit.llm.text import field_type
from pledgekit.runtime import stage

# How components become integers.
SCALE = 256
#: Most vectors of a block of rows and of a block of queries, on average.
ROW_BLOCK, QUERY_BLOCK = 8_192, 2_048


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks()
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * flat).reshape(len(values), -1)


def _scores(queries: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, float]:
    """Inner products of whole-number vectors, and how far they may be off: 0 while all sums are exact."""
    bound = queries.shape[1] * np.abs(queries).max(initial=0.0) * np.abs(rows).max(initial=0.0)
    with np.errstate(over="ignore", invalid="ignore"):
        scores = queries @ rows.T
    if not np.isfinite(bound) or bound > 2.0**62:
        raise OverflowError("inner products of these vectors do not fit 64 bits")
    return scores, 0.0 if bound < 2.0**53 else float(bound * 2.0**-51 * queries.shape[1])


def _exact(query: np.ndarray, rows: np.ndarray) -> list[int]:
    q = [int(x) for x in query]
    return [sum(a * int(b) for a, b in zip(q, row, strict=True)) for row in rows]


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    vector: str = "embedding",
    key: str = "vec_id",
    row_block: int = ROW_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, key, score): the ``k`` best rows of every query row, ties to the smaller key.

    Components are ``floor(256 * x)``; a row never answers a query of its own key. Rows and queries are dealt into
    blocks, and a pair of blocks is one task of bounded size, so nothing is broadcast and no task holds all of
    either. Phase 1: every pair of blocks reports its ``k`` best scores of each query, less their possible error; the
    k-th best of all reports is a score that the true k-th best reaches. Phase 2: that cutoff goes back to
    the blocks, which collect the entries that may reach it. Phase 3: collected entries get their exact
    integer score where the products could be off, and are ranked.

    Rows whose key or vector is null, or whose vector is empty or holds null, NaN or infinity, take no part. Only
    vectors of one length meet. Repeated rows count each. Scores beyond 62 bits raise ``OverflowError``.
    """
    kind = field_type(df, key)
    data = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"), is_query.alias("asks"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    data = data.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    data = stage(data.withColumns({"dims": F.size("v"), "at": F.monotonically_increasing_id()}), "vectors")
    n, asked = data.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    row_blocks, query_blocks = max(1, -(-n // row_block)), max(1, -(-asked // query_block))

    def dealt(blocks: int) -> Column:
        return F.pmod(F.xxhash64("at"), F.lit(blocks)).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    rows = data.select("id", "v", "dims", dealt(row_blocks).alias("r"), every(query_blocks).alias("q"))
    queries = data.filter("asks").select(
        F.col("id").alias("query_id"), "at", F.col("v").alias("query_v"), "dims", dealt(query_blocks).alias("q")
    )
    pair = ("dims", "r", "q")

    def report(left: pa.Table, right: pa.Table) -> pa.Table:
        asks, ids = left.column("at").to_pylist(), right.column("id").to_pylist()
        if not asks or not ids:
            return pa.table({"at": pa.array([], pa.int64()), "least": pa.array([], pa.float64())})
        scores, error = _scores(_matrix(left.column("query_v")), _matrix(right.column("v")))
        scores[_own(left, right)] = -np.inf
        best = -np.sort(-np.partition(scores, max(0, len(ids) - k), axis=1)[:, -k:], axis=1)
        real = best > -np.inf
        at = np.repeat(np.array(asks, np.int64), real.sum(axis=1))
        return pa.table({"at": pa.array(at), "least": pa.array(best[real] - error)})

    first = queries.select("*", every(row_blocks).alias("r")).groupBy(*pair).cogroup(rows.groupBy(*pair))
    reports = first.applyInArrow(report, "at bigint, least double")
    by_score = Window.partitionBy("at").orderBy(F.col("least").desc())
    cutoffs = reports.withColumn("n", F.row_number().over(by_score)).filter(F.col("n") == k).select("at", "least")
    told = stage(queries.join(cutoffs, "at", "left"), "cutoffs")

    def collect(left: pa.Table, right: pa.Table) -> pa.Table:
        names, ids = left.column("query_id").to_pylist(), right.column("id").to_pylist()
        out: list[tuple] = []
        if names and ids:
            asked_for, held = _matrix(left.column("query_v")), _matrix(right.column("v"))
            scores, error = _scores(asked_for, held)
            scores[_own(left, right)] = -np.inf
            least = [-np.inf if x is None else x for x in left.column("least").to_pylist()]
            here = np.partition(scores, max(0, len(ids) - k), axis=1)[:, max(0, len(ids) - k)] - error
            for i, name in enumerate(names):
                near = np.flatnonzero((scores[i] + error >= max(least[i], here[i])) & (scores[i] > -np.inf))
                exact = _exact(asked_for[i], held[near]) if error else [int(x) for x in scores[i, near]]
                found = sorted(zip([-s for s in exact], [ids[j] for j in near], strict=True))[:k]
                out += [(name, asks, other, -s) for asks in [left.column("at")[i].as_py()] for s, other in found]
        schema = [left.schema.field("query_id").type, pa.int64(), right.schema.field("id").type, pa.int64()]
        columns = [pa.array([x[c] for x in out], t) for c, t in enumerate(schema)]
        return pa.table(dict(zip(["query_id", "at", "id", "score"], columns, strict=True)))

    second = told.select("*", every(row_blocks).alias("r")).groupBy(*pair).cogroup(rows.groupBy(*pair))
    entries = second.applyInArrow(collect, f"query_id {kind}, at bigint, id {kind}, score bigint")
    order = Window.partitionBy("at").orderBy(F.col("score").desc(), "id")
    ranked = entries.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(key), "score")


def _own(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Positions (query, row) where both have the same key."""
    where: dict = {}
    for j, other in enumerate(right.column("id").to_pylist()):
        where.setdefault(other, []).append(j)
    pairs = [(i, j) for i, name in enumerate(left.column("query_id").to_pylist()) for j in where.get(name, ())]
    return np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)


SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v AS q, v AS c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
