"""Hard-negative mining: pair scores sorted by anchor and score, read as a stream that opens the positives' windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pledgekit.llm.limbs import exact_dot, whole_matrix
from pledgekit.llm.text import field_type
from pledgekit.llm.vector_codes import whole_vectors
from pledgekit.runtime import stage

# How components become integers, positives of an anchor, negatives of a positive, and the window in percent.
SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95
#: Most vectors of a block of rows and of a block of anchors, on average, and anchors whose scores a task holds at a time.
ROW_BLOCK, ANCHOR_BLOCK, ANCHOR_SLICE = 8_192, 4_096, 256


def window(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """Least and greatest whole score s with ``low * score <= 100 * s <= high * score``; empty where the first is greater."""
    return -(-low * score // 100), high * score // 100


class _Block:
    """Rows of one task in order of their ids, scored against anchors slice by slice."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by("id")
        self.ids = rows.column("id").combine_chunks()
        self.names = self.ids.to_pylist()
        self.labels = rows.column("label").combine_chunks().to_pylist()
        self.width = rows.column("dims")[0].as_py() if rows.num_rows else 0
        self.vectors = whole_matrix(rows.column("v"), self.width) if rows.num_rows else np.zeros((0, 0), np.int64)
        # Labels and ids as numbers, so that whole rows of scores are compared at once.
        self.label_of: dict = {}
        self.label_at = np.array([self.label_of.setdefault(x, len(self.label_of)) for x in self.labels], np.int64)
        self.at_of: dict = {}
        for i, name in enumerate(self.names):
            self.at_of.setdefault(name, []).append(i)

    def scores(self, anchors: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(number of the anchor, its scores, rows of its label, rows of other labels); its own id is in neither."""
        if not len(self.names) or not anchors.num_rows:
            return
        vectors = whole_matrix(anchors.column("v"), self.width)
        for start in range(0, anchors.num_rows, ANCHOR_SLICE):
            found = exact_dot(vectors[start : start + ANCHOR_SLICE], self.vectors)
            for i, scores in enumerate(found, start):
                same = self.label_at == self.label_of.get(anchors.column("label")[i].as_py(), -1)
                other = ~same
                own = self.at_of.get(anchors.column("anchor")[i].as_py(), [])
                same[own] = other[own] = False
                yield i, scores, np.flatnonzero(same), np.flatnonzero(other)


def _best(scores: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` first of the rows (ascending), higher scores first, ties to the lower row."""
    if len(rows) > 4 * n:
        least = np.partition(scores[rows], len(rows) - n)[len(rows) - n]
        above, level = rows[scores[rows] > least], rows[scores[rows] == least]
        rows = np.concatenate([above, level[: n - len(above)]])
        rows.sort()
    return rows[np.argsort(-scores[rows], kind="stable")[:n]]


def _table(schema: list[tuple[str, pa.DataType]], columns: list) -> pa.Table:
    return pa.table({name: pa.array(c, kind) for (name, kind), c in zip(schema, columns, strict=True)})


def hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    label: Column | str = "label",
    vector: str = "embedding",
    key: str = "vec_id",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    row_block: int = ROW_BLOCK,
    anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and positive.

    Scores are inner products of ``floor(256 * x)``. An anchor's positives are its ``positives`` best rows of its
    label; a positive's negatives are the ``negatives`` best rows of other labels with 50 to 95 percent of its score.

    1. Rows and anchors are dealt into blocks, and a pair of blocks is one task of bounded size that reports each anchor's
    best rows of its label; the best of these reports are the positives. 2. Pairs of blocks report, for the window of each
    positive, the best rows of other labels: whatever is first among all is first in its block. 3. Positives and reports
    are shuffled by anchor and sorted within partitions by (anchor, descending score, positives before negatives, id). One
    pass over that stream opens a window as its positive comes and emits negatives as they come. It
    remembers the open windows of one anchor only, so no anchor's pairs are ever held, and a window that
    has its negatives or lies above the score is closed.

    Rows with a null key, null label, or a vector that is null, empty, or holds null, NaN or infinity take no part.
    Only vectors of one length meet. A row is no partner of its own key. Repeated rows count each, and a repeated anchor
    has its rows each time. Positives of a score below 0 have an empty window. Scores beyond 63 bits raise
    ``OverflowError``. An empty table gives no rows; other columns are not read, whatever their names.
    """
    kind = field_type(df, key)
    shown = F.col(f"`{label}`") if isinstance(label, str) else label
    data = df.select(
        F.col(f"`{key}`").alias("id"), shown.alias("label"), whole_vectors(df, vector, SCALE).alias("v"), is_anchor.alias("asks")
    )
    data = data.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
    data = stage(data.withColumns({"dims": F.size("v"), "at": F.monotonically_increasing_id()}), "mining-rows")
    n, asked = data.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    row_blocks, anchor_blocks = max(1, -(-n // row_block)), max(1, -(-asked // anchor_block))

    def dealt(blocks: int) -> Column:
        return F.pmod(F.xxhash64("at"), F.lit(blocks)).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    pair = ("dims", "r", "q")
    rows = data.select("id", "label", "v", "dims", dealt(row_blocks).alias("r"), every(anchor_blocks).alias("q"))
    anchors = data.filter("asks").select(F.col("id").alias("anchor"), "at", "label", "v", "dims", dealt(anchor_blocks).alias("q"))

    def near(left: pa.Table, right: pa.Table) -> pa.Table:
        block, out = _Block(right), ([], [], [])
        at = left.column("at").to_pylist()
        for i, scores, same, _ in block.scores(left):
            found = _best(scores, same, positives)
            out[0].extend([at[i]] * len(found))
            out[1].extend(scores[found].tolist())
            out[2].extend(block.names[j] for j in found)
        return _table([("at", pa.int64()), ("score", pa.int64()), ("id", block.ids.type)], list(out))

    first = anchors.select("*", every(row_blocks).alias("r")).groupBy(*pair).cogroup(rows.groupBy(*pair))
    reports = first.applyInArrow(near, f"at bigint, score bigint, id {kind}")
    order = Window.partitionBy("at").orderBy(F.col("score").desc(), "id")
    best = reports.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= positives)
    best = stage(best, "mining-positives")
    # Windows are at most ``positives`` numbers per anchor, so they travel with the anchor's row.
    marks = best.groupBy("at").agg(F.sort_array(F.collect_set("score")).alias("marks"))
    told = stage(anchors.join(marks, "at"), "mining-anchors")

    def far(left: pa.Table, right: pa.Table) -> pa.Table:
        block, out = _Block(right), ([], [], [])
        at, marks = left.column("at").to_pylist(), left.column("marks").to_pylist()
        for i, scores, _, other in block.scores(left):
            found: set[int] = set()
            for mark in marks[i]:
                low, high = window(mark)
                inside = other[(scores[other] >= low) & (scores[other] <= high)]
                found.update(_best(scores, inside, negatives).tolist())
            out[0].extend([at[i]] * len(found))
            out[1].extend(int(scores[j]) for j in found)
            out[2].extend(block.names[j] for j in found)
        return _table([("at", pa.int64()), ("score", pa.int64()), ("id", block.ids.type)], list(out))

    second = told.select("*", every(row_blocks).alias("r")).groupBy(*pair).cogroup(rows.groupBy(*pair))
    entries = second.applyInArrow(far, f"at bigint, score bigint, id {kind}")
    stream = (
        best.select("at", "score", F.lit(False).alias("negative"), "id")
        .union(entries.select("at", "score", F.lit(True), "id"))
        .join(anchors.select("at", F.col("anchor")), "at")
        .repartition("at")
        .sortWithinPartitions("at", F.col("score").desc(), "negative", "id")
    )
    shape = f"anchor_id {kind}, positive_id {kind}, rank int, negative_id {kind}, positive_score bigint, negative_score bigint"
    return stream.select("at", "anchor", "score", "negative", "id").mapInArrow(_emit(negatives), shape)


def _emit(negatives: int):
    """Read (at, anchor, score, negative, id) in order and give each open window its next negative."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, windows = None, []  # a window: [positive, its score, least and greatest score, negatives so far]
        for batch in batches:
            out: list[tuple] = []
            for at, anchor, score, negative, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != current:
                    current, windows = at, []
                if not negative:
                    low, high = window(score)
                    if low <= high:
                        windows.append([name, score, low, high, 0])
                    continue
                windows = [w for w in windows if w[4] < negatives and w[2] <= score]
                for w in windows:
                    if score <= w[3]:
                        w[4] += 1
                        out.append((anchor, w[0], w[4], name, w[1], score))
            if out:
                kind = batch.schema.field("anchor").type
                kinds = [kind, kind, pa.int32(), kind, pa.int64(), pa.int64()]
                names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


SQL = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
         CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v AS a, v AS c WHERE a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.e) = len(c.e)),
positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS n FROM pairs WHERE same)
  WHERE n <= {POSITIVES}),
mined AS (
  SELECT p.anchor_id, p.other_id AS positive_id, x.other_id AS negative_id, p.score AS positive_score, x.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.n ORDER BY x.score DESC, x.other_id) AS INT) AS rank
  FROM positives AS p JOIN pairs AS x ON p.anchor_id = x.anchor_id AND NOT x.same
   AND {LOW} * p.score <= 100 * x.score AND 100 * x.score <= {HIGH} * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM mined WHERE rank <= {NEGATIVES}
"""
