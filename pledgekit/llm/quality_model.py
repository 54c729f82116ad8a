"""Quality classifier: n-gram indicators scaled by naive Bayes log-count ratios, and a linear hinge-loss model."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgekit.llm.text import field_type, map_texts, mix64, raw, sliced, word_hashes
from pledgekit.runtime import stage

#: The model is fitted on about so many labelled documents, chosen by a hash of their key.
FIT_ROWS = 3_000
#: N-grams are hashed to so many indicators.
SLOTS = 1 << 18
#: Lengths of the character n-grams, in bytes, and of the runs of one word that count as repetition.
GRAMS = (2, 3, 4)
REPEATS = (2, 3, 5)
SMOOTHING = 1.0
COST, EPOCHS, SEED = 0.1, 6, 42
THRESHOLD = 0.3


@dataclass
class QualityModel:
    """Weight per indicator (ratio times hinge-loss weight), intercept, and the scale from margin to score."""

    weights: np.ndarray
    intercept: float
    slope: float
    offset: float


def indicators(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Slots of each text's n-grams, each once: character n-grams of the bytes as they are, word unigrams and
    bigrams without regard to case, and repetitions of one word."""
    words, firsts = word_hashes(data, offsets)
    wide = data.astype(np.uint64)
    grams = []
    for n in GRAMS:
        code = np.full(max(len(data) - n + 1, 0), n, np.uint64)
        for k in range(n):
            code = code * np.uint64(257) + wide[k : len(data) - n + 1 + k]
        grams.append((n, (mix64(code) % np.uint64(SLOTS)).astype(np.int32)))
    unigrams = (mix64(words) % np.uint64(SLOTS)).astype(np.int32)
    pairs = (mix64(words[:-1] * np.uint64(3) + words[1:]) % np.uint64(SLOTS)).astype(np.int32)
    same = words[1:] == words[:-1]
    out = []
    for i in range(len(offsets) - 1):
        a, b, f, g = int(offsets[i]), int(offsets[i + 1]), int(firsts[i]), int(firsts[i + 1])
        parts = [codes[a : max(a, b - n + 1)] for n, codes in grams]
        parts += [unigrams[f:g], pairs[f : max(f, g - 1)]]
        run = _longest_run(same[f : max(f, g - 1)]) + 1
        parts.append(np.array([k for k, n in enumerate(REPEATS) if run >= n], np.int32))
        out.append(np.unique(np.concatenate(parts)))
    return out


def _longest_run(flags: np.ndarray) -> int:
    if not flags.any():
        return 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return int((edges[1::2] - edges[::2]).max())


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """log of the smoothed share of each indicator among documents of label 1 over that among label 0."""
    shares = []
    for label in (1, 0):
        count, n = np.zeros(SLOTS), 0
        for row, y in zip(rows, labels, strict=True):
            if y == label:
                count[row] += 1  # a document has each of its slots once
                n += 1
        shares.append((count + SMOOTHING) / (n + 2 * SMOOTHING))
    return np.log(shares[0] / shares[1])


def dual_coordinate_descent(
    rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, cost: float = COST, epochs: int = EPOCHS
) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise the squared norm and ``cost`` times the hinge losses.

    One dual variable per document is solved exactly at a time, in a seeded random order. A document's values are
    the ratios of its indicators over the root of their number, and a constant for the intercept. The rarer
    class costs more, so that both weigh the same.
    """
    order = np.random.default_rng(SEED)
    y = np.where(labels == 1, 1.0, -1.0)
    share = max(1e-9, float((y > 0).mean()))
    upper = np.where(y > 0, cost / (2 * share), cost / (2 * max(1e-9, 1 - share)))
    # Values are looked up again at every step; held for all documents, they would be most of the task's memory.
    roots = [np.sqrt(max(len(r), 1)) for r in rows]
    norms = np.array([v @ v + 1.0 for v in (ratios[r] / root for r, root in zip(rows, roots, strict=True))])
    alpha, w, b = np.zeros(len(rows)), np.zeros(SLOTS), 0.0
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            value = ratios[rows[i]] / roots[i]
            gradient = y[i] * (w[rows[i]] @ value + b) - 1.0
            new = min(max(alpha[i] - gradient / norms[i], 0.0), upper[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[rows[i]] += step * value
                b += step
                alpha[i] = new
    return w * ratios, b


def margins(rows: list[np.ndarray], weights: np.ndarray, intercept: float) -> np.ndarray:
    return np.array([weights[r].sum() / np.sqrt(max(len(r), 1)) + intercept for r in rows])


#: Bytes of text whose indicators a task holds at a time when it scores.
SCORE_BYTES = 512 << 10


def text_margins(texts: pa.Array, model: QualityModel) -> np.ndarray:
    """Margins of texts, a few at a time, as their indicators take many times the room of the text."""
    parts = sliced(pa.RecordBatch.from_arrays([texts], names=["text"]), "text", SCORE_BYTES)
    found = [margins(indicators(*raw(p.column(0))), model.weights, model.intercept) for p in parts]
    return np.concatenate(found or [np.zeros(0)])


def _scale(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from margin to the share of label 1 (Newton steps, lightly damped)."""
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    t = np.where(labels == 1, 1 - 1 / (labels.sum() + 2), 1 / ((1 - labels).sum() + 2))
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (t - p) - 1e-3 * (beta - [1.0, 0.0]))
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(beta[0], 1e-3)), float(beta[1])


def fit(texts: pa.Array, labels: np.ndarray) -> QualityModel:
    """Fit on four fifths of the rows, scale the margins on the last fifth."""
    rows: list[np.ndarray] = []
    for part in sliced(pa.RecordBatch.from_arrays([texts], names=["text"]), "text", SCORE_BYTES):
        rows += indicators(*raw(part.column(0)))
    if len(set(labels.tolist())) < 2:
        # Nothing to tell apart: every text scores like the only label, or one half without labels.
        share = (labels.sum() + 1.0) / (len(labels) + 2.0)
        return QualityModel(np.zeros(SLOTS, np.float32), 0.0, 1.0, float(np.log(share / (1 - share))))
    apart = np.arange(len(rows)) % 5 == 4
    if len(set(labels[apart].tolist())) < 2 or len(set(labels[~apart].tolist())) < 2:
        apart = np.zeros(len(rows), bool)
    inner = [r for r, out in zip(rows, apart, strict=True) if not out]
    ratios = log_count_ratios(inner, labels[~apart])
    weights, intercept = dual_coordinate_descent(inner, labels[~apart], ratios)
    outer = apart if apart.any() else ~apart
    margin = margins([r for r, out in zip(rows, outer, strict=True) if out], weights, intercept)
    return QualityModel(weights.astype(np.float32), intercept, *_scale(margin, labels[outer]))


def learn_quality(
    df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", fit_rows: int = FIT_ROWS
) -> QualityModel:
    """Fit on about ``fit_rows`` of the documents with a label of 0 or 1; the sample goes to one task, by its bound.

    Rows with a null text count as empty, rows without key or label teach nothing. Labels are joined by key; of a key's
    several labels the larger counts.
    """
    marks = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("label"))
    marks = marks.filter(F.col("label").isin(0, 1))
    # A key that is marked more than once teaches once, so the sample below is bounded whatever the keys are.
    marks = marks.filter(F.col("key").isNotNull()).groupBy("key").agg(F.max("label").alias("label"))
    n = max(1, marks.count())
    chosen = marks.filter(F.pmod(F.xxhash64(F.col("key"), F.lit("fit")), F.lit(1 << 20)) < fit_rows / n * (1 << 20))
    docs = df.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    # The sample's keys are bounded by `fit_rows`, so all documents pass by a small table instead of a shuffle.
    sample = stage(docs.join(F.broadcast(chosen), "key"), "quality-sample")

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("text", "ascending")])
        model = fit(table.column("text").combine_chunks(), table.column("label").to_numpy())
        packed = [model.weights.astype("<f4").tobytes()]
        return pa.table({"weights": pa.array(packed, pa.binary()), "terms": [[model.intercept, model.slope, model.offset]]})

    row = sample.groupBy(F.lit(0).alias("all")).applyInArrow(train, "weights binary, terms array<double>").first()
    if row is None:
        return fit(pa.array([], pa.string()), np.zeros(0, int))
    return QualityModel(np.frombuffer(row["weights"], "<f4"), *row["terms"])


def score_quality(
    df: DataFrame, model: QualityModel, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Key, ``keep`` columns, ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` of every whole text.

    Null and empty texts have no indicators and get the score of the intercept. Repeated rows are scored each,
    null keys stay null, an empty table gives no rows. One narrow pass; the model's size is fixed by ``SLOTS``.
    """
    shared = df.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        m = QualityModel(*shared.value)
        margin = text_margins(part.column("text"), m)
        score = 1 / (1 + np.exp(-np.clip(m.slope * margin + m.offset, -30, 30)))
        columns = [*(part.column(f"k{i}") for i in range(1 + len(keep))), pa.array(score), pa.array((score >= threshold).astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, names=[*(f"k{i}" for i in range(1 + len(keep))), "score", "predicted"])

    kept = [key, *keep]
    fields = ", ".join(f"k{i} {field_type(df, c)}" for i, c in enumerate(kept))
    chosen = {f"k{i}": c for i, c in enumerate(kept)} | {"text": text}
    scored = map_texts(df, chosen, f"{fields}, score double, predicted int", work)
    return scored.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(kept)], "score", "predicted")


def filter_quality(df: DataFrame, model: QualityModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` whose text scores ``threshold`` or more, all columns as they are; cases as in ``score_quality``."""
    shared = df.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))
    names = {f"c{i}": c for i, c in enumerate(df.columns)}
    own = f"c{df.columns.index(text)}"

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        m = QualityModel(*shared.value)
        margin = text_margins(part.column(part.schema.get_field_index(own)), m)
        score = 1 / (1 + np.exp(-np.clip(m.slope * margin + m.offset, -30, 30)))
        return part.filter(pa.array(score >= threshold))

    schema = ", ".join(f"{n} {field_type(df, c)}" for n, c in names.items())
    return map_texts(df, names, schema, work, own).toDF(*df.columns)
