"""Vector codes and hard negatives against brute force in Python integers, and the edge cases their docstrings name."""

import collections
import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pledgekit.llm import hard_negatives, limbs, vector_codes

SCHEMA = "vec_id bigint, embedding array<double>, label int, id string, code int, score string, at int"


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


# Limbs

WHOLE = st.integers(-(2**27), 2**27)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6).flatmap(lambda w: st.tuples(*[st.lists(st.lists(WHOLE, min_size=w, max_size=w), min_size=1, max_size=4)] * 2)))
def test_products_are_exact(sides):
    left, right = sides
    got = limbs.exact_dot(np.array(left, np.int64), np.array(right, np.int64))
    assert got.tolist() == [[sum(a * b for a, b in zip(x, y, strict=True)) for y in right] for x in left]


def test_products_of_several_limbs():
    r = np.random.default_rng(1)
    left, right = r.integers(-(2**56), 2**56, (5, 8)), r.integers(-7, 8, (7, 8))
    assert len(limbs.split_limbs(left, limbs.limb_bits(8))) == 3
    want = [[sum(int(a) * int(b) for a, b in zip(x, y, strict=True)) for y in right] for x in left]
    assert limbs.exact_dot(left, right).tolist() == want
    with pytest.raises(OverflowError):
        limbs.exact_dot(left, left)
    assert limbs.peak(np.array([[-(2**63)]])) == 2**63


def test_limb_products_stay_exact_in_any_order():
    for width in (1, 2, 3, 16, 17, 1536):
        assert width * (1 << limbs.limb_bits(width)) ** 2 <= 1 << 53


# Vector codes


def brute_codes(rows, parts=4, entries=256, rounds=4):
    good = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if usable(v)]
    by_id = collections.defaultdict(list)
    for i, v, _ in good:
        if i is not None:
            by_id[i].append(v)
    width = len(min(by_id[min(by_id)]))
    good = [g for g in good if len(g[1]) == width]
    by_id = {i: [v for v in own if len(v) == width] for i, own in by_id.items()}
    seeds = [min(by_id[i]) for i in sorted(i for i in by_id if by_id[i])[:entries]]
    w = width // parts
    books = [[s[p * w : p * w + w] for s in seeds] for p in range(parts)]

    def nearest(v, p):
        own = v[p * w : p * w + w]
        return min((sum((a - b) ** 2 for a, b in zip(own, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        members = collections.defaultdict(list)
        for _, v, _ in good:
            for p in range(parts):
                members[p, nearest(v, p)[1]].append(v[p * w : p * w + w])
        for (p, k), own in members.items():
            books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    out, totals = [], collections.Counter()
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    for i, v, label in good:
        found = [nearest(v, p) for p in range(parts)]
        totals[label] += sum(d for d, _ in found)
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
    return collections.Counter((i, c, e, totals[label], digest) for i, c, e, label in out)


@pytest.fixture(scope="module")
def rows():
    """Ties, copies, repeated ids, nulls in every column, odd values, other lengths."""
    r = np.random.default_rng(3)
    out = [(int(i), [float(x) for x in r.normal(size=8).round(2)], int(i % 4)) for i in r.permutation(90)]
    out += [(i, out[5][1], 1) for i in range(200, 230)]  # one common vector
    out += [out[3], out[3], (out[4][0], [0.5] * 8, 2)]  # repeated rows, and an id of two vectors
    out += [(None, [0.25] * 8, 1), (None, None, None), (300, [1.0] * 8, None), (301, [-1.0] * 8, None)]
    out += [(310, None, 1), (311, [1.0, None] * 4, 1), (312, [float("nan")] * 8, 1), (313, [float("-inf")] * 8, 1), (314, [], 1)]
    out += [(320, [1.0, 2.0, 3.0, 4.0], 2), (321, [1.0], 2), (322, [0.0] * 8, 2), (350, [0.1] * 8, 3), (350, [0.1] * 8, 3)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*x, "clash", 1, "clash", 2) for x in rows], SCHEMA)


@pytest.mark.parametrize(("entries", "rounds"), [(256, 4), (5, 4), (3, 0)])
def test_codes(spark, rows, entries, rounds):
    got = vector_codes.vector_codes(frame(spark, rows).repartition(5), entries=entries, rounds=rounds).collect()
    want = brute_codes(rows, entries=entries, rounds=rounds)
    assert collections.Counter((x.vec_id, x.code, x.error, x.label_error, x.codebooks_sha256) for x in got) == want


def test_codes_of_large_components(spark):
    r = np.random.default_rng(5)
    rows = [(i, [float(x) for x in r.integers(-(2**17), 2**17, 4)], 0) for i in range(40)]
    got = vector_codes.vector_codes(frame(spark, rows), entries=4).collect()
    assert collections.Counter((x.vec_id, x.code, x.error, x.label_error, x.codebooks_sha256) for x in got) == brute_codes(rows, entries=4)
    with pytest.raises(Exception, match="64 bits"):
        vector_codes.vector_codes(frame(spark, [(1, [1e300] * 4, 0), (2, [0.0] * 4, 0)])).collect()


def test_codes_without_rows(spark):
    assert vector_codes.vector_codes(frame(spark, [])).collect() == []
    assert vector_codes.vector_codes(frame(spark, [(1, None, 1), (2, [], 1)])).collect() == []
    assert vector_codes.vector_codes(frame(spark, [(None, [1.0] * 4, 1)])).collect() == []
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.vector_codes(frame(spark, [(1, [1.0] * 6, 1)]))


def test_entries_without_rows_stay(spark):
    rows = [(0, [0.0] * 4, 0), (1, [0.0] * 4, 0), (2, [5.0] * 4, 0)]
    got = {x.vec_id: x.code for x in vector_codes.vector_codes(frame(spark, rows)).collect()}
    assert got == {0: "00000000", 1: "00000000", 2: "02020202"}


# Hard negatives


def brute_negatives(rows, positives=5, negatives=3):
    good = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if usable(v) and i is not None and label is not None]
    out = []
    for i, v, label in (g for g in good if g[0] % 50 == 0):
        others = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, m) for j, w, m in good if j != i and len(w) == len(v))
        for ps, j in [(-s, j) for s, j, m in others if m == label][:positives]:
            inside = [(-s, k) for s, k, m in others if m != label and 50 * ps <= -100 * s <= 95 * ps][:negatives]
            out += [(i, j, n, k, ps, s) for n, (s, k) in enumerate(inside, 1)]
    return collections.Counter(out)


@pytest.mark.parametrize(("row_block", "anchor_block"), [(8192, 4096), (20, 1)])
def test_negatives(spark, rows, row_block, anchor_block, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHOR_SLICE", 2)
    # Rows around 0 and of equal scores: windows of score 0, ties at their ends, more ties than negatives.
    r = np.random.default_rng(8)
    more = rows + [(400 + i, [float(x) for x in r.integers(0, 3, 8)], int(i % 3)) for i in range(80)]
    more += [(500, [0.0] * 8, 1), (550, [1.0] + [0.0] * 7, 0), (551, [0.0, 1.0] + [0.0] * 6, 0), (50, [2.0] * 8, 2)]
    df = frame(spark, more).repartition(4)
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 50 == 0, row_block=row_block, anchor_block=anchor_block)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    found = collections.Counter(tuple(x[n] for n in names) for x in got.collect())
    assert found == brute_negatives(more) and found


def test_labels_may_be_computed_first(spark, rows):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 50 == 0, moved).collect()
    want = brute_negatives([(i, v, (m + 1) % 10 if i is not None and m is not None and i % 7 == 0 else m) for i, v, m in rows])
    assert collections.Counter(tuple(x) for x in got) == want


def test_negatives_without_rows(spark):
    for rows in ([], [(50, None, 1)], [(50, [1.0], 1)], [(50, [1.0], 1), (51, [1.0], 2)], [(None, [1.0], None)]):
        assert hard_negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 50 == 0).collect() == []


def test_windows_of_whole_scores():
    assert [hard_negatives.window(s) for s in (100, 3, 1, 0, -2)] == [(50, 95), (2, 2), (1, 0), (0, 0), (-1, -2)]


def test_the_stream_of_an_anchor_is_never_held():
    """The stream remembers the open windows of the current anchor, whatever the number of its negatives."""
    n = 5_000
    one = pa.RecordBatch.from_pydict(
        {"at": [1] * (n + 1), "anchor": [7] * (n + 1), "score": [100] + [90] * n, "negative": [False] + [True] * n, "id": list(range(n + 1))}
    )
    batches = [one.slice(i, 100) for i in range(0, n + 1, 100)]
    read = iter(batches)
    emit = hard_negatives._emit(3)(read)
    first = next(emit)
    assert first.column("negative_id").to_pylist() == [1, 2, 3] and first.column("rank").to_pylist() == [1, 2, 3]
    assert len(list(read)) == len(batches) - 1  # nothing beyond the first batch had been read


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-3, 3), max_size=30), st.integers(1, 4))
def test_best_of_ties(scores, n):
    scores, rows = np.array(scores, np.int64), np.arange(len(scores))
    want = sorted(rows.tolist(), key=lambda i: (-scores[i], i))[:n]
    assert hard_negatives._best(scores, rows, n).tolist() == want
