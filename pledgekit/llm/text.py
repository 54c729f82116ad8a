"""Texts inside tasks: bounded slices of Arrow batches, and hashes of words without a loop over characters."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a task looks at together; a longer text makes a slice of its own.
SLICE_BYTES = 2 << 20

_M = np.uint64(0x9E3779B97F4A7C15)
_M_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def field_type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def sliced(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with at most ``limit`` bytes of text each, one row at least."""
    column = batch.column(batch.schema.get_field_index(text))
    ends = np.cumsum([len(v) for v in _views(column)], dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        done = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _views(column: pa.Array) -> list[memoryview]:
    data, offsets = raw(column)
    return [memoryview(data[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and the offsets of the texts; null is empty."""
    filled = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(filled.buffers()[1], dtype=np.int64)[filled.offset : filled.offset + len(filled) + 1]
    if not len(filled) or filled.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(filled) + 1, np.int64)
    data = np.frombuffer(filled.buffers()[2], dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def map_texts(
    df: DataFrame,
    columns: dict[str, str],
    schema: str,
    work: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    text: str = "text",
) -> DataFrame:
    """Apply ``work`` to slices of the chosen columns (own name -> column of ``df``), partition by partition.

    Only the chosen columns leave the JVM, so other columns may have any name.
    """
    chosen = df.select(*[F.col(f"`{c}`").alias(name) for name, c in columns.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, text):
                out = work(part)
                if out is not None and out.num_rows:
                    yield out

    return chosen.mapInArrow(run, schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: np.uint64 = _M) -> np.ndarray:
    """Powers 0 to n of an odd base; a worker keeps those for slices of the usual size."""
    known = _POWERS.get(int(base))
    if known is None or len(known) <= n:
        known = np.full(max(n, SLICE_BYTES) + 1, base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if n <= SLICE_BYTES:
            _POWERS[int(base)] = known
    return known[: n + 1]


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _M)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def prefix_hashes(data: np.ndarray, table: np.ndarray = _BYTE) -> tuple[np.ndarray, np.ndarray]:
    """Running polynomial hash over bytes (with a leading 0), and the inverse powers that align its differences."""
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(table[data] * powers(n)[:n], out=total[1:])
    return total, powers(n, _M_INVERSE)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of all texts in order, and each text's first word.

    With ``lower``, A-Z count as a-z.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    cuts = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    total, inverse = prefix_hashes(_LOWER[data] if lower else data)
    hashes = mix64((total[stops] - total[starts]) * inverse[starts] + (stops - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)
