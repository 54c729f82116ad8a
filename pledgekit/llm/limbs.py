"""Exact products of integer matrices on floating-point hardware: limbs whose float64 sums stay below 2^53."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def whole_matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """The rows of a column of equally long lists of 64-bit integers as a matrix."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(values), width)


def peak(rows: np.ndarray) -> int:
    """Greatest magnitude in a matrix of 64-bit integers, as a Python integer (the least one has no 64-bit magnitude)."""
    return max(int(rows.max(initial=0)), -int(rows.min(initial=0)))


def limb_bits(width: int) -> int:
    """Bits of a limb, so that ``width`` products of two limbs add up to 2^53 at most."""
    return (53 - max(width - 1, 0).bit_length()) // 2


def split_limbs(rows: np.ndarray, bits: int) -> list[np.ndarray]:
    """Limbs of integers, lowest first, as float64: all but the last lie in [0, 2^bits), the last has the sign."""
    limbs = []
    while peak(rows) > 1 << bits:
        limbs.append((rows & ((1 << bits) - 1)).astype(np.float64))
        rows = rows >> bits
    return [*limbs, rows.astype(np.float64)]


def exact_dot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``left @ right.T`` of 64-bit integers without rounding; ``OverflowError`` where 64 bits may not hold a result.

    Every product of two limbs is a float64 matrix product of whole numbers below 2^53, hence exact in any order of
    summation. The limbs' products are shifted and added as 64-bit integers.
    """
    width = left.shape[1]
    if width * peak(left) * peak(right) >= 1 << 63:
        raise OverflowError("inner products of these vectors do not fit 64 bits")
    bits = limb_bits(width)
    low, high = split_limbs(left, bits), split_limbs(right, bits)
    total = np.zeros((len(left), len(right)), np.int64)
    for i, a in enumerate(low):
        for j, b in enumerate(high):
            # Shifted parts may pass 64 bits on the way; sums modulo 2^64 still end at the result, which fits.
            total += (a @ b.T).astype(np.int64) << np.int64(min(bits * (i + j), 63)) if bits * (i + j) < 64 else 0
    return total
