"""Common prefixes of suffixes from a Burrows-Wheeler transform, by increasing value up to a bound."""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by their suffixes to ``depth`` bytes at least, ties in any order.

    ``left`` is the number of bytes to the end of the own part, 0 at its terminator. The length of the prefixes that are
    ranked grows by as many ranks as one number holds, three of a text of up to two million bytes.
    """
    n = len(text)
    width, bits = 7, max(1, int(n).bit_length())
    steps = max(2, 64 // bits)
    padded = np.concatenate([text, np.zeros(width, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    valid = np.minimum(left, width)
    for k in range(width):
        key = (key << np.uint64(8)) | np.where(k < valid, padded[k : k + n], np.uint64(0))
    key = (key << np.uint64(3)) | valid.astype(np.uint64)
    while True:
        order = np.argsort(key)
        ranked = key[order]
        fresh = np.empty(n, bool)
        fresh[:1] = True
        np.not_equal(ranked[1:], ranked[:-1], out=fresh[1:])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        if width >= depth or fresh.all():
            return order
        key = rank.astype(np.uint64)
        for k in range(1, steps):
            # Past the own part, nothing follows; that ranks below all that does.
            beyond = np.zeros(n, np.uint64)
            far = np.flatnonzero(left >= k * width)
            beyond[far] = rank[far + k * width]
            key = (key << np.uint64(bits)) | beyond
        width *= steps


def long_prefixes(parts: list[bytes], least: int) -> list[np.ndarray]:
    """For each part, which positions start a string of ``least`` bytes that also starts at another position.

    Strings do not cross parts. All parts, each with a terminator of its own, are one text with its suffixes in
    order; the transform names the byte before each. Breadth first by length, an interval of suffixes that share a
    prefix is extended backward by each byte before it: the suffixes with that longer prefix are an
    interval as well, and where its end is not marked yet, the suffixes on both sides share just the
    length reached so far. Lengths are found in increasing order, and the search stops at ``least``: ends not
    marked by then separate suffixes with at least so long a common prefix.
    """
    sizes = np.array([len(p) for p in parts], np.int64)
    text = np.frombuffer(b"".join(p + b"\0" for p in parts), np.uint8)
    n = len(text)
    if not n:
        return []
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    left = np.repeat(starts + sizes, sizes + 1) - np.arange(n)
    order = suffix_order(text, left, least)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    # Where the suffix that is one byte longer lies; none before the first byte of a part.
    begins = np.zeros(n, bool)
    begins[starts] = True
    longer = np.where(begins[order], -1, place[order - 1])
    byte = text[order].astype(np.int64)
    ends_part = left[order] == 0
    marked = np.zeros(n + 1, bool)
    marked[[0, n]] = True
    marked[1 : len(parts) + 1] = True  # terminators come first and share nothing
    intervals = [np.array([0], np.int64), np.array([n], np.int64)]
    # Terminators, each an interval of one.
    ones = np.arange(len(parts), dtype=np.int64)
    waiting = [ones, ones + 1]
    for _ in range(least):
        begin, end = intervals
        count = end - begin
        total = int(count.sum())
        if total:
            base = np.repeat(begin - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
            to = longer[base + np.arange(total)]
            owner = np.repeat(np.arange(len(begin)), count)
            use = to >= 0
            code = np.sort((owner[use] << 34) | to[use])
            to, owner = code & ((1 << 34) - 1), code >> 34
            # A run of one owner and one byte is an interval again.
            split = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(byte[to], prepend=-1) != 0))
            low = to[split]
            high = to[np.append(split[1:], len(to)) - 1] + 1 if len(to) else low
            inner = ~ends_part[low] if len(low) else np.zeros(0, bool)
            low, high = low[inner], high[inner]
            high, first = np.unique(high, return_index=True)
            low = low[first]
            new = ~marked[high]
            marked[high[new]] = True
            intervals = [low[new], high[new]]
        else:
            intervals = [begin, end]
        if waiting:
            intervals = [np.concatenate([a, b]) for a, b in zip(intervals, waiting, strict=True)]
            waiting = []
        elif not len(intervals[0]):
            break
    alone = marked[:-1] & marked[1:]
    again = np.zeros(n, bool)
    again[order] = ~alone
    again &= left >= least
    return [again[a : a + size] for a, size in zip(starts.tolist(), sizes.tolist(), strict=True)]
