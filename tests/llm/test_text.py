"""Word hashes and slices against plain Python."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pledgekit.llm.bwt import long_prefixes
from pledgekit.llm.text import raw, sliced, word_hashes

TEXTS = st.lists(st.one_of(st.none(), st.text("aAbB \n\t\x0bé.", max_size=40)), max_size=6)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_word_hashes_follow_the_words(texts):
    hashes, firsts = word_hashes(*raw(pa.array(texts, pa.string())))
    words = [re.findall("[^\x20\x09-\x0d]+", lower(t or "")) for t in texts]
    assert np.diff(firsts).tolist() == [len(w) for w in words]
    seen = {}
    for word, value in zip([w for own in words for w in own], hashes.tolist(), strict=True):
        assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=50, deadline=None)
@given(TEXTS)
def test_slices_hold_all_rows_in_order(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    parts = list(sliced(batch, "text", 10))
    assert [v for p in parts for v in p.column(0).to_pylist()] == texts
    assert all(p.num_rows == 1 or sum(len((v or "").encode()) for v in p.column(0).to_pylist()) <= 10 for p in parts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.binary(max_size=25).map(lambda b: bytes(97 + x % 2 for x in b)), max_size=6), st.integers(1, 9))
def test_long_prefixes_are_the_strings_that_start_twice(parts, least):
    counts = {}
    for p in parts:
        for i in range(len(p) - least + 1):
            counts[p[i : i + least]] = counts.get(p[i : i + least], 0) + 1
    wanted = [[i + least <= len(p) and counts[p[i : i + least]] > 1 for i in range(len(p))] for p in parts]
    assert [x.tolist() for x in long_prefixes(parts, least)] == wanted


def test_no_text_at_all():
    assert word_hashes(*raw(pa.array([], pa.string())))[0].tolist() == []
    assert word_hashes(*raw(pa.array([None, ""], pa.string())))[1].tolist() == [0, 0, 0]


@pytest.mark.parametrize("size", [1, 3])
def test_long_text_is_a_slice_of_its_own(size):
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 100] * size)], names=["text"])
    assert len(list(sliced(batch, "text", 10))) == size
