from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from tests.llm import brute
from tickstream.llm.textbatch import Rolling, distinct_in_rows, pieces, shingles, text_bytes, words

TEXTS = st.lists(st.one_of(st.none(), st.text("aB \n\té", max_size=40)), min_size=1, max_size=6)


@given(TEXTS)
def test_words(texts):
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    start, end, row = words(data, offsets)
    got = [[] for _ in texts]
    for s, e, r in zip(start, end, row):
        got[r].append(data[s:e].tobytes())
    assert got == [brute.words(t) for t in texts]


@given(TEXTS, st.integers(1, 4))
def test_shingle_sets_agree_where_texts_do(texts, width):
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    hashes, rows = distinct_in_rows(*shingles(data, offsets, width))
    sets = [set(hashes[rows == k].tolist()) for k in range(len(texts))]
    plain = [brute.shingle_set(t, width) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in plain]
    for a in range(len(texts)):
        for b in range(len(texts)):
            assert len(sets[a] & sets[b]) == len(plain[a] & plain[b])


@given(st.binary(max_size=60))
def test_rolling_hashes_tell_substrings_apart(raw):
    data = np.frombuffer(raw, np.uint8)
    hasher = Rolling(data)
    spans = [(a, b) for a in range(len(raw)) for b in range(a, len(raw) + 1)]
    if spans:
        values = hasher(*map(np.array, zip(*spans)))
        seen: dict = {}
        for (a, b), value in zip(spans, values.tolist()):
            if b > a:
                assert seen.setdefault(value, raw[a:b]) == raw[a:b]


def test_sliced_and_null_columns():
    column = pa.array(["ab", None, "", "é"]).slice(1)
    data, offsets = text_bytes(column)
    assert data.tobytes() == "é".encode() and offsets.tolist() == [0, 0, 0, 2]
    assert list(pieces(np.array([0, 5, 9, 30, 31]), 10)) == [(0, 2), (2, 3), (3, 4)]
