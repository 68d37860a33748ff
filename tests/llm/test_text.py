"""Vectorised words against bytes.split, which cuts at the same six bytes."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from bourse.llm.text import grams, text_slices, words_of

texts = st.lists(st.one_of(st.none(), st.text(st.sampled_from("aB \t\n\x0b\x0c\ré漢  "), max_size=30)), max_size=12)


@settings(max_examples=150, deadline=None)
@given(texts, st.booleans())
def test_words_are_split_at_ascii_space(rows, fold):
    w = words_of(pa.array(rows, pa.string()), fold)
    raw = w.data.tobytes()
    want = [(t or "").encode() for t in rows]
    want = [(t.lower() if fold else t).split() for t in want]
    got = [[] for _ in rows]
    seen = {}
    for d, a, b, h in zip(w.doc, w.start, w.end, w.hash):
        got[d].append(raw[a:b])
        assert seen.setdefault(raw[a:b], h) == h
    assert got == want
    assert len(set(seen.values())) == len(seen)
    g, d = grams(w, 2)
    assert int((d >= 0).sum()) == sum(max(0, len(x) - 1) for x in want)


def test_slices_cover_all_rows_within_the_limit():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (5, 0, 50, 1, 1, 9, 200)])], names=["text"])
    parts = list(text_slices(batch, limit=20))
    assert sum(p.num_rows for p in parts) == 7
    assert all(p.num_rows == 1 or sum(map(len, p.column("text").to_pylist())) <= 20 for p in parts)
    assert list(text_slices(batch.slice(0, 0))) == []


def test_sliced_arrays_keep_their_offset():
    a = pa.array(["skip me", "a b", None, "c"]).slice(1)
    w = words_of(a)
    assert [w.data.tobytes()[s:e] for s, e in zip(w.start, w.end)] == [b"a", b"b", b"c"]
    assert np.array_equal(w.doc, [0, 0, 2])
