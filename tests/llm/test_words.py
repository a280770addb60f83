from __future__ import annotations

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from facetrank.llm import words

TEXTS = st.lists(
    st.text(st.sampled_from("abAZé \n\t\x0b\x1cß"), max_size=12) | st.just("long" * 40), max_size=6
)


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(0, 2), st.booleans())
def test_hashes_stand_for_words(texts, skip, lower):
    """Equal words have equal hashes, others do not; counts are those of split()."""
    data = [t.encode() for t in texts]
    column = pa.array([b"skipped text"] * skip + data, pa.binary()).slice(skip)
    hashes, counts = words.word_hashes(column, lower)
    split = [(t.lower() if lower else t).split() for t in data]
    assert counts.tolist() == [len(s) for s in split]
    flat = [w for s in split for w in s]
    assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat)) == len(set(hashes.tolist()))


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(1, 30))
def test_parts_cover_all_rows(texts, size):
    batch = pa.RecordBatch.from_arrays([pa.array([t.encode() for t in texts], pa.binary())], ["t"])
    parts = list(words.parts_of(batch, 0, size))
    assert [x for p in parts for x in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert all(p.num_rows == 1 or p.column(0).nbytes <= size + 4 * (len(texts) + 1) for p in parts)
