"""Words, hashes and blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm.text import byte_blocks, gram_hashes, mix, span_hashes, word_hashes, word_spans


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t字", max_size=30)), max_size=12), st.integers(1, 40))
def test_words_of_rows(texts, limit):
    found = {}
    for row, offsets, data in byte_blocks(pa.array(texts, pa.string()), limit):
        starts, ends, rows = word_spans(data, offsets)
        for i in range(len(rows) - 1):
            found[row + i] = [data[a:b].tobytes() for a, b in zip(starts[rows[i] : rows[i + 1]], ends[rows[i] : rows[i + 1]], strict=True)]
    assert found == {i: (t or "").encode().split() for i, t in enumerate(texts)}


def test_equal_spans_hash_equally_anywhere():
    data = np.frombuffer(b"abc xabc abcx abc", np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]))
    h = word_hashes(data, starts, ends)
    assert h[0] == h[3] and len(set(h.tolist())) == 3
    grams = gram_hashes(np.concatenate([h[:2], h, h[:2]]), 2)
    assert grams[0] == grams[2] == grams[6] and len(np.unique(grams)) == 5
    assert len(gram_hashes(h, 9)) == 0


def test_mix_is_a_bijection_on_a_sample():
    x = np.arange(100_000, dtype=np.uint64)
    assert len(np.unique(mix(x))) == len(x)


def test_empty_span_hashes():
    codes = np.arange(5, dtype=np.uint64)
    a = np.array([0, 3])
    assert len(set(span_hashes(codes, a, a).tolist())) == 1


def test_sliced_arrow_column():
    column = pa.array(["zz", "a b", None, "c"]).slice(1)
    assert [d.tobytes() for _, _, d in byte_blocks(column, 1)] == [b"a b", b"", b"c"] or b"".join(d.tobytes() for _, _, d in byte_blocks(column, 1)) == b"a bc"
