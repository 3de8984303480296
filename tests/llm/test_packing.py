"""Packing."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm.packing import Encoder, packed, places, shortest_pack_first
from siltstone.llm.queries import vocabulary
from tests.llm.helpers import edge_texts, frame, sentence, shipped  # noqa: F401

FILE = vocabulary("byte_bpe_50k.json")


def check(rows, got, size):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(FILE)
    want = []
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        want += [(i, a, len(ids[a : a + size]), zlib.crc32(np.array(ids[a : a + size], "<u4").tobytes()), len(ids)) for a in range(0, len(ids), size)]
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:5]) for r in got)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    assert sorted(sequences) == list(range(len(sequences)))
    return len(sequences)


@pytest.mark.parametrize("chunk", [16_384, 20])
def test_round_trip(spark, frame, monkeypatch, chunk):
    monkeypatch.setattr("siltstone.llm.packing.CHUNK", chunk)
    rng = random.Random(1)
    rows = edge_texts() + [(100, "a <|endoftext|> b"), (101, "\U00030001 x")] + [(200 + i, sentence(rng, rng.randrange(0, 300))) for i in range(150)]
    n = check(rows, packed(frame(rows), FILE, size=256).collect(), 256)
    total = sum(r.length for r in packed(frame(rows), FILE, size=256).collect())
    assert n <= total / 256 * 1.05 + 1


def test_empty_table(spark, frame):
    assert packed(frame([]), FILE).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 200), max_size=20))
def test_patterns_hold_every_piece_once(histogram):
    patterns = shortest_pack_first(histogram, 64)
    assert all(sum(n * k for n, k in p) <= 64 and c > 0 for p, c in patterns)
    count = defaultdict(int)
    for p, c in patterns:
        for n, k in p:
            count[n] += k * c
    assert dict(count) == histogram
    ranges = defaultdict(list)
    for length, a, b, *_ in places(patterns):
        ranges[length].append((a, b))
    for length, parts in ranges.items():
        assert [a for a, _ in sorted(parts)] == [0, *[b for _, b in sorted(parts)][:-1]] and max(b for _, b in parts) == histogram[length]


@pytest.mark.parametrize(
    "histogram, most", [({300: 1000}, 334), ({10: 1000}, 10), ({n: 100 for n in range(1, 101)}, 494), ({1: 5}, 1), ({1024: 3, 1: 1024}, 4), ({600: 10, 400: 10}, 10)]
)
def test_short_pieces_share_packs(histogram, most):
    assert sum(c for _, c in shortest_pack_first(histogram, 1024)) <= most


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 3000), min_size=1, max_size=4))
def test_few_short_lengths_leave_little_padding(histogram):
    used = sum(c for _, c in shortest_pack_first(histogram, 256))
    total = sum(n * k for n, k in histogram.items())
    # a pack is left only where no piece of the last length fits
    assert used <= total / (256 - max(histogram) + 1) + 1


def test_both_roads_give_the_same_ids():
    encode = Encoder(FILE)
    points = [i for i in range(0, 0x30000, 7) if not 0xD800 <= i < 0xE000]
    for i in points:
        c = chr(i)
        text = f"a{c}b {c}1{c}{c}  {c} .{c}'s"
        assert encode.fast.encode_ordinary(text) == encode.tokenizer.encode(text, add_special_tokens=False).ids
