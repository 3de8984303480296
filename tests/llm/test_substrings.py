"""Substring dedup against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm.queries import QUERIES
from siltstone.llm.substrings import window_anchors, without_repeats
from siltstone.llm.suffixes import SuffixAutomaton
from tests.llm.helpers import edge_texts, frame, sentence, shipped  # noqa: F401


def brute(rows, window):
    """Kept words by row number; rows with equal ids do not repeat each other at the same place."""
    first: dict[tuple, tuple] = {}
    order = [(i if i is not None else 1 << 63, (t or "").encode().split()) for i, t in rows]
    for i, w in order:
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            first[key] = min(first.get(key, (i, s)), (i, s))
    out = []
    for i, w in order:
        gone = np.zeros(len(w), bool)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < (i, s):
                gone[s : s + window] = True
        out.append((len(w), int(gone.sum()), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return out


def compare(spark, frame, rows, window):
    got = without_repeats(frame(rows), window=window).collect()
    want = [(i, *k) for (i, _), k in zip(rows, brute(rows, window), strict=True)]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_words, r.n_removed, r.kept)) for r in got)


def test_edges(spark, frame):
    compare(spark, frame, edge_texts(), 20)


def test_empty_table(spark, frame):
    assert without_repeats(frame([])).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_overlapping_passages(spark, frame, seed):
    """Few distinct words: passages overlap, repeat inside a document and between later documents only."""
    rng = random.Random(seed)
    shared = [sentence(rng, rng.randrange(8, 30), 6) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [rng.choice(shared) if rng.random() < 0.6 else sentence(rng, rng.randrange(1, 12), 6) for _ in range(rng.randrange(1, 6))]
        rows.append((rng.randrange(50), " ".join(parts)))
    compare(spark, frame, rows, 8)


def test_query_matches_brute_force(spark, tmp_path, frame):
    rows = edge_texts()
    frame(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op1_substring_dedup"](spark, str(tmp_path)).collect()
    want = [(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for (i, _), (n, gone, kept) in zip(rows, brute(rows, 20), strict=True)]
    assert sorted(map(str, want)) == sorted(map(str, (tuple(r) for r in got)))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=14), min_size=1, max_size=4), st.lists(st.integers(0, 3), max_size=25), st.integers(1, 5))
def test_automaton_finds_first_places(passages, text, window):
    automaton, at, first = SuffixAutomaton(), 0, {}
    for p in passages:
        automaton.add(p, at)
        for s in range(len(p) - window + 1):
            first.setdefault(tuple(p[s : s + window]), at + s)
        at += len(p) + 3
    want = [first.get(tuple(text[s : s + window]), -1) for s in range(len(text) - window + 1)]
    assert automaton.first_starts(text, window) == want


def test_equal_windows_pick_equal_anchors():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 4, 3000).astype(np.uint64)
    rows = np.array([0, 700, 710, 3000])
    places, keys, low, high = window_anchors(words, rows, 12, 4)
    picked = {s: (int(p) - s, int(k)) for p, k, a, b in zip(places, keys, low, high, strict=True) for s in range(a, b + 1)}
    assert set(picked) == {s for a, b in zip(rows, rows[1:], strict=False) for s in range(a, b - 11)}
    seen = {}
    for s, anchor in picked.items():
        assert seen.setdefault(tuple(words[s : s + 12].tolist()), anchor) == anchor
