"""Document fingerprints."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from siltstone.llm.fingerprints import Settings, _toss, document_fingerprints, likeness, phrase_names, phrase_starts, sketches, spelled
from siltstone.llm.queries import QUERIES
from tests.llm.helpers import edge_texts, frame, sentence, shipped  # noqa: F401


def own(text):
    return spelled(next(sketches(pa.array([text]), Settings())))


def test_query_matches_brute_force(spark, frame, tmp_path):
    rng = random.Random(1)
    rows = [(i, t) for i, t in edge_texts() if i != 3] + [(i, sentence(rng, rng.randrange(1, 200)) + "字é") for i in range(200, 260)]
    frame(rows).write.parquet(str(tmp_path / "documents.parquet"))
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for (i, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        text, following = text or "", following or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = own(text), own(edited), own(following)
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, likeness(a, b, 48), likeness(a, c, 48)))
    got = QUERIES["op6_document_fingerprints"](spark, str(tmp_path)).collect()
    assert sorted(map(str, want)) == sorted(map(str, (tuple(r) for r in got)))


def test_repeated_rows_and_empty_table(spark, frame):
    got = document_fingerprints(frame([(3, "abc"), (3, "abc"), (3, "xyz")])).collect()
    assert sorted((r.doc_id, r.n_chars, r.near_next) for r in got) == [(3, 3, 0.0), (3, 3, 0.0), (3, 3, 1.0)]
    assert document_fingerprints(frame([])).collect() == []


def test_a_text_has_one_fingerprint_in_any_company():
    rng = random.Random(2)
    texts = ["", "a", "aaaa", "ab" * 500, "é字" * 40, None, *[sentence(rng, rng.randrange(1, 400)) for _ in range(50)], "x" * 2_000_000]
    together = [spelled(v) for v in sketches(pa.array(texts), Settings())]
    assert together == [own(t) for t in texts]


def test_equal_substrings_share_phrases_at_any_offset():
    rng = random.Random(3)
    shared = sentence(rng, 300)
    sets = []
    for before in ("", "x", "some other words before ", sentence(rng, 50)):
        data = np.frombuffer((before + shared + sentence(rng, 20)).encode(), np.uint8)
        sets.append(set(phrase_names(data, np.array([0, len(data)]))[1].tolist()))
    alone = sets[0]
    assert all(len(alone & s) / len(alone) > 0.75 for s in sets)


@pytest.mark.parametrize("kind", [np.uint8, np.uint64])
def test_tossing_keeps_neighbours_apart_and_phrases_short(kind):
    rng = np.random.default_rng(4)
    symbols = rng.integers(0, 200, 5000).astype(kind)
    symbols = symbols[np.append(True, symbols[1:] != symbols[:-1])]
    labels = symbols
    for _ in range(4):
        labels = _toss(labels)
        assert (labels[5:] != labels[4:-1]).all()
    assert labels[5:].max() < 6
    starts = phrase_starts(symbols, np.array([0, len(symbols)]))
    assert starts[0] == 0 and np.diff(starts).min() >= 2 and np.diff(starts).max() <= 16


def test_likeness():
    a, b = own("The quick brown fox jumps over the lazy dog. " * 3), own("Something else entirely, without a common phrase")
    assert likeness(a, a, 48) == 1.0 and likeness("", "", 48) == 1.0 and likeness(a, "", 48) == 0.0
    assert 0 <= likeness(a, b, 48) < 0.2


@pytest.mark.parametrize("size", [40, 200, 500, 505, 520, 2000, 20_000])
def test_the_same_edit_gives_much_the_same_likeness_at_any_length(size):
    rng = random.Random(8)
    half, grown, apart = [], [], []
    for _ in range(30):
        text, other = sentence(rng, size)[:size], sentence(rng, size)[:size]
        cut = size - size // 2
        half.append(likeness(own(text), own(text[:cut] + other[: size // 2]), 48))
        grown.append(likeness(own(text), own(text + other[: size // 10]), 48))
        apart.append(likeness(own(text), own(other), 48))
    assert 0.2 < np.mean(half) < 0.55 and np.mean(grown) > 0.6 and np.mean(apart) < 0.25
    assert np.mean(grown) > np.mean(half) + 0.15 and np.mean(half) > np.mean(apart) + 0.1


def test_likeness_estimates_the_weighted_share():
    rng = random.Random(9)
    shared, more = sentence(rng, 3000), sentence(rng, 1000)
    names = []
    for text in (shared, shared + " " + more):
        data = np.frombuffer(text.encode(), np.uint8)
        _, name, width = phrase_names(data, np.array([0, len(data)]))
        names.append(dict(zip(name.tolist(), np.minimum(width, 32).tolist(), strict=True)))
    both = sum(w for n, w in names[0].items() if n in names[1])
    whole = sum((names[0] | names[1]).values())
    found = likeness(*(spelled(next(sketches(pa.array([t]), Settings(keep=4000)))) for t in (shared, shared + " " + more)), 4000)
    assert abs(found - both / whole) < 0.04
