"""Spelling variants."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from siltstone.llm import spelling
from tests.llm.helpers import edge_texts, frame, shipped  # noqa: F401

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute_words(rows):
    counts: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return counts


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, least_length=6, least_count=5, factor=5):
    words = {w: n for w, n in brute_words(rows).items() if len(w) >= least_length and n >= least_count}
    out, form = {}, {}
    for w, n in words.items():
        around = sorted((-words[v], v) for v in words if near(w, v))
        best = around[0] if around and -around[0][0] >= factor * n else None
        form[w] = best and best[1]
        out[w] = [w, n, len(around), best and best[1], best and -best[0]]
    for w in out:
        root = w
        while form[root]:
            root = form[root]
        out[w].append(root)
    return sorted(map(tuple, out.values()))


def found(df):
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect())


def corpus(seed, docs=300):
    rng = random.Random(seed)
    base = ["letters", "grenade", "straße", "éclaira", "ÀÉÎõü÷×ÿ", "planetary", "aaaaaaa", "aaaaaab", "abababab"]
    rows = []
    for i in range(docs):
        out = []
        for _ in range(60):
            w = base[min(int(rng.expovariate(0.5)), len(base) - 1)]
            for _ in range(2):
                if rng.random() < 0.12:
                    at = rng.randrange(len(w))
                    w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("aeÿ") + w[at:], w[:at] + rng.choice("aeÿ") + w[at + 1 :]])
            out.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, rng.choice([" ", ", ", "1", "Ā", " "]).join(out)))
    return rows + [(i + docs, "pqrstu " * 2 + "pqrstuv " * 20 + "pqrstuvw " * 200) for i in range(4)]  # a chain of forms


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(frame, seed):
    rows = corpus(seed)
    want = brute(rows)
    assert sum(w[3] is not None for w in want) > 10
    assert any(w[5] not in (w[0], w[3]) for w in want)  # chains
    assert found(spelling.variants(frame(rows))) == want


def test_edge_cases(frame):
    rows = edge_texts() + [(30, "Überfluß " * 9), (None, "überfluss " * 50), (31, "x" * 200_000 + " " + "überflus " * 6), (32, "ab" * 3)]
    assert found(spelling.variants(frame(rows), 3, 1, 2)) == brute(rows, 3, 1, 2)


def test_empty_table(frame):
    assert spelling.variants(frame([])).collect() == []
    assert spelling.variants(frame([(1, None), (2, "")])).collect() == []


def test_several_rounds(frame, monkeypatch):
    monkeypatch.setattr(spelling.Shards.__init__, "__defaults__", (64,))
    monkeypatch.setattr(spelling.Shards.rounds, "__defaults__", (128,))
    rows = corpus(3, 120)
    assert len(spelling.Shards({6: 400, 7: 100}).rounds()) > 4
    assert found(spelling.variants(frame(rows))) == brute(rows)


def test_hashes_of_edits():
    words = ["planet", "straße", "aabbcc"]
    letters = np.array([[ord(c) for c in w] for w in words], np.uint32)

    def own(word):
        return int(spelling._finished(spelling.raw_hashes(np.array([[ord(c) for c in word]], np.uint32)))[0])

    cut = spelling.deletions(letters)
    assert all(int(cut[i, k]) == own(w[:k] + w[k + 1 :]) for i, w in enumerate(words) for k in range(6))
    alphabet = np.array(sorted(map(ord, "abcxyzß")), np.uint32)
    word, place, letter, keys = spelling.replacements(letters, alphabet, 2, 7)
    for i, k, x, key in zip(word, place, letter, keys, strict=True):
        w, c = words[i], chr(alphabet[x])
        assert c > w[k] and int(key) == own(w[:k] + c + w[k + 1 :])
    assert len(word) == sum(chr(c) > x for w in words for x in w for c in alphabet[2:7])


def test_filter_never_misses():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 2000).astype(np.uint64)
    shards = spelling.Shards({8: 2000}, 1024)
    assert shards.parts[8] > 1
    tables = {(8, p): np.zeros((shards.blocks[8], spelling.WORDS), np.uint32) for p in range(shards.parts[8])}
    for p in range(shards.parts[8]):
        block, mask = spelling.masks(keys[shards.part(8, keys) == p], shards.blocks[8])
        np.bitwise_or.at(tables[8, p], block, mask)
    assert spelling.passed(keys, 8, shards, tables).all()
    other = rng.integers(0, 1 << 63, 20000).astype(np.uint64)
    assert spelling.passed(other, 8, shards, tables).mean() < 0.02


def test_crc_of_runs():
    texts = ["é Überfluß zÿ", "", "abc def", "x"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    starts, ends, rows = spelling.run_spans(data, offsets)
    states = np.array([zlib.crc32(f"{r}:".encode()) for r in rows], np.uint32)
    got = spelling.run_crcs(data, starts, ends, states)
    assert got.tolist() == [zlib.crc32(f"{r}:".encode() + data[a:b].tobytes()) for a, b, r in zip(starts, ends, rows, strict=True)]
    assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)] == ["é", "Überfluß", "zÿ", "abc", "def", "x"]
    assert pa.array(rows).to_pylist() == [0, 0, 0, 2, 2, 3]
