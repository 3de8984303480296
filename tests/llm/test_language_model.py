"""Kneser-Ney scores against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from siltstone.llm import arrays, language_model
from siltstone.llm.queries import QUERIES
from tests.llm.helpers import edge_texts, frame, sentence, shipped  # noqa: F401


def tokens(text):
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), "\n"]


def discounts(counts):
    n = Counter(counts)
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
    raw = [k + 1 - (k + 2) * y * n[k + 2] / n[k + 1] if n[k + 1] else 0.0 for k in range(3)]
    return [0.0, *[min(max(d, 0.0), k + 1.0) for k, d in enumerate(raw)]]


class Brute:
    def __init__(self, texts):
        self.words, self.pairs = Counter(), Counter()
        for t in texts:
            self.words.update(t)
            self.pairs.update(zip([None, *t[:-1]], t, strict=True))
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.spread = Counter(w for _, w in self.pairs)
        self.total, self.levels = Counter(), defaultdict(lambda: [0] * 4)
        for (a, _), c in self.pairs.items():
            self.total[a] += c
            self.levels[a][min(c, 3)] += 1
        self.d2, self.d1 = discounts(self.pairs.values()), discounts(self.spread.values())
        self.back = sum(self.d1[min(c, 3)] for c in self.spread.values()) / len(self.pairs) if self.pairs else 1.0

    def single(self, w):
        c = self.spread[w]
        return (c - self.d1[min(c, 3)]) / max(1, len(self.pairs)) + self.back / (self.v + 1)

    def p(self, a, w):
        if not self.total[a]:
            return self.single(w)
        c = self.pairs[a, w]
        back = sum(self.d2[k] * self.levels[a][k] for k in (1, 2, 3)) / self.total[a]
        return (c - self.d2[min(c, 3)]) / self.total[a] + back * self.single(w)


def check(rows, got):
    fold = lambda i: None if i is None else zlib.crc32(str(i).encode()) % 10
    model = Brute([tokens(t) for i, t in rows if fold(i)])
    want = []
    for i, text in rows:
        t = tokens(text)
        base = sum(math.log10((model.words[w] + 0.1) / (model.n + 0.1 * (model.v + 1))) for w in t)
        score = sum(math.log10(model.p(a, w)) for a, w in zip([None, *t[:-1]], t, strict=True))
        want.append((i, fold(i) == 0, len(t), sum(w in model.words for w in t), model.n, base, score))
    key = lambda r: tuple(map(str, r[:5])) + (round(r[5], 5),)
    for a, b in zip(sorted(want, key=key), sorted((tuple(r)[:7] for r in got), key=key), strict=True):
        assert a[:5] == b[:5] and np.allclose(a[5:], b[5:], rtol=1e-9)
    assert not model.pairs or abs(sum(model.p("w1", w) for w in model.words) + model.p("w1", "never") - 1) < 1e-9


@pytest.mark.parametrize("flush, shard", [(1 << 21, 1 << 21), (500, 64)])
def test_query_matches_brute_force(spark, frame, tmp_path, monkeypatch, flush, shard):
    monkeypatch.setattr(language_model, "FLUSH", flush)
    monkeypatch.setattr(language_model, "SHARD", shard)
    rng = random.Random(1)
    rows = edge_texts() + [(100 + i, sentence(rng, rng.randrange(0, 60), 40).title()) for i in range(80)]
    frame(rows).write.parquet(str(tmp_path / "documents.parquet"))
    check(rows, QUERIES["op8_lm_scoring"](spark, str(tmp_path)).collect())


def test_nothing_to_learn_from(spark, frame):
    rows = [(None, "a b"), (None, None)]
    docs = frame(rows)
    model = language_model.train(language_model.training_rows(docs))
    check(rows, language_model.scores(docs, model).collect())
    assert language_model.scores(frame([]), model).collect() == []


def test_sorted_hashes(tmp_path):
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2))
    shard = arrays.shard_of(keys, 3)
    sizes = [int((shard == s).sum()) for s in range(8)]
    for s in range(8):
        arrays.write_array(str(tmp_path), f"k-{s}", keys[shard == s])
        arrays.write_array(str(tmp_path), f"v-{s}", keys[shard == s] // np.uint64(7))
    table = arrays.SortedHashes(str(tmp_path), "k", 3, sizes)
    asked = np.unique(np.concatenate([keys[::3], keys[::5] + np.uint64(1)]))
    places = table.find(asked)
    assert (keys[places[places >= 0]] == asked[places >= 0]).all() and set(asked[places < 0]).isdisjoint(keys)
    assert (table.values("v", places[places >= 0]) == asked[places >= 0] // np.uint64(7)).all()
    assert len(table.find(asked[:0])) == 0


def test_packed_columns():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 63, 500, dtype=np.uint64))
    n = rng.integers(0, 1 << 40, len(keys)).astype(np.uint64)
    a, b = language_model._unpacked(language_model._packed(keys, n), 2)
    assert (a == keys).all() and (b == n).all()
