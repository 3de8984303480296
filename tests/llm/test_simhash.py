"""SimHash fingerprints, links and groups against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm.components import components
from siltstone.llm.queries import QUERIES
from siltstone.llm.simhash import block_masks, forest, links, near_duplicates, one_of_each_group, walk_alike
from tests.llm.helpers import edge_texts, frame, sentence, shipped  # noqa: F401


def brute_fingerprint(text):
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(n, close):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if close(i, j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(n)]


def brute(rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    of = groups(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    least = {g: min((i for (i, _), h in zip(rows, of, strict=True) if h == g and i is not None), default=None) for g in of}
    return [(i, f"{p:016x}", least[g]) for (i, _), p, g in zip(rows, prints, of, strict=True)]


def test_query_matches_brute_force(spark, frame, tmp_path):
    rng = random.Random(9)
    rows = edge_texts()
    for i in range(100, 160):
        base = sentence(rng, 400).split()
        rows.append((i, " ".join(base)))
        base[rng.randrange(400)] = "other"
        rows.append((i + 100, " ".join(base)))
    frame(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op5_simhash"](spark, str(tmp_path)).collect()
    assert sorted(map(str, brute(rows))) == sorted(map(str, (tuple(r) for r in got)))


def test_empty_and_idless(spark, frame):
    assert near_duplicates(frame([])).collect() == []
    assert [tuple(r) for r in near_duplicates(frame([(None, "a b c d")])).collect()] == [(None, f"{brute_fingerprint('a b c d'):016x}", None)]


def test_links_connect_what_is_close(spark):
    rng = random.Random(4)
    values = set()
    for _ in range(40):  # chains that leave their start step by step
        v = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            values.add(v)
            for b in rng.sample(range(64), rng.randrange(1, 6)):
                v ^= 1 << b
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    entries = spark.createDataFrame([(0, v, v) for v in signed], "series int, fingerprint long, id long")
    labels = {r.node: r.label for r in components(links(entries, block_masks())).collect()}
    of = groups(len(values), lambda i, j: (values[i] ^ values[j]).bit_count() <= 3)
    want = {}
    for v, g in zip(signed, of, strict=True):
        want.setdefault(g, []).append(v)
    got = {}
    for v in signed:
        got.setdefault(labels.get(v, v), []).append(v)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


@pytest.mark.parametrize("max_bits", [1, 3])
def test_close_pairs_share_a_file(max_bits):
    rng = random.Random(1)
    masks = block_masks(6, max_bits)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), max_bits):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


def test_a_file_yields_a_forest(monkeypatch):
    monkeypatch.setattr("siltstone.llm.simhash.WALK", 50)  # so the second filing is taken
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, dtype=np.uint64)
    values = np.unique(base ^ (np.uint64(1) << rng.integers(0, 32, (400, 6)).astype(np.uint64)).sum(1, dtype=np.uint64))
    a, b = forest(values, 3)
    of = groups(len(values), lambda i, j: int(np.bitwise_count(values[i] ^ values[j])) <= 3)
    pairs = set(zip(a.tolist(), b.tolist(), strict=True))
    assert all(np.bitwise_count(values[i] ^ values[j]) <= 3 for i, j in pairs)
    joined = groups(len(values), lambda i, j: (i, j) in pairs or (j, i) in pairs)
    assert [of.index(g) for g in of] == [joined.index(g) for g in joined]


@settings(max_examples=4, deadline=None)
@given(st.integers(0, 1000))
def test_components_of_chains_and_hubs(spark, seed):
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)] + [(rng.randrange(200, 230), rng.randrange(200, 230)) for _ in range(20)]
    rng.shuffle(edges)
    frame = spark.createDataFrame([(a, b) if rng.random() < 0.5 else (b, a) for a, b in [*edges, (None, 1), (5, 5)]], "a long, b long")
    got = {r.node: r.label for r in components(frame).collect()}
    nodes = sorted({n for a, b in edges if a != b for n in (a, b)})
    linked = set(edges)
    of = groups(len(nodes), lambda i, j: (nodes[i], nodes[j]) in linked or (nodes[j], nodes[i]) in linked)
    assert got == {n: nodes[g] for n, g in zip(nodes, of, strict=True)}


def test_one_of_each_group(spark, frame):
    rng = random.Random(6)
    rows, clean = [], 40
    for i in range(clean):
        rows.append((1000 + i, sentence(rng, 300, 5000)))
    for i in range(20):
        words = sentence(rng, 300, 5000).split()
        rows.append((2000 + i, " ".join(words)))
        words[rng.randrange(300)] = "edited"
        rows.append((3000 + i, " ".join(words)))
        rows.append((4000 + i, " ".join(words).upper()))
    rows += [(5, "tiny text"), (5, "tiny text"), (6, None), (7, ""), (None, "tiny text"), (None, "lone text here")]
    kept = one_of_each_group(frame(rows))
    assert kept.columns == frame(rows).columns
    got = sorted(str(r.doc_id) for r in kept.collect())
    want = [1000 + i for i in range(clean)] + [2000 + i for i in range(20)] + [5, 6, None]
    assert got == sorted(map(str, want))
    assert one_of_each_group(frame([])).collect() == []


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def zipf(rng, n):
    return [f"w{int(x)}" for x in np.minimum(rng.zipf(1.3, n), 50_000)]


def copies(rng, kind, pairs=60):
    """Pairs of texts with a five-word-shingle similarity of 0.83 to 0.9: copies of one kind."""
    for _ in range(pairs):
        words = zipf(rng, int(rng.integers(150, 600)))
        n = len(words)
        if kind == "appended":
            other = words + zipf(rng, n // 7)
        elif kind == "truncated":
            other = words[: n - n // 7]
        elif kind == "replaced":
            at, size = int(rng.integers(0, n * 9 // 10)), n // 15
            other = words[:at] + zipf(rng, size) + words[at + size :]
        else:
            other = list(words)
            for at in rng.choice(n, max(1, n // 60), replace=False):
                other[at] = "edited"
        yield " ".join(words), " ".join(other)


@pytest.mark.parametrize("kind", ["appended", "truncated", "replaced", "scattered"])
def test_pairs_alike_by_brute_force_lose_one(spark, frame, kind):
    rows, alike = [], 0
    for i, (a, b) in enumerate(copies(np.random.default_rng(3), kind)):
        x, y = shingles(a), shingles(b)
        if len(x & y) / len(x | y) >= 0.83:  # the long fingerprint is within about 0.03
            alike += 1
            rows += [(2 * i, a), (2 * i + 1, b)]
    assert alike >= 15
    kept = {r.doc_id for r in one_of_each_group(frame(rows)).collect()}
    assert len(kept) <= alike + alike * 0.1 and all(i in kept for i, _ in rows if i % 2 == 0)


def near_the_threshold(rng, kind, pairs):
    """Pairs of texts with a five-word-shingle similarity of 0.80 to 0.83."""
    share = {"appended": 0.23, "truncated": 0.185, "replaced": 0.095, "scattered": 0.021}[kind]
    found = 0
    while found < pairs:
        words = zipf(rng, int(rng.integers(150, 500)))
        n = len(words)
        k = max(1, int(n * share * rng.uniform(0.7, 1.2)))
        if kind == "appended":
            other = words + zipf(rng, k)
        elif kind == "truncated":
            other = words[: n - k]
        elif kind == "replaced":
            at = int(rng.integers(0, n - k))
            other = words[:at] + zipf(rng, k) + words[at + k :]
        else:
            other = list(words)
            for at in rng.choice(n, k, replace=False):
                other[at] = "edited"
        x, y = shingles(" ".join(words)), shingles(" ".join(other))
        if 0.80 <= len(x & y) / len(x | y) <= 0.83:
            found += 1
            yield " ".join(words), " ".join(other)


@pytest.mark.parametrize("kind", ["appended", "truncated", "replaced", "scattered"])
def test_pairs_at_the_threshold(spark, frame, kind):
    rows = [(2 * i + k, t) for i, pair in enumerate(near_the_threshold(np.random.default_rng(5), kind, 40)) for k, t in enumerate(pair)]
    kept = {r.doc_id for r in one_of_each_group(frame(rows)).collect()}
    assert all(i in kept for i, _ in rows if i % 2 == 0)
    assert len(kept) <= 44  # nine pairs in ten, at least


def test_clashing_names_and_ties(spark):
    schema = "doc_id long, text string, `_words` string, `_ID` string, `_again` int, `_order` string, m map<string,int>"
    rows = [(1, "a b c", "w1", "i1", 1, "o1", {"k": 1}), (1, "A  b c", "w2", "i2", 2, "o2", None), (2, "a b c", "w3", "i3", 3, "o3", None), (3, "other text", "w4", "i4", 4, "o4", None)]
    found = [sorted(tuple(r)[2:6] for r in one_of_each_group(spark.createDataFrame(rows[::turn], schema).repartition(2)).collect()) for turn in (1, -1)]
    assert found[0] == found[1] and len(found[0]) == 2 and found[0][1] == ("w4", "i4", 4, "o4") and found[0][0][0] in ("w1", "w2")


def test_copies_alike_through_their_original_only_in_a_large_file(spark, frame):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in rng.permutation(200)]
    rows = [(9999, " ".join(words))]
    for i in range(2500):  # the same words, 0.87 from the original and about 0.75 from each other
        at = int(rng.integers(5, 180))
        rows.append((i, " ".join(words[:at] + rng.permutation(words[at : at + 10]).tolist() + words[at + 10 :])))
    assert one_of_each_group(frame(rows)).count() <= 5


def test_a_star_is_one_component_at_any_file_size(monkeypatch):
    monkeypatch.setattr("siltstone.llm.simhash.WALK", 500)
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 1 << 63, 16, dtype=np.uint64)
    longs = np.stack([centre ^ np.packbits(rng.permutation(1024) < 110).view(np.uint64) for _ in range(3000)])
    longs[1700] = centre
    a, b = walk_alike(longs, 155)
    assert len(a) == 2999 and len(set(groups_of(3000, a, b))) == 1


def groups_of(n, a, b):
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        if (after == root).all():
            return root.tolist()
        root = after
