"""Merkle manifest: coordinates, trees and proofs against plain loops."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltstone.llm import manifest as m
from tests.llm.helpers import edge_texts, frame, shipped  # noqa: F401


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*fields):
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def climb(nodes):
    """Path of every node, and the root."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            paths[i].append(nodes[k ^ 1] if k ^ 1 < len(nodes) else "")
        nodes = [sha("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        at = [k // 2 for k in at]
    return paths, nodes[0] if nodes else None


def fold(digest, at, path):
    for other in path:
        digest = sha(other + digest if at & 1 else digest + other)
        at //= 2
    return digest


def brute(rows, tampered):
    """rows: (doc_id, grp, text)."""
    groups = {}
    for doc_id, grp, text in rows:
        groups.setdefault("" if grp is None else "=" + grp, []).append((doc_id, leaf(doc_id, grp, text), leaf(doc_id, grp, f"{text}!") if tampered(doc_id) and text is not None else None))
    names = sorted(groups, key=str.encode)
    for g in names:
        groups[g].sort(key=lambda r: (-(1 << 63) if r[0] is None else r[0], r[1]))
    trees = {g: climb([r[1] for r in groups[g]]) for g in names}
    uppers, root = climb([trees[g][1] for g in names])
    out = []
    for place, g in enumerate(names):
        paths, subroot = trees[g]
        for at, (doc_id, digest, other) in enumerate(groups[g]):
            again = fold(fold(other or digest, at, paths[at]), place, uppers[place])
            out.append((doc_id, digest, subroot, root, sha("".join(paths[at] + uppers[place])), again, again == root))
    return Counter(out)


def found(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, "x") for r in rows], "doc_id long, lang string, text string, pos string, total int, grp string").repartition(3)
    fields = [F.col(c) for c in ("doc_id", "lang", "text")]
    result = m.manifest(df, fields, "lang", "doc_id", F.col("doc_id") % 7 == 0, [*fields[:2], F.concat("text", F.lit("!"))])
    return Counter(tuple(r) for r in result.collect())


def bad(doc_id):
    return doc_id is not None and doc_id % 7 == 0


def test_groups_of_many_sizes(spark):
    rng = random.Random(1)
    sizes = {None: 1, "a": 2, "b": 3, "é": 5, "zz": 1024, "Z": 1025, "": 2300, "ß": 17}
    rows = [(i * 5 - 300, g, f"t{rng.random()}") for g, n in sizes.items() for i in rng.sample(range(4 * n), n)]
    got = found(spark, rows)
    assert got == brute(rows, bad)
    assert {x[-1] for x in got} == {True, False}


def test_wide_ids_nulls_and_repeats(spark):
    rng = random.Random(2)
    ids = [rng.randrange(-(1 << 63) + 1, 1 << 63) for _ in range(400)] + [(1 << 63) - 1, -1, 0, 1, 511, 512, -512, -513]
    rows = [(i, rng.choice(["a", "b", None]), rng.choice(["x", "", None, "long " * 50_000])) for i in ids]
    rows += [(None, "a", f"n{rng.randrange(60)}") for _ in range(300)]
    rows += [(513, "a", f"r{rng.randrange(90)}") for _ in range(300)] + [(514, "a", "same")] * 200 + rows[:20]
    assert found(spark, rows) == brute(rows, bad)


@pytest.mark.parametrize("rows", [[], [(7, None, None)], [(None, None, "")], [(7, "a", "x")] * 3])
def test_small_tables(spark, rows):
    assert found(spark, rows) == brute(rows, bad)


def test_edge_texts(spark):
    rows = [(i, "ab"[n % 2], t) for n, (i, t) in enumerate(edge_texts())]
    assert found(spark, rows) == brute(rows, bad)


def test_rank_has_no_order_by_id(spark):
    """Coordinates come from bitmaps: windows are over directory nodes only."""
    rows = spark.range(5000).select(F.lit("g").alias("grp"), (F.col("id") * 3).alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("digest"), F.col("id").alias("row"))
    plan = m.bitmaps(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" in plan
    placed = m.coordinates(rows).collect()
    assert sorted((r.pos, r.id) for r in placed) == [(i, 3 * i) for i in range(5000)]
    blocks = m.bitmaps(rows).collect()
    assert len(blocks) == -(-15000 // 512)
    assert sum(b.n for b in blocks) == 5000


def test_a_gap_is_an_error(spark):
    nodes = spark.createDataFrame([("g", 0, "a" * 64), ("g", 2, "b" * 64)], "grp string, pos long, digest string")
    with pytest.raises(Exception, match="without gaps|out of range"):
        m.paths(nodes)[1].collect()
