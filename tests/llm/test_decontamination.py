"""Benchmark decontamination."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm.decontamination import contaminated, distances, holds_item, passage
from tests.llm.helpers import edge_texts, frame, sentence, shipped  # noqa: F401


def table(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def edit_distance_to_passages(item, text):
    before, out = list(range(len(item) + 1)), []
    for w in text:
        row = [0]
        for j, x in enumerate(item, 1):
            row.append(min(before[j - 1] + (x != w), before[j] + 1, row[-1] + 1))
        before = row
        out.append(row[-1])
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=80), st.lists(st.integers(0, 3), max_size=60))
def test_bit_parallel_distance(item, text):
    want = edit_distance_to_passages(item, text)
    assert distances(item, text) == want
    hit = passage(item, text, len(item))
    if text:
        best, start, end = hit
        assert best == min(want) and end == want.index(best) + 1
        assert min(edit_distance_to_passages(item, text[start:end])[-1:], default=len(item)) == best


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[at] = f"e{rng.randrange(99)}"
        elif kind == 1:
            words.insert(at, f"e{rng.randrange(99)}")
        elif len(words) > 1:
            del words[at]
    return words


def test_every_passage_within_the_budget_is_found(spark, frame):
    rng = random.Random(2)
    items = [(i, sentence(rng, rng.randrange(8, 60), 50)) for i in range(30)]
    rows = edge_texts()
    for i, text in items:
        for edits in range(0, len(text.split()) // 3):
            rows.append((1000 + 100 * i + edits, sentence(rng, 30, 50) + " " + " ".join(edited(rng, text.split(), edits)).upper() + ". " + sentence(rng, 30, 50)))
    got = {(r.doc_id, r.item_id): r.distance for r in contaminated(frame(rows), table(spark, items)).collect()}
    words = {k: (t or "").lower().replace(".", " ").split() for k, t in rows}
    for doc, text in words.items():
        if doc is None or doc < 1000:
            continue
        for i, item in items:
            item = item.split()
            best = min(edit_distance_to_passages(item, text))
            assert got.get((doc, i)) == (best if best <= int(len(item) * 0.2 + 1e-9) else None)


def test_edges(spark, frame):
    rng = random.Random(5)
    item = sentence(rng, 20)
    docs = frame([(1, f"x {item} y"), (1, f"x {item} y"), (None, item), (2, None), (3, "")])
    items = table(spark, [(7, item), (7, item), (8, None), (None, item + " more"), (9, "too short")])
    got = sorted(str((r.doc_id, r.item_id, r.distance, r.start, r.end)) for r in contaminated(docs, items).collect())
    want = [(1, 7, 0, 1, 21)] * 2 + [(1, None, 1, 1, 21)] * 2 + [(None, 7, 0, 0, 20), (None, None, 1, 0, 20)]
    assert got == sorted(map(str, want))
    assert contaminated(frame([]), items).collect() == []
    assert contaminated(docs, table(spark, [])).collect() == []
    flags = docs.select("doc_id", holds_item(docs, items, docs.text).alias("h")).collect()
    assert sorted(str((r.doc_id, r.h)) for r in flags) == sorted(map(str, [(1, True), (1, True), (None, True), (2, False), (3, False)]))
    assert not any(r[0] for r in docs.select(holds_item(docs, table(spark, []), docs.text)).collect())


def test_parts_of_a_large_benchmark(spark, frame, monkeypatch):
    rng = random.Random(6)
    items = [(i, sentence(rng, 20)) for i in range(12)]
    docs = frame([(i, t) for i, t in items])
    monkeypatch.setattr("siltstone.llm.decontamination.PART_CHARS", 300)
    assert {(r.doc_id, r.item_id) for r in contaminated(docs, table(spark, items)).collect()} == {(i, i) for i, _ in items}
    assert all(r[0] for r in docs.select(holds_item(docs, table(spark, items), docs.text)).collect())


def test_short_items_and_scripts_without_spaces(spark, frame):
    items = [
        (1, "Who wrote Emma?"),
        (2, "光合作用的主要产物是什么物质呢"),
        (3, "ประเทศไทยมีเมืองหลวงชื่อว่าอะไร"),
        (4, "one two three four five six seven"),
        (5, "“When” did the—old—war end…"),
        (6, "?!"),
        (7, "Ωmega"),
    ]
    docs = frame(
        [
            (1, "Quiz: who wrote Emma, and when"),
            (2, "请问植物光合作用的主要产物是什么物质呢这个问题很简单"),
            (3, "ถามว่าประเทศไทยมีเมืองหลวงชื่อว่าอะไรครับ"),
            (4, "zero one two three other five six seven eight"),
            (5, "so when did the old war end"),
            (6, "who wrote Anna, when did they, 光合作用, one two"),
            (7, "an ωmega"),
            (8, "ωmegas"),
            (9, "请问植物光合作用的重要产物是什么物质呢"),
        ]
    )
    got = sorted((r.doc_id, r.item_id, r.distance, r.start, r.end) for r in contaminated(docs, table(spark, items)).collect())
    assert [g[:3] for g in got] == [(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 1), (5, 5, 0), (7, 7, 0), (9, 2, 1)]
    assert got[0][3:] == (1, 4) and got[1][3:] == (4, 19)
