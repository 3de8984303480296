"""Exact dedup against the digest index."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

from siltstone.llm.digests import DigestIndex, new_index
from siltstone.llm.shared import stored
from tests.llm.helpers import edge_texts, frame, shipped  # noqa: F401


def brute(rows, seen=()):
    """Rows of (doc_id, keep_id, group_size, kept, sha) by a plain loop; ``seen`` maps digests to the id that stays."""
    def sha(text):
        return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()

    groups: dict[str, list] = {}
    for doc_id, text in rows:
        groups.setdefault(sha(text), []).append(doc_id)
    seen = dict(seen)
    out = []
    for h, ids in groups.items():
        first = min(ids, key=lambda i: (i is None, i or 0))
        keep, left = (seen[h], 0) if h in seen else (first, 1)
        for i in ids:
            stays = left > 0 and i == first
            left -= stays
            out.append((i, keep, len(ids), stays, h))
        seen.setdefault(h, first)
    return out, seen


def found(df):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect())


def test_edge_cases(spark, frame):
    rows = edge_texts() + [(20, "a  b"), (21, "a\t\r\nb"), (22, "a b"), (23, "a b "), (24, "A b")]
    assert found(new_index(spark).add(frame(rows), "one")) == Counter(brute(rows)[0])


def test_empty_table(spark, frame):
    index = new_index(spark)
    assert index.add(frame([]), "none").collect() == []
    assert index.entries().count() == 0


def test_batches_and_reopening(spark, frame, tmp_path):
    first = [(5, "x y"), (6, "x  y"), (7, "z"), (8, None)]
    second = [(1, "x\ty"), (9, "new"), (3, "new"), (4, ""), (10, "other")]
    index = DigestIndex.open(spark, str(tmp_path / "index"), 4)
    rows, seen = brute(first)
    assert found(index.add(frame(first), "one")) == Counter(rows)
    again = DigestIndex.open(spark, str(tmp_path / "index"), 4)  # another session finds the folder
    rows, seen = brute(second, seen)
    assert found(again.add(frame(second), "two")) == Counter(rows)
    assert again.entries().count() == len(seen) == again.entries().select("digest").distinct().count()


def test_a_batch_may_run_again(spark, frame, tmp_path):
    rows = [(2, "p"), (1, "p"), (1, "p"), (None, "q"), (3, "r")]
    index = DigestIndex.open(spark, str(tmp_path / "index"), 4)
    once = found(index.add(frame(rows), "one"))
    assert found(index.add(frame(rows[::-1]), "one")) == once == Counter(brute(rows)[0])
    assert index.entries().count() == 3


def test_the_index_is_not_shuffled(spark, frame, tmp_path):
    index = DigestIndex.open(spark, str(tmp_path / "index"), 4)
    index.add(frame([(i, f"t{i}") for i in range(50)]), "one")
    groups = stored(index.entries(), "groups")
    plan = index.unseen(groups)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    assert "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the batch only


def test_a_hot_text(spark, frame):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    got = new_index(spark).add(frame(rows), "one")
    assert found(got) == Counter(brute(rows)[0])
