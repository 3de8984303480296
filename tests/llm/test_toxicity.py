"""The convolutional classifier."""

from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from siltstone.llm.toxicity import Settings, best_threshold, fit, score, threshold, thresholds, toxicity, train
from tests.llm.helpers import edge_texts, frame, sentence, shipped  # noqa: F401

SMALL = Settings(bits=12, epochs=4)
BAD = ["vile", "rotten", "beastly"]


def corpus(n=600):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        words = sentence(rng, rng.randrange(5, 60)).split()
        toxic = int(rng.random() < 0.3)
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), rng.choice(["en", "de"])))
        labels.append((i, toxic))
    return rows, labels


def tables(spark, frame, rows, labels):
    return frame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy(spark, frame):
    rows, labels = corpus()
    docs, marks = tables(spark, frame, rows, labels)
    truth = dict(labels)
    got = toxicity(docs, marks, SMALL).collect()
    assert {r.doc_id: r.held_out for r in got} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, *_ in rows}
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_edges(spark, frame):
    rows, labels = corpus(200)
    more = [(i, t, None) for i, t in edge_texts()] + [(500, "v" * 100_000, "xx")]
    docs, marks = tables(spark, frame, rows + more, labels + [(None, 1), (3, None), (5, 1), (5, 0), (9999, 1)])
    model = train(docs, marks, SMALL)
    got = docs.select("doc_id", "text", score(model, docs, F.col("text")).alias("s"), threshold(model, F.col("lang")).alias("t")).collect()
    assert len(got) == len(rows) + len(more) and all(0 <= r.s <= 1 and 0 <= r.t <= 1 for r in got)
    same = {}
    for r in got:  # a score depends on the text only
        assert abs(same.setdefault(r.text or "", r.s) - r.s) < 1e-6


def test_labels_of_the_held_out_fold_teach_nothing(spark, frame):
    rows, labels = corpus(120)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    docs, marks = tables(spark, frame, rows, labels)
    a, b = (train(docs, m, SMALL) for m in (marks, spark.createDataFrame(turned, "doc_id long, toxic int")))
    assert all(np.array_equal(a.arrays[k], b.arrays[k]) for k in a.arrays)


def test_one_kind_or_no_labels(spark, frame):
    rows, _ = corpus(40)
    for labels in ([], [(i, 0) for i in range(40)], [(i, 1) for i in range(40)]):
        docs, marks = tables(spark, frame, rows, labels)
        got = toxicity(docs, marks, SMALL).collect()
        assert len(got) == 40 and all(0 <= r.score <= 1 for r in got)
    docs, marks = tables(spark, frame, [], [])
    assert toxicity(docs, marks, SMALL).collect() == []


def test_threshold_and_share():
    scores, labels = np.array([0.9, 0.8, 0.8, 0.3, 0.1]), np.array([1.0, 1, 1, 0, 0])
    assert 0.3 < best_threshold(scores, labels) < 0.8
    assert best_threshold(np.array([0.5, 0.5]), np.array([1.0, 0.0])) <= 0.5
    model = fit([b"good words", b"vile words"] * 20, np.array([0.0, 1.0] * 20), SMALL, 0.01)
    even = fit([b"good words", b"vile words"] * 20, np.array([0.0, 1.0] * 20), SMALL, 0.5)
    assert model.arrays["bias"][0] < even.arrays["bias"][0]


def test_thresholds_follow_all_labelled_rows(spark, frame):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(2500):
        toxic = int(rng.random() < 0.1)
        words = sentence(rng, 12).split()
        if rng.random() < (0.85 if toxic else 0.08):  # scores overlap
            words[rng.randrange(12)] = rng.choice(BAD)
        rows.append((i, " ".join(words), "xx" if rng.random() < 0.25 else "en"))
        labels.append((i, toxic))
    docs, marks = tables(spark, frame, rows, labels)
    model = train(docs, marks, Settings(bits=12, epochs=4, positives=60, negatives=100))
    assert set(model.thresholds) == {"", "en", "xx"}  # of the sample, a fifth has about 3 toxic rows in xx


def test_sampled_rows_weigh_as_much_as_they_stand_for(spark):
    # 40 ones and 40 zeros are fresh, but there are ten times as many zeros: the cut must be at the upper step
    rows = [("en", 1, 0.9, False)] * 30 + [("en", 1, 0.6, False)] * 10 + [("en", 0, 0.6, False)] * 8 + [("en", 0, 0.1, False)] * 32 + [("en", 0, 0.1, True)] * 360
    got = thresholds(spark.createDataFrame(rows, "lang string, label int, score double, fitted boolean"))
    assert set(got) == {"", "en"} and all(0.6 < t < 0.9 for t in got.values())
    assert best_threshold(np.array([r[2] for r in rows[:80]]), np.array([r[1] for r in rows[:80]])) < 0.6
