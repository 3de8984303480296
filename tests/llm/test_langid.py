"""Language identification."""

from __future__ import annotations

import random
import zlib

import numpy as np

from siltstone.llm.arrays import read_array
from siltstone.llm.langid import languages, score_words, train, words_of
from tests.llm.helpers import edge_texts, frame, shipped  # noqa: F401


def corpus(n=300):
    rng = random.Random(1)
    parts = {"aa": ["ka", "lo", "mi", "tar"], "bb": ["kö", "lü", "mä", "ter"], "cc": ["xo", "lo", "zu", "par"]}
    rows = []
    for i in range(n):
        lang = rng.choice(list(parts))
        words = ["".join(rng.choice(parts[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(3, 30))]
        rows.append((i, " ".join(words), lang))
    return rows


def frames(frame, rows):
    return frame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(spark, frame):
    rows = corpus()
    docs = frames(frame, rows)
    got = {r.doc_id: r for r in languages(docs, train(docs)).collect()}
    held = [(i, lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out for i, _ in held) and sum(r.held_out for r in got.values()) == len(held)
    assert np.mean([got[i].lang_pred == lang for i, lang in held]) > 0.98


def test_edges(spark, frame):
    rows = corpus(60) + [(i and 700 + i, t, None) for i, t in edge_texts()] + [(900, None, "aa"), (901, "123 !?", "aa"), (902, "KALO", None), (None, "ka", "zz")]
    docs = frames(frame, rows)
    model = train(docs)
    assert model.langs == ["aa", "bb", "cc"]  # a row without an id teaches nothing
    got = languages(docs, model).collect()
    assert len(got) == len(rows)
    named = {}
    for r in got:
        named.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert named[900] == named[901] == [("und", 0.0)] and named[902][0][0] == "aa" and named[705] == [("und", 0.0)]
    assert all(0 <= r.score <= 1 for r in got)
    assert languages(docs.limit(0), model).collect() == []


def test_without_a_model(spark, frame):
    docs = frames(frame, [(1, "abc", None)])
    assert [(r.lang_pred, r.score) for r in languages(docs, train(docs)).collect()] == [("und", 0.0)]


def test_held_out_rows_teach_nothing(spark, frame):
    rows = corpus(100)
    turned = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 5 == 0 else lang) for i, t, lang in rows]
    a, b = (train(frames(frame, r)) for r in (rows, turned))
    assert a.langs == b.langs and a.sizes == b.sizes
    for level in a.sizes:
        keys = np.sort(np.concatenate([read_array(a.folder, f"{level}-key-{s}") for s, n in enumerate(a.sizes[level]) if n]))
        assert all(np.array_equal(x, y) for x, y in zip(a.rows(level, keys), b.rows(level, keys), strict=True))


def test_unseen_words_fall_back_to_shorter_grams(spark, frame):
    docs = frames(frame, corpus())
    model = train(docs)
    data = np.frombuffer("tarkalo tarkalokalotarqq xq q".encode(), np.uint8)
    points, starts, ends, _ = words_of(data, np.array([0, len(data)]))
    scores = score_words(model, points, starts, ends)
    best = model.langs.index("aa")
    assert scores[0].argmax() == best and scores[1].argmax() == best
    assert scores[2].argmax() == model.langs.index("cc")  # only its x is known
    assert (scores[3] == 0).all()


def test_every_word_and_gram_of_the_sample_is_kept(spark, frame, monkeypatch):
    monkeypatch.setattr("siltstone.llm.langid.SHARD", 100)  # several shards
    rows = corpus(200)
    model = train(frames(frame, rows))
    assert model.bits > 1
    taught = [(t, lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 5]
    counts = {}
    for text, lang in taught:
        for w in text.split():
            counts.setdefault(w, {}).setdefault(lang, 0)
            counts[w][lang] += 1
    totals = {lang: sum(c.get(lang, 0) for c in counts.values()) for lang in model.langs}
    assert sum(model.sizes[0]) == len(counts)
    assert sum(model.sizes[3]) == len({w[k : k + 3] for w in counts for k in range(len(w) - 2)})
    words = sorted(counts)
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    points, starts, ends, _ = words_of(data, np.array([0, len(data)]))
    want = [[np.log(counts[w].get(lang, 0.5) / totals[lang]) for lang in model.langs] for w in words]
    assert np.allclose(score_words(model, points, starts, ends), want, atol=1e-5)
