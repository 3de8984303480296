"""The pipeline, stage by stage, against what each stage must do."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline
from siltstone.llm.queries import QUERIES, vocabulary

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs.cache()]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], FOLDER).cache())
    return out


def test_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_columns_stay(stages):
    assert all(s.columns == stages[0].columns for s in stages[1:5])


def test_toxic_documents_go(spark, stages):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    toxic = [i for i, t in labels.items() if t]
    clean = [i for i, t in labels.items() if not t]
    assert sum(i in kept for i in clean) / len(clean) > 0.95
    assert sum(i in kept for i in toxic) <= len(toxic) * 0.8


def test_one_copy_stays(stages):
    before, after = ([r.asDict() for r in s.collect()] for s in stages[1:3])
    firsts = {}
    for r in before:
        key = tuple(r["text"].lower().split())
        firsts[key] = min(firsts.get(key, r["doc_id"]), r["doc_id"])
    kept = {r["doc_id"] for r in after}
    assert kept <= set(firsts.values())


def test_benchmark_passages_go(spark, stages):
    plain = lambda t: f" {' '.join(re.findall(r'[a-z0-9\x80-\U0010ffff]+', t.lower()))} "
    items = [plain(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in stages[3].collect()}
    for r in stages[2].collect():
        if any(i in plain(r.text) for i in items):
            assert r.doc_id not in kept


def test_secrets_are_masked(stages):
    from siltstone.llm.credentials import secret_spans

    assert all(r.base == [] for r in secret_spans(stages[4]).collect())
    assert stages[4].count() == stages[3].count()
    assert all(r.n_chars == len(r.text) for r in stages[4].collect() if "[secret]" in r.text)


def test_run_equals_the_stages(spark, stages):
    from siltstone.llm.packing import pieces

    docs = {r.doc_id for r in stages[4].collect()}
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in got} == docs
    want = pieces(stages[4], vocabulary("byte_bpe_50k.json")).collect()
    assert sorted(tuple(r) for r in want) == sorted(tuple(r)[:5] for r in got)


DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long, spans string, key long"


@pytest.mark.parametrize("stage", ["deduplicate", "decontaminate", "redact_secrets", "reject_toxic"])
def test_stages_with_odd_rows(spark, stage):
    secret = "my password = hunter22x now"
    rows = [(i, t, "en", None, len(t or ""), "x", 1) for i, t in [(1, None), (2, ""), (3, " \n"), (4, secret), (4, secret), (None, "clean words here"), (5, "é" * 200_000), (6, "lone document of its own")]]
    function = getattr(corpus_pipeline, stage)
    docs = spark.createDataFrame(rows, DOCUMENT)
    found = function(spark, docs, FOLDER)
    assert found.columns == docs.columns
    got = sorted(str(r.doc_id) for r in found.collect())
    if stage == "deduplicate":  # null and wordless texts are one group
        assert got == ["1", "4", "5", "6", "None"]
    elif stage == "reject_toxic":  # nothing to learn from, or learnt from too little: rows are kept or go, none is made
        assert set(got) <= {str(r[0]) for r in rows}
    else:
        assert got == sorted(str(r[0]) for r in rows)
    if stage == "redact_secrets":
        texts = {r.doc_id: (r.text, r.n_chars, r.spans) for r in found.collect()}
        assert texts[4] == ("my [secret] now", 15, "x") and texts[1] == (None, 0, "x") and texts[2] == ("", 0, "x")
    assert function(spark, docs.limit(0), FOLDER).collect() == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_return_a_row_per_document(spark, name):
    df = QUERIES[name](spark, FOLDER)
    n = {"op2": spark.read.parquet(f"{FOLDER}/pages.parquet").count()}.get(name.split("_")[0], stages_count(spark))
    if name.split("_")[0] in ("op4", "op9", "op12"):
        assert df.count() > 0
    else:
        assert df.count() == n


def stages_count(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").count()
