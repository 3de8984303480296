"""Stored state + increments = rebuild, for any split of the input."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltstone.operators.increments import EventState, RunState, VersionState
from siltstone.operators.ledger import change_events, revision_ledger, revision_runs
from siltstone.sources.store import EpochLog
from conftest import rows

RUN = "k string, v string, label string, t int, id int, day int"


def split(rng, data, parts):
    """Random parts, one of them empty, and one given twice."""
    dealt = [[] for _ in range(parts)]
    for row in data:
        dealt[rng.randrange(parts)].append(row)
    return [*dealt, dealt[0], []]


def observations(rng, n=120):
    out = []
    for i in range(n):
        t = rng.randrange(60)
        k = "hot" if i % 3 == 0 else rng.choice(["a", "b", None])
        out.append((k, rng.choice(["1", "2", None]), rng.choice(["x", None]), t, i, t // 10))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_runs(spark, tmp_path, seed):
    rng = random.Random(seed)
    data = observations(rng)
    whole = spark.createDataFrame(data, RUN)
    events = [("observed_value_changed", "v")]
    state = RunState(spark, str(tmp_path / "s"), keys=["k"], order=["t", "id"], state=["v"], chunk="day", seen_at="t", payload=["label"], evidence={"id": "id"})
    for i, part in enumerate(split(rng, data, 4)):
        state.apply(spark.createDataFrame(part, RUN))
        if i == 2 and seed == 1:
            state.compact(whole)
    rebuilt = revision_runs(whole, keys=["k"], order=["t", "id"], state=["v"], payload=["label"], seen_at="t", evidence={"id": "id"}, events=events)
    columns = rebuilt.columns
    assert rows(state.ledger(whole, events), *columns) == rows(rebuilt, *columns)
    chunked = revision_runs(whole, keys=["k"], order=["t", "id"], state=["v"], payload=["label"], seen_at="t", evidence={"id": "id"}, events=events, chunk="day")
    assert rows(chunked, *columns) == rows(rebuilt, *columns)


def test_a_late_observation_splits_a_run(spark, tmp_path):
    state = RunState(spark, str(tmp_path / "s"), keys=["k"], order=["t", "id"], state=["v"], chunk="day", seen_at="t")
    first = spark.createDataFrame([("a", "1", None, 1, 1, 0), ("a", "1", None, 9, 9, 0), ("a", "1", None, 12, 12, 1)], RUN)
    state.apply(first)
    events = [("observed_value_changed", "v")]
    assert rows(state.ledger(first, events), "revision_number", "v", "replayed_response_count") == [(1, "1", 3)]
    state.apply(spark.createDataFrame([("a", "2", None, 5, 5, 0)], RUN))
    assert rows(state.ledger(first, events), "revision_number", "v", "replayed_response_count") == [(1, "1", 1), (2, "2", 1), (3, "1", 2)]


def test_a_contradicting_repeat_fails_and_changes_nothing(spark, tmp_path):
    state = RunState(spark, str(tmp_path / "s"), keys=["k"], order=["t", "id"], state=["v"], chunk="day", seen_at="t")
    first = spark.createDataFrame([("a", "1", None, 1, 1, 0)], RUN)
    state.apply(first)
    with pytest.raises(PySparkException, match="two contents"):
        state.apply(spark.createDataFrame([("a", "2", None, 1, 1, 0)], RUN))
    assert rows(state.ledger(first, []), "v") == [("1",)]


@pytest.mark.parametrize("seed", [1, 2])
def test_versions(spark, tmp_path, seed):
    rng = random.Random(seed)
    data = observations(rng)
    whole = spark.createDataFrame(data, RUN)
    state = VersionState(spark, str(tmp_path / "s"), keys=["k"], fields=["k", "v", "label"], seen_at="t", response=["id"], evidence={"id": "id"})
    for i, part in enumerate(split(rng, data, 4)):
        state.apply(spark.createDataFrame(part, RUN))
        if i == 2 and seed == 1:
            state.compact(whole)
    events = [("observed_value_changed", ["v"])]
    rebuilt = revision_ledger(whole, keys=["k"], record={"k": "k", "v": "v", "label": "label"}, seen_at="t", evidence={"id": "id"}, events=events)
    assert rows(state.ledger(whole, events=events), *rebuilt.columns) == rows(rebuilt, *rebuilt.columns)


RECORD = "source string, member string, seq int, amount int, label string, ev int"
OPTIONS = {"values": ["amount"], "metadata": ["label"], "evidence": ["ev"], "contract": "c1", "from_response": []}


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_events(spark, tmp_path, seed):
    rng = random.Random(seed)
    responses = {}
    for source in ("hot", "b", "c"):
        for seq in rng.sample(range(30), 14 if source == "hot" else 5):
            members = [m for m in "uvwxyz" if rng.random() < 0.7] or ["u"]
            responses[source, seq] = [(source, m, seq, rng.randrange(2), rng.choice(["p", None]), 100 * seq) for m in members]
    data = [r for group in responses.values() for r in group]
    whole = spark.createDataFrame(data, RECORD)
    state = EventState(spark, str(tmp_path / "s"), scope=["source"], member="member", sequence="seq", **OPTIONS)
    for i, part in enumerate(split(rng, list(responses), 4)):
        state.apply(spark.createDataFrame([r for key in part for r in responses[key]], RECORD))
        if i == 2 and seed == 1:
            state.compact(whole)
    rebuilt = change_events(whole, scope=["source"], member="member", sequence="seq", **OPTIONS)
    kinds = {r["event_type"] for r in rebuilt.collect()}
    assert kinds == {"source_value_changed", "source_metadata_changed", "source_record_missing", "source_record_reappeared"}
    assert rows(state.events(whole), *rebuilt.columns) == rows(rebuilt, *rebuilt.columns)


def test_an_uncommitted_epoch_is_not_read(spark, tmp_path):
    log = EpochLog(spark, str(tmp_path / "log"))
    log.commit({"t": spark.createDataFrame([(1,)], "x int")})
    broken = spark.createDataFrame([(2,)], "x int").withColumn("x", F.when(F.col("x") == 2, F.raise_error(F.lit("lost")).cast("int")))
    with pytest.raises(PySparkException):
        log.commit({"t": spark.createDataFrame([(3,)], "x int"), "u": broken})
    assert rows(log.read("t", "x int")) == [(1, 1)]
    assert log.commit({"t": spark.createDataFrame([(4,)], "x int")}) == 2
    assert rows(log.read("t", "x int")) == [(1, 1), (4, 2)]
    log.commit({"t": spark.createDataFrame([(9,)], "x int")}, base=True)
    assert rows(log.read("t", "x int")) == [(9, 3)]
    assert rows(log.read("absent", "x int")) == []
