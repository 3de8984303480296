"""Ledgers: replays, A-B-A, metadata changes, conflicts, presence."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators.ledger import (
    change_events,
    conflicting_keys,
    fold_replays,
    guarded_current,
    guarded_dedup,
    presence_timeline,
    revision_ledger,
    revision_runs,
)
from conftest import rows

OBSERVED = "k string, v double, m string, seen int, sha string"


def ledger(spark, data, chunk=None):
    return revision_ledger(
        spark.createDataFrame(data, OBSERVED),
        keys=["k"],
        record={"k": "k", "v": "v", "m": "m"},
        seen_at="seen",
        evidence={"sha": "sha"},
        events=[("observed_value_changed", ["v"])],
        chunk=chunk,
    )


def test_version_ledger_folds_replays_and_returns(spark):
    data = [("a", 1.0, "x", 1, "s1"), ("a", 1.0, "x", 2, "s2"), ("a", 2.0, "x", 3, "s3"), ("a", 1.0, "x", 4, "s4"), ("a", 1.0, "y", 5, "s5")]
    for chunk in (None, F.col("first_seen_at_utc")):
        got = rows(
            ledger(spark, data, chunk), "revision_number", "v", "m", "replayed_response_count", "is_current", "revision_event_type", "revision_count", "previous_v", "first_sha", "last_sha"
        )
        assert got == [
            (1, 1.0, "x", 3, False, "first_observed", 3, None, "s1", "s4"),
            (2, 2.0, "x", 1, False, "observed_value_changed", 3, 1.0, "s3", "s3"),
            (3, 1.0, "y", 1, True, "observed_value_changed", 3, 2.0, "s5", "s5"),
        ]


def test_version_ledger_is_idempotent_and_null_keys_hold_together(spark):
    data = [(None, 0.0, None, 1, "s1"), (None, None, None, 2, "s2"), ("a", 0.0, None, 1, "s1")]
    once = rows(ledger(spark, data), "k", "v", "revision_number", "is_current", "revision_event_type")
    twice = rows(ledger(spark, data + data), "k", "v", "revision_number", "is_current", "revision_event_type")
    assert once == twice
    assert (None, 0.0, 1, False, "first_observed") in once and (None, None, 2, True, "observed_value_changed") in once


def test_current_version_is_the_one_seen_last(spark):
    data = [("a", 1.0, "x", 1, "s1"), ("a", 2.0, "x", 2, "s2"), ("a", 1.0, "x", 3, "s3")]
    assert rows(ledger(spark, data), "revision_number", "v", "is_current") == [(1, 1.0, True), (2, 2.0, False)]


def runs(spark, data, chunk=None):
    return revision_runs(
        spark.createDataFrame(data, "k string, v string, st string, up int, label string, t int, id int"),
        keys=["k"],
        order=["t", "id"],
        state=["v", "st", "up"],
        payload=["label"],
        seen_at="t",
        evidence={"id": "id"},
        events=[("observed_value_changed", "v"), ("observed_status_changed", "st")],
        chunk=chunk,
    )


@pytest.mark.parametrize("chunk", [None, "t"])
def test_run_ledger_keeps_a_b_a(spark, chunk):
    data = [
        ("a", "1", None, 0, None, 1, 1), ("a", "1", None, 0, "L", 2, 2), ("a", "2", None, 0, "M", 3, 3), ("a", "1", None, 0, "N", 4, 4),
        ("a", "1", "p", 0, "N", 5, 5), ("a", "1", "p", 1, "N", 6, 6), ("b", None, None, 0, "Z", 1, 7),
    ]
    got = rows(
        runs(spark, data, None if chunk is None else F.col(chunk)),
        "k", "revision_number", "v", "label", "replayed_response_count", "is_current", "revision_count", "previous_v", "revision_event_type", "first_id", "last_id",
    )
    assert got == [
        ("a", 1, "1", "L", 2, False, 5, None, "first_observed", 1, 2),
        ("a", 2, "2", "M", 1, False, 5, "1", "observed_value_changed", 3, 3),
        ("a", 3, "1", "N", 1, False, 5, "2", "observed_value_changed", 4, 4),
        ("a", 4, "1", "N", 1, False, 5, "1", "observed_status_changed", 5, 5),
        ("a", 5, "1", "N", 1, True, 5, "1", "observed_metadata_changed", 6, 6),
        ("b", 1, None, "Z", 1, True, 1, None, "first_observed", 7, 7),
    ]


def test_conflicts(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", 2.0), ("c", None), ("c", 1.0), ("d", None)], "k string, v double")
    assert rows(conflicting_keys(df, ["k"], ["v"])) == [("b",), ("c",)]
    assert rows(conflicting_keys(df, ["k"], ["v"], null_is_value=False)) == [("b",)]


QUOTE = "src string, day string, code string, seq long, mid double, label string, batch string"


def current(spark, data):
    return guarded_current(
        spark.createDataFrame(data, QUOTE), source=["src"], identity=["day", "code"], sequence="seq", measures=["mid"], labels=["label"],
        evidence=["batch"], newest=["batch"], zero_flag="zero",
    )


def test_guarded_current_folds_labels_and_takes_the_latest(spark):
    data = [("s", "d", "USD", 1, 4.0, None, "b1"), ("s", "d", "USD", 2, 0.0, "us dollar", "b2"), ("s", "d", "USD", 2, 0.0, "dollar", "b2"), ("s", "d", None, 1, 1.0, "x", "b1")]
    assert rows(current(spark, data), "code", "mid", "label", "seq", "zero") == [("USD", 0.0, "dollar", 2, True), (None, 1.0, "x", 1, False)]


def test_guarded_current_fails_on_any_conflict(spark):
    data = [("s", "d", "USD", 1, 4.0, "x", "b1"), ("s", "d", "USD", 1, 4.1, "x", "b1"), ("s", "d", "USD", 2, 5.0, "x", "b2")]
    with pytest.raises(Exception, match="conflicting values"):
        current(spark, data).collect()
    with pytest.raises(Exception, match="conflicting values"):
        current(spark, data).select("code").collect()


def test_fold_replays_without_guard(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, "x")], "k string, v int, w string")
    assert rows(fold_replays(df, ["k"], ["v", "w"])) == [("a", 1, "x")]


def test_guarded_dedup(spark):
    data = [("a", 1.0, None), ("a", 1.0, "z"), ("a", 1.0, "b"), ("b", 2.0, None)]
    df = spark.createDataFrame(data, "k string, v double, label string")
    assert rows(guarded_dedup(df, identity=["k"], measures=["v"], labels=["label"])) == [("a", "b", 1.0), ("b", None, 2.0)]
    bad = spark.createDataFrame(data + [("b", None, None)], "k string, v double, label string")
    with pytest.raises(Exception, match="conflicting values"):
        guarded_dedup(bad, identity=["k"], measures=["v"], labels=["label"]).collect()
    assert len(rows(guarded_dedup(bad, identity=["k"], measures=["v"], labels=["label"], null_is_value=False))) == 2


RECORD = "src string, day string, code string, seq int, mid double, tbl string, name string, sha string"
KW = dict(scope=["src", "day"], member="code", sequence="seq", evidence=["sha"], from_response=["tbl"])


def timeline_brute(data):
    """Presence timeline as the definition says: every later response of the same publication."""
    batches, first, held = {}, {}, {}
    for s, d, c, q, mid, tbl, name, sha in data:
        b = batches.setdefault((s, d), {})
        old = b.get(q)
        b[q] = (sha if old is None else min(old[0], sha), tbl if old is None or old[1] is None else min(old[1], tbl or old[1]))
        first[(s, d, c)] = min(first.get((s, d, c), q), q)
        held[(s, d, c, q)] = (mid, tbl, name)
    out = {}
    for (s, d, c), start in first.items():
        line = []
        for q in sorted(x for x in batches[(s, d)] if x >= start):
            mid, tbl, name = held.get((s, d, c, q), (None, None, None))
            present = (s, d, c, q) in held
            sha, batch_tbl = batches[(s, d)][q]
            line.append((q, sha, present, mid, tbl if tbl is not None else batch_tbl, name))
        out[(s, d, c)] = line
    return out


def events_brute(data):
    out = []
    for key, line in timeline_brute(data).items():
        for before, now in zip(line, line[1:]):
            if before[2] and not now[2]:
                kind = "source_record_missing"
            elif not before[2] and now[2]:
                kind = "source_record_reappeared"
            elif not now[2]:
                continue
            elif before[3] != now[3]:
                kind = "source_value_changed"
            elif before[4:] != now[4:]:
                kind = "source_metadata_changed"
            else:
                continue
            names = [n for n, a, b in zip(("record_presence", "mid", "tbl", "name"), before[2:], now[2:]) if a != b]
            out.append((*key, kind, before[0], now[0], before[1], now[1], before[3], now[3], before[4], now[4], before[5], now[5], names))
    return sorted(out, key=str)


def random_records(seed):
    rng = random.Random(seed)
    data = []
    for s in "AB":
        for d in ("d1", "d2"):
            for q in range(1, 9):
                if rng.random() < 0.2:
                    continue
                for c in ("USD", "EUR", "CHF", None):
                    if rng.random() < 0.6:
                        data.append((s, d, c, q, float(rng.randrange(2)), rng.choice(["A", None]), rng.choice(["x", "y"]), f"{s}{q}{rng.randrange(3)}"))
    return data


@pytest.mark.parametrize("seed, chunk", [(0, None), (1, None), (2, None), (3, 1), (4, 2), (5, 3), (0, 100)])
def test_change_events_against_the_definition(spark, seed, chunk):
    import json

    data = random_records(seed)
    found = change_events(
        spark.createDataFrame(data, RECORD), values=["mid"], metadata=["tbl", "name"], contract="v1", chunk_steps=chunk, **KW
    ).collect()
    got = sorted(
        (
            (r["src"], r["day"], r["code"], r["event_type"], r["previous_seq"], r["seq"], r["previous_sha"], r["sha"], r["previous_mid"], r["current_mid"],
             r["previous_tbl"], r["current_tbl"], r["previous_name"], r["current_name"], json.loads(r["changed_fields"]))
            for r in found
        ),
        key=str,
    )
    assert got == events_brute(data)


@pytest.mark.parametrize("seed, chunk", [(0, None), (1, None), (2, 2)])
def test_presence_timeline_against_the_definition(spark, seed, chunk):
    data = random_records(seed)
    found = presence_timeline(spark.createDataFrame(data, RECORD), fields=["mid", "tbl", "name"], chunk_steps=chunk, **KW)
    got = sorted((tuple(r) for r in found.select("src", "day", "code", "seq", "sha", "is_present", "mid", "tbl", "name").collect()), key=str)
    want = sorted(((*k, *step) for k, line in timeline_brute(data).items() for step in line), key=str)
    assert got == want


def test_absent_publication_makes_no_event(spark):
    data = [("A", "d1", "USD", 1, 1.0, "A", "x", "s1"), ("A", "d2", "USD", 2, 1.0, "A", "x", "s2")]
    assert change_events(spark.createDataFrame(data, RECORD), values=["mid"], metadata=["tbl", "name"], contract="v1", **KW).count() == 0


def test_row_order_and_partitioning_do_not_matter(spark):
    data = random_records(11)
    base = spark.createDataFrame(data, RECORD)
    kw = dict(values=["mid"], metadata=["tbl", "name"], contract="v1", **KW)
    one = rows(change_events(base.coalesce(1), **kw))
    assert one == rows(change_events(base.orderBy(F.desc("seq")).repartition(7), **kw))


def test_folds_sort_by_the_sequence_first(spark):
    df = spark.createDataFrame([("s", "b", "k", 1, 1.0, "x")], "src string, batch string, code string, seq long, mid double, no string")
    found = guarded_current(df, source=["src", "batch"], identity=["code"], sequence="seq", measures=["mid"], evidence=["no"])
    assert "SortAggregate(key=[seq" in found._jdf.queryExecution().executedPlan().toString()
    assert found.columns == ["src", "batch", "code", "seq", "mid", "no"]


def test_chunked_runs_compute_their_pieces_once(spark):
    df = spark.range(60).selectExpr("'k' as k", "id", "id div 7 as s", "id div 10 as day")
    runs = revision_runs(df, keys=["k"], order=["id"], state=["s"], seen_at="id", events=[("changed", "s")], chunk="day")
    assert "Range" not in runs._jdf.queryExecution().optimizedPlan().toString()
    assert rows(runs, "revision_number", "s", "replayed_response_count") == [(i + 1, i, min(7, 60 - 7 * i)) for i in range(9)]
