"""The two-level scans must agree with the plain ones and with brute force."""

from __future__ import annotations

import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from siltstone.operators.keyed import first_last_by_order, latest_per_key
from siltstone.operators.ordered import annotate_sequence, number_runs
from conftest import rows


def sample(spark, seed, hot=True):
    rng = random.Random(seed)
    data, seq = [], 0
    for _ in range(600):
        key = None if rng.random() < 0.1 else ("hot" if hot and rng.random() < 0.5 else rng.choice("abcdef"))
        seq += 1
        data.append((key, rng.randrange(20), seq, rng.choice(["x", "y", None])))
    rng.shuffle(data)
    return spark.createDataFrame(data, "k string, t int, id int, s string"), data


def brute_runs(data):
    out = {}
    key = lambda r: (r[0] is None, r[0] or "")
    for k, group in groupby(sorted(data, key=lambda r: (*key(r), r[1], r[2])), key=lambda r: r[0]):
        run, prev, items = 0, "start", list(group)
        for r in items:
            before = None if prev == "start" else (prev,)
            if prev == "start" or r[3] != prev:
                run += 1
            out[r[2]] = (k, run, before)
            prev = r[3]
        for r in items:
            out[r[2]] += (run,)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("chunk", [None, "t", "wide"])
def test_number_runs(spark, seed, chunk):
    df, data = sample(spark, seed)
    column = {None: None, "t": F.col("t"), "wide": F.floor(F.col("t") / 7)}[chunk]
    got = number_runs(df, ["k"], ["t", "id"], ["s"], chunk=column).collect()
    want = brute_runs(data)
    assert len(got) == len(data)
    for r in got:
        before = None if r["_prev"] is None else (r["_prev"]["s"],)
        assert (r["k"], r["_run"], before, r["_runs"]) == want[r["id"]]


@pytest.mark.parametrize("chunk", [None, "t"])
def test_annotate_sequence(spark, chunk):
    df, data = sample(spark, 9)
    got = annotate_sequence(
        df, ["k"], ["t", "id"], previous=["id", "s"], newest=["s", "id"], chunk=None if chunk is None else F.col("t")
    ).collect()
    by_key = {}
    for r in data:
        by_key.setdefault(r[0], []).append(r)
    for r in got:
        line = sorted(by_key[r["k"]], key=lambda x: (x[1], x[2]))
        at = [x[2] for x in line].index(r["id"])
        assert r["_row"] == at + 1 and r["_rows"] == len(line)
        assert r["_prev"] == (None if at == 0 else (line[at - 1][2], line[at - 1][3]))
        top = max(line, key=lambda x: (x[3] is not None, x[3] or "", x[2]))
        assert r["_newest"]["id"] == top[2]


def test_chunked_scan_spreads_a_hot_key(spark):
    df, _ = sample(spark, 4)
    plan = number_runs(df, ["k"], ["t", "id"], ["s"], chunk=F.col("t"))._jdf.queryExecution().toString()
    assert "hashpartitioning(_key" in plan and "_chunk" in plan


def test_one_row_per_key_is_limited_before_the_shuffle(spark):
    df, data = sample(spark, 5)
    picked = latest_per_key(df, ["k"], ["t", "id"])
    want = {}
    for r in data:
        if r[0] not in want or (r[1], r[2]) > want[r[0]]:
            want[r[0]] = (r[1], r[2])
    assert {r["k"]: (r["t"], r["id"]) for r in picked.collect()} == want
    assert picked._jdf.queryExecution().toString().count("WindowGroupLimit") >= 2


def test_first_last_skips_nulls(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("a", 3, "y"), ("a", 4, None), ("b", 1, None)], "k string, o int, v string")
    assert rows(first_last_by_order(df, ["k"], ["o"], ["v"])) == [("a", "x", "y"), ("b", None, None)]
