from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators.intervals import contiguous_through, coverage_gaps, latest_outcome
from conftest import rows

DAY = dt.timedelta(days=1)


def gaps_brute(spans, lo, hi):
    covered = {lo + i * DAY for s, e in spans for i in range(-500, 500) if s <= lo + i * DAY <= e}
    out, day, open_day = [], lo, None
    while day <= hi + DAY:
        if day <= hi and day not in covered:
            open_day = open_day or day
        elif open_day:
            out.append((open_day, day - DAY))
            open_day = None
        day += DAY
    return out


def through_brute(spans, lo):
    covered = {lo + i * DAY for s, e in spans for i in range(-500, 500) if s <= lo + i * DAY <= e}
    day = lo
    while day in covered:
        day += DAY
    return day - DAY if day > lo else None


@pytest.mark.parametrize("seed", range(8))
def test_against_the_calendar(spark, seed):
    rng = random.Random(seed)
    base = dt.date(2024, 1, 1)
    data = []
    for key in "abcde":
        for _ in range(rng.randrange(1, 7)):
            s = base + rng.randrange(-5, 45) * DAY
            data.append((key, s, s + rng.randrange(0, 12) * DAY))
    df = spark.createDataFrame(data, "k string, s date, e date")
    lo, hi = base, base + 30 * DAY
    got = rows(coverage_gaps(df, ["k"], "s", "e", F.lit(lo), F.lit(hi)))
    spans = {k: [(s, e) for kk, s, e in data if kk == k] for k in "abcde"}
    assert got == sorted((k, a, b) for k in spans for a, b in gaps_brute(spans[k], lo, hi))
    assert rows(contiguous_through(df, ["k"], "s", "e", F.lit(lo))) == sorted(
        ((k, through_brute(spans[k], lo)) for k in spans), key=lambda t: t[0]
    )


def test_latest_outcome(spark):
    df = spark.createDataFrame([("a", 1, 2, 1, "x"), ("a", 1, 2, 2, "y"), ("a", 1, 3, 1, "z")], "k string, s int, e int, t int, o string")
    assert rows(latest_outcome(df, ["k"], "s", "e", ["t"]), "s", "e", "o") == [(1, 2, "y"), (1, 3, "z")]
