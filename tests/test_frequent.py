"""Most frequent values, exact, whatever the road."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltstone.operators.frequent import frequent_values
from conftest import rows


def brute(data, k):
    counts = Counter(str(v) for v in data if v is not None)
    return [(v, n) for v, n in sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[:k]], len(counts)


def check(df, columns, k, data, capacity, distinct=False):
    best, totals, ways = frequent_values(df, columns, k, capacity, distinct)
    got = {}
    for r in sorted(best.collect(), key=lambda r: (r["position"], r["rank"])):
        got.setdefault(r["position"], []).append((r["value"], r["n"]))
    numbers = {r["position"]: r for r in totals.collect()}
    for i, column in enumerate(data):
        want, size = brute(column, k)
        assert got.get(i, []) == want, (i, ways)
        assert numbers[i]["rows"] == len(column) and numbers[i]["nulls"] == sum(v is None for v in column)
        assert numbers[i]["distinct"] == size or (not distinct and numbers[i]["distinct"] is None)
    return ways


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_all_roads(spark, seed):
    rng = random.Random(seed)
    n = 4000
    skewed = [f"v{int(rng.paretovariate(0.7)) % 3000}" for _ in range(n)]
    few = [rng.choice([None, "a", "é", "", "Z"]) for _ in range(n)]
    keys = [i // 3 for i in range(n)]
    even = rng.sample(range(n), n)
    nothing = [None] * n
    data = list(zip(skewed, few, keys, even, nothing, strict=True))
    df = spark.createDataFrame(data, "skewed string, few string, keys int, even int, nothing int").coalesce(3)
    ways = check(df, df.columns, 5, list(zip(*data, strict=True)), 64)
    assert ways == {"summary": [1, 4], "runs": [2], "counting": [0], "shuffle": [3]}
    assert check(df, df.columns, 5, list(zip(*data, strict=True)), 64, distinct=True)["shuffle"] == [0, 3]


def test_runs_across_tasks(spark, tmp_path):
    """A clustered key in several files, with runs that cross their borders, hot ones too."""
    keys = sorted([7] * 1500 + [i // 2 for i in range(-900, 900)] + [10**12, -(10**12)])
    days = [dt.date(1969, 12, 1) + dt.timedelta(days=i // 40) for i in range(len(keys))]
    for i, lo in enumerate(range(0, len(keys), 500)):
        part = list(zip(keys[lo : lo + 500], days[lo : lo + 500], strict=True))
        spark.createDataFrame(part, "k long, d date").coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert df.rdd.getNumPartitions() > 2
    ways = check(df, ["k", "d"], 10, [keys, days], 16, distinct=True)
    assert ways["runs"] == [0] and ways["summary"] == [1]  # no task has more than 16 days


def test_unique_keys_are_not_shuffled(spark):
    df = spark.range(100_000)
    best, totals, ways = frequent_values(df, ["id"], 3, 64, distinct=True)
    assert ways["runs"] == [0]
    assert rows(best.select("value", "n")) == [("0", 1), ("1", 1), ("10", 1)]
    assert totals.first()["distinct"] == 100_000


def test_overlapping_or_falling_keys_are_no_runs(spark):
    df = spark.range(0, 3000, 1, 3).select((F.col("id") % 1000).alias("k"))
    assert check(df, ["k"], 4, [[i % 1000 for i in range(3000)]], 64)["shuffle"] == [0]
    down = spark.createDataFrame([(-i,) for i in range(3000)], "k long").coalesce(1)
    assert check(down, ["k"], 4, [[-i for i in range(3000)]], 64)["shuffle"] == [0]


def test_empty_table(spark):
    best, totals, _ = frequent_values(spark.createDataFrame([], "a int, b string"), ["a", "b"], 3)
    assert best.collect() == [] and all(r["rows"] == 0 and r["distinct"] == 0 for r in totals.collect())


def test_a_hot_value(spark):
    data = [("hot" if i % 3 == 0 else f"x{i}") for i in range(30_000)]
    df = spark.createDataFrame([(v,) for v in data], "v string").repartition(6)
    assert check(df, ["v"], 1, [data], 64)["counting"] == [0]
