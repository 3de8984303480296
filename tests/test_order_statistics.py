"""Exact order statistics in three passes at most."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators import order_statistics as o

SHAPES = {
    "uniform": lambda rng: [rng.random() for _ in range(3000)],
    "skewed": lambda rng: [10 ** rng.uniform(-200, 200) for _ in range(3000)],
    "constant": lambda rng: [3.0] * 50,
    "ties": lambda rng: [float(rng.randrange(4)) for _ in range(3000)],
    "huge": lambda rng: [rng.choice([-1.7e308, 1.7e308, 0.0, rng.random()]) for _ in range(1000)],
    "hot": lambda rng: [7.0 if i % 3 == 0 else rng.gauss(7, 1) for i in range(3000)],
    "few": lambda rng: [2.0, 1.0],
    "infinite": lambda rng: [float("inf"), float("-inf"), 0.0, -0.0, 5e-324] * 20,
}


def column(spark, data):
    return spark.createDataFrame([(v,) for v in [*data, None, float("nan")]], "v double").repartition(7)


def passes(monkeypatch):
    """Counts the passes over the rows."""
    made = []
    for name in ("_sketched", "_resolve"):
        inner = getattr(o, name)
        monkeypatch.setattr(o, name, lambda *a, _inner=inner, _name=name: (made.append(_name), _inner(*a))[1])
    return made


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("small", [2, 100_000])
def test_exact(spark, monkeypatch, shape, small):
    data = SHAPES[shape](random.Random(7))
    made = passes(monkeypatch)
    ranks = sorted({0, len(data) // 4, len(data) // 2, len(data) * 3 // 4, len(data) - 1})
    n, got = o.values_at_ranks(column(spark, data), F.col("v"), ranks, small=small)
    assert n == len(data) and got == [sorted(data)[r] for r in ranks]
    assert len(made) <= 3


def test_a_large_column_in_three_passes(spark, monkeypatch):
    made = passes(monkeypatch)
    rows = spark.range(0, 2_000_000, 1, 8).select((F.pmod(F.col("id") * 1_000_003, F.lit(2_000_000)) / 8).alias("v"))
    n, got = o.values_at_ranks(rows, F.col("v"), lambda n: [n // 4, n // 2], small=1000)
    assert (n, got) == (2_000_000, [500_000 / 8, 1_000_000 / 8])
    assert made == ["_sketched", "_sketched", "_resolve"]


@pytest.mark.parametrize("error", [0.0, -0.05])
def test_brackets_that_miss_are_noticed(spark, monkeypatch, error):
    monkeypatch.setattr(o, "RANK_ERROR", error)
    monkeypatch.setattr(o, "SKETCH", 8)
    data = [float(i * 37 % 5000) for i in range(5000)]
    ranks = [10, 1250, 2500, 4990]
    assert o.values_at_ranks(column(spark, data), F.col("v"), ranks, small=50)[1] == [float(r) for r in ranks]


def test_no_values(spark):
    empty = column(spark, [])
    assert o.values_at_ranks(empty, F.col("v"), lambda n: []) == (0, [])
    with pytest.raises(ValueError, match="ranks"):
        o.values_at_ranks(empty, F.col("v"), [0])
