"""Exact values at given ranks, bracketed by a mergeable quantile sketch.

One pass builds a KLL sketch of the values: each task its own, merged in two steps. It brackets every wanted rank with a margin of
``MARGIN`` times the rank error that the sketch keeps with 99 % confidence. Where the brackets still hold many rows, a second pass
counts what lies below each bracket and sketches inside it. The last pass counts below the brackets and every value inside
them. So two or three passes give the exact values, whatever the values are. A bracket that missed its rank, against all odds,
shows in the exact counts and is searched again on the side where the rank lies.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.sources.scratch import scratch_path

#: Size of the sketch; a sketch takes about 250 KB.
SKETCH = 8192
#: Rank error of such a sketch as a share of the rows, at 99 % confidence: 2.296 / k ** 0.9021.
RANK_ERROR = 2.296 / SKETCH**0.9021
MARGIN = 3
#: Sketches that one task merges first, about.
MERGED = 64
#: Counted values that may come to the driver, for all ranks together.
SMALL = 100_000


@dataclass
class Bracket:
    """Where the value of a rank lies: between ``lo`` and ``hi``, both included; ``outer`` are bounds that surely hold."""

    rank: int
    lo: float
    hi: float
    outer: tuple[float, float]


def _sketched(rows: DataFrame, parts: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One row with, for each (values, those below) pair of columns: sketch, count, least, largest, and rows below."""
    aggregates, merges = [], []
    for name, (value, below) in parts.items():
        aggregates += [
            F.kll_sketch_agg_double(value, SKETCH).alias(f"s_{name}"), F.count(value).alias(f"n_{name}"), F.min(value).alias(f"lo_{name}"),
            F.max(value).alias(f"hi_{name}"), F.count_if(below).alias(f"b_{name}"),
        ]
        merges += [
            F.kll_merge_agg_double(F.when(F.col(f"n_{name}") > 0, F.col(f"s_{name}")), SKETCH).alias(f"s_{name}"), F.sum(f"n_{name}").alias(f"n_{name}"),
            F.min(f"lo_{name}").alias(f"lo_{name}"), F.max(f"hi_{name}").alias(f"hi_{name}"), F.sum(f"b_{name}").alias(f"b_{name}"),
        ]
    return rows.groupBy((F.spark_partition_id() / MERGED).cast("int").alias("_part")).agg(*aggregates).agg(*merges)


def _quantiles(sketches: DataFrame, shares: list[tuple[str, float]]) -> list[float]:
    """Quantiles of the sketches of one row; shares are literals, as Spark wants them."""
    cells = [F.kll_sketch_get_quantile_double(f"s_{name}", F.lit(share)).alias(f"q{i}") for i, (name, share) in enumerate(shares)]
    return list(sketches.select(*cells).first()) if cells else []


def _bracket(sketches: DataFrame, wanted: list[tuple[str, int, int, float, float]]) -> list[tuple[float, float]]:
    """Bounds around each (sketch, rank, rows, least, largest); open to the end of the scale where the margin reaches it."""
    margin = MARGIN * RANK_ERROR
    shares = [(name, min(1.0, max(0.0, share))) for name, rank, n, *_ in wanted for share in (rank / n - margin, (rank + 1) / n + margin)]
    found = _quantiles(sketches, shares)
    out = []
    for i, (_, _, _, least, largest) in enumerate(wanted):
        (_, down), (_, up) = shares[2 * i : 2 * i + 2]
        out.append((least if down <= 0 else found[2 * i], largest if up >= 1 else found[2 * i + 1]))
    return out


def values_at_ranks(df: DataFrame, value: Column, ranks: Sequence[int] | Callable[[int], Sequence[int]], small: int = SMALL) -> tuple[int, list[float]]:
    """The number of non-NULL values, and the exact values at 0-based ranks of their order.

    ``ranks`` may be a function of the number of values. NaN is no value here. The driver sees at most ``small`` counted values; more
    are narrowed down in the stored table of counts.
    """
    rows = df.select(value.cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    nothing = F.lit(False)
    sketches = _sketched(rows, {"all": (F.col("v"), nothing)}).persist()  # one row
    n, least, largest = sketches.select("n_all", "lo_all", "hi_all").first()
    n = n or 0
    wanted = list(ranks(n) if callable(ranks) else ranks)
    if any(not 0 <= r < n for r in wanted):
        raise ValueError(f"ranks {wanted} of {n} values")
    open_ = []
    if wanted:
        found = _bracket(sketches, [("all", r, n, least, largest) for r in wanted])
        open_ = [Bracket(r, lo, hi, (least, largest)) for r, (lo, hi) in zip(wanted, found, strict=True)]
    sketches.unpersist()
    answers: dict[int, float] = {}
    sketched = 2 * MARGIN * RANK_ERROR * n * len(open_) > small
    while open_:
        if sketched:
            _narrow(rows, open_)
            sketched = False
        open_ = _resolve(rows, open_, answers, small)
    return n, [answers[r] for r in wanted]


def _narrow(rows: DataFrame, brackets: list[Bracket]) -> None:
    """One pass: count below every bracket, sketch inside it, and draw the bracket closer."""
    v = F.col("v")
    parts = {str(i): (F.when(v.between(b.lo, b.hi), v), v < b.lo) for i, b in enumerate(brackets)}
    sketches = _sketched(rows, parts).persist()  # one row
    counts = sketches.select(*[f"{c}_{i}" for i in parts for c in ("b", "n", "lo", "hi")]).first().asDict()
    held = []
    for i, b in enumerate(brackets):
        below, inside = counts[f"b_{i}"], counts[f"n_{i}"] or 0
        if below <= b.rank < below + inside:
            b.outer = counts[f"lo_{i}"], counts[f"hi_{i}"]
            held.append((b, (str(i), b.rank - below, inside, *b.outer)))
        elif b.rank < below:  # the bracket missed: the rank lies below it
            b.lo, b.hi = b.outer[0], b.lo
        else:
            b.lo, b.hi = b.hi, b.outer[1]
    for (b, _), bounds in zip(held, _bracket(sketches, [w for _, w in held]), strict=True):
        b.lo, b.hi = bounds
    sketches.unpersist()


def _resolve(rows: DataFrame, brackets: list[Bracket], answers: dict[int, float], small: int) -> list[Bracket]:
    """One pass: rows below every bracket and the count of each value inside; returns brackets that missed, moved."""
    v = F.col("v")
    cells = [F.when(v <= b.hi, F.struct(F.lit(i).alias("i"), (v < b.lo).alias("below"), F.when(v >= b.lo, v).alias("v"))) for i, b in enumerate(brackets)]
    counted = rows.select(F.inline(F.array_compact(F.array(*cells)))).groupBy("i", "below", "v").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(rows.sparkSession, "values")
    counted.write.parquet(path)
    counts = rows.sparkSession.read.schema("i int, below boolean, v double, n long").parquet(path)
    sides = {r["i"]: r for r in counts.groupBy("i").agg(F.sum(F.when(F.col("below"), F.col("n")).otherwise(0)).alias("below"), F.sum(F.when(F.col("below"), 0).otherwise(F.col("n"))).alias("inside")).collect()}
    missed = []
    for i, b in enumerate(brackets):
        below, inside = (sides[i]["below"], sides[i]["inside"]) if i in sides else (0, 0)
        if below <= b.rank < below + inside:
            answers[b.rank] = _value_at(counts.where((F.col("i") == i) & ~F.col("below")).select("v", "n"), b.rank - below, small // len(brackets) or 1)
        else:
            missed.append(Bracket(b.rank, *((b.outer[0], b.lo) if b.rank < below else (b.hi, b.outer[1])), b.outer))
    return missed


def _value_at(counts: DataFrame, rank: int, small: int) -> float:
    """The value at a rank in a stored table of counted values, by ranges that hold the rank."""
    while True:
        size = counts.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("size")).first()
        if size["size"] <= small or size["lo"] == size["hi"]:
            for row in counts.orderBy("v").toLocalIterator():
                rank -= row["n"]
                if rank < 0:
                    return row["v"]
        # halving before subtracting keeps the width finite over the whole double range
        lo, hi = size["lo"], size["hi"]
        place = F.least(F.lit(4095), F.floor((F.col("v") / 2 - lo / 2) / F.lit(hi / 2 - lo / 2) * 4096).cast("int"))
        for row in counts.groupBy(place.alias("b")).agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("b").collect():
            if rank < row["n"]:
                counts = counts.where(F.col("v").between(row["lo"], row["hi"]))
                break
            rank -= row["n"]
