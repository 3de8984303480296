"""Coverage of date ranges: what is not covered, and how far coverage reaches.

A date column has few distinct values, so intervals are first folded to one row per
(key, start day) by partial aggregation. What a key has left is bounded by the calendar,
whatever its share of the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from siltstone.operators.keyed import latest_per_key


def _spans(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    return df.groupBy(*keys, F.col(start).alias("_lo")).agg(F.max(end).alias("_hi"))


def _with_sentinels(spans: DataFrame, keys: Sequence[str], first: Column, last: Column) -> DataFrame:
    """Spans inside [first, last] plus one empty span behind the end, with the reach before each."""
    inside = spans.where((F.col("_hi") >= first) & (F.col("_lo") <= last)).select(*keys, "_lo", "_hi")
    tails = spans.select(*keys).distinct().select(*keys, F.date_add(last, 1).alias("_lo"), last.alias("_hi"))
    line = Window.partitionBy(*keys).orderBy("_lo").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.greatest(F.coalesce(F.max("_hi").over(line), F.date_sub(first, 1)), F.date_sub(first, 1))
    return inside.unionByName(tails).select(*keys, "_lo", "_hi", reach.alias("_reach"))


def coverage_gaps(df: DataFrame, keys: Sequence[str], start: str, end: str, first: Column, last: Column) -> DataFrame:
    """Uncovered sub-ranges of [first, last] per key (``gap_start``, ``gap_end``, both inclusive)."""
    lined = _with_sentinels(_spans(df, keys, start, end), keys, first, last)
    low = F.date_add(F.col("_reach"), 1)
    high = F.least(F.date_sub(F.col("_lo"), 1), last)
    return lined.where(low <= high).select(*keys, low.alias("gap_start"), high.alias("gap_end"))


def contiguous_through(df: DataFrame, keys: Sequence[str], start: str, end: str, first: Column) -> DataFrame:
    """Last day up to which coverage from ``first`` on has no hole; NULL if ``first`` is uncovered."""
    spans = _spans(df, keys, start, end).where(F.col("_hi") >= first)
    line = Window.partitionBy(*keys).orderBy("_lo").rowsBetween(Window.unboundedPreceding, -1)
    before = F.date_sub(first, 1)
    reach = F.greatest(F.coalesce(F.max("_hi").over(line), before), before)
    lined = spans.select(*keys, "_lo", "_hi", reach.alias("_reach"))
    hole = F.when(F.col("_lo") > F.date_add(F.col("_reach"), 1), F.col("_lo"))
    # The reach at the first hole is the answer; without a hole it is the largest end.
    through = F.coalesce(F.min_by("_reach", hole), F.max("_hi"))
    answers = lined.groupBy(*keys).agg(F.when(through >= first, through).alias("contiguous_through"))
    return df.select(*keys).distinct().join(answers, list(keys), "left")


def latest_outcome(df: DataFrame, keys: Sequence[str], start: str, end: str, newest: Sequence[str]) -> DataFrame:
    """The newest outcome for each identical interval."""
    return latest_per_key(df, [*keys, start, end], newest)
