"""Coverage marts: a universe against what was discovered, landed and modeled."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.functions.text import ratio


def one_row(df: DataFrame, **aggregates: Column) -> DataFrame:
    """Aggregate a whole table to one row."""
    return df.agg(*[c.alias(n) for n, c in aggregates.items()])


def side_by_side(*summaries: DataFrame) -> DataFrame:
    """Put one-row summaries next to each other.

    The first frame is scanned, the others enter as scalar subqueries, which Spark merges
    per source and which fail if a summary has more than one row.
    """
    first, *rest = summaries
    return first.select("*", *[s.select(c).scalar().alias(c) for s in rest for c in s.columns])


def coverage_mart(*summaries: DataFrame, ratios: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row of totals with ratios (output -> (part, whole)); no ratio over an empty whole."""
    totals = side_by_side(*summaries)
    return totals.select("*", *[ratio(part, whole).alias(n) for n, (part, whole) in ratios.items()])


def column_coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """Filled count and share of each column, one row per column, from one pass."""
    counted = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in columns])
    return counted.select("_n", F.inline(pairs)).select(
        "column_name",
        "filled",
        F.when(F.col("_n") > 0, F.col("filled") * 100.0 / F.col("_n")).alias("filled_pct"),
    )


def text_member_count(*parts: str, sep: str = ":") -> Column:
    """Distinct members of a composite text key; a member with a NULL part is not counted."""
    pieces: list[Column] = []
    for number, part in enumerate(parts):
        if number:
            pieces.append(F.lit(sep))
        pieces.append(F.col(part).cast("string"))
    return F.count_distinct(F.concat(*pieces))
