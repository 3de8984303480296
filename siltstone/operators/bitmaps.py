"""Distinct counts from stored bitmaps: exact, and mergeable over any range of days, files or groups.

Values get dense numbers once, in a dictionary that only grows. A bitmap holds the numbers that a group saw, in pieces of 32,768 bits; OR
merges groups, and the set bits are the distinct count. So one small table, built per day, answers every coarser grain,
and a new day adds its own rows only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

PIECE_BITS = 15
#: Values that are numbered in one task, about.
PART = 100_000


def value_numbers(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(value, number) of the non-NULL values that ``known`` lacks, numbered from behind it without gaps.

    Numbers are counted per hash part and then inside the part, so no task sees all values.
    """
    fresh = values.select(F.col(column).alias("value")).where("value is not null").distinct()
    first = 0
    if known is not None:
        fresh = fresh.join(known.select("value"), "value", "left_anti")
        first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
    parts = fresh.count() // PART + 1
    dealt = fresh.withColumn("_part", F.pmod(F.xxhash64("value"), F.lit(parts)))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    starts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("value")) - 1
    return dealt.withColumn("_in", inside).join(starts, "_part").select("value", (F.lit(first) + F.col("_start") + F.col("_in")).cast("long").alias("number"))


def distinct_bitmaps(df: DataFrame, by: Sequence[str], column: str, numbers: DataFrame) -> DataFrame:
    """(by, piece, bitmap) of the values that each group saw; groups without a value have no row."""
    seen = df.select(*by, F.col(column).alias("value")).where("value is not null").distinct()
    numbered = seen.join(numbers, "value")
    piece = F.shiftright("number", PIECE_BITS).alias("piece")
    return numbered.groupBy(*by, piece).agg(F.bitmap_construct_agg(F.col("number").bitwiseAND(F.lit((1 << PIECE_BITS) - 1))).alias("bitmap"))


def merged_bitmaps(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """The bitmaps of coarser groups."""
    return bitmaps.groupBy(*by, "piece").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_values(bitmaps: DataFrame, by: Sequence[str], name: str = "distinct_values") -> DataFrame:
    """Distinct count of every group, at the bitmaps' grain or any coarser one."""
    return merged_bitmaps(bitmaps, by).groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias(name))
