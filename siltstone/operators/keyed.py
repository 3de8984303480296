"""One row per key.

``row_number() = 1`` is the right shape here: Spark keeps one row per key *before* the
shuffle (WindowGroupLimit), so a key that holds a third of the table sends one row per
input task and not its whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from siltstone.functions.text import as_column


def first_per_key(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key under a total order."""
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[Column | str], newest: Sequence[str]) -> DataFrame:
    """Keep the newest row per key; ``newest`` lists the order columns, compared descending."""
    return first_per_key(df, keys, [F.desc_nulls_last(c) for c in newest])


def dedup_tiebreak(
    df: DataFrame, keys: Sequence[Column | str], prefer_filled: Sequence[str], then: Sequence[str] = ()
) -> DataFrame:
    """One row per key: rows with the label filled in first, then the smallest values, NULLs last."""
    order = [F.desc(F.col(c).isNotNull()) for c in prefer_filled]
    order += [F.asc_nulls_last(c) for c in (*prefer_filled, *then)]
    return first_per_key(df, keys, order)


def dedup_trimmed_key(df: DataFrame, key: str, tiebreak: Sequence[str]) -> DataFrame:
    """Trim a text key, drop blank keys, keep one row per trimmed key."""
    trimmed = df.withColumn(key, F.nullif(F.trim(F.col(key)), F.lit(""))).where(F.col(key).isNotNull())
    return first_per_key(trimmed, [key], [F.asc_nulls_last(c) for c in tiebreak])


def first_last_by_order(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """First and last non-NULL value of each column by a compound order, per key.

    Both come from one partial aggregation, so no group is ever brought together whole.
    """
    position = F.struct(*[F.col(c) for c in order])
    picks = []
    for name in values:
        known = F.when(F.col(name).isNotNull(), position)
        picks += [
            F.min_by(F.col(name), known).alias(f"first_{name}"),
            F.max_by(F.col(name), known).alias(f"last_{name}"),
        ]
    return df.groupBy(*keys).agg(*picks)


def conditional_minimum(value: Column | str, condition: Column) -> Column:
    """``min(value)`` over the rows that meet the condition."""
    return F.min(F.when(condition, as_column(value)))
