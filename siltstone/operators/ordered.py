"""Ordered scans over keys of any size.

``lag``, ``row_number`` and running sums need the rows of a key in order. A plain window
sends each key to one task, which is fine while keys are small and ruinous when one key
holds a third of the table. With ``chunk`` (a column that never decreases along the order,
such as the day of the order timestamp) the scan runs in two levels instead:

1. inside each (key, chunk) the window functions run as usual, so one hot key is spread
   over as many tasks as it has chunks;
2. each (key, chunk) is folded to one summary row, the summaries are scanned per key, and
   what they carry (last state, rows so far) is joined back on the same (key, chunk)
   partitioning, so the large side is shuffled once.

Keys and chunks are packed into structs, whose equality treats NULL members as equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from siltstone.functions.text import as_column

_SCRATCH = ("_key", "_chunk", "_pos")


def _packed(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column | str) -> DataFrame:
    return df.select(
        "*",
        F.struct(*keys).alias("_key"),
        F.struct(as_column(chunk).alias("c")).alias("_chunk"),
        F.struct(*order).alias("_pos"),
    )


def annotate_sequence(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    previous: Sequence[str] = (),
    newest: Sequence[str] = (),
    chunk: Column | str | None = None,
) -> DataFrame:
    """Number the rows of each key and look one row back.

    Adds ``_row`` (from 1), ``_rows`` (rows of the key), ``_prev`` (struct of the previous
    row's ``previous`` columns, NULL on the first row) and ``_newest`` (the largest
    ``newest`` struct of the key). ``order`` must be total within a key.
    """
    look = F.struct(*(previous or order))
    top = F.struct(*(newest or order))
    if chunk is None:
        whole = Window.partitionBy(*keys)
        line = whole.orderBy(*order)
        return df.select(
            "*",
            F.row_number().over(line).cast("long").alias("_row"),
            F.count(F.lit(1)).over(whole).alias("_rows"),
            F.lag(look).over(line).alias("_prev"),
            F.max(top).over(whole).alias("_newest"),
        )

    rows = _packed(df, keys, order, chunk)
    line = Window.partitionBy("_key", "_chunk").orderBy("_pos")
    inner = rows.select("*", F.row_number().over(line).cast("long").alias("_row_in"), F.lag(look).over(line).alias("_prev_in"))

    along = Window.partitionBy("_key").orderBy("_chunk")
    carried = (
        rows.groupBy("_key", "_chunk")
        .agg(F.count(F.lit(1)).alias("_n"), F.max_by(look, F.col("_pos")).alias("_last"), F.max(top).alias("_top"))
        .select(
            "_key",
            "_chunk",
            F.coalesce(F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
            F.sum("_n").over(Window.partitionBy("_key")).alias("_rows"),
            F.lag("_last").over(along).alias("_carry"),
            F.max("_top").over(Window.partitionBy("_key")).alias("_newest"),
        )
    )
    return inner.join(carried, ["_key", "_chunk"]).select(
        *df.columns,
        (F.col("_before") + F.col("_row_in")).alias("_row"),
        "_rows",
        F.coalesce("_prev_in", "_carry").alias("_prev"),
        "_newest",
    )


def number_runs(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    state: Sequence[str],
    chunk: Column | str | None = None,
) -> DataFrame:
    """Number the runs of equal consecutive states of each key.

    Adds ``_run`` (from 1), ``_runs`` (runs of the key) and ``_prev`` (struct of the state
    one row back, NULL on the first row). A state that returns later starts a new run.
    """
    now = F.struct(*state)
    if chunk is None:
        line = Window.partitionBy(*keys).orderBy(*order)
        looked = df.select("*", F.lag(now).over(line).alias("_prev"))
        starts = F.when(F.col("_prev").isNotNull() & F.col("_prev").eqNullSafe(now), 0).otherwise(1)
        numbered = looked.select(
            "*", F.sum(starts).over(line.rowsBetween(Window.unboundedPreceding, 0)).alias("_run")
        )
        return numbered.select("*", F.max("_run").over(Window.partitionBy(*keys)).alias("_runs"))

    rows = _packed(df, keys, order, chunk).select("*", now.alias("_now"))
    line = Window.partitionBy("_key", "_chunk").orderBy("_pos")
    looked = rows.select("*", F.lag("_now").over(line).alias("_prev_in"))
    turned = looked.select(
        "*",
        F.when(F.col("_prev_in").isNull() | F.col("_prev_in").eqNullSafe(F.col("_now")), 0)
        .otherwise(1)
        .alias("_turn"),
    )
    inner = turned.select(
        "*", F.sum("_turn").over(line.rowsBetween(Window.unboundedPreceding, 0)).alias("_run_in")
    )

    along = Window.partitionBy("_key").orderBy("_chunk")
    folded = (
        turned.groupBy("_key", "_chunk")
        .agg(
            F.min_by("_now", "_pos").alias("_first"),
            F.max_by("_now", "_pos").alias("_last"),
            F.sum("_turn").alias("_turns"),
        )
        .select("*", F.lag("_last").over(along).alias("_carry"))
        .select(
            "*",
            F.when(F.col("_carry").isNotNull() & F.col("_carry").eqNullSafe(F.col("_first")), 0)
            .otherwise(1)
            .alias("_opens"),
        )
        .select(
            "_key",
            "_chunk",
            "_carry",
            (
                F.coalesce(
                    F.sum(F.col("_turns") + F.col("_opens")).over(along.rowsBetween(Window.unboundedPreceding, -1)),
                    F.lit(0),
                )
                + F.col("_opens")
            ).alias("_base"),
            F.sum(F.col("_turns") + F.col("_opens")).over(Window.partitionBy("_key")).alias("_runs"),
        )
    )
    return inner.join(folded, ["_key", "_chunk"]).select(
        *df.columns,
        F.coalesce("_prev_in", "_carry").alias("_prev"),
        (F.col("_base") + F.col("_run_in")).alias("_run"),
        "_runs",
    )
