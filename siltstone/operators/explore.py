"""Exploration: profiles, distributions, chart data, bounded results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from siltstone.functions.text import as_column, decimal_number, is_finite
from siltstone.operators.frequent import frequent_values
from siltstone.operators.order_statistics import values_at_ranks

NUMERIC = (T.NumericType,)


def _is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, NUMERIC)


def _numeric(df: DataFrame, column: str) -> Column:
    """The column as a finite double; text that is no number, NaN and infinities give NULL."""
    value = F.col(column).cast("double") if _is_numeric(df, column) else decimal_number(F.col(column).cast("string"))
    return F.when(is_finite(value), value)


# --- profiles ---------------------------------------------------------------------------


def summarize(df: DataFrame, approximate: bool = True, accuracy: int = 1000) -> DataFrame:
    """One row per column: type, bounds, distinct count, mean, deviation, quartiles, fill.

    Everything comes from one aggregation over one scan. Distinct counts and quartiles are
    sketches, good to 1 / ``accuracy`` in rank; ``approximate=False`` leaves them out.
    """
    aggregates, rows = [F.count(F.lit(1)).alias("_n")], []
    for i, field in enumerate(df.schema.fields):
        c, numeric = F.col(f"`{field.name}`"), isinstance(field.dataType, NUMERIC)
        orderable = not isinstance(field.dataType, (T.MapType, T.ArrayType, T.StructType, T.VariantType))
        nothing = F.lit(None).cast("double")
        parts = {
            "min": F.min(c).cast("string") if orderable else F.lit(None).cast("string"),
            "max": F.max(c).cast("string") if orderable else F.lit(None).cast("string"),
            "avg": F.avg(c).cast("double") if numeric else nothing,
            "std": F.stddev(c) if numeric else nothing,
            "filled": F.count(c),
        }
        if approximate:
            sketch = F.percentile_approx(c.cast("double"), F.array(*[F.lit(q) for q in (0.25, 0.5, 0.75)]), accuracy)
            parts["approx_unique"] = F.approx_count_distinct(c) if orderable else F.lit(None).cast("long")
            parts["quartiles"] = sketch if numeric else F.lit(None).cast("array<double>")
        aggregates += [
            (expr if _aggregates(name, numeric, orderable) else F.max(expr)).alias(f"_{i}_{name}") for name, expr in parts.items()
        ]
        shown = [
            F.lit(i).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("column_type"),
            F.col(f"_{i}_min").alias("min"),
            F.col(f"_{i}_max").alias("max"),
        ]
        if approximate:
            shown.append(F.col(f"_{i}_approx_unique").alias("approx_unique"))
        shown += [F.col(f"_{i}_avg").alias("avg"), F.col(f"_{i}_std").alias("std")]
        if approximate:
            shown += [F.get(F.col(f"_{i}_quartiles"), F.lit(k)).alias(q) for k, q in enumerate(("q25", "q50", "q75"))]
        shown += [
            F.col("_n").alias("count"),
            F.when(F.col("_n") > 0, 100.0 * (F.col("_n") - F.col(f"_{i}_filled")) / F.col("_n")).alias("null_percentage"),
        ]
        rows.append(F.struct(*shown))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def _aggregates(name: str, numeric: bool, orderable: bool) -> bool:
    if name in ("min", "max", "approx_unique"):
        return orderable
    return numeric if name in ("avg", "std", "quartiles") else True


def column_stats(df: DataFrame, top: int = 10, small: int = 20) -> DataFrame:
    """Exact per-column statistics and the most frequent values.

    Counts come from heavy-hitter summaries (``frequent``): columns of few values and clustered keys are settled by one
    pass without a shuffle of rows; only the values of the others are counted in a shuffle. Top values are given for text
    and boolean columns and for columns of at most ``small`` distinct values; ties go to the smaller value.
    """
    fields = df.schema.fields
    best, totals, _ = frequent_values(df, df.columns, top, distinct=True)
    basic = totals.select("position", F.col("rows").alias("total_count"), F.col("nulls").alias("null_count"), F.col("distinct").alias("unique_count"))
    best = best.groupBy("position").agg(F.array_sort(F.collect_list(F.struct("rank", "value", "n"))).alias("_best"))
    numeric = [f.name for f in fields if isinstance(f.dataType, NUMERIC)]
    named = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            *[
                (F.col(f"_{how}_{i}") if f.name in numeric else F.lit(None).cast("double")).alias(how)
                for how in ("min", "max", "avg")
            ],
        )
        for i, f in enumerate(fields)
    ]
    measures = [
        fn(F.col(f"`{f.name}`").cast("double")).alias(f"_{how}_{i}")
        for i, f in enumerate(fields)
        if f.name in numeric
        for how, fn in (("min", F.min), ("max", F.max), ("avg", F.avg))
    ]
    described = df.agg(F.count(F.lit(1)).alias("_n"), *measures).select(F.inline(F.array(*named)))
    listed = F.col("data_type").isin("string", "boolean") | (F.col("unique_count") <= small)
    return (
        described.join(basic, "position", "left")
        .join(best, "position", "left")
        .select(
            "position",
            "column_name",
            "data_type",
            F.coalesce("total_count", F.lit(0)).alias("total_count"),
            F.coalesce("null_count", F.lit(0)).alias("null_count"),
            F.coalesce("unique_count", F.lit(0)).alias("unique_count"),
            "min",
            "max",
            "avg",
            F.when(
                listed, F.transform("_best", lambda b: F.struct(b["value"].alias("value"), b["n"].alias("count")))
            ).alias("top_values"),
        )
    )


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equi-width histogram over the observed range; a constant column fills bin 0.

    Empty bins are listed with zero.
    """
    value = F.col(column).cast("double")
    rows = df.where(F.col(column).isNotNull())
    bounds = rows.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    place = F.floor((value - lo) * F.lit(float(bins)) / F.nullif(hi - lo, F.lit(0.0)))
    bucket = F.coalesce(F.least(F.lit(bins - 1), F.greatest(F.lit(0), place.cast("int"))), F.lit(0))
    counted = rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bucket"))
    return every.join(counted, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def topk_values(df: DataFrame, column: str, k: int = 5) -> DataFrame:
    """Most frequent non-NULL values, ties to the smaller value."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc("v"))
        .limit(k)
    )


def box_plot(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Box-plot statistics (one row) and the outlier rows.

    Quartiles are the sorted values at index floor(n * q); fences lie 1.5 interquartile
    ranges outside, whiskers are the outermost values inside the fences. Quartiles take two or three passes
    (``order_statistics``), the rest one more.
    """
    value = _numeric(df, column)
    rows = df.select(value.alias("value")).where("value is not null")
    n, quartiles = values_at_ranks(rows, F.col("value"), lambda n: [n // 4, n // 2, n * 3 // 4] if n else [])
    if n == 0:
        empty = T.StructType([T.StructField(c, T.DoubleType()) for c in ("min", "q1", "median", "q3", "max")])
        stats = df.sparkSession.createDataFrame([], empty.add("outlier_count", T.LongType()))
        return stats, rows
    q1, median, q3 = quartiles
    spread = 1.5 * (q3 - q1)
    inside = F.col("value").between(q1 - spread, q3 + spread)
    stats = rows.agg(
        F.min(F.when(inside, F.col("value"))).alias("min"),
        F.lit(q1).alias("q1"),
        F.lit(median).alias("median"),
        F.lit(q3).alias("q3"),
        F.max(F.when(inside, F.col("value"))).alias("max"),
        F.count_if(~inside).alias("outlier_count"),
    )
    return stats, rows.where(~inside)


# --- chart data -------------------------------------------------------------------------


def chart_aggregate(
    df: DataFrame, group: str, value: str, how: str = "sum", position: Sequence[str] = ()
) -> DataFrame:
    """One value per group for a chart. NULL groups are dropped, text that is no number ignored.

    ``count`` counts every row of the group; the others give 0 where a group has no number.
    ``first`` takes the first number by ``position``.
    """
    number = _numeric(df, value)
    rows = df.where(F.col(group).isNotNull())
    if how == "first":
        known = F.when(number.isNotNull(), F.struct(*position))
        picked = F.min_by(number, known)
    else:
        picked = {
            "sum": F.sum(number),
            "avg": F.avg(number),
            "min": F.min(number),
            "max": F.max(number),
            "count": F.when(F.count(number) > 0, F.count(F.lit(1)).cast("double")),
        }[how]
    return rows.groupBy(group).agg(F.coalesce(picked, F.lit(0.0)).alias(value))


def sort_limit_nulls_last(df: DataFrame, by: str, descending: bool, n: int | None = None, then: Sequence[str] = ()) -> DataFrame:
    """Sort with NULLs last in both directions, then keep at least one row."""
    first = F.desc_nulls_last(by) if descending else F.asc_nulls_last(by)
    ordered = df.orderBy(first, *[F.asc_nulls_last(c) for c in then])
    return ordered if n is None else ordered.limit(max(1, n))


def chart_transform(
    df: DataFrame, group: str | None, value: str, how: str = "sum", sort: tuple[str, bool] | None = None, n: int | None = None, position: Sequence[str] = ()
) -> DataFrame:
    """Group, then sort, then limit, each step optional."""
    out = df if group is None else chart_aggregate(df, group, value, how, position)
    if sort is not None:
        by, descending = sort
        out = sort_limit_nulls_last(out, by, descending, n, [c for c in out.columns if c != by])
    elif n is not None:
        out = out.limit(max(1, n))
    return out


def stacked_series(df: DataFrame, x: str, series: str, y: str, order: Mapping[str, int]) -> DataFrame:
    """Running total of ``y`` over the series of one x, in series order; missing counts as 0.

    Rows are summed per (x, series) first, so a group holds at most one row per series.
    """
    rank = F.create_map(*[F.lit(v) for pair in order.items() for v in pair])
    cells = df.groupBy(x, series).agg(F.sum(F.coalesce(as_column(y), F.lit(0).cast(df.schema[y].dataType))).alias(y))
    line = Window.partitionBy(x).orderBy(F.element_at(rank, F.col(series))).rowsBetween(Window.unboundedPreceding, 0)
    return cells.select(x, series, y, F.sum(y).over(line).alias("stack_top"))


def kpi(df: DataFrame, column: str, how: str, position: Sequence[str] = ()) -> DataFrame:
    """A single number; NULL if the column has no finite value. ``count`` counts all rows."""
    number = _numeric(df, column)
    picked = {
        "count": lambda: F.count(F.lit(1)).cast("double"),
        "sum": lambda: F.sum(number),
        "avg": lambda: F.avg(number),
        "min": lambda: F.min(number),
        "max": lambda: F.max(number),
        "first": lambda: F.min_by(number, F.when(number.isNotNull(), F.struct(*position))),
    }[how]()
    return df.agg(picked.alias("value"))


# --- bounded results and search ---------------------------------------------------------


def global_text_filter(df: DataFrame, text: str) -> DataFrame:
    """Rows in which any column contains the text, case ignored; NULL never matches."""
    wanted = F.lit(text.lower())
    hit = F.lit(False)
    for name in df.columns:
        cell = F.col(f"`{name}`")
        shown = F.to_json(cell) if isinstance(df.schema[name].dataType, (T.ArrayType, T.MapType, T.StructType)) else cell.cast("string")
        hit = hit | F.coalesce(F.contains(F.lower(shown), wanted), F.lit(False))
    return df.where(hit)


def capped_result(df: DataFrame, cap: int, order: Sequence[Column]) -> DataFrame:
    """The first ``cap`` rows with a flag telling whether there were more."""
    probe = df.orderBy(*order).limit(cap + 1)  # no more rows than these meet in the window
    every = Window.partitionBy(F.lit(1))
    numbered = probe.select("*", F.row_number().over(every.orderBy(*order)).alias("_row"), (F.count(F.lit(1)).over(every) > cap).alias("truncated"))
    return numbered.where(F.col("_row") <= cap).orderBy("_row").drop("_row")


def result_page(df: DataFrame, order: Sequence[Column], offset: int, n: int) -> DataFrame:
    """One page of a totally ordered result."""
    return df.orderBy(*order).offset(offset).limit(n)


def preview(df: DataFrame, n: int = 100, columns: Sequence[str] | None = None) -> DataFrame:
    return (df if columns is None else df.select(*columns)).limit(n)


# --- SQL surface ------------------------------------------------------------------------


def parameterized_sql(spark: SparkSession, text: str, parameters: Mapping[str, Any] | None = None) -> DataFrame:
    """Run SQL with ``:name`` parameters, bound by Spark and never spliced into the text."""
    return spark.sql(text, args=dict(parameters or {}))


def dashboard_dataset(spark: SparkSession, text: str, parameters: Mapping[str, Any], cap: int, order: Sequence[Column]) -> DataFrame:
    """The first ``cap`` rows of a parameterised query, with a flag telling whether there were more."""
    return capped_result(parameterized_sql(spark, text, parameters), cap, order)


def create_view(df: DataFrame, name: str) -> None:
    """Name a query; an existing name is refused, not replaced."""
    df.createTempView(name)


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table, as one query over all of them."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out
