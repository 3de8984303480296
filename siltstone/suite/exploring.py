"""Profiles, distributions, chart data, bounded results, SQL surface."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.operators.explore import (
    box_plot,
    capped_result,
    dashboard_dataset,
    chart_aggregate,
    chart_transform,
    column_stats,
    global_text_filter,
    histogram,
    kpi,
    parameterized_sql,
    result_page,
    sort_limit_nulls_last,
    stacked_series,
    summarize,
    table_row_counts,
    topk_values,
)
from siltstone.sources.readers import spread_scan
from siltstone.suite.registry import query, table

MONEY = "decimal(18,2)"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


_PROFILED = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}


def _summary_sql() -> str:
    parts = []
    for i, (c, kind) in enumerate(_PROFILED.items()):
        numeric = kind in ("bigint", "int", "double")
        shown = {
            "double": "cast({0} as decimal(18,2))",
            "timestamp_ntz": "strftime({0}, '%Y-%m-%d')",
        }.get(kind, "{0}")
        lo, hi = (f"cast({shown.format(f'{f}({c})')} as varchar)" for f in ("min", "max"))
        avg = f"round(cast(sum(cast({c} as decimal(18,2))) as double) / count({c}), 4)" if numeric else "cast(null as double)"
        std = f"round(stddev({c}), 2)" if numeric else "cast(null as double)"
        parts.append(
            f"select {i} as position, '{c}' as column_name, '{kind}' as column_type, {lo} as min, {hi} as max, {avg} as avg, {std} as std, "
            f"count(*) as count, 100.0::double * (count(*) - count({c})) / count(*) as null_percentage from lineitem"
        )
    return " union all ".join(parts)


@query("summarize", _summary_sql())
def _summarize(spark, folder):
    report = summarize(table(spark, folder, "lineitem").select(*_PROFILED), approximate=False)

    def shown(c):
        kind = F.col("column_type")
        return (
            F.when(kind == "double", F.col(c).cast(MONEY).cast("string"))
            .when(kind == "timestamp_ntz", F.substring(c, 1, 10))
            .otherwise(F.col(c))
            .alias(c)
        )

    return report.select(
        "position",
        "column_name",
        "column_type",
        shown("min"),
        shown("max"),
        F.round("avg", 4).alias("avg"),
        F.round("std", 2).alias("std"),
        "count",
        F.col("null_percentage").cast("double").alias("null_percentage"),
    )


@query("summarize_sketches")
def _summarize_sketches(spark, folder):
    return summarize(spread_scan(table(spark, folder, "lineitem")))


@query(
    "histogram_20",
    """
    with b as (select min(l_extendedprice) as lo, max(l_extendedprice) as hi from lineitem),
    h as (select coalesce(least(19, greatest(0, cast(floor((l_extendedprice - lo) * 20.0::double / nullif(hi - lo, 0)) as integer))), 0) as bucket, count(*) as n from lineitem, b group by 1)
    select cast(i as integer) as bucket, coalesce(n, 0) as n from range(20) r(i) left join h on bucket = i
    """,
)
def _histogram(spark, folder):
    return histogram(table(spark, folder, "lineitem"), "l_extendedprice")


@query(
    "topk_values",
    "select p_brand as v, count(*) as n from lineitem join part on l_partkey = p_partkey group by 1 order by n desc, v limit 5",
)
def _topk(spark, folder):
    joined = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return topk_values(joined, "p_brand")


_STATS = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}


def _stats_sql() -> str:
    parts = []
    for i, (c, kind) in enumerate(_STATS.items()):
        numeric = kind in ("bigint", "double")
        values = (
            "null"
            if kind != "string"
            else f"(select string_agg(v || '=' || n, ';' order by n desc, v) from (select {c} as v, count(*) as n from orders where {c} is not null group by 1 order by n desc, v limit 10))"
        )
        nums = [f"cast({f}({c}) as double)" if numeric else "cast(null as double)" for f in ("min", "max")]
        avg = f"round(cast(sum(cast({c} as decimal(18,2))) as double) / count({c}), 3)" if numeric else "cast(null as double)"
        parts.append(
            f"select '{c}' as column_name, '{kind}' as data_type, count(*) as total_count, count(*) - count({c}) as null_count, count(distinct {c}) as unique_count, "
            f"{nums[0]} as min, {nums[1]} as max, {avg} as avg, {values} as top_values from orders"
        )
    return " union all ".join(parts)


@query("column_stats", _stats_sql())
def _column_stats(spark, folder):
    stats = column_stats(table(spark, folder, "orders").select(*_STATS))
    listed = F.transform("top_values", lambda v: F.concat_ws("=", v["value"], v["count"].cast("string")))
    return stats.drop("position").withColumns(
        {"top_values": F.when(F.col("top_values").isNotNull(), F.array_join(listed, ";")), "avg": F.round("avg", 3)}
    )


_QUARTILES = """
    s as (select l_extendedprice as v, row_number() over (order by l_extendedprice) - 1 as i, count(*) over () as n from lineitem),
    q as (select max(v) filter (where i = n // 4) as q1, max(v) filter (where i = n // 2) as median, max(v) filter (where i = n * 3 // 4) as q3 from s),
    f as (select *, q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi from q)
"""


@query(
    "box_plot",
    f"""
    with {_QUARTILES}
    select min(v) filter (where v between lo and hi) as min, max(q1) as q1, max(median) as median, max(q3) as q3,
           max(v) filter (where v between lo and hi) as max, count(*) filter (where v not between lo and hi) as outlier_count from s, f
    """,
)
def _box_plot(spark, folder):
    return box_plot(table(spark, folder, "lineitem"), "l_extendedprice")[0]


@query(
    "box_plot_outliers",
    """
    with s as (select value as v, row_number() over (order by value) - 1 as i, count(*) over () as n from events),
    q as (select max(v) filter (where i = n // 4) as q1, max(v) filter (where i = n * 3 // 4) as q3 from s)
    select v as value from s, q where not v between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)
    """,
)
def _outliers(spark, folder):
    return box_plot(table(spark, folder, "events"), "value")[1]


@query(
    "chart_aggregate",
    """
    select o_orderpriority, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as o_totalprice from orders where o_orderpriority <> '5-LOW' group by 1
    """,
)
def _chart(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
        F.col("o_totalprice").cast(MONEY).alias("o_totalprice"),
    )
    return chart_aggregate(orders, "o_orderpriority", "o_totalprice", "sum").withColumn(
        "o_totalprice", F.round("o_totalprice", 2)
    )


@query(
    "chart_top_groups",
    """
    select user_id, cast(count(*) as double) as value from events group by user_id order by value desc, user_id limit 8
    """,
)
def _chart_top(spark, folder):
    return chart_transform(table(spark, folder, "events"), "user_id", "value", "count", ("value", True), 8)


@query(
    "kpi_metric",
    """
    select cast(count(*) as double) as rows_total, max(l_extendedprice) as top_price, arg_min(l_quantity, (l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) as first_quantity from lineitem
    """,
)
def _kpi(spark, folder):
    lines = table(spark, folder, "lineitem")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return (
        kpi(lines, "l_quantity", "count")
        .withColumnRenamed("value", "rows_total")
        .select(
            "rows_total",
            kpi(lines, "l_extendedprice", "max").scalar().alias("top_price"),
            kpi(lines, "l_quantity", "first", order).scalar().alias("first_quantity"),
        )
    )


@query(
    "stacked_series",
    """
    with c as (select cast(ts as date) as day, event_type, sum(cast(value as decimal(18,2))) as amount,
                      case event_type when 'view' then 1 when 'click' then 2 when 'signup' then 3 when 'purchase' then 4 else 5 end as pos from events group by all)
    select day, event_type, cast(amount as decimal(28,2)) as amount,
           cast(sum(amount) over (partition by day order by pos rows unbounded preceding) as decimal(38,2)) as stack_top from c
    """,
)
def _stacked(spark, folder):
    df = table(spark, folder, "events").select(
        F.col("ts").cast("date").alias("day"), "event_type", F.col("value").cast(MONEY).alias("amount")
    )
    order = {"view": 1, "click": 2, "signup": 3, "purchase": 4, "error": 5}
    return stacked_series(df, "day", "event_type", "amount", order)


@query(
    "sort_limit_nulls_last",
    """
    select page_id, k from (select event_id as page_id, nullif(try_cast(json_extract_string(props, '$.k') as integer), 99) as k from events)
    order by k desc nulls last, page_id limit 250
    """,
)
def _sorted(spark, folder):
    k = F.nullif(F.get_json_object("props", "$.k").try_cast("int"), F.lit(99))
    df = table(spark, folder, "events").select(F.col("event_id").alias("page_id"), k.alias("k"))
    return sort_limit_nulls_last(df, "k", True, 250, ["page_id"])


@query(
    "capped_result",
    "select o_orderkey, o_totalprice, true as truncated from orders order by o_totalprice desc, o_orderkey limit 100",
)
def _capped(spark, folder):
    df = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return capped_result(df, 100, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query(
    "result_page",
    "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 50 offset 200",
)
def _page(spark, folder):
    df = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return result_page(df, [F.desc("o_totalprice"), F.asc("o_orderkey")], 200, 50)


@query(
    "latest_total",
    """
    select o_orderkey, o_orderdate, o_totalprice from (select distinct o_orderkey, o_orderdate, o_totalprice from orders where o_orderstatus = 'O')
    order by o_orderdate desc, o_orderkey desc limit 1
    """,
)
def _latest_total(spark, folder):
    pages = table(spark, folder, "orders").where("o_orderstatus = 'O'").select("o_orderkey", "o_orderdate", "o_totalprice").distinct()
    return pages.orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(1)


@query(
    "global_text_filter",
    """
    select doc_id, lang, source, n_chars from documents
    where contains(lower(text), 'license') or contains(lower(source), 'license') or contains(lower(lang), 'license') or contains(cast(doc_id as varchar), 'license') or contains(cast(n_chars as varchar), 'license')
    """,
)
def _text_filter(spark, folder):
    return global_text_filter(table(spark, folder, "documents"), "LICENSE").select("doc_id", "lang", "source", "n_chars")


_TOP_ORDERS = "select o_orderkey, o_custkey, o_totalprice from orders_input where o_orderpriority <> :excluded"


@query(
    "dashboard_dataset",
    """
    select o_orderkey, o_custkey, o_totalprice, (select count(*) > 50 from orders where o_orderpriority <> '1-URGENT') as truncated
    from orders where o_orderpriority <> '1-URGENT' order by o_totalprice desc, o_orderkey limit 50
    """,
)
def _dashboard(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("orders_input")
    return dashboard_dataset(spark, _TOP_ORDERS, {"excluded": "1-URGENT"}, 50, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query(
    "parameterized_sql",
    """
    select o_custkey, count(*) as orders, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(28,2)) as total from orders
    where o_orderdate between timestamp '1996-01-01' and timestamp '1998-06-30' and o_orderpriority <> 'it''s' group by o_custkey
    """,
)
def _parameters(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("orders_input")
    return parameterized_sql(
        spark,
        """
        select o_custkey, count(*) as orders, sum(cast(o_totalprice as decimal(18,2))) as total from orders_input
        where cast(o_orderdate as date) between cast(:start as date) and cast(:end as date) and o_orderpriority <> :excluded
        group by o_custkey
        """,
        {"start": "1996-01-01", "end": "1998-06-30", "excluded": "it's"},
    )


@query(
    "table_row_counts",
    " union all ".join(f"select '{t}' as table_name, count(*) as row_count from {t}" for t in TABLES),
)
def _row_counts(spark, folder):
    return table_row_counts({t: table(spark, folder, t) for t in TABLES})
