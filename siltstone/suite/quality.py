"""Equivalence, reconciliation, rules, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltstone.operators.intervals import latest_outcome
from siltstone.operators.metrics import Metric, grain_check, latest_dates_window, metric_crosscheck, query_metric
from siltstone.operators.quality import (
    dataset_differences,
    dataset_equivalence,
    dataset_profile,
    duplicate_keys,
    exact_key_set,
    key_regression,
    missing_keys,
    outcome_counts,
    page_checks,
    partition_homogeneity,
    pending_inputs,
    profile_differences,
    repeated_in_group,
    rows_with_keys,
    rule_violations,
    value_reconciliation,
)
from siltstone.sources.scratch import scratch_path
from siltstone.sources.writers import write_partitioned
from siltstone.suite.registry import query, table


def _releases(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """An older release with all orders, a newer one without the pending ones."""
    orders = table(spark, folder, "orders")
    keys = orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("day"), "o_orderstatus", "o_orderpriority")
    return keys, keys.where("o_orderstatus <> 'P'")


_RELEASES = """
    baseline as (select o_custkey, cast(o_orderdate as date) as day, o_orderstatus, o_orderpriority from orders),
    fresh as (select * from baseline where o_orderstatus <> 'P')
"""


@query(
    "dataset_equivalence",
    f"""
    with {_RELEASES}
    select (select count(*) from baseline) as left_rows, (select count(*) from fresh) as right_rows,
           (select count(*) from (select o_custkey, day, o_orderpriority from baseline except all select o_custkey, day, o_orderpriority from fresh)) as only_left,
           (select count(*) from (select o_custkey, day, o_orderpriority from fresh except all select o_custkey, day, o_orderpriority from baseline)) as only_right,
           false as equivalent
    """,
)
def _equivalence(spark, folder):
    return dataset_equivalence(*_releases(spark, folder), technical=["o_orderstatus"])


@query(
    "dataset_differences",
    f"""
    with {_RELEASES},
    l as (select o_custkey, o_orderpriority, o_orderstatus, count(*) as n from baseline group by all),
    r as (select o_custkey, o_orderpriority, o_orderstatus, count(*) as n from baseline where o_orderpriority <> '1-URGENT' or o_orderstatus = 'F' group by all)
    select l.o_custkey, l.o_orderpriority, l.o_orderstatus, 'left' as side, l.n - coalesce(r.n, 0) as extra_rows
    from l left join r using (o_custkey, o_orderpriority, o_orderstatus) where l.n > coalesce(r.n, 0)
    """,
)
def _differences(spark, folder):
    left = _releases(spark, folder)[0].drop("day")
    return dataset_differences(left, left.where("o_orderpriority <> '1-URGENT' or o_orderstatus = 'F'"))


@query(
    "key_regression",
    f"""
    with {_RELEASES}, cut as (select max(day) as d from baseline),
    o as (select distinct o_custkey, day from baseline), n as (select distinct o_custkey, day from fresh, cut where day <= d)
    select (select count(*) from o) as baseline_distinct_keys, (select count(*) from n) as current_distinct_keys_through_cutoff,
           (select count(*) from (select * from o except select * from n)) as missing_key_count,
           (select d from cut) as baseline_max_date, (select max(day) from fresh) as current_max_date,
           (select max(day) from fresh) < (select d from cut) as max_date_regressed
    """,
)
def _regression(spark, folder):
    return key_regression(*_releases(spark, folder), ["o_custkey", "day"], "day")[0]


@query(
    "key_regression_sample",
    f"""
    with {_RELEASES}
    select * from (select o_custkey, day from baseline except select o_custkey, day from fresh) order by o_custkey, day limit 20
    """,
)
def _regression_sample(spark, folder):
    return key_regression(*_releases(spark, folder), ["o_custkey", "day"], "day", sample=20)[1]


@query(
    "missing_keys",
    f"with {_RELEASES} select o_custkey, day from baseline except select o_custkey, day from fresh",
)
def _missing_keys(spark, folder):
    return missing_keys(*_releases(spark, folder), ["o_custkey", "day"])


@query(
    "exact_key_set",
    """
    select coalesce(c_custkey, k) as k, coalesce(n, 0) as row_count,
           case when c_custkey is null then 'unexpected' when n is null then 'missing' else 'repeated' end as reason
    from (select c_custkey from customer where c_mktsegment <> 'BUILDING') full join (select o_custkey as k, count(*) as n from orders group by 1) on c_custkey = k
    where c_custkey is null or n is null or n > 1
    """,
)
def _exact_key_set(spark, folder):
    observed = table(spark, folder, "orders").select(F.col("o_custkey").alias("k"))
    expected = table(spark, folder, "customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("k"))
    return exact_key_set(observed, expected, ["k"])


@query(
    "duplicate_keys",
    "select l_orderkey, l_linenumber, count(*) as row_count from lineitem where l_returnflag <> 'N' group by all having count(*) > 1",
)
def _duplicate_keys(spark, folder):
    return duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], F.col("l_returnflag") != "N")


@query(
    "pending_inputs",
    """
    select c_custkey, sha256(c_name || c_mktsegment) as content_hash from customer
    where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')
    """,
)
def _pending_inputs(spark, folder):
    content = F.sha2(F.concat("c_name", "c_mktsegment"), 256)
    inputs = table(spark, folder, "customer").select("c_custkey", content.alias("content_hash"))
    done = (
        table(spark, folder, "orders")
        .where("o_orderstatus = 'P'")
        .join(inputs, F.col("o_custkey") == F.col("c_custkey"))
        .select("content_hash")
    )
    return pending_inputs(inputs, done, "content_hash")


_API = """
    api as (
      select l_orderkey, l_linenumber, l_returnflag,
             case l_linestatus when 'O' then cast(cast(l_quantity as integer) as varchar) || '.00'
                               else case l_returnflag when 'A' then null when 'R' then cast(cast(l_quantity as integer) + 1 as varchar) else 'n/a' end end as value,
             case when l_tax = 0 then '' else 'known' end as code
      from lineitem),
    bulk as (
      select l_orderkey, l_linenumber, case when l_discount = 0 then null when l_discount = 0.01 then 'NaN' else ' ' || cast(cast(l_quantity as integer) as varchar) end as bulk_value
      from lineitem where l_partkey > l_suppkey),
    idx as (select l_orderkey, l_linenumber, count(*) as n, min(bulk_value) as b from bulk group by all),
    judged as (
      select api.*, case when code = '' then 'missing_code' when n is null then case when value is null then 'null_api_value_absent_from_bulk' else 'missing_bulk_key' end
                when n <> 1 then 'ambiguous_bulk_key' when value is null then 'null_api_value_with_bulk_key' when b is null then 'bulk_value_null'
                when value = 'n/a' then 'bulk_value_not_numeric' when b = 'NaN' then 'nonfinite_value'
                when cast(value as decimal(18,2)) = cast(trim(b) as decimal(18,2)) then 'exact_numeric_match' else 'value_conflict' end as outcome
      from api left join idx using (l_orderkey, l_linenumber))
"""


def _judged(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    whole = F.col("l_quantity").cast("int")
    flag = F.col("l_returnflag")
    value = F.when(F.col("l_linestatus") == "O", F.concat(whole.cast("string"), F.lit(".00"))).otherwise(
        F.when(flag == "A", F.lit(None)).when(flag == "R", (whole + 1).cast("string")).otherwise(F.lit("n/a"))
    )
    code = F.when(F.col("l_tax") == 0, F.lit("")).otherwise(F.lit("known"))
    api = lines.select("l_orderkey", "l_linenumber", "l_returnflag", value.alias("value"), code.alias("code"))
    stored = F.when(F.col("l_discount") == 0, F.lit(None)).when(F.col("l_discount") == 0.01, F.lit("NaN")).otherwise(
        F.concat(F.lit(" "), whole.cast("string"))
    )
    bulk = lines.where("l_partkey > l_suppkey").select("l_orderkey", "l_linenumber", stored.alias("bulk_value"))
    return value_reconciliation(api, bulk, ["l_orderkey", "l_linenumber"], "value", "bulk_value", required="code")


@query("value_reconciliation", f"with {_API} select * from judged")
def _reconciliation(spark, folder):
    return _judged(spark, folder)


@query("outcome_counts", f"with {_API} select l_returnflag, outcome, count(*) as row_count from judged group by all")
def _outcomes(spark, folder):
    return outcome_counts(_judged(spark, folder), ["l_returnflag"])


@query(
    "rule_violations",
    """
    select o_orderkey as record_key, 'total_too_large' as rule from orders where o_totalprice > 400000
    union all select o_orderkey, 'unknown_status' from orders where o_orderstatus not in ('O', 'F')
    union all select o_orderkey, 'late_urgent' from orders where o_orderpriority = '1-URGENT' and o_orderdate > timestamp '2000-01-01'
    union all select l_orderkey, 'repeated_line' from lineitem where (l_orderkey, l_linenumber) in (select (l_orderkey, l_linenumber) from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
    """,
)
def _rules(spark, folder):
    orders = table(spark, folder, "orders").withColumn("record_key", F.col("o_orderkey"))
    single = rule_violations(
        orders,
        ["record_key"],
        {
            "total_too_large": F.col("o_totalprice") > 400000,
            "unknown_status": ~F.col("o_orderstatus").isin("O", "F"),
            "late_urgent": (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderdate") > F.lit("2000-01-01").cast("timestamp_ntz")),
        },
    )
    lines = table(spark, folder, "lineitem").withColumn("record_key", F.col("l_orderkey"))
    return single.unionByName(repeated_in_group(lines, ["l_orderkey", "l_linenumber"], ["record_key"], "repeated_line"))


@query(
    "page_checks",
    """
    with p as (select l_orderkey, l_partkey, l_linenumber as page, cast(round(l_tax * 100) as integer) as pages, cast(l_quantity as integer) as per_page,
                      cast(round(l_discount * 400) as integer) as total, l_linenumber * 3 as got from lineitem)
    select *, case when page < 1 or pages < 0 or per_page < 1 or total < 0 then 'invalid_number' when pages = 0 and total <> 0 then 'rows_without_pages'
                   when pages > 0 and page > pages then 'page_beyond_last' when got > per_page then 'more_rows_than_page_size'
                   when got > total then 'more_rows_than_total' when total > 0 and got = 0 then 'empty_page' end as page_error from p
    """,
)
def _pages(spark, folder):
    df = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.col("l_linenumber").alias("page"),
        F.round(F.col("l_tax") * 100).cast("int").alias("pages"),
        F.col("l_quantity").cast("int").alias("per_page"),
        F.round(F.col("l_discount") * 400).cast("int").alias("total"),
        (F.col("l_linenumber") * 3).alias("got"),
    )
    return page_checks(df, "page", "pages", "per_page", "total", "got")


@query(
    "dataset_profile",
    """
    select 'orders' as dataset_id, count(*) as row_count, strftime(min(o_orderdate), '%Y-%m-%d') as min_date, strftime(max(o_orderdate), '%Y-%m-%d') as max_date,
           'o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string' as column_types
    from orders
    """,
)
def _profile(spark, folder):
    return dataset_profile(table(spark, folder, "orders"), "orders", "o_orderdate")


@query(
    "profile_differences",
    """
    select 'orders' as dataset_id, 'row_count' as field, cast((select count(*) from orders where o_orderstatus <> 'P') as varchar) as expected, cast((select count(*) from orders) as varchar) as observed
    where (select count(*) from orders where o_orderstatus = 'P') > 0
    union all select 'gone', f, v, null from (select unnest(['row_count', 'min_date', 'max_date', 'column_types']) as f, unnest([cast((select count(*) from customer) as varchar), null, null,
        'c_custkey:bigint']) as v) where v is not null
    """,
)
def _profile_differences(spark, folder):
    """A contract recorded before the pending orders came, with a dataset that is no longer there."""
    orders = table(spark, folder, "orders")
    recorded = dataset_profile(orders.where("o_orderstatus <> 'P'"), "orders", "o_orderdate").unionByName(
        dataset_profile(table(spark, folder, "customer").select("c_custkey"), "gone")
    )
    whole = dataset_profile(orders, "orders", "o_orderdate")
    bounds = recorded.where("dataset_id = 'orders'").select(F.col("min_date").alias("lo"), F.col("max_date").alias("hi"))
    whole = whole.withColumns({"min_date": bounds.select("lo").scalar(), "max_date": bounds.select("hi").scalar()})
    return profile_differences(whole, recorded)


@query(
    "rows_with_keys",
    "select l_orderkey, l_linenumber, l_quantity from lineitem where (l_orderkey, l_linenumber) in (select l_orderkey, l_linenumber from lineitem where l_returnflag = 'R' and l_discount > 0.05)",
)
def _rows_with_keys(spark, folder):
    lines = table(spark, folder, "lineitem")
    wanted = lines.where("l_returnflag = 'R' and l_discount > 0.05").select("l_orderkey", "l_linenumber")
    return rows_with_keys(lines, wanted.unionByName(wanted), ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "latest_outcome",
    """
    select o_custkey, cast(o_orderdate as date) as day_from, cast(o_orderdate as date) as day_to, o_orderstatus, o_orderkey from orders
    qualify row_number() over (partition by o_custkey, cast(o_orderdate as date) order by o_orderkey desc) = 1
    """,
)
def _latest_outcome(spark, folder):
    day = F.col("o_orderdate").cast("date")
    tried = table(spark, folder, "orders").select("o_custkey", day.alias("day_from"), day.alias("day_to"), "o_orderstatus", "o_orderkey")
    return latest_outcome(tried, ["o_custkey"], "day_from", "day_to", ["o_orderkey"])


@query(
    "partition_homogeneity",
    """
    select o_orderstatus as partition, count(*) as row_count, cast(0 as bigint) as foreign_rows, o_orderstatus as min_key, o_orderstatus as max_key
    from orders group by o_orderstatus
    """,
)
def _homogeneity(spark, folder):
    written = write_partitioned(table(spark, folder, "orders"), scratch_path(spark, "by-status"), "o_orderstatus")
    return partition_homogeneity(written, F.col("_part"), F.col("o_orderstatus"))


# --- metrics ----------------------------------------------------------------------------

DAILY_TOTAL = Metric("daily_total", "orders_daily", "total", "order_date", ("o_orderstatus",), latest_dates=2)
FINISHED_TOTAL = Metric(
    "finished_total", "orders_daily", "total", "order_date", ("o_orderstatus",), {"o_orderstatus": "F"}, latest_dates=2
)

_DAILY = "daily as (select cast(o_orderdate as date) as order_date, o_orderstatus, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(28,2)) as total from orders group by all)"


def _daily(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("order_date"), "o_orderstatus")
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))
    )


@query(
    "metric_query",
    f"with {_DAILY} select order_date, o_orderstatus, total as finished_total from daily where o_orderstatus = 'F' and order_date between date '1996-01-01' and date '1997-12-31'",
)
def _metric_query(spark, folder):
    return query_metric(FINISHED_TOTAL, _daily(spark, folder), "1996-01-01", "1997-12-31")


@query(
    "metric_grain_check",
    """
    with g as (select cast(o_orderdate as date) as d, o_orderstatus as s, count(*) as n, count(*) filter (where o_orderstatus not in ('O', 'F')) as u from orders group by all)
    select cast(sum(n) as bigint) as row_count, cast(0 as bigint) as blank_key_rows, cast(sum(u) as bigint) as unknown_code_rows, cast(0 as bigint) as invalid_value_rows,
           count(*) filter (where n > 1) as duplicate_grain_keys, true as date_typed from g
    """,
)
def _grain(spark, folder):
    rows = table(spark, folder, "orders").select(
        F.col("o_orderdate").cast("date").alias("order_date"), "o_orderstatus", F.col("o_totalprice").alias("total")
    )
    return grain_check(DAILY_TOTAL, rows, {"o_orderstatus": ["O", "F"]})


@query(
    "metric_crosscheck",
    f"""
    with {_DAILY} select order_date, o_orderstatus, total as value, cast(0 as bigint) as surplus from daily where false
    """,
)
def _crosscheck(spark, folder):
    return metric_crosscheck(DAILY_TOTAL, _daily(spark, folder))


@query(
    "latest_dates_window",
    "select o_orderkey, o_orderdate, o_totalprice from orders where o_orderdate in (select distinct o_orderdate from orders order by 1 desc limit 2)",
)
def _latest_dates(spark, folder):
    return latest_dates_window(table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_totalprice"), "o_orderdate", 2)
