"""Clustered tables, keyset pages, stored bitmaps, frequent values, sections of long files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltstone.operators.bitmaps import distinct_bitmaps, distinct_values, value_numbers
from siltstone.operators.frequent import frequent_values
from siltstone.operators.pages import By, keyset_page
from siltstone.sources.clustered import ClusteredTable
from siltstone.sources.readers import read_sectioned_lines
from siltstone.sources.scratch import scratch_path
from siltstone.suite.registry import query, table

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"]


def _clustered(spark: SparkSession, folder: str) -> tuple[ClusteredTable, DataFrame]:
    lines = table(spark, folder, "lineitem").select(*LINE)
    stored = ClusteredTable.open(spark, scratch_path(spark, "clustered"), lines.schema, ["l_orderkey", "l_linenumber"], buckets=16, spread=2)
    stored.append(lines.where("l_returnflag <> 'R'"))
    stored.append(lines.where("l_returnflag = 'R'"))
    return stored, lines


@query(
    "clustered_short_list",
    """
    select l_orderkey, l_linenumber, l_partkey, l_returnflag from lineitem
    where (l_orderkey, l_linenumber) in (select o_orderkey, 1 + o_custkey % 3 from orders order by o_totalprice desc, o_orderkey limit 100)
    """,
)
def _short_list(spark, folder):
    """Lines of a top-100 report, by key."""
    stored, _ = _clustered(spark, folder)
    top = table(spark, folder, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)
    listed = top.select(F.col("o_orderkey").alias("l_orderkey"), (1 + F.col("o_custkey") % 3).cast(stored.rows().schema["l_linenumber"].dataType).alias("l_linenumber"))
    return stored.with_keys(listed.unionByName(listed))


@query(
    "clustered_long_list",
    "select l_orderkey, l_linenumber, l_partkey, l_returnflag from lineitem where (l_orderkey, l_linenumber) in (select l_orderkey, l_linenumber from lineitem where l_returnflag = 'A')",
)
def _long_list(spark, folder):
    stored, lines = _clustered(spark, folder)
    return stored.with_keys(lines.where("l_returnflag = 'A'"))


@query(
    "keyset_pages",
    """
    select (row_number() over (order by o_orderpriority desc, o_orderstatus nulls first, o_custkey, o_orderkey) - 1) // ((select count(*) from orders) // 6 + 1) as page,
           o_orderpriority, o_orderstatus, o_custkey, o_orderkey
    from (select o_orderpriority, nullif(o_orderstatus, 'P') as o_orderstatus, o_custkey, o_orderkey from orders)
    """,
)
def _pages(spark, folder):
    """A whole table in pages, each found by the token of the one before."""
    orders = table(spark, folder, "orders").select("o_orderpriority", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), "o_custkey", "o_orderkey")
    size = orders.count() // 6 + 1
    out, token, number = None, None, 0
    while True:
        page, token = keyset_page(orders, [By("o_orderpriority", descending=True), By("o_orderstatus", nulls_first=True)], size, token)
        page = page.withColumn("page", F.lit(number).cast("long"))
        out = page if out is None else out.unionByName(page)
        if token is None:
            return out
        number += 1


@query(
    "distinct_from_bitmaps",
    """
    with e as (select cast(ts as date) as day, date_trunc('month', ts)::date as month, event_type, user_id from events)
    select 'day and type' as grain, day, event_type, count(distinct user_id) as users from e group by all having count(user_id) > 0
    union all select 'day', day, null, count(distinct user_id) from e group by all having count(user_id) > 0
    union all select 'type', null, event_type, count(distinct user_id) from e group by all having count(user_id) > 0
    union all select 'month', month, null, count(distinct user_id) from e group by all having count(user_id) > 0
    union all select 'all', null, null, count(distinct user_id) from e
    """,
)
def _bitmaps(spark, folder):
    """Every grain from one stored table of bitmaps; the dictionary came in two steps."""
    events = table(spark, folder, "events").withColumn("day", F.col("ts").cast("date"))
    first = value_numbers(events.where("event_type = 'view'"), "user_id")
    path = scratch_path(spark, "numbers")
    first.write.parquet(path)
    known = spark.read.parquet(path)
    value_numbers(events, "user_id", known).write.parquet(f"{path}-more")
    numbers = known.unionByName(spark.read.parquet(f"{path}-more"))
    distinct_bitmaps(events, ["day", "event_type"], "user_id", numbers).write.parquet(f"{path}-bitmaps")
    stored = spark.read.parquet(f"{path}-bitmaps")
    months = stored.withColumn("day", F.trunc("day", "month"))
    out = None
    for grain, rows, by in (("day and type", stored, ["day", "event_type"]), ("day", stored, ["day"]), ("type", stored, ["event_type"]), ("month", months, ["day"]), ("all", stored, [])):
        counted = distinct_values(rows, by, "users")
        absent = {c: F.lit(None).cast(stored.schema[c].dataType) for c in ("day", "event_type") if c not in by}
        part = counted.withColumns({"grain": F.lit(grain), **absent}).select("grain", "day", "event_type", "users")
        out = part if out is None else out.unionByName(part)
    return out


_FREQUENT = ("l_orderkey", "l_partkey", "l_returnflag", "l_extendedprice")


@query(
    "frequent_values",
    " union all ".join(
        f"select '{c}' as column_name, * from (select cast({c} as varchar) as value, count(*) as n, row_number() over (order by count(*) desc, cast({c} as varchar)) as rank "
        f"from (select {'cast(l_extendedprice * 100 as bigint) as l_extendedprice' if c == 'l_extendedprice' else c} from lineitem) group by 1) where rank <= 7"
        for c in _FREQUENT
    ),
)
def _frequent(spark, folder):
    """A clustered key, a foreign key, a flag and a nearly unique amount."""
    lines = table(spark, folder, "lineitem").withColumn("l_extendedprice", F.round(F.col("l_extendedprice") * 100).cast("long"))
    best, _, _ = frequent_values(lines.select(*_FREQUENT), _FREQUENT, 7)
    name = F.element_at(F.array(*map(F.lit, _FREQUENT)), F.col("position") + 1)
    return best.select(name.alias("column_name"), "value", "n", F.col("rank").cast("long").alias("rank"))


@query(
    "sectioned_lines",
    "select 'c' || o_custkey as section, count(*) as lines, min(o_orderkey) as first_key, max(o_orderkey) as last_key from orders group by o_custkey",
)
def _sections(spark, folder):
    """A document with a section for every customer, in files that are split anywhere."""
    orders = table(spark, folder, "orders")
    keyed = orders.select("o_custkey", F.lit(1).alias("place"), "o_orderkey", F.concat(F.lit("    "), F.col("o_orderkey").cast("string"), F.lit(",")).alias("value"))
    opens = orders.select("o_custkey", F.lit(0).alias("place"), F.lit(None).cast("long").alias("o_orderkey"), F.concat(F.lit('  "c'), F.col("o_custkey").cast("string"), F.lit('": [')).alias("value")).distinct()
    closes = opens.select("o_custkey", F.lit(2).alias("place"), "o_orderkey", F.lit("  ],").alias("value"))
    path = scratch_path(spark, "sections")
    whole = keyed.unionByName(opens).unionByName(closes).repartitionByRange(3, "o_custkey")
    whole.sortWithinPartitions("o_custkey", "place", "o_orderkey").select("value").write.text(path)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")  # read when the scan is planned, which is here
    try:
        lines = read_sectioned_lines(spark, path)
        key = F.regexp_extract("value", "([0-9]+)", 1).cast("long")
        result = lines.groupBy("section").agg(F.count(F.lit(1)).alias("lines"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))
        result.write.parquet(f"{path}-counted")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    return spark.read.parquet(f"{path}-counted")
