"""Dimensions, joins, pivots and coverage marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.functions.dates import calendar_columns, month_start, parse_timestamp, date_from_parts, year_start
from siltstone.functions.records import canonical_json, field, record_hash, surrogate_key
from siltstone.functions.text import (
    any_zero,
    clean_text,
    code_label,
    joined_label,
    local_number,
    period_year,
    round_half_up,
    territory_code,
    unit_code,
)
from siltstone.operators.coverage import column_coverage, coverage_mart, one_row, text_member_count
from siltstone.operators.dimensions import (
    attach_evidence,
    attribute_pivot,
    bilingual_current,
    child_count_dimension,
    code_dimension,
    date_spine,
    fact_with_dimensions,
    hierarchy_names,
    inferred_members,
    label_join,
    period_dimension,
    role_parents,
    rollup_dimension,
    union_levels,
)
from siltstone.operators.keyed import conditional_minimum
from siltstone.suite.registry import query, table

MONEY = "decimal(18,2)"


# --- projections and text ---------------------------------------------------------------


@query(
    "typed_projection",
    """
    select l_orderkey as order_key, cast(l_linenumber as bigint) as line_number, cast(l_quantity as integer) as quantity,
           cast(l_extendedprice as decimal(18,2)) as price, cast(l_shipdate as date) as ship_date, cast(l_partkey as varchar) as part_code
    from lineitem
    """,
)
def _typed_projection(spark, folder):
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").cast("bigint").alias("line_number"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("l_partkey").cast("string").alias("part_code"),
    )


@query(
    "clean_text_columns",
    """
    select c_custkey, upper(trim('  ' || c_name || ' ')) as name_upper, lower(trim(c_mktsegment)) as segment_lower,
           nullif(trim(case when c_nationkey = 3 then '   ' else ' ' || c_mktsegment end), '') as segment_or_null
    from customer
    """,
)
def _clean_text(spark, folder):
    blank = F.when(F.col("c_nationkey") == 3, F.lit("   ")).otherwise(F.concat(F.lit(" "), "c_mktsegment"))
    return table(spark, folder, "customer").select(
        "c_custkey",
        clean_text(F.concat(F.lit("  "), "c_name", F.lit(" ")), case="upper").alias("name_upper"),
        clean_text("c_mktsegment", case="lower").alias("segment_lower"),
        clean_text(blank).alias("segment_or_null"),
    )


@query(
    "joined_labels",
    """
    select p_partkey, concat_ws(' / ', nullif(p_brand, ''), nullif(case when p_size > 25 then '' else p_type end, ''), p_name) as label
    from part
    """,
)
def _joined_labels(spark, folder):
    kind = F.when(F.col("p_size") > 25, F.lit("")).otherwise(F.col("p_type"))
    return table(spark, folder, "part").select("p_partkey", joined_label("p_brand", kind, "p_name").alias("label"))


@query(
    "normalize_number_text",
    """
    select l_orderkey, l_linenumber, l_partkey, case when l_returnflag = 'R' then null else l_extendedprice end as amount from lineitem
    """,
)
def _number_text(spark, folder):
    # Provider spelling of a price: blanks between thousands, decimal comma, text where unknown.
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    text = F.concat(
        F.floor(cents / 100000).cast("string"),
        F.when(F.col("l_returnflag") == "A", F.lit("\u00a0")).otherwise(F.lit("\u202f")),
        F.lpad((F.floor(cents / 100) % 1000).cast("string"), 3, "0"),
        F.lit(","),
        F.lpad((cents % 100).cast("string"), 2, "0"),
    )
    shown = F.when(F.col("l_returnflag") == "R", F.lit("n/a")).otherwise(text)
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", local_number(shown).alias("amount")
    )


@query(
    "normalize_codes",
    """
    with codes as (select o_orderkey, cast(o_orderkey * o_custkey as varchar) as code from orders)
    select o_orderkey,
           case when length(code) <= 2 then lpad(code, 2, '0') when length(code) <= 4 then lpad(code, 4, '0')
                when length(code) <= 7 then lpad(code, 7, '0') when length(code) <= 12 then lpad(code, 12, '0') else code end as unit_id,
           case when length(code) in (6, 7) then lpad(code, 7, '0')
                when length(code) in (11, 12) then substr(lpad(code, 12, '0'), 3, 7) end as terc_code
    from codes
    """,
)
def _codes(spark, folder):
    code = (F.col("o_orderkey") * F.col("o_custkey")).cast("string")
    return table(spark, folder, "orders").select(
        "o_orderkey", unit_code(code).alias("unit_id"), territory_code(code).alias("terc_code")
    )


@query(
    "period_year",
    """
    select o_orderkey, case when o_orderstatus = 'P' then null else cast(extract(year from o_orderdate) as integer) end as period_year from orders
    """,
)
def _period_year(spark, folder):
    year = F.date_format("o_orderdate", "yyyy")
    text = (
        F.when(F.col("o_orderstatus") == "P", F.lit("no period"))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit(" "), year, F.lit(" ")))
        .otherwise(F.concat(F.lit("rok "), year, F.lit(" q1")))
    )
    return table(spark, folder, "orders").select("o_orderkey", period_year(text).alias("period_year"))


@query(
    "parse_timestamp_multi",
    """
    select event_id, case event_type when 'click' then date_trunc('minute', ts) when 'error' then null
                       when 'view' then date_trunc('day', ts) else date_trunc('second', ts) end as stamp from events
    """,
)
def _parse_timestamp(spark, folder):
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.date_format("ts", "dd.MM.yyyy HH:mm"))
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == "error", F.date_format("ts", "yyyy/MM/dd"))
        .when(kind == "signup", F.date_format("ts", "dd.MM.yyyy HH:mm:ss"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    return table(spark, folder, "events").select("event_id", parse_timestamp(text).alias("stamp"))


@query(
    "date_from_parts",
    """
    select o_orderkey, case when o_orderstatus = 'P' then null else cast(o_orderdate as date) end as day from orders
    """,
)
def _date_from_parts(spark, folder):
    month = F.when(F.col("o_orderstatus") == "P", F.lit("13")).otherwise(F.month("o_orderdate").cast("string"))
    return table(spark, folder, "orders").select(
        "o_orderkey",
        date_from_parts(F.year("o_orderdate").cast("string"), month, F.dayofmonth("o_orderdate").cast("string")).alias("day"),
    )


@query(
    "calendar_truncations",
    """
    select o_orderkey, cast(date_trunc('month', o_orderdate) as date) as month_start, cast(date_trunc('year', o_orderdate) as date) as year_start,
           cast(extract(year from o_orderdate) as integer) as calendar_year, cast(extract(month from o_orderdate) as integer) as calendar_month,
           cast(extract(day from o_orderdate) as integer) as calendar_day, cast(extract(isodow from o_orderdate) as integer) as iso_weekday
    from orders
    """,
)
def _truncations(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        month_start("o_orderdate").alias("month_start"),
        year_start("o_orderdate").alias("year_start"),
        *[c.alias(n) for n, c in calendar_columns(F.col("o_orderdate").cast("date")).items()],
    )


@query(
    "code_labels",
    """
    select o_orderkey, case o_orderstatus when 'O' then 'open' when 'F' then 'finished' end as status_label,
           case o_orderpriority when '1-URGENT' then 'high' when '2-HIGH' then 'high' else o_orderpriority end as priority_label
    from orders
    """,
)
def _code_labels(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        code_label("o_orderstatus", {"O": "open", "F": "finished"}).alias("status_label"),
        code_label("o_orderpriority", {"1-URGENT": "high", "2-HIGH": "high"}, F.col("o_orderpriority")).alias("priority_label"),
    )


@query(
    "threshold_flags",
    """
    select l_orderkey, l_linenumber, l_partkey, l_quantity - l_linenumber as spread,
           case when l_discount > 0.0 then 1 else 0 end as has_discount, case when l_quantity >= 25.0 then 1 else 0 end as is_bulk,
           case when l_tax < 0.02 then 1 else 0 end as is_low_tax
    from lineitem
    """,
)
def _flags(spark, folder):
    def flag(test):
        return F.when(test, 1).otherwise(0)

    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (F.col("l_quantity") - F.col("l_linenumber")).alias("spread"),
        flag(F.col("l_discount") > 0.0).alias("has_discount"),
        flag(F.col("l_quantity") >= 25.0).alias("is_bulk"),
        flag(F.col("l_tax") < 0.02).alias("is_low_tax"),
    )


@query(
    "zero_quote_flag",
    """
    select l_orderkey, l_linenumber, l_partkey,
           coalesce(l_discount = 0, false) or coalesce(l_tax = 0, false) or coalesce(nullif(l_quantity, 1.0) = 0, false) as has_zero
    from lineitem
    """,
)
def _zero_flag(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        any_zero("l_discount", "l_tax", F.nullif("l_quantity", F.lit(1.0))).alias("has_zero"),
    )


@query(
    "surrogate_key",
    """
    select o_orderkey, md5(concat_ws('||', cast(o_orderkey as varchar), nullif(o_orderstatus, 'P'), o_orderpriority)) as order_hash from orders
    """,
)
def _surrogate(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        surrogate_key(["o_orderkey", F.nullif("o_orderstatus", F.lit("P")), "o_orderpriority"]).alias("order_hash"),
    )


@query(
    "canonical_record_hash",
    """
    select o_orderkey, sha256(cast(json_object('order_key', o_orderkey, 'status', nullif(o_orderstatus, 'P'), 'priority', o_orderpriority,
                                   'ordered_at', strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')) as varchar)) as record_sha256
    from orders
    """,
)
def _record_hash(spark, folder):
    record = canonical_json(
        [
            F.col("o_orderkey").alias("order_key"),
            F.nullif("o_orderstatus", F.lit("P")).alias("status"),
            F.col("o_orderpriority").alias("priority"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("ordered_at"),
        ]
    )
    return table(spark, folder, "orders").select("o_orderkey", record_hash(record).alias("record_sha256"))


@query(
    "json_fields",
    """
    select event_id, try_cast(json_extract_string(props, '$.k') as integer) as k, json_extract_string(props, '$.absent') as absent from events
    """,
)
def _json_fields(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", field("props", "$.k", "int").alias("k"), field("props", "$.absent").alias("absent")
    )


# --- dimensions -------------------------------------------------------------------------


@query(
    "period_dimension",
    """
    with days as (select distinct cast(o_orderdate as date) as d from orders),
    keys as (
      select strftime(d, '%Y') as period_key, 'year' as g, cast(date_trunc('year', d) as date) as s, cast(date_trunc('year', d) + interval 1 year - interval 1 day as date) as e, cast(null as integer) as q, d from days
      union all select strftime(d, '%Y') || '-Q' || cast(quarter(d) as varchar), 'quarter', cast(date_trunc('quarter', d) as date), cast(date_trunc('quarter', d) + interval 3 month - interval 1 day as date), cast(quarter(d) as integer), d from days
      union all select strftime(d, '%Y-%m'), 'month', cast(date_trunc('month', d) as date), last_day(d), null, d from days
      union all select strftime(d, '%Y-M%m'), 'month', cast(date_trunc('month', d) as date), last_day(d), null, d from days
      union all select strftime(d, '%Y-%m-%d'), 'day', d, d, null, d from days
      union all select strftime(d, '%Y') || '-Q5', 'other', null, null, null, d from days)
    select distinct period_key, g as period_granularity, s as period_start_date, e as period_end_date,
           cast(extract(year from d) as integer) as calendar_year, q as quarter_number from keys
    """,
)
def _period_dimension(spark, folder):
    d = F.col("o_orderdate")
    year = F.date_format(d, "yyyy")
    spellings = F.array(
        year,
        F.concat(year, F.lit("-Q"), F.quarter(d).cast("string")),
        F.date_format(d, "yyyy-MM"),
        F.concat(year, F.lit("-M"), F.date_format(d, "MM")),
        F.date_format(d, "yyyy-MM-dd"),
        F.concat(year, F.lit("-Q5")),
    )
    keys = table(spark, folder, "orders").select(F.explode(spellings).alias("key"))
    return period_dimension(keys, "key")


@query(
    "date_spine",
    """
    with b as (select min(d) as lo, max(d) as hi from (
      select cast(o_orderdate as date) as d from orders union all select cast(l_shipdate as date) from lineitem))
    select cast(s.d as date) as date_key, cast(extract(year from s.d) as integer) as calendar_year, cast(extract(month from s.d) as integer) as calendar_month,
           cast(extract(day from s.d) as integer) as calendar_day, cast(extract(isodow from s.d) as integer) as iso_weekday
    from b, unnest(generate_series(cast(b.lo as timestamp), cast(b.hi as timestamp), interval 1 day)) as s(d)
    """,
)
def _date_spine(spark, folder):
    return date_spine(table(spark, folder, "orders").select("o_orderdate"), table(spark, folder, "lineitem").select("l_shipdate"))


@query(
    "inferred_members",
    """
    select c_custkey, c_name, c_nationkey, null::timestamp as last_order from customer where c_mktsegment <> 'BUILDING'
    union all
    select o_custkey, 'Customer ' || o_custkey, null, max(o_orderdate) from orders
    where o_custkey not in (select c_custkey from customer where c_mktsegment <> 'BUILDING') group by o_custkey
    """,
)
def _inferred(spark, folder):
    known = (
        table(spark, folder, "customer")
        .where("c_mktsegment <> 'BUILDING'")
        .select("c_custkey", "c_name", "c_nationkey", F.lit(None).cast("timestamp_ntz").alias("last_order"))
    )
    return inferred_members(
        known,
        table(spark, folder, "orders"),
        "c_custkey",
        "o_custkey",
        {"c_name": F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")), "last_order": F.max("o_orderdate")},
    )


@query(
    "code_dimension",
    """
    select code, min(label) as label from (
      select c_mktsegment as code, min(c_name) as label from customer group by 1
      union all select o_orderpriority, min(o_orderstatus) from orders group by 1
      union all select 'PLN', null) group by code
    """,
)
def _code_dimension(spark, folder):
    segments = table(spark, folder, "customer").select(F.col("c_mktsegment").alias("code"), F.col("c_name").alias("label"))
    ranks = table(spark, folder, "orders").select(F.col("o_orderpriority").alias("code"), F.col("o_orderstatus").alias("label"))
    return code_dimension([segments, ranks], "code", "label", mandatory="PLN")


@query(
    "attribute_pivot",
    """
    with latest as (select * from documents qualify row_number() over (partition by source, lang order by n_chars desc, doc_id desc) = 1)
    select source, min(doc_id) filter (where lang = 'en') as doc_en, min(doc_id) filter (where lang = 'fr') as doc_fr,
           min(text) filter (where lang = 'de') as text_de, min(text) filter (where lang = 'es') as text_es,
           bool_or(n_chars > 10000) as has_long, max(n_chars) as longest
    from latest group by source
    """,
)
def _attribute_pivot(spark, folder):
    lang = F.col("lang")
    return bilingual_current(
        table(spark, folder, "documents"),
        ["source"],
        ["lang"],
        ["n_chars", "doc_id"],
        {
            "doc_en": ("doc_id", lang == "en"),
            "doc_fr": ("doc_id", lang == "fr"),
            "text_de": ("text", lang == "de"),
            "text_es": ("text", lang == "es"),
        },
        {"has_long": F.bool_or(F.col("n_chars") > 10000), "longest": F.max("n_chars")},
    )


@query(
    "bilingual_label_join",
    """
    with dictionary as (
      select cast(doc_id as varchar) as entry_id, min(source) filter (where lang = 'en') as label_en, min(source) filter (where lang = 'fr') as label_fr
      from documents group by 1)
    select doc_id, quality, toxic, label_en, label_fr from labels left join dictionary on entry_id = cast(doc_id as varchar)
    """,
)
def _bilingual_label_join(spark, folder):
    entries = table(spark, folder, "documents").withColumn("entry_id", F.col("doc_id").cast("string"))
    dictionary = attribute_pivot(
        entries,
        ["entry_id"],
        {"label_en": ("source", F.col("lang") == "en"), "label_fr": ("source", F.col("lang") == "fr")},
    )
    return label_join(table(spark, folder, "labels"), dictionary, "doc_id", "entry_id", ["label_en", "label_fr"])


@query(
    "rollup_dimension",
    """
    select o_custkey, arg_max(o_orderpriority, o_orderkey) as o_orderpriority, count(distinct o_orderstatus) as status_count,
           count(*) as order_count, count(*) filter (where o_orderstatus = 'F') as finished_count,
           min(o_orderdate) as first_order, max(o_orderdate) as last_order
    from orders group by o_custkey
    """,
)
def _rollup(spark, folder):
    return rollup_dimension(
        table(spark, folder, "orders"),
        "o_custkey",
        label="o_orderpriority",
        newest="o_orderkey",
        distinct={"status_count": "o_orderstatus"},
        counts={"order_count": None, "finished_count": F.col("o_orderstatus") == "F"},
        bounds={"first_order": ("min", "o_orderdate"), "last_order": ("max", "o_orderdate")},
    )


@query(
    "child_count_dimension",
    """
    select n_nationkey, n_name, n_regionkey, count(distinct c_mktsegment) as segments
    from nation left join customer on n_nationkey = c_nationkey group by all
    """,
)
def _child_count(spark, folder):
    children = table(spark, folder, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    return child_count_dimension(table(spark, folder, "nation"), children, "n_nationkey", "c_mktsegment", "segments")


@query(
    "hierarchy_names",
    """
    select 'region' as level, r_regionkey as region_code, null::integer as nation_code, null::bigint as customer_code, r_name as unit_name, r_name as region_name, null as nation_name from region
    union all select 'nation', n_regionkey, n_nationkey, null, n_name, r_name, n_name from nation join region on n_regionkey = r_regionkey
    union all select 'customer', n_regionkey, n_nationkey, c_custkey, c_name, r_name, n_name from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    """,
)
def _hierarchy(spark, folder):
    region = table(spark, folder, "region").select(F.col("r_regionkey").alias("region_code"), F.col("r_name").alias("unit_name"))
    nation = table(spark, folder, "nation").select(
        F.col("n_regionkey").alias("region_code"), F.col("n_nationkey").alias("nation_code"), F.col("n_name").alias("unit_name")
    )
    customer = (
        table(spark, folder, "customer")
        .join(nation.drop("unit_name"), F.col("c_nationkey") == F.col("nation_code"))
        .select("region_code", "nation_code", F.col("c_custkey").alias("customer_code"), F.col("c_name").alias("unit_name"))
    )
    register = union_levels(
        {"region": region, "nation": nation, "customer": customer},
        order=["level", "region_code", "nation_code", "customer_code", "unit_name"],
    )
    return hierarchy_names(
        register,
        "level",
        "unit_name",
        [("region", ["region_code"], "region_name"), ("nation", ["region_code", "nation_code"], "nation_name")],
    )


@query(
    "enrichment_chain",
    """
    select o_orderkey, o_custkey, c_name, n_name, r_name from orders left join customer on o_custkey = c_custkey
    left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey
    """,
)
def _chain(spark, folder):
    nations = fact_with_dimensions(table(spark, folder, "nation"), [(table(spark, folder, "region"), {"n_regionkey": "r_regionkey"}, ["r_name"])])
    customers = fact_with_dimensions(table(spark, folder, "customer"), [(nations, {"c_nationkey": "n_nationkey"}, ["n_name", "r_name"])])
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return fact_with_dimensions(orders, [(customers, {"o_custkey": "c_custkey"}, ["c_name", "n_name", "r_name"])])


@query(
    "fact_with_dims",
    """
    select l_orderkey, l_linenumber, l_quantity, p_brand, s_name, o_orderstatus from lineitem
    left join part on l_partkey = p_partkey left join supplier on l_suppkey = s_suppkey left join orders on l_orderkey = o_orderkey
    """,
)
def _fact_with_dims(spark, folder):
    fact = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_suppkey")
    return fact_with_dimensions(
        fact,
        [
            (table(spark, folder, "part"), {"l_partkey": "p_partkey"}, ["p_brand"]),
            (table(spark, folder, "supplier"), {"l_suppkey": "s_suppkey"}, ["s_name"]),
            (table(spark, folder, "orders"), {"l_orderkey": "o_orderkey"}, ["o_orderstatus"]),
        ],
    ).drop("l_partkey", "l_suppkey")


@query(
    "star_join_report",
    """
    select cast(o_orderdate as date) as order_date, cast(extract(year from o_orderdate) as integer) as calendar_year, o_orderkey, c_name, o_totalprice
    from orders join customer on o_custkey = c_custkey
    where o_orderstatus = 'F' and c_mktsegment = 'BUILDING' order by 1 desc, o_orderkey limit 10
    """,
)
def _star_report(spark, folder):
    orders = table(spark, folder, "orders").where("o_orderstatus = 'F'").withColumn("order_date", F.col("o_orderdate").cast("date"))
    spine = date_spine(table(spark, folder, "orders").select("o_orderdate"))
    buyers = table(spark, folder, "customer").where("c_mktsegment = 'BUILDING'")
    joined = fact_with_dimensions(
        orders,
        [(buyers, {"o_custkey": "c_custkey"}, ["c_name"]), (spine, {"order_date": "date_key"}, ["calendar_year"])],
        how="inner",
    )
    return (
        joined.select("order_date", "calendar_year", "o_orderkey", "c_name", "o_totalprice")
        .orderBy(F.desc("order_date"), "o_orderkey")
        .limit(10)
    )


@query(
    "role_parent_join",
    """
    select c_custkey, c_name, n_name as direct_parent, case when n_regionkey <> 2 then r_name end as ultimate_parent
    from customer left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey
    """,
)
def _roles(spark, folder):
    homes = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    direct = homes.select(F.col("c_custkey").alias("child"), F.col("n_name").alias("parent"), F.lit("DIRECT").alias("kind"), F.lit("ACTIVE").alias("status"))
    ultimate = homes.select(
        F.col("c_custkey").alias("child"),
        F.col("r_name").alias("parent"),
        F.lit("ULTIMATE").alias("kind"),
        F.when(F.col("n_regionkey") == 2, F.lit("INACTIVE")).otherwise(F.lit("ACTIVE")).alias("status"),
    )
    active = F.col("status") == "ACTIVE"
    return role_parents(
        table(spark, folder, "customer").select("c_custkey", "c_name"),
        direct.unionByName(ultimate),
        "c_custkey",
        "child",
        "parent",
        {"direct_parent": (F.col("kind") == "DIRECT") & active, "ultimate_parent": (F.col("kind") == "ULTIMATE") & active},
    )


@query(
    "companion_join",
    """
    with prices as (select l_partkey, l_suppkey, min(l_extendedprice) as low from lineitem where l_returnflag = 'A' group by all),
    rates as (select l_partkey, l_suppkey, max(l_tax) as top_tax from lineitem where l_returnflag = 'R' group by all)
    select p.l_partkey, p.l_suppkey, low, top_tax from prices p left join rates r on p.l_partkey = r.l_partkey and p.l_suppkey = r.l_suppkey
    """,
)
def _companion(spark, folder):
    lines = table(spark, folder, "lineitem")
    prices = lines.where("l_returnflag = 'A'").groupBy("l_partkey", "l_suppkey").agg(F.min("l_extendedprice").alias("low"))
    rates = lines.where("l_returnflag = 'R'").groupBy("l_partkey", "l_suppkey").agg(F.max("l_tax").alias("top_tax"))
    return prices.join(rates, ["l_partkey", "l_suppkey"], "left")


@query(
    "union_layers",
    """
    select 'customer' as level, c_name as unit_name, c_nationkey as nation_key, c_acctbal as balance, c_acctbal / 100.0 as balance_hundreds, c_mktsegment as segment from customer
    union all select 'supplier', s_name, s_nationkey, s_acctbal, s_acctbal / 100.0, null from supplier
    """,
)
def _union_layers(spark, folder):
    def side(name, p, extra):
        balance = F.col(f"{p}_acctbal")
        return table(spark, folder, name).select(
            F.col(f"{p}_name").alias("unit_name"),
            F.col(f"{p}_nationkey").alias("nation_key"),
            balance.alias("balance"),
            (balance / 100.0).alias("balance_hundreds"),
            *extra,
        )

    return union_levels(
        {"customer": side("customer", "c", [F.col("c_mktsegment").alias("segment")]), "supplier": side("supplier", "s", [])}
    )


@query(
    "attach_evidence",
    """
    select l_orderkey, l_linenumber, l_partkey, (select max(o_orderdate) from orders) as checked_at, (select count(*) from orders) as member_total from lineitem
    """,
)
def _evidence(spark, folder):
    evidence = one_row(table(spark, folder, "orders"), checked=F.max("o_orderdate"), members=F.count(F.lit(1)))
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return attach_evidence(rows, evidence, {"checked_at": "checked", "member_total": "members"})


# --- aggregates and marts ---------------------------------------------------------------


@query(
    "distinct_counts",
    """
    select l_returnflag, count(distinct l_partkey) as parts, count(distinct l_suppkey) as suppliers,
           count(distinct cast(l_partkey as varchar) || ':' || cast(l_suppkey as varchar)) as series, count(*) as lines
    from lineitem group by l_returnflag
    """,
)
def _distinct_counts(spark, folder):
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_returnflag")
        .agg(
            F.count_distinct("l_partkey").alias("parts"),
            F.count_distinct("l_suppkey").alias("suppliers"),
            text_member_count("l_partkey", "l_suppkey").alias("series"),
            F.count(F.lit(1)).alias("lines"),
        )
    )


@query(
    "conditional_aggs",
    """
    select l_suppkey, min(l_shipdate) filter (where l_returnflag = 'R') as first_return, min(l_extendedprice) filter (where l_discount > 0.05) as low_discounted,
           count(*) filter (where l_linestatus = 'O') as open_lines, bool_or(l_tax = 0) as any_untaxed
    from lineitem group by l_suppkey
    """,
)
def _conditional(spark, folder):
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_suppkey")
        .agg(
            conditional_minimum("l_shipdate", F.col("l_returnflag") == "R").alias("first_return"),
            conditional_minimum("l_extendedprice", F.col("l_discount") > 0.05).alias("low_discounted"),
            F.count_if(F.col("l_linestatus") == "O").alias("open_lines"),
            F.bool_or(F.col("l_tax") == 0).alias("any_untaxed"),
        )
    )


@query(
    "daily_rollup",
    """
    select cast(ts as date) as day, event_type, floor(cast(sum(cast(value as decimal(18,2))) as double) / count(value) * 100.0 + 0.5) / 100.0 as avg_value,
           min(value) as min_value, max(value) as max_value, count(*) as observations, max(ts) as last_seen
    from events group by all
    """,
)
def _daily_rollup(spark, folder):
    mean = F.sum(F.col("value").cast(MONEY)).cast("double") / F.count("value")
    return (
        table(spark, folder, "events")
        .groupBy(F.col("ts").cast("date").alias("day"), "event_type")
        .agg(
            round_half_up(mean, 2).alias("avg_value"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
            F.count(F.lit(1)).alias("observations"),
            F.max("ts").alias("last_seen"),
        )
    )


@query(
    "coverage_mart",
    """
    select u.*, m.*, l.*, cast(modeled_total as double) / universe_total as modeled_coverage_ratio, cast(landed_total as double) / modeled_total as landed_per_modeled_ratio,
           cast(null as double) as empty_ratio
    from (select count(*) as universe_total from part) u,
         (select count(distinct l_partkey) as modeled_total, count(*) as modeled_observation_total, cast(max(l_shipdate) as date) as latest_observation_date from lineitem) m,
         (select count(*) as landed_total, cast(max(o_orderdate) as date) as snapshot_date, count(*) filter (where o_totalprice < 0) as rejected_total from orders) l
    """,
)
def _coverage_mart(spark, folder):
    return coverage_mart(
        one_row(table(spark, folder, "part"), universe_total=F.count(F.lit(1))),
        one_row(
            table(spark, folder, "lineitem"),
            modeled_total=F.count_distinct("l_partkey"),
            modeled_observation_total=F.count(F.lit(1)),
            latest_observation_date=F.max("l_shipdate").cast("date"),
        ),
        one_row(
            table(spark, folder, "orders"),
            landed_total=F.count(F.lit(1)),
            snapshot_date=F.max("o_orderdate").cast("date"),
            rejected_total=F.count_if(F.col("o_totalprice") < 0),
        ),
        ratios={
            "modeled_coverage_ratio": ("modeled_total", "universe_total"),
            "landed_per_modeled_ratio": ("landed_total", "modeled_total"),
            "empty_ratio": ("landed_total", "rejected_total"),
        },
    )


@query(
    "identifier_coverage",
    """
    with c as (select count(*) as n, count(nullif(lang, 'fr')) as lang, count(nullif(source, 'src0')) as source, count(text) as text from documents)
    select 'lang' as column_name, lang as filled, lang * 100.0::double / n as filled_pct from c
    union all select 'source', source, source * 100.0::double / n from c union all select 'text', text, text * 100.0::double / n from c
    """,
)
def _identifier_coverage(spark, folder):
    df = table(spark, folder, "documents").select(
        F.nullif("lang", F.lit("fr")).alias("lang"), F.nullif("source", F.lit("src0")).alias("source"), "text"
    )
    return column_coverage(df, ["lang", "source", "text"]).withColumn("filled_pct", F.col("filled_pct").cast("double"))
