"""Envelopes, cubes, wide files, feature arrays, sections, codes and pivots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltstone.operators.codes import area_rows_check, taxonomy_paths, territory_columns
from siltstone.operators.decode import (
    bank_prefix,
    decode_catalogue_detail,
    decode_cube,
    decode_envelopes,
    decode_wide_tsv,
    explode_sections,
    flatten_features,
)
from siltstone.operators.dimensions import code_dimension, date_spine, fact_with_dimensions
from siltstone.operators.ledger import guarded_current
from siltstone.operators.reshape import map_by_synonyms, pivot_series, unpivot_matrix, unpivot_years
from siltstone.sources.catalog import materialize
from siltstone.sources.readers import fold_extra_columns, spread_scan
from siltstone.sources.scratch import scratch_path
from siltstone.suite.registry import query, table

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


# --- envelopes --------------------------------------------------------------------------

BATCH_SCHEMA = "array<struct<`table`: string, no: string, effectiveDate: string, rates: array<struct<code: string, mid: double>>>>"


def _quote_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """One response envelope per order line: one publication with four quotes.

    The body is built from its own row, so no rows are gathered to make it.
    """
    def quote(code: str, column: str):
        return F.struct(F.lit(code).alias("code"), F.col(column).alias("mid"))

    publication = F.struct(
        F.lit("A").alias("table"),
        F.concat(F.col("l_suppkey").cast("string"), F.lit("/A")).alias("no"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("effectiveDate"),
        F.array(
            quote("QTY", "l_quantity"), quote("PRC", "l_extendedprice"), quote("DSC", "l_discount"), quote("TAX", "l_tax")
        ).alias("rates"),
    )
    return spread_scan(table(spark, folder, "lineitem")).select(
        F.lit("quotes_a").alias("source_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ingestion_sequence"),
        F.col("l_partkey").alias("batch_id"),
        F.to_json(F.array(publication)).alias("body_json"),
    )


def _quotes(spark: SparkSession, folder: str) -> DataFrame:
    return decode_envelopes(
        _quote_envelopes(spark, folder),
        "body_json",
        BATCH_SCHEMA,
        ["body", "item0.rates"],
        {
            "source_table": "item0.table",
            "no": "item0.no",
            "effective_date": F.col("item0.effectiveDate").cast("date"),
            "code": "item1.code",
            "mid": "item1.mid",
        },
        ["source_id", "ingestion_sequence", "batch_id"],
    )


_QUOTES = """
    quotes as (
      select 'quotes_a' as source_id, l_orderkey * 10 + l_linenumber as ingestion_sequence, l_partkey as batch_id, 'A' as source_table,
             cast(l_suppkey as varchar) || '/A' as no, cast(l_shipdate as date) as effective_date, q.code, q.mid
      from lineitem, unnest([{'code': 'QTY', 'mid': l_quantity}, {'code': 'PRC', 'mid': l_extendedprice},
                             {'code': 'DSC', 'mid': l_discount}, {'code': 'TAX', 'mid': l_tax}]) as u(q))
"""


@query("decode_batches", f"with {_QUOTES} select * from quotes")
def _decode_batches(spark, folder):
    return _quotes(spark, folder)


def quote_report(spark: SparkSession, folder: str) -> DataFrame:
    """Envelopes -> quotes -> guarded current value per day and code -> star report."""
    decoded = _quotes(spark, folder)
    guarded = guarded_current(
        decoded,
        source=["source_id", "batch_id"],
        identity=["effective_date", "code"],
        sequence="ingestion_sequence",
        measures=["mid"],
        labels=["source_table"],
        evidence=["no"],
        newest=["batch_id", "mid"],
    )
    # Stored once: the fact and both dimensions read it, and decoding is the costly part.
    current = materialize(guarded, "table", scratch_path(spark, "current-quotes"))
    labels = code_dimension([current.select("code", F.concat(F.lit("quote "), "code").alias("label"))], "code", "label", "PLN")
    days = date_spine(current.select("effective_date"))
    return (
        fact_with_dimensions(
            current.where("code = 'PRC' and source_table = 'A'"),
            [(labels, {"code": "code"}, ["label"]), (days, {"effective_date": "date_key"}, ["calendar_year", "calendar_month"])],
            how="inner",
        )
        .select("effective_date", "calendar_year", "calendar_month", "source_table", F.col("code").alias("currency_key"), "label", "mid")
        .orderBy(F.desc("effective_date"))
        .limit(10)
    )


query(
    "quote_report",
    f"""
    with {_QUOTES},
    folded as (select effective_date, code, ingestion_sequence, batch_id, min(mid) as mid, min(source_table) as source_table from quotes group by all),
    cur as (select * from folded qualify row_number() over (partition by effective_date, code order by ingestion_sequence desc, batch_id desc, mid desc) = 1)
    select effective_date, cast(extract(year from effective_date) as integer) as calendar_year, cast(extract(month from effective_date) as integer) as calendar_month,
           source_table, code as currency_key, 'quote ' || code as label, mid
    from cur where code = 'PRC' order by effective_date desc limit 10
    """,
)(quote_report)


@query(
    "decode_catalogue_detail",
    """
    select c_custkey as task_id, 'catalogue' as response_kind, cast(c_nationkey as bigint) as universe_total, cast(c_nationkey as integer) as item_id, c_name as item_name, true as has_values, '["' || c_mktsegment || '",' || c_nationkey || ']' as years_json
    from customer where c_acctbal >= 0
    union all select c_custkey, 'catalogue', c_nationkey, -1, null, false, null from customer where c_acctbal >= 0
    union all select c_custkey, 'detail', null, c_nationkey, c_name, null, '["' || c_mktsegment || '",' || c_nationkey || ']' from customer where c_acctbal < 0
    """,
)
def _catalogue_detail(spark, folder):
    customer = table(spark, folder, "customer")
    years_text = F.concat(F.lit('["'), "c_mktsegment", F.lit('",'), F.col("c_nationkey").cast("string"), F.lit("]"))
    name = F.concat(F.lit('"'), "c_name", F.lit('"'))
    entry = F.concat(F.lit('{"id":'), F.col("c_nationkey").cast("string"), F.lit(',"name":'), name, F.lit(',"years":'), years_text)
    page = F.concat(
        F.lit('{"totalRecords":'),
        F.col("c_nationkey").cast("string"),
        F.lit(',"results":['),
        entry,
        F.lit(',"hasValues":true},{"id":-1,"name":null,"hasValues":false}]}'),
    )
    is_page = F.col("c_acctbal") >= 0
    envelopes = customer.select(
        F.col("c_custkey").alias("task_id"),
        F.when(is_page, F.lit("subjects")).otherwise(F.lit("subject_detail")).alias("task_kind"),
        F.when(is_page, page).otherwise(F.concat(entry, F.lit("}"))).alias("payload"),
    )
    return decode_catalogue_detail(
        envelopes,
        "payload",
        is_catalogue=F.col("task_kind") == "subjects",
        is_detail=F.col("task_kind") == "subject_detail",
        items="$.results",
        page_fields={"universe_total": "bigint $.totalRecords"},
        fields={
            "item_id": "int $.id",
            "item_name": "string $.name",
            "has_values": "boolean $.hasValues",
            "years_json": "string $.years",
        },
        keep=["task_id"],
    ).drop("source_record_json")


# --- cubes and wide files ---------------------------------------------------------------


def _cubes(spark: SparkSession, folder: str) -> DataFrame:
    """One cube per user: weekday x hour, sparse values, statuses where a cell is crowded.

    Cells are counted first, so the map of one cube has at most 7 * 24 entries.
    """
    cells = (
        table(spark, folder, "events")
        .groupBy("user_id", F.weekday("ts").alias("wd"), F.hour("ts").alias("hr"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("user_id", (F.col("wd") * 24 + F.col("hr")).alias("pos"), "n")
    )
    entry = F.concat(F.lit('"'), F.col("pos").cast("string"), F.lit('":'))
    per_user = cells.groupBy("user_id").agg(
        F.array_join(F.collect_list(F.concat(entry, F.col("n").cast("string"))), ",").alias("value"),
        F.array_join(F.collect_list(F.when(F.col("n") > 1, F.concat(entry, F.lit('"c"')))), ",").alias("status"),
    )
    days = ",".join(f'"D{i}"' for i in range(7))
    hours = ",".join(f'"H{i:02d}":{i}' for i in range(24))
    body = F.concat(
        F.lit('{"version":"2.0","class":"dataset","label":"activity","updated":"2024-02-01","id":["freq","unit","geo","time"],"size":[1,1,7,24],"dimension":{'),
        F.lit('"freq":{"category":{"index":["H"]}},"unit":{"category":{"index":{"NR":0}}},'),
        F.lit(f'"geo":{{"category":{{"index":[{days}]}}}},"time":{{"category":{{"index":{{{hours}}}}}}}}},"value":{{'),
        F.col("value"),
        F.lit('},"status":{'),
        F.col("status"),
        F.lit("}}"),
    )
    # Bodies are small beside their cells: keep adaptive execution from packing them into one task.
    return per_user.select("user_id", body.alias("payload")).repartition(spark.sparkContext.defaultParallelism)


@query(
    "decode_cube",
    """
    with cells as (select user_id, (isodow(ts) - 1) as wd, extract(hour from ts) as hr, count(*) as n from events group by all),
    grid as (select user_id, d.wd, h.hr from (select distinct user_id from events), range(7) d(wd), range(24) h(hr))
    select user_id, cast(wd * 24 + hr as integer) as position, 'D' || wd as geo_code, 'H' || lpad(cast(hr as varchar), 2, '0') as period_key,
           '{"freq":"H","geo":"D' || wd || '","time":"H' || lpad(cast(hr as varchar), 2, '0') || '","unit":"NR"}' as dimension_key_json,
           coalesce(cast(n as varchar), 'null') as value_json, cast(n as double) as value_numeric, case when n > 1 then 'c' end as status_code, n is null as is_missing
    from grid left join cells using (user_id, wd, hr)
    """,
)
def _decode_cube(spark, folder):
    return decode_cube(_cubes(spark, folder), "payload", ["user_id"]).select(
        "user_id",
        "position",
        F.element_at("dimensions", "geo").alias("geo_code"),
        F.element_at("dimensions", "time").alias("period_key"),
        "dimension_key_json",
        "value_json",
        "value_numeric",
        "status_code",
        "is_missing",
    )


@query(
    "decode_wide_tsv",
    """
    with cells as (select event_type, user_id, cast(ts as date) as day, count(*) as n, max(try_cast(json_extract_string(props, '$.k') as integer)) as k from events group by all),
    days as (select distinct day from cells),
    series as (select distinct event_type, user_id from events where user_id is not null),
    grid as (select * from series, days)
    select g.event_type as unit_code, 'U' || g.user_id as geo_code, strftime(g.day, '%Y-%m-%d') as period_key,
           case when n is null then ':' when k < 10 then '' else n || '.50' end as value_text,
           case when n is null or k < 10 then null else n + 0.5::double end as value_numeric,
           case when n is null then 'm' when k < 10 then null when k > 50 then 'b p' end as status_code,
           n is null or k < 10 as is_missing, case when n is null then 'colon' when k < 10 then 'empty' end as missing_reason,
           '{"freq":"D","geo":"U' || g.user_id || '","time":"' || strftime(g.day, '%Y-%m-%d') || '","unit":"' || g.event_type || '"}' as dimension_key_json
    from grid g left join cells c on c.event_type = g.event_type and c.user_id = g.user_id and c.day = g.day
    """,
)
def _decode_wide_tsv(spark, folder):
    events = table(spark, folder, "events")
    cells = events.groupBy("event_type", "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.get_json_object("props", "$.k").try_cast("int")).alias("k")
    )
    # The period axis is read off the table; it is one short row.
    days = [r[0] for r in cells.select("day").distinct().orderBy("day").collect()]
    shown = F.when(F.col("k") < 10, F.lit("  ")).otherwise(
        F.concat(F.col("n").cast("string"), F.lit(".50"), F.when(F.col("k") > 50, F.lit("  b p")).otherwise(F.lit(" ")))
    )
    wide = cells.select("event_type", "user_id", "day", shown.alias("cell")).groupBy("event_type", "user_id").pivot("day", days).agg(F.min("cell"))
    line = F.concat_ws(
        "\t",
        F.concat(F.lit("D, "), "event_type", F.lit(",U"), F.col("user_id").cast("string")),
        *[F.coalesce(F.col(f"`{d}`"), F.lit(": m")) for d in days],
    )
    header = "freq,unit,geo\\TIME_PERIOD\t" + "\t".join(f"{d} " for d in days)
    lines = wide.select(line.alias("line")).withColumn("header", F.lit(header))
    return decode_wide_tsv(lines, "line", "header").select(
        F.element_at("dimensions", "unit").alias("unit_code"),
        F.element_at("dimensions", "geo").alias("geo_code"),
        "period_key",
        "value_text",
        "value_numeric",
        "status_code",
        "is_missing",
        "missing_reason",
        "dimension_key_json",
    )


# --- wide and long ----------------------------------------------------------------------


@query(
    "unpivot_years",
    """
    select l_suppkey, l_returnflag, cast(extract(year from l_shipdate) as integer) as observation_year, cast(cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(28,2)) as varchar) as observation_value_text
    from lineitem group by all
    """,
)
def _unpivot_years(spark, folder):
    lines = table(spark, folder, "lineitem")
    years = [r[0] for r in lines.select(F.date_format("l_shipdate", "yyyy").alias("y")).where("y is not null").distinct().orderBy("y").collect()]
    total = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("string")
    wide = (
        lines
        .withColumn("y", F.date_format("l_shipdate", "yyyy"))
        .groupBy("l_suppkey", "l_returnflag")
        .pivot("y", years)
        .agg(total)
        .withColumn("Unnamed: 70", F.lit("  "))
    )
    return unpivot_years(wide, ["l_suppkey", "l_returnflag"])


@query(
    "unpivot_matrix",
    """
    select event_type as station_code, event_type as sensor_code, 'PM2.5' as pollutant, '24g' as averaging_interval, date_trunc('hour', ts) as measurement_timestamp,
           cast(ts as date) as observation_date, cast(sum(cast(value as decimal(18,2))) as double) as value, 'ug/m3' as unit
    from events group by event_type, date_trunc('hour', ts), cast(ts as date)
    """,
)
def _unpivot_matrix(spark, folder):
    total = F.translate(F.sum(F.col("value").cast("decimal(18,2)")).cast("string"), ".", ",")
    events = table(spark, folder, "events")
    sensors = [r[0] for r in events.select("event_type").where("event_type is not null").distinct().orderBy("event_type").collect()]
    matrix = (
        events
        .withColumn("Czas", F.date_format("ts", "dd.MM.yyyy HH:00"))
        .groupBy("Czas")
        .pivot("event_type", sensors)
        .agg(total)
    )
    return unpivot_matrix(matrix, "Czas", F.lit("2024_pm25_24g.csv"))


@query(
    "pivot_series",
    """
    select cast(ts as date) as day, """
    + ", ".join(f"arg_max(value, (ts, event_id)) filter (where event_type = '{t}') as {t}" for t in EVENT_TYPES)
    + " from events group by 1",
)
def _pivot_series(spark, folder):
    df = table(spark, folder, "events").withColumn("day", F.col("ts").cast("date"))
    return pivot_series(df, "day", "value", "event_type", ["ts", "event_id"])


@query(
    "map_by_synonyms",
    """
    select 'C' || c_custkey as station_code, c_name as station_name, nullif(c_mktsegment, 'BUILDING') as station_type, cast(null as varchar) as city
    from customer where c_nationkey <> 4
    """,
)
def _synonyms(spark, folder):
    sheet = table(spark, folder, "customer").select(
        F.when(F.col("c_nationkey") == 4, F.lit(" ")).otherwise(F.concat(F.lit(" C"), F.col("c_custkey").cast("string"))).alias(" Kod Stacji "),
        F.col("c_name").alias("NAZWA_STACJI"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")).otherwise(F.col("c_mktsegment")).alias("typ stacji"),
    )
    return map_by_synonyms(
        sheet,
        {
            "station_code": ["kod stacji", "station_code"],
            "station_name": ["nazwa stacji", "nazwa_stacji"],
            "station_type": ["typ stacji"],
            "city": ["city"],
        },
        required=["station_code"],
    )


@query(
    "fold_extra_columns_json",
    """
    select 'customers' as subgroup_id, lpad(cast(c_custkey as varchar), case when length(cast(c_custkey as varchar)) <= 2 then 2 when length(cast(c_custkey as varchar)) <= 4 then 4 else 7 end, '0') as unit_id,
           c_name as unit_name, case when length(cast(c_custkey as varchar)) in (6, 7) then lpad(cast(c_custkey as varchar), 7, '0') end as terc_code,
           '2024 r.' as period_raw, 2024 as period_year, cast(cast(c_nationkey as integer) as varchar) || ',5' as val_raw, c_nationkey + 0.5::double as val_numeric, 'zl' as measure_unit, '' as attr_name,
           cast(json_object('Segment', c_mktsegment, 'Opis', coalesce(case when c_nationkey > 12 then 'wysoki' end, '')) as varchar) as dimensions_json
    from customer
    """,
)
def _fold_extra(spark, folder):
    raw = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("Kod"),
        F.col("c_name").alias("Nazwa"),
        F.lit("2024 r.").alias("Rok"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit(",5 ")).alias("Wartosc"),
        F.lit("zl").alias("Jednostka miary"),
        F.col("c_mktsegment").alias("Segment"),
        F.when(F.col("c_nationkey") > 12, F.lit("wysoki")).alias("Opis"),
    )
    return fold_extra_columns(raw, {"subgroup_id": F.lit("customers")})


# --- features, sections, codes ----------------------------------------------------------


@query(
    "features_first_value",
    """
    select 'R' || c_custkey as record_id, coalesce(case when c_nationkey > 5 then c_name end, c_mktsegment) as name_org,
           case when c_nationkey <= 20 then c_acctbal end as geo_latitude, cast(null as varchar) as placekey from customer
    """,
)
def _features(spark, folder):
    def feature(key, value):
        return F.create_map(F.lit("LIB_FEAT_TYPE"), F.lit("X"), F.lit(key), value)

    known = F.when(F.col("c_nationkey") > 5, F.col("c_name"))
    number = F.when(F.col("c_nationkey") > 20, F.lit("north")).otherwise(F.col("c_acctbal").cast("string"))
    features = F.array(feature("NAME_ORG", known), feature("NAME_ORG", F.col("c_mktsegment")), feature("GEO_LATITUDE", number))
    rows = table(spark, folder, "customer").select(
        F.concat(F.lit("R"), F.col("c_custkey").cast("string")).alias("record_id"), features.alias("features")
    )
    return flatten_features(
        rows, "features", {"name_org": "string NAME_ORG", "geo_latitude": "double GEO_LATITUDE", "placekey": "string PLACEKEY"}, ["record_id"]
    )


@query(
    "explode_sections",
    """
    select p_partkey, sha256(p_name || p_partkey) as hash, 'active' as status, case when length(p_name) >= 10 then substr(p_name, 3, 8) else '' end as bank_prefix from part
    union all select p_partkey, sha256(p_brand || p_partkey), 'exempt', case when length(p_name) >= 10 then substr(p_name, 3, 8) else '' end from part
    """,
)
def _sections(spark, folder):
    key = F.col("p_partkey").cast("string")
    docs = table(spark, folder, "part").select(
        "p_partkey",
        "p_name",
        F.array(F.sha2(F.concat("p_name", key), 256), F.md5("p_name")).alias("skrotyPodatnikowCzynnych"),
        F.array(F.lit("]"), F.sha2(F.concat("p_brand", key), 256)).alias("skrotyPodatnikowZwolnionych"),
    )
    out = explode_sections(
        docs,
        {"skrotyPodatnikowCzynnych": "active", "skrotyPodatnikowZwolnionych": "exempt"},
        "hash",
        "status",
        keep=["p_partkey", "p_name"],
    )
    return out.select("p_partkey", "hash", "status", bank_prefix("p_name").alias("bank_prefix"))


@query(
    "taxonomy_paths",
    """
    select 'R' || r_regionkey as node_id, null as parent_id, r_name as node_name, 'AREA' as node_kind, r_name as thematic_area, '' as domain, r_name as taxonomy_path, 1 as tree_level from region
    union all select 'N' || n_nationkey, 'R' || n_regionkey, n_name, 'GROUP', r_name, n_name, r_name || ' > ' || n_name, 2 from nation join region on n_regionkey = r_regionkey
    union all select 'C' || c_custkey, 'N' || c_nationkey, c_name, 'INDICATOR', r_name, n_name, r_name || ' > ' || n_name || ' > ' || c_name, 3
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    """,
)
def _taxonomy(spark, folder):
    def node(name, prefix, key, parent, label, kind):
        up = F.lit(None).cast("string") if parent is None else F.concat(F.lit(parent[0]), F.col(parent[1]).cast("string"))
        return table(spark, folder, name).select(
            F.concat(F.lit(prefix), F.col(key).cast("string")).alias("id"), up.alias("parent"), F.col(label).alias("name"), F.lit(kind).alias("type")
        )

    nodes = (
        node("region", "R", "r_regionkey", None, "r_name", "AREA")
        .unionByName(node("nation", "N", "n_nationkey", ("R", "n_regionkey"), "n_name", "GROUP"))
        .unionByName(node("customer", "C", "c_custkey", ("N", "c_nationkey"), "c_name", "INDICATOR"))
    )
    return taxonomy_paths(nodes, id="id", parent="parent", name="name", kind="type")


@query(
    "territory_codes",
    """
    with r as (select c_custkey, cast(c_nationkey as varchar) as a, case when c_mktsegment = 'BUILDING' then '' else substr(c_name, 17, 2) end as b,
                      case when c_mktsegment in ('BUILDING', 'MACHINERY') then null else substr(c_name, 18, 1) end as c, case when c_mktsegment in ('BUILDING', 'MACHINERY') then null else '1' end as k from customer)
    select c_custkey, lpad(a, 2, '0') as woj, case when b <> '' then lpad(b, 2, '0') end as pow, case when c <> '' then lpad(c, 2, '0') end as gmi, k as rodz,
           case when b = '' then 'wojewodztwo' when c is null then 'powiat' else 'gmina' end as level,
           lpad(a, 2, '0') || case when b = '' then '' else lpad(b, 2, '0') || coalesce(lpad(c, 2, '0') || k, '') end as teryt_code,
           case when b = '' then null when c is null then lpad(a, 2, '0') else lpad(a, 2, '0') || lpad(b, 2, '0') end as parent_teryt_code
    from r
    """,
)
def _territories(spark, folder):
    top = F.col("c_mktsegment") == "BUILDING"
    upper = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    register = table(spark, folder, "customer").select(
        "c_custkey",
        F.col("c_nationkey").cast("string").alias("WOJ"),
        F.when(top, F.lit("")).otherwise(F.substring("c_name", 17, 2)).alias("POW"),
        F.when(~upper, F.substring("c_name", 18, 1)).alias("GMI"),
        F.when(~upper, F.lit("1")).alias("RODZ"),
    )
    return register.select("c_custkey", *[c.alias(n) for n, c in territory_columns("WOJ", "POW", "GMI", "RODZ").items()])


@query(
    "area_rows_check",
    """
    select ' ' || p_size || ' ' || p_partkey as code_source, p_size || '' || p_partkey as code, p_name as unit_name, cast(trunc(p_retailprice) as bigint) as area_m2, cast(p_size as bigint) as area_ha,
           case when p_type = 'ECONOMY' then null else p_partkey end as area_km2, case when p_type = 'ECONOMY' then 'incomplete_row' end as row_error
    from part
    """,
)
def _areas(spark, folder):
    sheet = table(spark, folder, "part").select(
        F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" "), F.col("p_partkey").cast("string"), F.lit("  ")).alias("TERYT"),
        "p_name",
        F.col("p_retailprice").alias("area_m2"),
        F.col("p_size").alias("area_ha"),
        F.when(F.col("p_type") != "ECONOMY", F.col("p_partkey")).alias("area_km2"),
    )
    return area_rows_check(sheet, "TERYT", "p_name", ["area_m2", "area_ha", "area_km2"])
