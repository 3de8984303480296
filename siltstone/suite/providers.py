"""More source pipelines end to end, with inputs that repeat, conflict and break rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltstone.operators.metrics import METRICS, query_metric
from siltstone.plans import accounts, annual, cubes, entities, fx, indicators, weather
from siltstone.sources.readers import spread_scan
from siltstone.sources.scratch import scratch_path, stored_once
from siltstone.suite.pipelines import _PRICES, _QUOTES, AS_OF, _envelopes, _wide
from siltstone.suite.registry import query, table


# --- quotations: every kind of event, rules, daily mart ---------------------------------------


@query(
    "fx_change_events",
    f"""with {_QUOTES},
    all_responses as (select source_id, day, k, code, price, no from quotes union all
                      select 'nbp_gold_prices', day, k, null, price, null from q where t = 'G'),
    seen as (select *, lag(k) over w as k_before, lag(code) over w as code_before, lag(price) over w as price_before, lag(no) over w as no_before
             from all_responses window w as (partition by source_id, day order by k)),
    returned as (select source_id, day, k, code, row_number() over (partition by source_id, day, code order by k) as n from all_responses)
    select source_id, day as effective_date, code, k as ingestion_sequence, k_before as previous_ingestion_sequence,
           case when price is distinct from price_before then 'source_value_changed' else 'source_metadata_changed' end as event_type
    from seen where k_before is not null and code is not distinct from code_before and (price is distinct from price_before or no is distinct from no_before)
    union all
    select source_id, day, code_before, k, k_before, 'source_record_missing' from seen where k_before is not null and code is distinct from code_before
    union all
    select seen.source_id, seen.day, seen.code, seen.k, seen.k_before, 'source_record_reappeared'
    from seen join returned using (source_id, day, k) where k_before is not null and seen.code is distinct from code_before and n > 1
    """,
)
def _fx_events(spark, folder):
    """Value and metadata changes, losses and returns, of quotations and gold."""
    envelopes = _envelopes(spark, folder)
    events = fx.quote_change_events({t: fx.bronze_quotes(envelopes, t) for t in fx.QUOTE_SOURCES}, fx.bronze_gold(envelopes))
    return events.select("source_id", "effective_date", "code", "ingestion_sequence", "previous_ingestion_sequence", "event_type")


@query(
    "fx_quote_rules",
    """
    with q as (select o_orderkey as k, substr('ABC', cast(o_orderkey % 3 as integer) + 1, 1) as t, cast(o_orderdate as date) as day, o_totalprice as price,
                      case when o_custkey % 11 = 0 then ' ' else o_orderpriority end as code from orders)
    select 'b' || k as batch_id, t as source_table, code, 'code_required' as rule from q where trim(code) = ''
    union all select 'b' || k, t, code, 'mid_invalid' from q where t <> 'C' and k % 7 < 3
    union all select 'b' || k, t, code, 'bid_invalid' from q where t = 'C' and k % 7 < 3
    union all select 'b' || k, t, code, 'bid_above_ask' from q where t = 'C' and (k % 7 = 2 or k % 7 >= 3 and k % 5 = 0)
    union all select 'b' || k, t, code, 'effective_date_required' from q where k % 13 = 0
    union all select 'b' || k, t, code, 'wrong_table' from q where k % 17 = 0
    """,
)
def _fx_rules(spark, folder):
    """Quotations with blank codes, missing dates, wrong tables, and rates that are negative, absent or no number."""
    orders = table(spark, folder, "orders")
    k = F.col("o_orderkey")
    kind = F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")), (k % 3 + 1).cast("int"))
    price = F.when(k % 7 == 0, -F.col("o_totalprice")).when(k % 7 == 1, F.lit(None).cast("double")).when(k % 7 == 2, F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    rows = orders.select(
        F.lit("s").alias("source_id"),
        F.concat(F.lit("b"), k.cast("string")).alias("batch_id"),
        kind.alias("kind"),
        F.when(k % 17 != 0, kind).alias("source_table"),
        F.when(k % 13 != 0, F.col("o_orderdate").cast("date")).alias("effective_date"),
        F.when(F.col("o_custkey") % 11 == 0, F.lit(" ")).otherwise(F.col("o_orderpriority")).alias("code"),
        F.when(kind != "C", price).alias("mid"),
        F.when(kind == "C", price).alias("bid"),
        F.when(kind == "C", F.abs("o_totalprice") + F.when(k % 5 == 0, -1).otherwise(1)).alias("ask"),
    )
    out = None
    for t in ("A", "B", "C"):
        broken = fx.quote_rules(rows.where(F.col("kind") == t), t).select("batch_id", F.lit(t).alias("source_table"), "code", "rule")
        out = broken if out is None else out.unionByName(broken)
    return out


@query(
    "fx_daily_mart",
    f"""with {_QUOTES} select day as "effectiveDate", currency, code, price as mid, false as has_zero_source_quote, no, k as ingestion_sequence from newest where t = 'A'""",
)
def _fx_daily(spark, folder):
    mart = fx.mart_exchange_rates_daily(fx.current_quotes(fx.bronze_quotes(_envelopes(spark, folder), "A"), "A"))
    return mart.select("effectiveDate", "currency", "code", "mid", "has_zero_source_quote", "no", "ingestion_sequence")


_FX_METRICS = {"nbp_table_a_mid": ("A", "mid"), "nbp_table_b_mid": ("B", "mid"), "nbp_table_c_bid": ("C", "bid"), "nbp_table_c_ask": ("C", "ask")}


@query(
    "metrics_fx",
    f"with {_QUOTES}, f as (select t, day, code, {_PRICES} from newest) "
    + " union all ".join(
        f"select '{name}' as metric, day as effective_date, code as currency_key, '{t}' as source_table_key, {c} as value from f where t = '{t}' and day between date '1996-01-01' and date '1997-06-30'"
        for name, (t, c) in _FX_METRICS.items()
    )
    + " union all select 'nbp_gold_price_pln_per_gram_1000', day, 'nbp_gold_1000_gram', null, cast(cast(price as decimal(18,2)) as double) from gold where day between date '1996-01-01' and date '1997-06-30'",
)
def _metrics_fx(spark, folder):
    """All governed quotation metrics at their grain."""
    envelopes = _envelopes(spark, folder)
    current = [fx.current_quotes(fx.bronze_quotes(envelopes, t), t) for t in fx.QUOTE_SOURCES]
    facts = {"fact_fx_quotes": fx.fact_fx_quotes(*current), "fact_gold_prices": fx.fact_gold_prices(fx.current_gold(fx.bronze_gold(envelopes)))}
    out = None
    for name in (*_FX_METRICS, "nbp_gold_price_pln_per_gram_1000"):
        metric = METRICS[name]
        found = query_metric(metric, facts[metric.table], "1996-01-01", "1997-06-30")
        key = F.col("commodity_key") if "commodity_key" in found.columns else F.col("currency_key")
        kind = F.col("source_table_key") if "source_table_key" in found.columns else F.lit(None).cast("string")
        rows = found.select(F.lit(name).alias("metric"), "effective_date", key.alias("currency_key"), kind.alias("source_table_key"), F.col(name).cast("double").alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out


# --- annual indicators: catalogue members, coverage mart, metrics -----------------------------


def _members(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The archive's members: values, countries (each twice, once without a region) and series."""
    nations = table(spark, folder, "nation").join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    nothing = F.lit(None).cast("string")
    region = F.when(F.col("n_regionkey") == 0, F.lit(annual.AGGREGATES_REGION)).otherwise(F.col("r_name"))
    filled = {"country_code": F.concat(F.lit(" N"), F.col("n_nationkey").cast("string"), F.lit(" ")), "table_name": F.concat("n_name", F.lit(" ")), "region_name": region, "short_name": F.lit("  ")}
    countries = nations.select(*[filled.get(c, nothing).alias(k) for k, c in annual.COUNTRY.items()])
    again = nations.select(*[({**filled, "region_name": nothing}).get(c, nothing).alias(k) for k, c in annual.COUNTRY.items()])
    names = {"indicator_code": F.col("o_orderpriority"), "indicator_name": F.concat(F.lit("name of "), "o_orderpriority")}
    series = table(spark, folder, "orders").select(*[names.get(c, nothing).alias(k) for k, c in annual.SERIES.items()]).distinct()
    return {"data": _wide(spark, folder), "country": countries.unionByName(again), "series": series}


def _annual_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    evidence = spark.createDataFrame([("abc", "2024-01-02 03:04:05", 1, 6)], "raw_sha256 string, retrieved_at_utc string, current_distribution_total int, member_total int")
    return annual.build(_members(spark, folder), evidence)


@query(
    "annual_dim_geography",
    """
    select 'N' || n_nationkey as geography_key, n_name as geography_name, case when n_regionkey = 0 then 'Aggregates' else r_name end as region_name,
           case when n_regionkey = 0 then 'source_published_aggregate' else 'country_or_territory' end as geography_type
    from nation join region on n_regionkey = r_regionkey
    """,
)
def _geography(spark, folder):
    return _annual_tables(spark, folder)["dim_wdi_geography"].select("geography_key", "geography_name", "region_name", "geography_type")


@query("annual_dim_indicator", "select distinct o_orderpriority as indicator_key, 'name of ' || o_orderpriority as indicator_name from orders")
def _indicators(spark, folder):
    return _annual_tables(spark, folder)["dim_wdi_indicator"].select("indicator_key", "indicator_name")


_ANNUAL_TOTALS = """
    cells as (select distinct c_nationkey, o_orderpriority, extract(year from o_orderdate) as y from orders join customer on o_custkey = c_custkey),
    totals as (select date '2024-01-02' as snapshot_date, 1::bigint as current_archive_total, 6::bigint as archive_member_total,
               2 * (select count(*) from nation) as source_geography_total, (select count(distinct o_orderpriority) from orders) as source_indicator_total,
               (select count(*) from cells) as source_value_total, (select count(distinct c_nationkey) from cells) as modeled_geography_total,
               (select count(distinct o_orderpriority) from cells) as modeled_indicator_total, (select count(*) from cells) as modeled_observation_total,
               (select min(make_date(y, 1, 1)) from cells) as first_observation_date, (select max(make_date(y, 1, 1)) from cells) as latest_observation_date,
               1.0::double as modeled_value_coverage_ratio)
"""


@query("annual_coverage_mart", f"with {_ANNUAL_TOTALS} select * from totals")
def _annual_mart(spark, folder):
    return _annual_tables(spark, folder)["mart_wdi_coverage"].drop("latest_retrieved_at_utc").withColumn("modeled_value_coverage_ratio", F.col("modeled_value_coverage_ratio").cast("double"))


_WDI = [m for m in METRICS.values() if m.table == "mart_wdi_coverage"]


@query("metrics_annual", f"with {_ANNUAL_TOTALS} " + " union all ".join(f"select '{m.name}' as metric, snapshot_date, {m.column}::double as value from totals" for m in _WDI))
def _metrics_annual(spark, folder):
    """All governed metrics of the coverage mart."""
    path = scratch_path(spark, "coverage")
    _annual_tables(spark, folder)["mart_wdi_coverage"].write.parquet(path)
    mart, out = spark.read.parquet(path), None
    for m in _WDI:
        rows = query_metric(m, mart, "2024-01-01", "2024-12-31").select(F.lit(m.name).alias("metric"), "snapshot_date", F.col(m.name).cast("double").alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out


# --- weather ----------------------------------------------------------------------------------


_WEATHER = """
    d as (select 'S' || user_id % 20 as station, cast(ts as date) as day, cast(max(value) as decimal(18,2)) as hi, cast(min(value) - 20 as decimal(18,2)) as lo,
                 count(*) as n, count(*) filter (where event_type = 'view') as rain
          from events where user_id is not null and value is not null group by all)
"""


@query(
    "weather_daily_mart",
    f"""with {_WEATHER}
    select day as observation_date, date_trunc('month', day)::date as observation_month, station as station_code, 'Station ' || station as station_name,
           hi::double as tmax_celsius, lo::double as tmin_celsius, rain::double as precipitation_mm,
           case n % 3 when 0 then 'liquid' when 1 then 'solid' end as precipitation_type_standardized, (n % 9)::double as wind_speed_ms,
           (rain > 0)::int as has_precipitation, (rain >= 10)::int as is_heavy_rain_day, (lo < 0)::int as is_frost_day, (hi >= 25)::int as is_summer_day, (hi >= 30)::int as is_hot_day
    from d
    """,
)
def _weather(spark, folder):
    """Two companion files by position, blank stations and impossible dates among their rows."""
    events = table(spark, folder, "events").where("user_id is not null and value is not null")
    station = F.concat(F.lit("S"), (F.col("user_id") % 20).cast("string"))
    days = events.groupBy(station.alias("station"), F.col("ts").cast("date").alias("day")).agg(
        F.max("value").cast("decimal(18,2)").alias("hi"), (F.min("value") - 20).cast("decimal(18,2)").alias("lo"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "view").alias("rain")
    )
    place = {"station_code": F.col("station"), "station_name": F.col("station"), "year_val": F.year("day").cast("string"), "month_val": F.month("day").cast("string"), "day_val": F.dayofmonth("day").cast("string")}
    kind = F.element_at(F.array(F.lit(" W"), F.lit("S "), F.lit("")), (F.col("n") % 3 + 1).cast("int"))
    cells = {**place, "tmax_celsius": F.col("hi").cast("string"), "tmin_celsius": F.col("lo").cast("string"), "precipitation_mm": F.col("rain").cast("string"), "precipitation_type": kind}
    more = {**place, "wind_speed_ms": (F.col("n") % 9).cast("string")}
    nothing = F.lit(None).cast("string")

    def sheet(columns, values):
        return days.select(*[values.get(c, nothing).alias(c) for c in columns], F.lit("s_d_x.csv").alias("raw_archive_file"))

    main = sheet(weather.SYNOPTIC, cells)
    main = main.unionByName(sheet(weather.SYNOPTIC, {**cells, "month_val": F.lit("13")})).unionByName(sheet(weather.SYNOPTIC, {**cells, "station_code": nothing}))
    synoptic = weather.stg_synoptic(weather.bronze_synoptic(main, sheet(weather.COMPANION, more), AS_OF))
    listed = days.select(F.col("station").alias("station_code"), F.concat(F.lit("Station "), "station", F.lit(" ")).alias("station_name"), F.lit("1").alias("station_num")).distinct()
    mart = weather.mart_daily_summary(weather.fact_daily(synoptic), weather.dim_station(weather.stg_stations(listed)))
    return mart.select(
        "observation_date", "observation_month", "station_code", "station_name", "tmax_celsius", "tmin_celsius", "precipitation_mm", "precipitation_type_standardized", "wind_speed_ms", *weather.FLAGS
    )


# --- taxpayer accounts ------------------------------------------------------------------------


@query(
    "accounts_taxpayers",
    """
    select sha256(c_name) as hash, case when c_custkey % 3 = 0 then 'exempt' else 'active' end as taxpayer_status, date '2024-01-02' as snapshot_date from customer where c_custkey % 10 <> 1
    """,
)
def _taxpayers(spark, folder):
    """The flat file of hashes, read as split lines; every tenth entry is no hash."""
    customers = table(spark, folder, "customer")
    section = F.when(F.col("c_custkey") % 3 == 0, F.lit(1)).otherwise(F.lit(0))
    code = F.when(F.col("c_custkey") % 10 == 1, F.lit("zz")).otherwise(F.sha2("c_name", 256))
    body = customers.select(section.alias("s"), F.lit(1).alias("o"), F.concat(F.lit('    "'), code, F.lit('",')).alias("value"))
    frame = [(-1, 0, "{"), (-1, 1, '  "naglowek": {'), (-1, 2, '    "dataGenerowaniaDanych": "20240102"'), (-1, 3, "  },")]
    for s, name in enumerate(accounts.STATUS):
        frame += [(s, 0, f'  "{name}": ['), (s, 2, "  ],")]
    lines = body.unionByName(spark.createDataFrame(frame, "s int, o int, value string"))
    path = scratch_path(spark, "accounts")
    # one document is one file, so its lines are written in their order by one task
    lines.repartitionByRange(1, "s", "o").sortWithinPartitions("s", "o").select("value").write.text(path)
    found = accounts.bronze_taxpayers(accounts.sections(spark, path), "2024-01-02", AS_OF)
    return accounts.dim_taxpayer_account(found).select("hash", "taxpayer_status", "snapshot_date")


# --- open business data -----------------------------------------------------------------------


@query(
    "open_data_organizations",
    """
    select cast(s_suppkey as varchar) as record_id, 'X' as data_source, case when s_suppkey % 2 = 0 then 'lower' else 'upper' end as bq_dataset, s_name as name_org,
           n_name as addr_country, case when s_suppkey % 3 = 0 then null else s_suppkey + 0.5::double end as geo_latitude
    from supplier join nation on s_nationkey = n_nationkey
    """,
)
def _organizations(spark, folder):
    """Records with features that repeat: the first one counts, numbers that are none are missing."""
    suppliers = table(spark, folder, "supplier").join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    text = F.col("s_suppkey").cast("string")
    latitude = F.when(F.col("s_suppkey") % 3 == 0, F.lit("north")).otherwise(F.concat(text, F.lit(".5")))
    features = F.array(
        F.create_map(F.lit("NAME_ORG"), F.col("s_name")),
        F.create_map(F.lit("NAME_ORG"), F.lit("later"), F.lit("ADDR_COUNTRY"), F.col("n_name")),
        F.create_map(F.lit("GEO_LATITUDE"), latitude),
    )
    name = F.when(F.col("s_suppkey") % 2 == 0, F.lit("lower"))
    record = F.struct(text.alias("RECORD_ID"), F.lit("X").alias("DATA_SOURCE"), name.alias("bq_dataset"), F.when(name.isNull(), F.lit("upper")).alias("BQ_DATASET"), features.alias("FEATURES"))
    path = scratch_path(spark, "open-data")
    spark_case = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", "true")  # the two spellings of one name
    try:
        suppliers.select(F.to_json(record).alias("value")).write.text(path)
    finally:
        spark.conf.set("spark.sql.caseSensitive", spark_case)
    found = entities.read(spark, path, "organizations")
    return found.select("record_id", "data_source", "bq_dataset", "name_org", "addr_country", "geo_latitude")


# --- statistical cubes and indicators with revisions --------------------------------------------


_MOMENT = "o_orderdate + to_microseconds(o_orderkey)"


def _moment():
    """A moment that no other response has."""
    part = (F.col("o_orderkey").cast("decimal(18,0)") / 1_000_000).cast("decimal(18,6)")
    return (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=part)).alias("retrieved_at_utc")


def _cube_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """One cube of two periods per order; the second value comes and goes, texts stand among the numbers."""
    orders = spread_scan(table(spark, folder, "orders"))
    number = F.when(F.col("o_custkey") % 4 == 3, F.lit('"n"')).otherwise((F.col("o_custkey") % 4).cast("string"))
    later = F.when(F.col("o_custkey") % 2 == 0, F.lit("null")).otherwise(F.lit("7"))
    index = "{\"category\": {\"index\": [%s]}}"
    body = F.format_string(
        '{"version": "2.0", "class": "dataset", "label": "L", "updated": "2024-01-01T00:00:00Z", "id": ["freq", "geo", "time"], "size": [1, 1, 2], '
        '"dimension": {"freq": ' + index % '"A"' + ', "geo": ' + index % '"%s"' + ', "time": ' + index % '"2020", "2020-05"' + '}, "value": [%s, %s]}',
        F.col("o_orderstatus"), number, later,
    )
    meta = F.to_json(F.struct(F.col("o_orderpriority").alias("dataset"), F.col("o_orderstatus").alias("geo")))
    return orders.select(
        F.lit("eurostat").alias("source_id"), F.col("o_orderkey").cast("string").alias("task_id"), F.lit("jsonstat").alias("task_kind"), F.lit("lane").alias("lane"), _moment(),
        F.md5(F.col("o_orderkey").cast("string")).alias("raw_sha256"), meta.alias("metadata_json"), body.alias("payload_utf8"),
    )


_CELLS = f"""
    cells as (
        select o_orderpriority as dataset_id, o_orderstatus as geo_code, {_MOMENT} as seen, o_orderkey as k, '2020' as period_key,
               case when o_custkey % 4 = 3 then '"n"' else cast(o_custkey % 4 as varchar) end as value_json from orders
        union all select o_orderpriority, o_orderstatus, {_MOMENT}, o_orderkey, '2020-05', case when o_custkey % 2 = 0 then 'null' else '7' end from orders),
    turned as (select *, case when value_json is not distinct from lag(value_json) over w then 0 else 1 end as turn, row_number() over w as n
               from cells window w as (partition by dataset_id, geo_code, period_key order by seen)),
    numbered as (select *, sum(turn) over (partition by dataset_id, geo_code, period_key order by seen rows unbounded preceding) as run from turned),
    runs as (
        select dataset_id, geo_code, period_key, run as revision_number, max(value_json) as value_json, min(seen) as first_seen_at_utc, max(seen) as last_seen_at_utc,
               count(*) as replayed_response_count, arg_max(k, seen) as last_key
        from numbered group by all),
    ledger as (select *, max(revision_number) over (partition by dataset_id, geo_code, period_key) as revision_count from runs)
"""


@query(
    "cube_observation_revisions",
    f"""with {_CELLS}
    select dataset_id, geo_code, period_key, cast(revision_number as bigint) as revision_number, cast(revision_count as bigint) as revision_count, value_json,
           try_cast(value_json as double) as value_numeric, value_json = 'null' as is_missing, replayed_response_count, revision_number = revision_count as is_current,
           case when revision_number = 1 then 'first_observed' else 'observed_value_changed' end as revision_event_type from ledger""",
)
def _cube_revisions(spark, folder):
    ledger = cubes.observation_revisions(cubes.bronze_observations(_cube_envelopes(spark, folder)))
    return ledger.select(
        "dataset_id", "geo_code", "period_key", "revision_number", "revision_count", "value_json", "value_numeric", "is_missing", "replayed_response_count", "is_current", "revision_event_type"
    )


@query(
    "cube_fact_observations",
    f"""with {_CELLS}
    select dataset_id as dataset_key, geo_code as geography_key, period_key, value_json, cast(revision_count as bigint) as revision_count, cast(last_key as varchar) as task_id,
           case period_key when '2020' then date '2020-12-31' else date '2020-05-31' end as period_end_date, case period_key when '2020' then 'year' else 'month' end as period_granularity
    from ledger where revision_number = revision_count""",
)
def _cube_fact(spark, folder):
    observations = cubes.current_observations(cubes.observation_revisions(cubes.bronze_observations(_cube_envelopes(spark, folder))))
    observations = stored_once(observations, "observations")  # the fact and its periods both read them
    fact = cubes.fact_observations(observations, cubes.dim_period(observations))
    return fact.select("dataset_key", "geography_key", "period_key", "value_json", "revision_count", "task_id", "period_end_date", "period_granularity")


@query(
    "cube_dim_dataset",
    f"""with {_CELLS}
    select dataset_id as dataset_key, count(distinct geo_code) as modeled_geography_count, count(*) as modeled_cell_count,
           count(*) filter (where value_json <> 'null') as modeled_value_count, min(period_key) as first_period_key, max(period_key) as last_period_key
    from ledger where revision_number = revision_count group by dataset_id""",
)
def _cube_datasets(spark, folder):
    observations = cubes.current_observations(cubes.observation_revisions(cubes.bronze_observations(_cube_envelopes(spark, folder))))
    return cubes.dim_dataset(observations).select("dataset_key", "modeled_geography_count", "modeled_cell_count", "modeled_value_count", "first_period_key", "last_period_key")


def _data_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """One page of observations per order: a unit of twelve digits or not, a value as ``val`` or as ``value``, or both."""
    orders = table(spark, folder, "orders")
    unit = F.when(F.col("o_orderkey") % 10 == 9, F.lit("short")).otherwise(F.lpad((F.col("o_custkey") % 20).cast("string"), 12, "0"))
    figure = (F.col("o_custkey") % 3).cast("string")
    name = F.when(F.col("o_orderkey") % 2 == 0, F.lit('"val": ')).otherwise(F.lit('"value": '))
    both = F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit('"val": '), figure, F.lit(', "value": '), figure)).otherwise(F.concat(name, figure))
    body = F.format_string(
        '{"totalRecords": 1, "variableId": %d, "measureUnitId": %d, "aggregateId": 1, "lastUpdate": "2024-01-01T00:00:00", "results": [{"id": "%s", "name": "u", "values": [{"year": "%s", %s, "attrId": %d, "precision": 0}]}]}',
        F.col("o_custkey") % 5, F.when(F.col("o_orderkey") % 11 == 0, F.lit(-1)).otherwise(F.lit(3)), unit, F.date_format("o_orderdate", "yyyy"), both,
        F.when(F.col("o_orderkey") % 13 == 0, F.lit(-1)).otherwise(F.lit(1)),
    )
    return orders.select(
        F.lit(indicators.SOURCE).alias("source_id"), F.col("o_orderkey").cast("string").alias("task_id"), F.lit("data_by_variable").alias("task_kind"),
        F.lit('{"params": {"lang": "pl", "page": 0}}').alias("request_json"), _moment(), F.md5(F.col("o_orderkey").cast("string")).alias("raw_sha256"), F.lit(1).alias("raw_size_bytes"), body.alias("payload_utf8"),
    )


_OBSERVATIONS = f"""
    obs as (select cast(o_orderkey as varchar) as task_id, o_orderkey as k, cast(o_custkey % 5 as bigint) as variable_id,
                   case when o_orderkey % 10 = 9 then 'short' else lpad(cast(o_custkey % 20 as varchar), 12, '0') end as unit_id, strftime(o_orderdate, '%Y') as period_key,
                   case when o_orderkey % 13 = 0 then -1 else 1 end as attr_id, case when o_orderkey % 11 = 0 then -1 else 3 end as measure_unit_id,
                   cast(o_custkey % 3 as double) as value_numeric, {_MOMENT} as seen from orders)
"""


@query(
    "indicator_observation_rules",
    f"""with {_OBSERVATIONS}
    select task_id, unit_id, 'unit_id_not_12_digits' as rule from obs where unit_id = 'short'
    union all select task_id, unit_id, 'one_of_val_or_value' from obs where k % 7 = 0
    union all select task_id, unit_id, 'negative_attribute' from obs where attr_id < 0
    union all select task_id, unit_id, 'negative_measure_unit' from obs where measure_unit_id < 0
    """,
)
def _indicator_rules(spark, folder):
    return indicators.observation_rules(indicators.bronze_observations(_data_envelopes(spark, folder))).select("task_id", "unit_id", "rule")


@query(
    "indicator_observation_revisions",
    f"""with {_OBSERVATIONS},
    versions as (select variable_id, unit_id, period_key, attr_id, measure_unit_id, value_numeric, min(seen) as first_seen, max(seen) as last_seen, count(*) as replayed_response_count
                 from obs group by all),
    lined as (select *, row_number() over w as revision_number, count(*) over (partition by variable_id, unit_id, period_key, attr_id) as revision_count,
                     lag(value_numeric) over w as previous_value_numeric, max(last_seen) over (partition by variable_id, unit_id, period_key, attr_id) as newest
              from versions window w as (partition by variable_id, unit_id, period_key, attr_id order by first_seen))
    select variable_id, unit_id, period_key, attr_id, measure_unit_id, value_numeric, replayed_response_count, revision_number, revision_count, last_seen = newest as is_current, previous_value_numeric,
           case when revision_number = 1 then 'first_observed' when value_numeric <> previous_value_numeric then 'observed_value_changed' else 'observed_metadata_changed' end as revision_event_type
    from lined
    """,
)
def _indicator_revisions(spark, folder):
    ledger = indicators.observation_revisions(indicators.bronze_observations(_data_envelopes(spark, folder)))
    return ledger.select(
        "variable_id", "unit_id", "period_key", "attr_id", "measure_unit_id", "value_numeric", "replayed_response_count", "revision_number", "revision_count", "is_current",
        "previous_value_numeric", "revision_event_type",
    )
