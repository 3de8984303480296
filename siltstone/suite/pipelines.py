"""Source pipelines end to end: tables in the sources' own layouts, through every layer of a plan."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltstone.plans import air, annual, corporate, fx, territory
from siltstone.suite.registry import query, table

AS_OF = datetime(2024, 1, 1)


# --- quotations ---------------------------------------------------------------------------


def _envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """One response per order: a publication of table A, B or C with one quote, or a gold price.

    The day is quoted again by every later order of that day and code, so the ledger has repeats and corrections.
    """
    orders = table(spark, folder, "orders")
    kind = F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C"), F.lit("G")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    price = F.col("o_totalprice")
    code = F.concat(F.lit("P"), F.substring("o_orderpriority", 1, 1))
    rate = F.struct(
        F.col("o_orderpriority").alias("currency"),
        code.alias("code"),
        F.when(kind != "C", price).alias("mid"),
        F.when(kind == "C", price).alias("bid"),
        F.when(kind == "C", price + 1).alias("ask"),
    )
    publication = F.struct(kind.alias("table"), F.concat(F.lit("N"), F.col("o_custkey").cast("string")).alias("no"), day.alias("effectiveDate"), F.when(kind == "C", day).alias("tradingDate"), F.array(rate).alias("rates"))
    gold = F.struct(day.alias("data"), price.cast("decimal(18,2)").alias("cena"))
    source = F.create_map(*[F.lit(x) for pair in (*fx.QUOTE_SOURCES.items(), ("G", fx.GOLD_SOURCE)) for x in pair])[kind]
    return orders.select(
        source.alias("source_id"),
        F.concat(F.lit("b"), F.col("o_orderkey").cast("string")).alias("batch_id"),
        F.col("o_orderkey").alias("ingestion_sequence"),
        day.alias("requested_start_date"),
        day.alias("requested_end_date"),
        F.concat(day, F.lit(" 10:00:00")).alias("retrieved_at_utc"),
        F.md5(F.col("o_orderkey").cast("string")).alias("response_sha256"),
        F.col("o_orderkey").cast("string").alias("raw_file_id"),
        F.when(kind == "G", F.to_json(F.array(gold))).otherwise(F.to_json(F.array(publication))).alias("body_json"),
    )


_QUOTES = """
    q as (select o_orderkey as k, substr('ABCG', cast(o_orderkey % 4 as integer) + 1, 1) as t, cast(o_orderdate as date) as day, 'P' || substr(o_orderpriority, 1, 1) as code,
                 o_orderpriority as currency, o_totalprice as price, 'N' || o_custkey as no from orders),
    sources(t, source_id) as (values ('A', 'nbp_exchange_rates_table_a'), ('B', 'nbp_exchange_rates_table_b'), ('C', 'nbp_exchange_rates_table_c'), ('G', 'nbp_gold_prices')),
    quotes as (select * from q join sources using (t) where t <> 'G'),
    newest as (select * from quotes qualify row_number() over (partition by t, day, code order by k desc) = 1),
    gold as (select * from q where t = 'G' qualify row_number() over (partition by day order by k desc) = 1)
"""
_PRICES = "case when t <> 'C' then price end as mid, case when t = 'C' then price end as bid, case when t = 'C' then price + 1 end as ask"


@query("fx_bronze_quotes", f"with {_QUOTES} select source_id, t as source_table, no, day as effective_date, case when t = 'C' then day end as trading_date, currency, code, {_PRICES}, k as ingestion_sequence from quotes")
def _fx_bronze(spark, folder):
    envelopes = _envelopes(spark, folder)
    out = None
    for t in fx.QUOTE_SOURCES:
        rows = fx.bronze_quotes(envelopes, t).select("source_id", "source_table", "no", "effective_date", "trading_date", "currency", "code", "mid", "bid", "ask", "ingestion_sequence")
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "fx_fact_quotes",
    f"""with {_QUOTES} select t as source_table_key, day as effective_date, case when t = 'C' then day end as trading_date, code as currency_key, 'PLN' as quote_currency_key, {_PRICES},
    false as has_zero_source_quote, no as source_no, k as ingestion_sequence from newest""",
)
def _fx_fact(spark, folder):
    """Guarded current quotes with their real measures, of all three tables."""
    envelopes = _envelopes(spark, folder)
    current = [fx.current_quotes(fx.bronze_quotes(envelopes, t), t) for t in fx.QUOTE_SOURCES]
    return fx.fact_fx_quotes(*current).select(
        "source_table_key", "effective_date", "trading_date", "currency_key", "quote_currency_key", "mid", "bid", "ask", "has_zero_source_quote", "source_no", "ingestion_sequence"
    )


@query(
    "fx_fact_gold",
    f"with {_QUOTES} select day as effective_date, 'nbp_gold_1000_gram' as commodity_key, 'PLN' as quote_currency_key, cast(price as decimal(18,2)) as price_pln_per_gram_1000, k as ingestion_sequence from gold",
)
def _fx_gold(spark, folder):
    fact = fx.fact_gold_prices(fx.current_gold(fx.bronze_gold(_envelopes(spark, folder))))
    return fact.select("effective_date", "commodity_key", "quote_currency_key", "price_pln_per_gram_1000", "ingestion_sequence")


@query(
    "fx_absences",
    f"""with {_QUOTES},
    seen as (select source_id, day, k, code, lag(code) over w as before, lag(k) over w as k_before from quotes window w as (partition by source_id, day order by k))
    select source_id, day as effective_date, before as code, k as ingestion_sequence, k_before as previous_ingestion_sequence from seen where before is not null and before <> code""",
)
def _fx_absences(spark, folder):
    """Change events of records that the next response of their day no longer shows."""
    envelopes = _envelopes(spark, folder)
    events = fx.quote_change_events({t: fx.bronze_quotes(envelopes, t) for t in fx.QUOTE_SOURCES}, fx.bronze_gold(envelopes))
    gone = events.where("current_record_sha256 is null")
    return gone.select("source_id", "effective_date", "code", "ingestion_sequence", "previous_ingestion_sequence")


@query(
    "fx_dim_currency",
    f"with {_QUOTES} select code as currency_key from newest union select 'PLN'",
)
def _fx_currency(spark, folder):
    envelopes = _envelopes(spark, folder)
    return fx.dim_currency(*[fx.current_quotes(fx.bronze_quotes(envelopes, t), t) for t in fx.QUOTE_SOURCES]).select("currency_key")


# --- annual indicators ----------------------------------------------------------------------


def _wide(spark, folder):
    years = [r[0] for r in table(spark, folder, "orders").select(F.date_format("o_orderdate", "yyyy")).distinct().collect()]
    joined = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    name, series = (next(k for k, v in annual.DATA_IDS.items() if v == c) for c in ("country_code", "indicator_code"))
    others = [F.lit("x").alias(k) for k in annual.DATA_IDS if k not in (name, series)]
    wide = (
        joined.withColumn("y", F.date_format("o_orderdate", "yyyy"))
        .groupBy(F.concat(F.lit(" N"), F.col("c_nationkey").cast("string")).alias(name), F.col("o_orderpriority").alias(series))
        .pivot("y", sorted(years))
        .agg(F.sum(F.lit(1)).cast("string"))
    )
    return wide.select("*", *others)


@query(
    "annual_fact_observations",
    """
    select 'N' || c_nationkey as geography_key, o_orderpriority as indicator_key, cast(extract(year from o_orderdate) as integer) as year_key,
           make_date(extract(year from o_orderdate), 1, 1) as observation_date, cast(count(*) as varchar) as observation_value_text,
           cast(count(*) as double) as observation_value, 'abc' as archive_sha256
    from orders join customer on o_custkey = c_custkey group by all
    """,
)
def _annual(spark, folder):
    evidence = spark.createDataFrame([("abc", "2024-01-02 03:04:05")], "raw_sha256 string, retrieved_at_utc string")
    fact = annual.fact_observations(annual.stg_observations(annual.bronze_data(_wide(spark, folder)), evidence))
    return fact.select("geography_key", "indicator_key", "year_key", "observation_date", "observation_value_text", "observation_value", "archive_sha256")


@query("annual_dim_year", "select distinct cast(extract(year from o_orderdate) as integer) as year_key, make_date(extract(year from o_orderdate), 1, 1) as year_start_date from orders")
def _annual_years(spark, folder):
    evidence = spark.createDataFrame([("abc", "2024-01-02 03:04:05")], "raw_sha256 string, retrieved_at_utc string")
    return annual.dim_year(annual.stg_observations(annual.bronze_data(_wide(spark, folder)), evidence)).select("year_key", "year_start_date")


# --- air quality ----------------------------------------------------------------------------


@query(
    "air_fact_daily",
    """
    select cast(ts as date) as observation_date, 'S' || user_id % 20 as station_code, upper(event_type) as pollutant, 'ug/m3' as unit,
           min(cast(value as decimal(18,2)))::double as min_daily_value, max(cast(value as decimal(18,2)))::double as max_daily_value, count(*) as observations_count
    from events where value is not null and value >= 0 and user_id is not null group by all
    """,
)
def _air_daily(spark, folder):
    """A tabular sheet in Polish headings with decimal commas."""
    sheet = table(spark, folder, "events").where("user_id is not null").select(
        F.concat(F.lit(" S"), (F.col("user_id") % 20).cast("string")).alias("Kod stacji"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Data"),
        F.col("event_type").alias("Wskaźnik"),
        F.translate(F.col("value").cast("decimal(18,2)").cast("string"), ".", ",").alias("Wartość"),
    )
    measured = air.stg_measurements(air.bronze_measurements(sheet, F.lit("2024_x_1g.csv"), AS_OF))
    return air.fact_daily(measured).select("observation_date", "station_code", "pollutant", "unit", "min_daily_value", "max_daily_value", "observations_count")


@query(
    "air_dim_station",
    """
    select 'S' || n_nationkey as station_code, n_name as station_name, upper(r_name) as voivodeship, cast(n_nationkey + 0.5 as double) as latitude,
           (select count(*) from customer where c_nationkey = n_nationkey) as active_sensors_count
    from nation join region on n_regionkey = r_regionkey
    """,
)
def _air_stations(spark, folder):
    nations = table(spark, folder, "nation").join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    code = F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("Kod stacji")
    sheet = nations.select(code, F.col("n_name").alias("Nazwa stacji"), F.lower("r_name").alias("Województwo"), F.concat(F.col("n_nationkey").cast("string"), F.lit(",5")).alias("WGS84 φ N"))
    sensors = table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("Kod stanowiska"), F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("Kod stacji"))
    stations = air.stg_stations(air.bronze_stations(sheet, AS_OF))
    return air.dim_station(stations, air.stg_sensors(air.bronze_sensors(sensors, AS_OF))).select("station_code", "station_name", "voivodeship", "latitude", "active_sensors_count")


# --- corporate ------------------------------------------------------------------------------


@query(
    "corporate_dim_entity",
    """
    select cast(c_custkey as varchar) as lei, c_name as legal_name, d.parent as direct_parent_lei, u.parent as ultimate_parent_lei,
           case c_nationkey % 3 when 0 then 'KRS' when 1 then 'REGON' end as national_registry_type
    from customer
    left join (select cast(o_custkey as varchar) as child, cast(o_orderkey as varchar) as parent from orders where o_orderstatus = 'F' and o_orderkey % 7 = 0) d on d.child = cast(c_custkey as varchar)
    left join (select cast(o_custkey as varchar) as child, cast(o_orderkey as varchar) as parent from orders where o_orderstatus = 'F' and o_orderkey % 7 = 1) u on u.child = cast(c_custkey as varchar)
    """,
)
def _corporate(spark, folder):
    authority = F.element_at(F.array(F.lit("RA000484"), F.lit("RA000654"), F.lit(None).cast("string")), (F.col("c_nationkey") % 3 + 1).cast("int"))
    filled = {"lei": F.col("c_custkey").cast("string"), "legal_name": F.col("c_name"), "validation_authority_id": authority}
    customers = table(spark, folder, "customer").select(*[filled.get(v, F.lit(None).cast("string")).alias(k) for k, v in corporate.ENTITY.items()])
    links = {
        "child_lei": F.col("o_custkey").cast("string"),
        "parent_lei": F.col("o_orderkey").cast("string"),
        "relationship_type": F.when(F.col("o_orderkey") % 7 == 0, corporate.DIRECT).when(F.col("o_orderkey") % 7 == 1, corporate.ULTIMATE).otherwise("OTHER"),
        "relationship_status": F.when(F.col("o_orderstatus") == "F", corporate.ACTIVE).otherwise("INACTIVE"),
    }
    relations = table(spark, folder, "orders").select(*[links.get(v, F.lit(None).cast("string")).alias(k) for k, v in corporate.RELATIONSHIP.items()])
    entities = corporate.dim_entity(corporate.bronze(customers, corporate.ENTITY, AS_OF), corporate.bronze(relations, corporate.RELATIONSHIP, AS_OF))
    return entities.select("lei", "legal_name", "direct_parent_lei", "ultimate_parent_lei", "national_registry_type")


# --- territories ----------------------------------------------------------------------------


@query(
    "territory_dim_territory",
    """
    select lpad(cast(r_regionkey as varchar), 2, '0') as teryt_code, 'wojewodztwo' as level, r_name as unit_name, r_name as voivodeship_name, null as county_name from region
    union all
    select lpad(cast(n_regionkey as varchar), 2, '0') || lpad(cast(n_nationkey as varchar), 2, '0'), 'powiat', n_name, r_name, n_name from nation join region on n_regionkey = r_regionkey
    """,
)
def _territories(spark, folder):
    nothing = F.lit(None).cast("string")

    def unit(rows, region, county, label):
        return rows.select(region.alias("WOJ"), county.alias("POW"), nothing.alias("GMI"), nothing.alias("RODZ"), F.col(label).alias("NAZWA"), nothing.alias("NAZWA_DOD"), F.lit(AS_OF).cast("date").alias("STAN_NA"))

    regions = unit(table(spark, folder, "region"), F.col("r_regionkey").cast("string"), nothing, "r_name")
    counties = unit(table(spark, folder, "nation"), F.col("n_regionkey").cast("string"), F.col("n_nationkey").cast("string"), "n_name")
    units = territory.stg_territories(territory.bronze_territories(regions.unionByName(counties), AS_OF))
    return territory.dim_territory(units).select("teryt_code", "level", "unit_name", "voivodeship_name", "county_name")


@query(
    "territory_dim_street",
    """
    select lpad(cast(s_suppkey as varchar), 5, '0') as street_id, 'ul. ' || s_name as full_street_name, lpad(cast(s_nationkey as varchar), 7, '0') as locality_id, n_name as locality_name
    from supplier join nation on s_nationkey = n_nationkey
    """,
)
def _streets(spark, folder):
    place = [F.lit("1").alias("WOJ"), F.lit("2").alias("POW"), F.lit("3").alias("GMI"), F.lit("1").alias("RODZ_GMI")]
    day = F.lit(AS_OF).cast("date").alias("STAN_NA")
    nations = table(spark, folder, "nation").withColumn("key", F.col("n_nationkey").cast("string"))
    localities = nations.select(*place, F.lit("01").alias("RM"), F.lit("1").alias("MZ"), F.col("n_name").alias("NAZWA"), F.col("key").alias("SYM"), F.col("key").alias("SYMPOD"), day)
    streets = table(spark, folder, "supplier").select(
        *place, F.col("s_nationkey").cast("string").alias("SYM"), F.col("s_suppkey").cast("string").alias("SYM_UL"), F.lit("ul.").alias("CECHA"), F.col("s_name").alias("NAZWA_1"), F.lit("").alias("NAZWA_2"), day
    )
    units = spark.createDataFrame([], territory.TERRITORY_FILE)
    dim = territory.dim_locality(territory.stg_localities(territory.bronze_localities(localities, AS_OF)), territory.dim_territory(territory.stg_territories(territory.bronze_territories(units, AS_OF))))
    out = territory.dim_street(territory.stg_streets(territory.bronze_streets(streets, AS_OF)), dim)
    return out.select("street_id", "full_street_name", "locality_id", "locality_name")
