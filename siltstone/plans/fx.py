"""Exchange-rate and gold quotations, from response envelopes to facts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltstone.operators.decode import decode_envelopes
from siltstone.operators.dimensions import code_dimension, date_spine
from siltstone.operators.ledger import change_events, conflicting_keys, fold_replays, guarded_current, guarded_dedup
from siltstone.operators.quality import repeated_in_group, rule_violations
from siltstone.functions.text import is_finite
from siltstone.sources.scratch import stored_once

# Source ids, table letters, and keys of the published facts.
QUOTE_SOURCES = {
    "A": "nbp_exchange_rates_table_a",
    "B": "nbp_exchange_rates_table_b",
    "C": "nbp_exchange_rates_table_c",
}
GOLD_SOURCE = "nbp_gold_prices"
GOLD_COMMODITY = "nbp_gold_1000_gram"
GOLD_UNIT = "PLN per gram at 1000 fineness"
QUOTE_CURRENCY = "PLN"
RECORD_CONTRACT = "nbp_typed_record_v1"
DETECTION = "typed_record_comparison_v1"

ENVELOPE_SCHEMA = (
    "source_id string, batch_id string, ingestion_sequence bigint, requested_start_date string, "
    "requested_end_date string, retrieved_at_utc string, response_sha256 string, raw_file_id string, body_json string"
)
QUOTE_BODY = (
    "array<struct<`table`: string, no: string, effectiveDate: string, tradingDate: string, rates: array<struct<"
    "currency: string, country: string, symbol: string, code: string, mid: string, bid: string, ask: string>>>>"
)
GOLD_BODY = "array<struct<data: string, cena: string>>"

BATCH = ["batch_id", "requested_start_date", "requested_end_date", "retrieved_at_utc", "response_sha256", "raw_file_id"]
PROVENANCE = ["source_id", "ingestion_sequence", *BATCH]
NEWEST = ["retrieved_at_utc", "batch_id", "response_sha256"]


def _typed(envelopes: DataFrame, source: str) -> DataFrame:
    return envelopes.where(F.col("source_id") == source).select(
        "source_id",
        "batch_id",
        F.col("ingestion_sequence").cast("bigint").alias("ingestion_sequence"),
        *[F.col(c).cast("date").alias(c) for c in ("requested_start_date", "requested_end_date")],
        F.col("retrieved_at_utc").cast("timestamp").alias("retrieved_at_utc"),
        "response_sha256",
        "raw_file_id",
        "body_json",
    )


def bronze_quotes(envelopes: DataFrame, table: str) -> DataFrame:
    """Quotations of one table; tables A and B quote a mid rate, table C bid and ask."""
    two_sided = table == "C"
    nothing = F.lit(None)

    def rate(name: str, wanted: bool):
        return F.col(f"item1.{name}").cast("double") if wanted else nothing.cast("double")

    return decode_envelopes(
        _typed(envelopes, QUOTE_SOURCES[table]),
        "body_json",
        QUOTE_BODY,
        ["body", "item0.rates"],
        {
            "source_table": "item0.table",
            "no": "item0.no",
            "effective_date": F.col("item0.effectiveDate").cast("date"),
            "trading_date": F.col("item0.tradingDate").cast("date") if two_sided else nothing.cast("date"),
            "currency": "item1.currency",
            "country": "item1.country",
            "symbol": "item1.symbol",
            "code": "item1.code",
            "mid": rate("mid", not two_sided),
            "bid": rate("bid", two_sided),
            "ask": rate("ask", two_sided),
        },
        PROVENANCE,
    )


def bronze_gold(envelopes: DataFrame) -> DataFrame:
    return decode_envelopes(
        _typed(envelopes, GOLD_SOURCE),
        "body_json",
        GOLD_BODY,
        ["body"],
        {
            "effective_date": F.col("item0.data").cast("date"),
            "price_pln_per_gram": F.col("item0.cena").cast("decimal(18,2)"),
        },
        PROVENANCE,
    )


def current_quotes(bronze: DataFrame, table: str) -> DataFrame:
    """Current quotation per date and currency; contradictory input fails."""
    current = guarded_current(
        bronze.where(F.col("source_table") == table),
        source=["source_id"],
        identity=["effective_date", "code"],
        sequence="ingestion_sequence",
        measures=["mid", "bid", "ask"],
        labels=["source_table", "currency", "no", "trading_date"],
        evidence=BATCH,
        newest=NEWEST,
        zero_flag="has_zero_source_quote",
    )
    renamed = current.withColumnsRenamed({"effective_date": "effectiveDate", "trading_date": "tradingDate"})
    head = ["effectiveDate", "currency", "code", "mid", "bid", "ask", "has_zero_source_quote", "source_table", "no", "tradingDate"]
    return renamed.select(*head, *PROVENANCE)


def current_gold(bronze: DataFrame) -> DataFrame:
    current = guarded_current(
        bronze,
        source=["source_id"],
        identity=["effective_date"],
        sequence="ingestion_sequence",
        measures=["price_pln_per_gram"],
        evidence=BATCH,
        newest=NEWEST,
    )
    return current.withColumnRenamed("effective_date", "effectiveDate").select("effectiveDate", "price_pln_per_gram", *PROVENANCE)


LEGACY_RATES = "array<struct<currency: string, code: string, mid: string, bid: string, ask: string>>"


def legacy_quotes(scanned: DataFrame, table: str) -> DataFrame:
    """Quotations from files without envelopes (``effectiveDate``, rates as JSON text)."""
    measures = ["bid", "ask"] if table == "C" else ["mid"]
    flat = decode_envelopes(
        scanned,
        "rates_json",
        LEGACY_RATES,
        ["body"],
        {"currency": "item0.currency", "code": "item0.code", **{m: F.col(f"item0.{m}").cast("double") for m in measures}},
        ["effectiveDate"],
    ).withColumn("effectiveDate", F.col("effectiveDate").cast("date"))
    return guarded_dedup(flat, identity=["code", "effectiveDate"], measures=measures, labels=["currency"]).select(
        "effectiveDate", "currency", "code", *measures
    )


def legacy_gold(rows: DataFrame) -> DataFrame:
    typed = rows.select(F.col("data").cast("date").alias("effectiveDate"), F.col("cena").cast("decimal(18,2)").alias("price_pln_per_gram"))
    return guarded_dedup(typed, identity=["effectiveDate"], measures=["price_pln_per_gram"], null_is_value=False)


def quote_change_events(quotes: Mapping[str, DataFrame], gold: DataFrame) -> DataFrame:
    """Change events over all quotation tables and gold."""
    gold_rows = gold.select(
        *PROVENANCE, "effective_date", F.col("price_pln_per_gram").cast("double").alias("mid")
    )
    observed = gold_rows
    for bronze in quotes.values():
        observed = observed.unionByName(bronze, allowMissingColumns=True)
    values = ["mid", "bid", "ask"]
    metadata = ["source_table", "currency", "country", "symbol", "no", "trading_date"]
    records = fold_replays(
        observed, ["ingestion_sequence", "source_id", "effective_date", "code"], [*values, *metadata, *BATCH]
    )
    records = stored_once(records, "quote-records")  # responses and sightings both read them, and decoding is the costly part
    found = change_events(
        records,
        scope=["source_id", "effective_date"],
        member="code",
        sequence="ingestion_sequence",
        values=values,
        metadata=metadata,
        evidence=BATCH,
        from_response=["source_table"],
        contract=RECORD_CONTRACT,
        record=["source_id", "source_table", "effective_date", "code", "currency", "country", "symbol", "no", "trading_date", *values],
    )
    pairs = [x for c in (*values, *metadata) for x in (F.col(f"previous_{c}"), F.col(f"current_{c}").alias("current_source_table" if c == "source_table" else c))]
    return found.select(
        "source_id",
        F.col("current_source_table").alias("source_table"),
        "effective_date",
        "code",
        "event_type",
        "evidence_status",
        "provider_event_asserted",
        "record_contract_version",
        F.lit(DETECTION).alias("detection_method"),
        "changed_fields",
        "previous_ingestion_sequence",
        "ingestion_sequence",
        "previous_response_sha256",
        "response_sha256",
        "previous_record_sha256",
        "current_record_sha256",
        *pairs,
        "batch_id",
        "raw_file_id",
        "requested_start_date",
        "requested_end_date",
        F.col("retrieved_at_utc").alias("detected_at_utc"),
    )


def quote_rules(bronze: DataFrame, table: str) -> DataFrame:
    """Broken input rules of quotations, one row per (record, rule)."""
    def bad(name: str):
        value = F.col(name)
        return value.isNull() | ~is_finite(value) | (value < 0)

    rules = {
        "code_required": F.trim(F.coalesce("code", F.lit(""))) == "",
        "effective_date_required": F.col("effective_date").isNull(),
        "wrong_table": F.coalesce("source_table", F.lit("")) != table,
    }
    if table == "C":
        rules |= {"bid_invalid": bad("bid"), "ask_invalid": bad("ask"), "bid_above_ask": F.col("bid") > F.col("ask")}
    else:
        rules["mid_invalid"] = bad("mid")
    return rule_violations(bronze, ["source_id", "batch_id", "effective_date", "code"], rules)


def contradictory_quotes(bronze: DataFrame) -> DataFrame:
    """Quotations one response repeats with other measures, number or trading date."""
    return conflicting_keys(bronze, ["source_id", "batch_id", "effective_date", "code"], ["mid", "bid", "ask", "no", "trading_date"])


def gold_rules(bronze: DataFrame) -> DataFrame:
    """Broken input rules of gold prices, one row per (record, rule)."""
    keys = ["source_id", "batch_id", "effective_date"]
    price = F.col("price_pln_per_gram")
    single = rule_violations(
        bronze, keys, {"price_not_positive": price.isNull() | (price <= 0), "effective_date_required": F.col("effective_date").isNull()}
    )
    return single.unionByName(repeated_in_group(bronze, keys, keys, "repeated_date"))


def fact_fx_quotes(*current: DataFrame) -> DataFrame:
    stacked = current[0]
    for more in current[1:]:
        stacked = stacked.unionByName(more)
    return stacked.select(
        F.col("source_table").alias("source_table_key"),
        F.col("effectiveDate").alias("effective_date"),
        F.col("tradingDate").alias("trading_date"),
        F.col("code").alias("currency_key"),
        F.lit(QUOTE_CURRENCY).alias("quote_currency_key"),
        "mid",
        "bid",
        "ask",
        "has_zero_source_quote",
        F.col("no").alias("source_no"),
        *PROVENANCE,
    )


def fact_gold_prices(current: DataFrame) -> DataFrame:
    return current.select(
        F.col("effectiveDate").alias("effective_date"),
        F.lit(GOLD_COMMODITY).alias("commodity_key"),
        F.lit(QUOTE_CURRENCY).alias("quote_currency_key"),
        F.col("price_pln_per_gram").alias("price_pln_per_gram_1000"),
        F.col("price_pln_per_gram").alias("raw_cena"),
        *PROVENANCE,
    )


def dim_date(quotes: Mapping[str, DataFrame], gold: DataFrame) -> DataFrame:
    """Calendar over every publication date, and the trading dates of table C."""
    roles = [q.select("effectiveDate") for q in quotes.values()] + [gold.select("effectiveDate")]
    if "C" in quotes:
        roles.append(quotes["C"].select("tradingDate"))
    return date_spine(*roles)


def dim_currency(*current: DataFrame) -> DataFrame:
    branches = [q.select(F.col("code").alias("currency_key"), F.col("currency").alias("source_currency_name")) for q in current]
    return code_dimension(branches, "currency_key", "source_currency_name", mandatory=QUOTE_CURRENCY)


def dim_source_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(QUOTE_SOURCES.items()), "source_table_key string, source_id string")


def dim_commodity(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(GOLD_COMMODITY, GOLD_SOURCE, GOLD_UNIT)], "commodity_key string, source_id string, published_unit string"
    )


def mart_exchange_rates_daily(current_a: DataFrame) -> DataFrame:
    return current_a


def build(envelopes: DataFrame) -> dict[str, DataFrame]:
    """All tables of this source from its envelopes."""
    spark = envelopes.sparkSession
    bronze = {t: bronze_quotes(envelopes, t) for t in QUOTE_SOURCES}
    bronze_g = bronze_gold(envelopes)
    current = {t: current_quotes(bronze[t], t) for t in QUOTE_SOURCES}
    current_g = current_gold(bronze_g)
    return {
        **{f"br_{QUOTE_SOURCES[t]}": df for t, df in bronze.items()},
        f"br_{GOLD_SOURCE}": bronze_g,
        **{QUOTE_SOURCES[t]: df for t, df in current.items()},
        GOLD_SOURCE: current_g,
        "nbp_change_events": quote_change_events(bronze, bronze_g),
        "fact_fx_quotes": fact_fx_quotes(*current.values()),
        "fact_gold_prices": fact_gold_prices(current_g),
        "dim_date": dim_date(current, current_g),
        "dim_currency": dim_currency(*current.values()),
        "dim_source_table": dim_source_table(spark),
        "dim_commodity": dim_commodity(spark),
        "mart_exchange_rates_daily": mart_exchange_rates_daily(current["A"]),
    }
