"""Annual development indicators: wide CSV members, cleaned dimensions, coverage."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from siltstone.functions.text import clean_text, decimal_number, ratio
from siltstone.operators.coverage import one_row, side_by_side
from siltstone.operators.decode import explode_rows
from siltstone.operators.dimensions import attach_evidence
from siltstone.operators.keyed import first_per_key
from siltstone.operators.quality import page_checks, repeated_in_group, rule_violations, value_reconciliation
from siltstone.operators.reshape import unpivot_years

# Headings of the archive members and the columns they become.
DATA_IDS = {
    "Country Name": "country_name",
    "Country Code": "country_code",
    "Indicator Name": "indicator_name",
    "Indicator Code": "indicator_code",
}
COUNTRY = {
    "Country Code": "country_code",
    "Short Name": "short_name",
    "Table Name": "table_name",
    "Long Name": "long_name",
    "2-alpha code": "iso2_code",
    "Currency Unit": "currency_unit",
    "Region": "region_name",
    "Income Group": "income_group",
    "Lending category": "lending_category",
    "Special Notes": "special_notes",
}
SERIES = {
    "Series Code": "indicator_code",
    "Indicator Name": "indicator_name",
    "Topic": "topic",
    "Short definition": "short_definition",
    "Long definition": "long_definition",
    "Unit of measure": "unit_of_measure",
    "Periodicity": "periodicity",
    "Aggregation method": "aggregation_method",
    "Source": "source_organization",
    "License Type": "license_type",
    "Limitations and exceptions": "limitations_and_exceptions",
}
AGGREGATES_REGION = "Aggregates"


def bronze_data(wide: DataFrame) -> DataFrame:
    """Annual values as rows; blank cells give none."""
    long = unpivot_years(wide, list(DATA_IDS))
    return long.select(*[F.trim(F.col(f"`{k}`")).alias(v) for k, v in DATA_IDS.items()], "observation_year", "observation_value_text")


def _catalogue(rows: DataFrame, headings: Mapping[str, str]) -> DataFrame:
    """Cleaned columns, one row per key (the first heading); ties go to the smallest values."""
    cleaned = rows.select(*[clean_text(F.col(f"`{k}`")).alias(v) for k, v in headings.items()])
    key, *others = headings.values()
    return first_per_key(cleaned.where(F.col(key).isNotNull()), [key], [F.asc_nulls_last(c) for c in others])


def stg_countries(rows: DataFrame) -> DataFrame:
    return _catalogue(rows, COUNTRY)


def stg_indicators(rows: DataFrame) -> DataFrame:
    return _catalogue(rows, SERIES)


def stg_observations(data: DataFrame, evidence: DataFrame) -> DataFrame:
    """Typed values with the identity of the archive on every row."""
    typed = data.select(
        "country_code",
        "indicator_code",
        "observation_year",
        F.make_date("observation_year", F.lit(1), F.lit(1)).alias("observation_date"),
        "observation_value_text",
        decimal_number("observation_value_text").alias("observation_value"),
    )
    return attach_evidence(
        typed,
        evidence,
        {"archive_sha256": "raw_sha256", "archive_retrieved_at_utc": F.col("retrieved_at_utc").cast("timestamp")},
    )


def dim_geography(countries: DataFrame) -> DataFrame:
    aggregate = F.col("region_name") == AGGREGATES_REGION
    return countries.select(
        F.col("country_code").alias("geography_key"),
        "country_code",
        "iso2_code",
        F.coalesce("short_name", "table_name", "long_name", "country_code").alias("geography_name"),
        "long_name",
        "region_name",
        "income_group",
        "lending_category",
        "currency_unit",
        "special_notes",
        F.when(aggregate, F.lit("source_published_aggregate")).otherwise(F.lit("country_or_territory")).alias("geography_type"),
    )


def dim_indicator(indicators: DataFrame) -> DataFrame:
    return indicators.select(F.col("indicator_code").alias("indicator_key"), *indicators.columns)


def dim_year(observations: DataFrame) -> DataFrame:
    years = observations.select("observation_year").distinct()
    return years.select(
        F.col("observation_year").alias("year_key"),
        "observation_year",
        F.make_date("observation_year", F.lit(1), F.lit(1)).alias("year_start_date"),
    )


def fact_observations(observations: DataFrame) -> DataFrame:
    return observations.withColumnsRenamed(
        {"country_code": "geography_key", "indicator_code": "indicator_key", "observation_year": "year_key"}
    )


def mart_coverage(evidence: DataFrame, countries: DataFrame, series: DataFrame, data: DataFrame, fact: DataFrame) -> DataFrame:
    """One snapshot row: archive evidence, source totals, modeled totals."""
    archive = evidence.select(
        F.col("retrieved_at_utc").cast("date").alias("snapshot_date"),
        F.col("retrieved_at_utc").cast("timestamp").alias("latest_retrieved_at_utc"),
        F.col("current_distribution_total").cast("bigint").alias("current_archive_total"),
        F.col("member_total").cast("bigint").alias("archive_member_total"),
    )
    rows = F.count(F.lit(1))
    totals = side_by_side(
        archive,
        one_row(countries, source_geography_total=rows),
        one_row(series, source_indicator_total=rows),
        one_row(data, source_value_total=rows),
        one_row(
            fact,
            modeled_geography_total=F.count_distinct("geography_key"),
            modeled_indicator_total=F.count_distinct("indicator_key"),
            modeled_observation_total=rows,
            first_observation_date=F.min("observation_date"),
            latest_observation_date=F.max("observation_date"),
        ),
    )
    return totals.withColumn("modeled_value_coverage_ratio", ratio("modeled_observation_total", "source_value_total"))


# --- retained API responses against the bulk archive -------------------------------------

# The API's source number for these indicators, and its region of aggregates.
API_SOURCE, API_AGGREGATE_REGION = "2", "NA"
API_ROW = (
    "array<struct<indicator: struct<id: string>, country: struct<id: string>, countryiso3code: string, date: string, "
    "value: string, unit: string, obs_status: string, `decimal`: string>>"
)
API_INDICATOR = "array<struct<id: string, name: string, source: struct<id: string>>>"
API_COUNTRY = "array<struct<id: string, name: string, region: struct<id: string>>>"


def api_pages(responses: DataFrame) -> DataFrame:
    """Paging numbers of every response (``raw_sha256``, ``body``), with their fault if any."""
    numbers = ["page", "pages", "per_page", "total"]
    head = F.from_json(F.get_json_object("body", "$[0]"), ", ".join(f"{n} string" for n in numbers))
    rows = F.coalesce(F.json_array_length(F.get_json_object("body", "$[1]")), F.lit(0))
    parsed = responses.select("raw_sha256", head.alias("head"), rows.alias("rows"))
    pages = parsed.select("raw_sha256", *[F.col(f"head.{n}").try_cast("int").alias(n) for n in numbers], "rows")
    return page_checks(pages, "page", "pages", "per_page", "total", "rows")


def _api_rows(responses: DataFrame, schema: str) -> DataFrame:
    parsed = responses.select("raw_sha256", F.from_json(F.get_json_object("body", "$[1]"), schema, {"mode": "FAILFAST"}).alias("rows"))
    return explode_rows(parsed, "rows", "row")


def api_observations(responses: DataFrame) -> DataFrame:
    """Observations of retained API responses, values as the text of the response."""
    return _api_rows(responses, API_ROW).select(
        "raw_sha256",
        F.col("row.countryiso3code").alias("country_iso3code"),
        F.col("row.countryiso3code").alias("country_code"),
        F.col("row.country.id").alias("country_id"),
        F.col("row.indicator.id").alias("indicator_code"),
        F.col("row.date").alias("period"),
        F.col("row.date").try_cast("int").alias("observation_year"),
        F.col("row.value").alias("api_value"),
        F.col("row.decimal").alias("decimals"),
    )


def api_observation_rules(rows: DataFrame, start_year: int = 0, end_year: int = 9999) -> DataFrame:
    """Broken input rules of API observations, one row per (record, rule)."""
    def blank(name: str):
        return F.coalesce(name, F.lit("")) == ""

    return rule_violations(
        rows,
        ["raw_sha256", "country_id", "indicator_code", "period"],
        {
            "source_keys_invalid": blank("country_id") | blank("indicator_code"),
            "period_not_a_year": ~F.coalesce(F.col("period").rlike("^[0-9]+$"), F.lit(False)),
            "period_out_of_range": ~F.col("observation_year").between(start_year, end_year),
            "value_not_numeric": F.col("api_value").isNotNull() & decimal_number("api_value").isNull(),
            "decimal_not_integer": F.col("decimals").isNotNull() & F.col("decimals").try_cast("int").isNull(),
        },
    )


def api_catalogue_rules(indicators: DataFrame, countries: DataFrame) -> DataFrame:
    """Broken rules of indicator and country responses, one row per (record, rule)."""
    wanted = _api_rows(indicators, API_INDICATOR).select("raw_sha256", F.lit("indicator").alias("kind"), F.col("row.id").alias("id"), F.col("row.name").alias("name"), F.col("row.source.id").alias("parent"))
    places = _api_rows(countries, API_COUNTRY).select("raw_sha256", F.lit("country").alias("kind"), F.col("row.id").alias("id"), F.col("row.name").alias("name"), F.col("row.region.id").alias("parent"))
    rows = wanted.unionByName(places)
    keys = ["raw_sha256", "kind", "id"]
    single = rule_violations(
        rows,
        keys,
        {
            "id_required": F.coalesce("id", F.lit("")) == "",
            "name_required": F.col("name").isNull(),
            "foreign_source": (F.col("kind") == "indicator") & ~F.coalesce(F.col("parent") == API_SOURCE, F.lit(False)),
            "region_required": (F.col("kind") == "country") & F.col("parent").isNull(),
        },
    )
    return single.unionByName(repeated_in_group(rows, keys, keys, "repeated_id"))


def api_country_kinds(countries: DataFrame) -> DataFrame:
    """Economies and aggregates among the country entities."""
    region = F.col("row.region.id")
    return _api_rows(countries, API_COUNTRY).agg(
        F.count_if(region != API_AGGREGATE_REGION).alias("economies"), F.count_if(region == API_AGGREGATE_REGION).alias("aggregates")
    )


def api_against_bulk(rows: DataFrame, data: DataFrame) -> DataFrame:
    """Outcome of every API value against the bulk values."""
    keys = ["country_code", "indicator_code", "observation_year"]
    asked = rows.select("raw_sha256", "country_iso3code", *keys, "api_value")
    return value_reconciliation(asked, data, keys, "api_value", "observation_value_text", required="country_iso3code")


def build(members: Mapping[str, DataFrame], evidence: DataFrame) -> dict[str, DataFrame]:
    """All tables of this source; ``members`` holds the CSV members ``data``, ``country``, ``series`` and others."""
    data = bronze_data(members["data"])
    countries, indicators = stg_countries(members["country"]), stg_indicators(members["series"])
    observations = stg_observations(data, evidence)
    fact = fact_observations(observations)
    return {
        **{f"br_wdi_{name}": df for name, df in members.items() if name != "data"},
        "br_wdi_data": data,
        "wdi_countries": countries,
        "wdi_indicators": indicators,
        "wdi_observations": observations,
        "dim_wdi_geography": dim_geography(countries),
        "dim_wdi_indicator": dim_indicator(indicators),
        "dim_wdi_year": dim_year(observations),
        "fact_wdi_observations": fact,
        "mart_wdi_coverage": mart_coverage(evidence, members["country"], members["series"], data, fact),
    }
