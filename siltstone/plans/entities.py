"""Open business data: organizations, locations and people from JSONL feature records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltstone.operators.coverage import column_coverage
from siltstone.operators.decode import flatten_features
from siltstone.sources.readers import read_jsonl_lines

# The columns of each table; the feature key is the name in capitals.
ADDRESS = ["addr_line1", "addr_city", "addr_state", "addr_postal_code", "addr_country"]
PLACE = ["geo_latitude", "geo_longitude", "placekey", "bq_id"]
TABLES = {
    "organizations": ["name_org", "name_type", "record_type", *ADDRESS, "addr_type", *PLACE, "rel_anchor_domain", "rel_anchor_key"],
    "locations": ["name_full", "record_type", *ADDRESS, *PLACE],
    "people": [
        "name_full",
        "name_first",
        "name_last",
        "record_type",
        "addr_country",
        "group_assn_id_number",
        "group_assn_id_type",
        "rel_pointer_domain",
        "rel_pointer_key",
        "rel_pointer_role",
        "linkedin",
    ],
}
NUMBERS = ("geo_latitude", "geo_longitude")


def bronze(lines: DataFrame, table: str) -> DataFrame:
    """One row per JSONL line: record identity and the first known value of each feature."""
    member = lambda name: F.try_element_at("record", F.lit(name))
    records = lines.select(F.from_json("line", "map<string,string>").alias("record"))
    parsed = records.select(
        member("RECORD_ID").alias("record_id"),
        member("DATA_SOURCE").alias("data_source"),
        F.coalesce(member("BQ_DATASET"), member("bq_dataset")).alias("bq_dataset"),
        F.from_json(member("FEATURES"), "array<map<string,string>>").alias("features"),
    )
    columns = {c: f"{'double' if c in NUMBERS else 'string'} {c.upper()}" for c in TABLES[table]}
    return flatten_features(parsed, "features", columns, ["record_id", "data_source", "bq_dataset"])


def read(spark: SparkSession, path: str, table: str) -> DataFrame:
    return bronze(read_jsonl_lines(spark, path), table)


def identifier_coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    return column_coverage(df, columns)
