"""Taxpayer account list: one flat file with a header, account masks and two hash lists."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siltstone.functions.text import code_label, whole_number
from siltstone.operators.decode import HASH_PATTERN, bank_prefix
from siltstone.sources.readers import read_sectioned_lines

# Section names of the file and the status they stand for.
HEADER, MASKS = "naglowek", "maski"
STATUS = {"skrotyPodatnikowCzynnych": "active", "skrotyPodatnikowZwolnionych": "exempt"}
HEADER_FIELDS = {"generation_date": "dataGenerowaniaDanych", "transformation_count": "liczbaTransformacji", "schema_description": "schemat"}
DEFAULT_TRANSFORMATIONS = 5000


def _stamps(snapshot_date: str, as_of: datetime | None) -> list[Column]:
    stamp = F.current_timestamp() if as_of is None else F.lit(as_of)
    return [F.lit(snapshot_date).cast("date").alias("snapshot_date"), stamp.alias("processed_at_utc")]


def sections(spark: SparkSession, path: str) -> DataFrame:
    return read_sectioned_lines(spark, path)


def bronze_taxpayers(lines: DataFrame, snapshot_date: str, as_of: datetime | None = None) -> DataFrame:
    """Hashes of both lists with their status; anything else in them is ignored."""
    found = lines.where(F.col("section").isin(list(STATUS))).select(
        F.regexp_extract("value", '"([^"]*)"', 1).alias("hash"), code_label("section", STATUS).alias("status")
    )
    return found.where(F.col("hash").rlike(HASH_PATTERN)).select("*", *_stamps(snapshot_date, as_of))


def bronze_masks(lines: DataFrame, snapshot_date: str, as_of: datetime | None = None) -> DataFrame:
    found = lines.where(F.col("section") == MASKS).select(F.regexp_extract("value", '"([^"]+)"', 1).alias("account_mask"))
    return found.where("account_mask <> ''").select(
        "account_mask", bank_prefix("account_mask").alias("bank_prefix"), *_stamps(snapshot_date, as_of)
    )


def bronze_header(lines: DataFrame, snapshot_date: str, as_of: datetime | None = None) -> DataFrame:
    """The header as one row."""
    key = F.regexp_extract("value", r'^\s*"([^"]+)"\s*:', 1)
    value = F.regexp_extract("value", r':\s*"?([^",]*)"?', 1)
    members = lines.where(F.col("section") == HEADER).select(key.alias("k"), value.alias("v"))
    picked = {out: F.max(F.when(F.col("k") == name, F.col("v"))) for out, name in HEADER_FIELDS.items()}
    row = members.agg(*[c.alias(n) for n, c in picked.items()])
    count = F.coalesce(whole_number("transformation_count"), F.lit(DEFAULT_TRANSFORMATIONS))
    day = F.date_format(F.lit(snapshot_date).cast("date"), "yyyyMMdd")
    return row.select(
        *_stamps(snapshot_date, as_of),
        F.coalesce("generation_date", day).alias("generation_date"),
        count.alias("transformation_count"),
        F.coalesce("schema_description", F.lit("")).alias("schema_description"),
    )


def dim_taxpayer_account(taxpayers: DataFrame) -> DataFrame:
    return taxpayers.withColumnRenamed("status", "taxpayer_status")
