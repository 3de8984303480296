"""Statistical archives: CSV exports with varying dimension columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siltstone.functions.records import surrogate_key
from siltstone.operators.dimensions import fact_with_dimensions
from siltstone.operators.keyed import first_per_key
from siltstone.sources.readers import fold_extra_columns, read_union_by_name

# Fixed value: page the subgroups are published on.
SUBGROUP_URL = "https://bdl.stat.gov.pl/bdl/dane/podgrup/tablica"


def _now(as_of: datetime | None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of)


def bronze_web_observations(
    spark: SparkSession, paths: list[str], subgroup_id: str, selection_id: str = "", raw_archive_file: str = "", as_of: datetime | None = None
) -> DataFrame:
    """Observations of one archive's CSV files."""
    rows = read_union_by_name(spark, paths)
    folded = fold_extra_columns(rows, {"subgroup_id": F.lit(subgroup_id), "selection_id": F.lit(selection_id)})
    return folded.withColumns({"raw_archive_file": F.lit(raw_archive_file), "processed_at_utc": _now(as_of)})


IDENTITY = ["subgroup_id", "unit_id", "period_raw", "dimensions_json"]


def stg_web_observations(bronze: DataFrame) -> DataFrame:
    """Newest row per observation; equally new rows are told apart by archive and value."""
    attribute = F.coalesce("attr_name", F.lit(""))
    newest = first_per_key(
        bronze,
        [*IDENTITY, attribute],
        [F.desc_nulls_last("processed_at_utc"), F.desc_nulls_last("raw_archive_file"), F.desc_nulls_last("val_raw")],
    )
    key = surrogate_key([*IDENTITY, attribute]).alias("observation_key")
    return newest.select(key, *[F.col(c).alias("period_key") if c == "period_raw" else F.col(c) for c in bronze.columns])


def dim_subgroup(staged: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return staged.select("subgroup_id").distinct().select(
        F.col("subgroup_id").alias("subgroup_key"), "subgroup_id", F.lit(SUBGROUP_URL).alias("source_url"), _now(as_of).alias("modeled_at_utc")
    )


def fact_web_observations(staged: DataFrame, periods: DataFrame) -> DataFrame:
    joined = fact_with_dimensions(
        staged, [(periods, {"period_key": "period_key"}, ["period_start_date", "period_end_date", "period_granularity"])]
    )
    return joined.drop("selection_id").withColumnsRenamed({"subgroup_id": "subgroup_key", "unit_id": "unit_key"})
