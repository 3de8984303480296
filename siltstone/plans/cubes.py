"""Dimensional statistics: JSON cubes, full TSV distributions, run ledger, coverage."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siltstone.functions.records import field
from siltstone.functions.text import ratio
from siltstone.operators.coverage import one_row, side_by_side, text_member_count
from siltstone.operators.decode import decode_cube
from siltstone.operators.dimensions import fact_with_dimensions, period_dimension, rollup_dimension
from siltstone.operators.ledger import revision_runs
from siltstone.operators.quality import duplicate_keys
from siltstone.sources.readers import read_wide_tsv

# The datasets and series admitted for response-level tracking.
ADMITTED_DATASETS, ADMITTED_SERIES = 3, 81
COMPLETE = "complete_current_catalogue"


def bronze_observations(envelopes: DataFrame) -> DataFrame:
    """Every cube cell, missing ones included, with its complete dimension key."""
    kept = ["dataset_id", "envelope_geo", "retrieved_at_utc", "response_sha256", "task_id", "lane"]
    rows = envelopes.where("source_id = 'eurostat' and task_kind = 'jsonstat'").select(
        field("metadata_json", "$.dataset").alias("dataset_id"),
        field("metadata_json", "$.geo").alias("envelope_geo"),
        "retrieved_at_utc",
        F.col("raw_sha256").alias("response_sha256"),
        "task_id",
        "lane",
        "payload_utf8",
    )
    cells = decode_cube(rows, "payload_utf8", kept)

    def code(name: str) -> Column:
        return F.try_element_at("dimensions", F.lit(name))

    inside = (code("geo") == F.col("envelope_geo")) & code("time").isNotNull() & F.col("dataset_id").isNotNull()
    cells = cells.where(F.assert_true(F.coalesce(inside, F.lit(False)), "cell outside its accepted key").isNull())
    return cells.select(
        "dataset_id",
        F.coalesce("label", "dataset_id").alias("dataset_label"),
        F.col("envelope_geo").alias("geo_code"),
        code("freq").alias("freq_code"),
        code("unit").alias("unit_code"),
        code("time").alias("period_key"),
        "dimension_key_json",
        "dimension_key_sha256",
        "value_json",
        "value_numeric",
        "status_code",
        "is_missing",
        F.col("updated").try_cast("timestamp").alias("source_updated_at"),
        "retrieved_at_utc",
        "response_sha256",
        "task_id",
        "lane",
    )


# Columns that identify a distribution, in output order around the cells.
IDENTITY = ["dataset_id", "distribution_id", "partition_id", "partition_selection_json"]
RECEIPT = ["source_version", "retrieved_at_utc", "raw_sha256", "raw_file_id", "receipt_sha256", "receipt_file_id", "receipt_size_bytes"]


def bulk_cells(spark: SparkSession, paths: list[str], identity: Mapping[str, object]) -> DataFrame:
    """Cells of a full distribution with the identity of its receipt on every row."""
    cells = read_wide_tsv(spark, paths)

    def fixed(names: list[str]) -> list[Column]:
        return [F.lit(identity.get(n)).alias(n) for n in names]

    def code(name: str) -> Column:
        return F.try_element_at("dimensions", F.lit(name))

    return cells.select(
        *fixed(IDENTITY),
        "period_key",
        code("freq").alias("freq_code"),
        code("unit").alias("unit_code"),
        code("geo").alias("geo_code"),
        "dimension_key_json",
        "dimension_key_sha256",
        "value_text",
        "value_numeric",
        "status_code",
        "is_missing",
        "missing_reason",
        *fixed(RECEIPT),
        "source_row_number",
        "source_period_position",
    )


def repeated_cells(cells: DataFrame) -> DataFrame:
    """Complete keys that occur twice.

    All series of a distribution share its periods, so a repeated key shows at the first
    period already; looking only there cuts the shuffle by the number of periods.
    """
    return duplicate_keys(cells, ["dimension_key_sha256"], F.col("source_period_position") == 1)


STATE = ["value_json", "status_code", "is_missing", "source_updated_at"]


def observation_revisions(observations: DataFrame, chunk: Column | str | None = None) -> DataFrame:
    """Runs of equal consecutive states of every cell.

    Observations are scanned in chunks of one retrieval day unless another ``chunk`` is given,
    so a cell with very many responses is spread over tasks.
    """
    chunk = F.col("retrieved_at_utc").cast("date") if chunk is None else chunk
    return revision_runs(
        observations,
        keys=["dataset_id", "dimension_key_sha256"],
        order=["retrieved_at_utc", "response_sha256", "task_id"],
        state=STATE,
        payload=["dataset_label", "geo_code", "freq_code", "unit_code", "period_key", "dimension_key_json", "value_numeric"],
        seen_at="retrieved_at_utc",
        evidence={"response_sha256": "response_sha256", "task_id": "task_id"},
        events=[
            ("observed_value_changed", "value_json"),
            ("observed_status_changed", "status_code"),
            ("observed_missing_state_changed", "is_missing"),
        ],
        chunk=chunk,
    ).drop("previous_source_updated_at")


def current_observations(revisions: DataFrame) -> DataFrame:
    return revisions.where("is_current").select(
        "dataset_id",
        "dataset_label",
        "geo_code",
        "freq_code",
        "unit_code",
        "period_key",
        "dimension_key_json",
        "dimension_key_sha256",
        "value_json",
        "value_numeric",
        "status_code",
        "is_missing",
        "revision_number",
        "revision_count",
        "replayed_response_count",
        F.col("revision_event_type").alias("current_revision_event_type"),
        "source_updated_at",
        "first_seen_at_utc",
        "last_seen_at_utc",
        F.col("last_response_sha256").alias("response_sha256"),
        F.col("last_task_id").alias("task_id"),
    )


PERIOD_BOUNDS = {"first_period_key": ("min", "period_key"), "last_period_key": ("max", "period_key")}


def dim_dataset(observations: DataFrame) -> DataFrame:
    return rollup_dimension(
        observations,
        "dataset_id",
        label="dataset_label",
        newest="last_seen_at_utc",
        distinct={"modeled_geography_count": "geo_code"},
        counts={"modeled_cell_count": None, "modeled_value_count": ~F.col("is_missing")},
        bounds={**PERIOD_BOUNDS, "source_updated_at": ("max", "source_updated_at"), "last_seen_at_utc": ("max", "last_seen_at_utc")},
    ).withColumnRenamed("dataset_id", "dataset_key")


def dim_geography(observations: DataFrame) -> DataFrame:
    return rollup_dimension(
        observations,
        "geo_code",
        distinct={"modeled_dataset_count": "dataset_id"},
        counts={"modeled_cell_count": None},
        bounds=PERIOD_BOUNDS,
    ).withColumnRenamed("geo_code", "geography_key")


def dim_period(observations: DataFrame) -> DataFrame:
    """Years and ``YYYY-MM`` months; other spellings stay ``other``."""
    spelled_months = observations.where("period_key is not null")
    periods = period_dimension(spelled_months, "period_key", also=["freq_code"], granularities=("year", "month"))
    month_name = F.col("period_key").rlike("^[0-9]{4}-M")
    blank = F.lit(None).cast("date")
    return periods.select(
        "period_key",
        "freq_code",
        F.when(month_name, F.lit("other")).otherwise(F.col("period_granularity")).alias("period_granularity"),
        *[F.when(month_name, blank).otherwise(F.col(c)).alias(c) for c in ("period_start_date", "period_end_date")],
    )


def fact_observations(observations: DataFrame, periods: DataFrame) -> DataFrame:
    joined = fact_with_dimensions(
        observations,
        [
            (
                periods,
                {"period_key": "period_key", "freq_code": "freq_code"},
                ["period_start_date", "period_end_date", "period_granularity"],
            )
        ],
    )
    return joined.drop("dataset_label", "revision_number").withColumnsRenamed({"dataset_id": "dataset_key", "geo_code": "geography_key"})


def mart_coverage(fact: DataFrame, full_source: DataFrame) -> DataFrame:
    """One snapshot row over the modeled cells and the full-source campaign."""
    modeled = one_row(
        fact,
        latest_retrieved_at_utc=F.max("last_seen_at_utc"),
        snapshot_date=F.max("last_seen_at_utc").cast("date"),
        latest_observation_date=F.max("period_end_date"),
        modeled_response_total=F.count_distinct("response_sha256"),
        modeled_dataset_total=F.count_distinct("dataset_key"),
        modeled_series_total=text_member_count("dataset_key", "geography_key"),
        modeled_cell_total=F.count(F.lit(1)),
        modeled_value_total=F.count_if(~F.col("is_missing")),
    )
    campaign = full_source.select(
        "catalogue_distributions",
        "validated_current_distributions",
        F.col("pending_tasks").alias("pending_distribution_tasks"),
        F.col("failed_pending_tasks").alias("failed_pending_distribution_tasks"),
        "accepted_distributions",
        "received_raw_bytes",
        "inventories_current",
        F.col("catalogue_checked_on").cast("date").alias("catalogue_checked_on"),
        (F.col("coverage_status") == COMPLETE).alias("raw_catalogue_complete"),
    )
    datasets, series = F.lit(ADMITTED_DATASETS).cast("long"), F.lit(ADMITTED_SERIES).cast("long")
    return side_by_side(modeled, campaign).select(
        "*",
        datasets.alias("admitted_dataset_total"),
        series.alias("admitted_series_total"),
        ratio("modeled_dataset_total", datasets).alias("admitted_dataset_coverage_ratio"),
        ratio("modeled_series_total", series).alias("admitted_series_coverage_ratio"),
        ratio("validated_current_distributions", "catalogue_distributions").alias("full_distribution_coverage_ratio"),
        F.lit(False).alias("complete_official_catalogue"),
    )


def build(envelopes: DataFrame, full_source: DataFrame, chunk: Column | str | None = None) -> dict[str, DataFrame]:
    """All tables of this source from its cube envelopes."""
    bronze = bronze_observations(envelopes)
    revisions = observation_revisions(bronze, chunk)
    observations = current_observations(revisions)
    periods = dim_period(observations)
    fact = fact_observations(observations, periods)
    return {
        "br_eurostat_observations": bronze,
        "eurostat_observation_revisions": revisions,
        "eurostat_observations": observations,
        "dim_eurostat_dataset": dim_dataset(observations),
        "dim_eurostat_geography": dim_geography(observations),
        "dim_eurostat_period": periods,
        "fact_eurostat_observations": fact,
        "mart_eurostat_coverage": mart_coverage(fact, full_source),
    }
