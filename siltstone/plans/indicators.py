"""Statistical indicators from a paged API: catalogues, observations, revisions, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.functions.records import field, iso_timestamp
from siltstone.functions.text import concat_skip_null, joined_label, ratio
from siltstone.operators.coverage import one_row, side_by_side
from siltstone.operators.decode import decode_catalogue_detail, decode_json_items, step_into
from siltstone.operators.dimensions import (
    attribute_pivot,
    bilingual_current,
    fact_with_dimensions,
    inferred_members,
    label_join,
    period_dimension,
)
from siltstone.operators.keyed import latest_per_key
from siltstone.operators.ledger import revision_ledger
from siltstone.operators.quality import repeated_in_group, rule_violations

# The source id and the task kinds of its responses.
SOURCE = "gus_bdl"
KINDS = {
    "subjects": (["subjects"], ["subject_detail"]),
    "variables": (["variables"], ["variable_detail"]),
    "units": (["units", "localities"], ["unit_detail", "locality_detail"]),
}

# Where each column of a catalogue record is found.
FIELDS = {
    "subjects": {
        "subject_id": "string $.id",
        "parent_subject_id": "string $.parentId",
        "subject_name": "string $.name",
        "has_variables": "boolean $.hasVariables",
        "child_subject_ids_json": "string $.children",
        "subject_levels_json": "string $.levels",
        "description": "string $.description",
        "years_json": "string $.years",
        "availability_json": "string $.availability",
        "dimensions_json": "string $.dimensions",
        "last_update_at": "timestamp $.lastUpdate",
    },
    "variables": {
        "variable_id": "bigint $.id",
        "subject_id": "string $.subjectId",
        **{f"name_component_{i}": f"string $.n{i}" for i in range(1, 6)},
        "level": "int $.level",
        "measure_unit_id": "int $.measureUnitId",
        "measure_unit_name": "string $.measureUnitName",
        "description": "string $.description",
        "years_json": "string $.years",
    },
    "units": {
        "unit_id": "string $.id",
        "parent_unit_id": "string $.parentId",
        "unit_name": "string $.name",
        "level": "int $.level",
        "kind": "string $.kind",
        "has_description": "boolean $.hasDescription",
        "description": "string $.description",
        "years_json": "string $.years",
        "availability_json": "string $.availability",
        "last_update_at": "timestamp $.lastUpdate",
    },
}
PAGE = {
    "source_universe_total": "bigint $.totalRecords",
    "response_page": "int $.page",
    "response_page_size": "int $.pageSize",
}
NEWEST = ["retrieved_at_utc", "response_sha256"]


def _responses(envelopes: DataFrame) -> DataFrame:
    return envelopes.where(F.col("source_id") == SOURCE).select(
        "source_id",
        "task_id",
        "task_kind",
        field("request_json", "$.params.lang").alias("lang"),
        field("request_json", "$.params.page", "int").alias("requested_page"),
        "retrieved_at_utc",
        F.col("raw_sha256").alias("response_sha256"),
        "raw_size_bytes",
        "payload_utf8",
    )


def bronze_catalogue(envelopes: DataFrame, what: str) -> DataFrame:
    """Catalogue pages and detail responses of subjects, variables or units."""
    pages, details = KINDS[what]
    responses = _responses(envelopes)
    keep: list[str | Column] = ["source_id", "task_id", "lang", "retrieved_at_utc", "response_sha256", "raw_size_bytes"]
    if what == "units":
        locality = F.col("task_kind").isin("localities", "locality_detail")
        responses = responses.withColumn("resource_kind", F.when(locality, F.lit("locality")).otherwise(F.lit("unit")))
        keep.insert(2, "resource_kind")
    return decode_catalogue_detail(
        responses,
        "payload_utf8",
        is_catalogue=F.col("task_kind").isin(pages),
        is_detail=F.col("task_kind").isin(details),
        items="$.results",
        page_fields=PAGE,
        fields=FIELDS[what],
        keep=keep,
    )


def bronze_dictionary_entries(envelopes: DataFrame) -> DataFrame:
    pages = _responses(envelopes).where("task_kind = 'dictionary'").select(
        "*",
        F.regexp_extract("task_id", "^discovery:dictionary:([^:]+):", 1).alias("dictionary_resource"),
        field("payload_utf8", "$.totalRecords", "bigint").alias("source_universe_total"),
    )
    keep = ["source_id", "task_id", "dictionary_resource", "lang", "retrieved_at_utc", "response_sha256", "raw_size_bytes", "source_universe_total"]
    names = {"_id": "$.id", "_code": "$.code", "_name": "$.name", "_label": "$.label", "_nazwa": "$.nazwa", "_value": "$.value"}
    items = decode_json_items(pages, "payload_utf8", "$.results", {k: f"string {p}" for k, p in names.items()}, keep, "source_record_json")
    return items.select(
        *keep,
        F.coalesce("_id", "_code").alias("entry_id"),
        F.coalesce("_name", "_label", "_nazwa", "_value").alias("entry_name"),
        "source_record_json",
    )


def bronze_years(envelopes: DataFrame) -> DataFrame:
    pages = _responses(envelopes).where("task_kind = 'years'").withColumn(
        "source_universe_total", field("payload_utf8", "$.totalRecords", "bigint")
    )
    keep = ["source_id", "task_id", "retrieved_at_utc", "response_sha256", "raw_size_bytes", "source_universe_total"]
    return decode_json_items(pages, "payload_utf8", "$.results", {"year_id": "int $.id"}, keep, "source_record_json")


OBSERVATION_BODY = (
    "totalRecords bigint, variableId bigint, measureUnitId int, aggregateId int, lastUpdate string, "
    "results array<struct<id: string, name: string, values: array<string>>>"
)


def bronze_observations(envelopes: DataFrame) -> DataFrame:
    """One row per reported value; the exact text of the value object is kept."""
    keep = ["source_id", "task_id", "retrieved_at_utc", "response_sha256", "raw_size_bytes", "requested_page"]
    bodies = _responses(envelopes).where("task_kind = 'data_by_variable'").select(
        *keep, F.from_json("payload_utf8", OBSERVATION_BODY, {"mode": "FAILFAST"}).alias("b")
    )
    values = step_into(step_into(bodies, "b.results", "u"), "u.values", "source_record_json").select(
        *keep,
        F.col("b.totalRecords").alias("source_universe_total"),
        F.col("b.variableId").alias("variable_id"),
        F.col("b.measureUnitId").alias("measure_unit_id"),
        F.col("b.aggregateId").alias("aggregate_id"),
        F.col("b.lastUpdate").try_cast("timestamp").alias("source_last_update_at"),
        F.col("u.id").alias("unit_id"),
        F.col("u.name").alias("unit_name"),
        "source_record_json",
    )
    return values.select(
        *[c for c in values.columns if c != "source_record_json"],
        field("source_record_json", "$.year").alias("period_key"),
        F.coalesce(field("source_record_json", "$.val"), field("source_record_json", "$.value")).try_cast("double").alias("value_numeric"),
        field("source_record_json", "$.valueFormatted").alias("value_formatted"),
        field("source_record_json", "$.precision", "int").alias("precision"),
        field("source_record_json", "$.attrId", "int").alias("attr_id"),
        "source_record_json",
    )


OBSERVATION_KEY = ["variable_id", "unit_id", "period_key", "attr_id"]


def observation_rules(observations: DataFrame) -> DataFrame:
    """Broken input rules of observations, one row per (record, rule)."""
    def negative(name: str) -> Column:
        return F.col(name) < 0

    has_val = field("source_record_json", "$.val").isNotNull()
    has_value = field("source_record_json", "$.value").isNotNull()
    keys = ["task_id", "variable_id", "unit_id", "period_key", "attr_id"]
    page = ["task_id", "response_sha256"]
    repeated = repeated_in_group(observations, [*page, *OBSERVATION_KEY], keys, "repeated_observation_grain")
    single = rule_violations(
        observations,
        keys,
        {
            "unit_id_not_12_digits": ~F.coalesce(F.col("unit_id").rlike("^[0-9]{12}$"), F.lit(False)),
            "period_required": F.coalesce("period_key", F.lit("")) == "",
            "value_not_numeric": F.col("value_numeric").isNull(),
            "one_of_val_or_value": has_val == has_value,
            "negative_attribute": negative("attr_id"),
            "negative_precision": negative("precision"),
            "negative_measure_unit": negative("measure_unit_id"),
            "negative_aggregate": negative("aggregate_id"),
        },
    )
    return single.unionByName(repeated)


def observation_revisions(observations: DataFrame, chunk: Column | str | None = None) -> DataFrame:
    """Distinct versions of every observation.

    Versions are scanned in chunks of one first-seen day unless another ``chunk`` is given.
    """
    chunk = F.col("first_seen_at_utc").cast("date") if chunk is None else chunk
    plain = ["value_numeric", "value_formatted", "precision", "measure_unit_id", "aggregate_id"]
    ledger = revision_ledger(
        observations,
        keys=OBSERVATION_KEY,
        record={
            **{c: c for c in (*OBSERVATION_KEY, *plain)},
            "source_last_update_at": iso_timestamp("source_last_update_at"),
        },
        seen_at="retrieved_at_utc",
        evidence={"response_sha256": "response_sha256", "task_id": "task_id"},
        events=[
            ("observed_value_changed", ["value_numeric"]),
            ("observed_representation_changed", ["value_formatted", "precision"]),
        ],
        look_back=["source_last_update_at"],
        chunk=chunk,
    )
    stamps = ["source_last_update_at", "previous_source_last_update_at"]
    return ledger.withColumns(
        {
            **{c: F.col(c).cast("timestamp") for c in stamps},
            "attribute_key": F.coalesce(F.col("attr_id").cast("string"), F.lit("reported")),
        }
    )


def current_dictionary_entries(entries: DataFrame) -> DataFrame:
    current = latest_per_key(entries, ["dictionary_resource", "entry_id", "lang"], NEWEST)
    return current.select("dictionary_resource", "entry_id", "lang", "entry_name", "source_record_json", *NEWEST)


def _by_language(names: list[str], condition: Column | None = None) -> dict[str, tuple[str, Column]]:
    picks = {}
    for name in names:
        for lang in ("pl", "en"):
            test = F.col("lang") == lang
            picks[f"{name}_{lang}"] = (name, test if condition is None else test & condition)
    return picks


def current_subjects(subjects: DataFrame) -> DataFrame:
    return bilingual_current(
        subjects,
        ["subject_id"],
        ["lang", "response_kind"],
        NEWEST,
        {
            **_by_language(["subject_name", "description"]),
            **{
                c: (c, None)
                for c in (
                    "parent_subject_id",
                    "child_subject_ids_json",
                    "subject_levels_json",
                    "years_json",
                    "availability_json",
                    "dimensions_json",
                )
            },
        },
        {
            "has_variables": F.bool_or(F.coalesce("has_variables", F.lit(False))),
            "last_update_at": F.max("last_update_at"),
            "modeled_at_utc": F.max("retrieved_at_utc"),
        },
    )


def current_units(units: DataFrame) -> DataFrame:
    merged = bilingual_current(
        units,
        ["resource_kind", "unit_id"],
        ["lang", "response_kind"],
        NEWEST,
        {
            **_by_language(["unit_name", "description"]),
            **{c: (c, None) for c in ("parent_unit_id", "kind", "years_json", "availability_json")},
        },
        {
            "level": F.max("level"),
            "has_description": F.bool_or(F.coalesce("has_description", F.lit(False))),
            "last_update_at": F.max("last_update_at"),
            "modeled_at_utc": F.max("retrieved_at_utc"),
        },
    )
    return merged.withColumn("is_locality", F.col("resource_kind") == "locality")


def current_variables(variables: DataFrame, observations: DataFrame) -> DataFrame:
    """Known variables, and a placeholder for each one seen only in observations."""
    catalogue, detail = F.col("response_kind") == "catalogue", F.col("response_kind") == "detail"
    parts = [f"name_component_{i}" for i in range(1, 6)]
    names = _by_language(parts)
    # Polish name parts are taken from catalogue pages only, English ones from any response.
    picks = {k: (c, t & catalogue if k.endswith("_pl") else t) for k, (c, t) in names.items()}
    known = bilingual_current(
        variables,
        ["variable_id"],
        ["lang", "response_kind"],
        NEWEST,
        {
            "subject_id": ("subject_id", None),
            **_by_language(["measure_unit_name"], catalogue),
            **picks,
            **_by_language(["description"], detail),
            "years_json": ("years_json", detail),
        },
        {
            "source_universe_total": F.max("source_universe_total"),
            "level": F.max("level"),
            "measure_unit_id": F.max("measure_unit_id"),
            "modeled_at_utc": F.max("retrieved_at_utc"),
        },
    )
    label = concat_skip_null(F.lit("Variable "), "variable_id")
    return inferred_members(
        known,
        observations,
        "variable_id",
        "variable_id",
        {
            "source_universe_total": F.max("source_universe_total"),
            "measure_unit_id": F.max("measure_unit_id"),
            "name_component_1_pl": label,
            "name_component_1_en": label,
            "modeled_at_utc": F.max("retrieved_at_utc"),
        },
    )


def current_observations(revisions: DataFrame, entries: DataFrame) -> DataFrame:
    """Current observations with their aggregate and attribute labels."""
    def labels(resource: str, prefix: str) -> DataFrame:
        return attribute_pivot(
            entries.where(F.col("dictionary_resource") == resource),
            ["entry_id"],
            {f"{prefix}_name_{lang}": ("entry_name", F.col("lang") == lang) for lang in ("pl", "en")},
        )

    current = revisions.where("is_current")
    current = label_join(current, labels("aggregates", "aggregate"), "aggregate_id", "entry_id", ["aggregate_name_pl", "aggregate_name_en"])
    current = label_join(current, labels("attributes", "attribute"), "attr_id", "entry_id", ["attribute_name_pl", "attribute_name_en"])
    return current.select(
        *OBSERVATION_KEY,
        "attribute_key",
        "value_numeric",
        "value_formatted",
        "precision",
        "measure_unit_id",
        "aggregate_id",
        "aggregate_name_pl",
        "aggregate_name_en",
        "attribute_name_pl",
        "attribute_name_en",
        F.col("attr_id").isNotNull().alias("is_attribute_flagged"),
        "revision_count",
        "replayed_response_count",
        F.col("revision_event_type").alias("current_revision_event_type"),
        "source_last_update_at",
        "first_seen_at_utc",
        "last_seen_at_utc",
        "canonical_record_sha256",
        "previous_record_sha256",
        F.col("last_response_sha256").alias("response_sha256"),
        F.col("last_task_id").alias("task_id"),
    )


def dim_period(observations: DataFrame) -> DataFrame:
    return period_dimension(observations, "period_key")


def dim_subject(subjects: DataFrame, variables: DataFrame) -> DataFrame:
    known = subjects.withColumnRenamed("subject_id", "subject_key").withColumn(
        "subject_name", F.coalesce("subject_name_pl", "subject_name_en")
    )
    return inferred_members(
        known,
        variables,
        "subject_key",
        "subject_id",
        {
            "subject_name": concat_skip_null(F.lit("Subject "), "subject_id"),
            "has_variables": F.bool_or(F.lit(True)),
            "modeled_at_utc": F.max("modeled_at_utc"),
        },
    )


def dim_variable(variables: DataFrame) -> DataFrame:
    return variables.select(
        F.col("variable_id").alias("variable_key"),
        F.col("subject_id").alias("subject_key"),
        F.coalesce("name_component_1_pl", "name_component_1_en").alias("variable_name"),
        *[joined_label(*[f"name_component_{i}_{lang}" for i in range(1, 6)]).alias(f"variable_name_{lang}") for lang in ("pl", "en")],
        "level",
        "measure_unit_id",
        "measure_unit_name_pl",
        "measure_unit_name_en",
        "description_pl",
        "description_en",
        "years_json",
        "source_universe_total",
        "modeled_at_utc",
    )


def dim_unit(units: DataFrame) -> DataFrame:
    return units.withColumnRenamed("unit_id", "unit_key").withColumn("unit_name", F.coalesce("unit_name_pl", "unit_name_en"))


def fact_observations(observations: DataFrame, periods: DataFrame, variables: DataFrame) -> DataFrame:
    joined = fact_with_dimensions(
        observations,
        [
            (periods, {"period_key": "period_key"}, ["period_start_date", "period_end_date", "period_granularity"]),
            (variables, {"variable_id": "variable_key"}, ["subject_key", "measure_unit_name_pl", "measure_unit_name_en"]),
        ],
    )
    return joined.withColumnsRenamed({"variable_id": "variable_key", "unit_id": "unit_key"})


def mart_coverage(envelopes: DataFrame, bronze_variables: DataFrame, variables: DataFrame, fact: DataFrame) -> DataFrame:
    """One snapshot row: universe, discovered, landed and modeled totals with their ratios."""
    landed = one_row(
        envelopes.where(F.col("source_id") == SOURCE),
        snapshot_date=F.max("retrieved_at_utc").cast("date"),
        latest_retrieved_at_utc=F.max("retrieved_at_utc"),
        landed_accepted_total=F.count(F.lit(1)),
    )
    newest = F.struct("retrieved_at_utc", "task_id", "response_sha256")
    universe = one_row(
        bronze_variables.where("response_kind = 'catalogue' and source_universe_total is not null"),
        source_universe_total=F.max_by("source_universe_total", newest),
    )
    discovered = one_row(variables, discovered_total=F.count(F.lit(1)))
    modeled = one_row(
        fact, modeled_total=F.count_distinct("variable_key"), modeled_observation_total=F.count(F.lit(1))
    )
    totals = side_by_side(landed, universe, discovered, modeled)
    return totals.select(
        "*",
        ratio("discovered_total", "source_universe_total").alias("discovery_coverage_ratio"),
        ratio("modeled_total", "source_universe_total").alias("modeled_coverage_ratio"),
        ratio("landed_accepted_total", "discovered_total").alias("landed_responses_per_discovered_variable_ratio"),
    )


def build(envelopes: DataFrame, chunk: Column | str | None = None) -> dict[str, DataFrame]:
    """All tables of this source from its envelopes."""
    bronze = {w: bronze_catalogue(envelopes, w) for w in KINDS}
    entries, observed = bronze_dictionary_entries(envelopes), bronze_observations(envelopes)
    revisions = observation_revisions(observed, chunk)
    dictionary = current_dictionary_entries(entries)
    subjects, units = current_subjects(bronze["subjects"]), current_units(bronze["units"])
    variables = current_variables(bronze["variables"], observed)
    observations = current_observations(revisions, dictionary)
    periods, variable_dim = dim_period(observations), dim_variable(variables)
    fact = fact_observations(observations, periods, variable_dim)
    return {
        **{f"br_bdl_{w}": df for w, df in bronze.items()},
        "br_bdl_dictionary_entries": entries,
        "br_bdl_years": bronze_years(envelopes),
        "br_bdl_observations": observed,
        "bdl_observation_revisions": revisions,
        "bdl_dictionary_entries": dictionary,
        "bdl_subjects": subjects,
        "bdl_units": units,
        "bdl_variables": variables,
        "bdl_observations": observations,
        "dim_bdl_period": periods,
        "dim_bdl_subject": dim_subject(subjects, variables),
        "dim_bdl_variable": variable_dim,
        "dim_bdl_unit": dim_unit(units),
        "fact_bdl_observations": fact,
        "mart_bdl_coverage": mart_coverage(envelopes, bronze["variables"], variables, fact),
    }
