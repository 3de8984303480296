"""Domain warehouse files: nine-dimension observations, dictionaries, taxonomy, metadata."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltstone.functions.text import clean_text, decimal_number, whole_number
from siltstone.operators.codes import taxonomy_paths
from siltstone.operators.dimensions import fact_with_dimensions
from siltstone.sources.readers import first_data_row, read_csv_strict

# The file headings, in file order, and the columns they become.
DIMENSIONS = {
    **{f"id_{pl}_{i}": f"{out}_{i}" for i in range(1, 10) for pl, out in (("wymiar", "wymiar"), ("pozycja", "pozycja"))}
}
NUMBERS = {
    "id_przekroj": ("przekroj_id", "bigint"),
    **{k: (v, "bigint") for k, v in DIMENSIONS.items()},
    "id_okres": ("okres_id", "int"),
    "id_sposob_prezentacji_miara": ("sposob_prezentacji_miara_id", "int"),
    "id_daty": ("period_year", "int"),
    "precyzja": ("precyzja", "int"),
    "id_brak_wartosci": ("brak_wartosci_id", "int"),
    "id_tajnosci": ("tajnosci_id", "int"),
    "id_flaga": ("flaga_id", "int"),
    "rowNumber": ("source_row_number", "bigint"),
}
OBSERVATION_HEADINGS = [
    "id_przekroj",
    *[f"id_{k}_{i}" for i in range(1, 10) for k in ("wymiar", "pozycja")],
    "id_okres",
    "id_sposob_prezentacji_miara",
    "id_daty",
    "wartosc",
    "precyzja",
    "id_brak_wartosci",
    "id_tajnosci",
    "id_flaga",
    "rowNumber",
]
DICTIONARY_HEADINGS = ["nazwa_kolumny", "nazwa_slownika", "id_elementu", "opis"]
METADATA = {
    "id_zmienna": "indicator_id",
    "nazwa": "metric_name",
    "nazwa_ang": "metric_name_en",
    "definicja_pojecie": "description",
    "nazwa_czestotliwosc": "frequency",
    "nazwa_jednostki": "measure_unit",
    "temat_badanie": "data_source",
    "tytul_akt": "legal_basis",
    "aktualizacja_ostatnia": "last_update",
}


def _stamp(as_of: datetime | None):
    return (F.current_timestamp() if as_of is None else F.lit(as_of)).alias("processed_at_utc")


def bronze_observations(rows: DataFrame, indicator_id: int, raw_archive_file: str, as_of: datetime | None = None) -> DataFrame:
    """Typed observations; numbers that do not parse become NULL, the value text is kept."""
    numbers = [F.col(k).try_cast(kind).alias(name) for k, (name, kind) in NUMBERS.items()]
    return rows.select(
        F.lit(indicator_id).cast("bigint").alias("indicator_id"),
        *numbers,
        F.col("wartosc").alias("wartosc_raw"),
        decimal_number(F.replace(F.col("wartosc"), F.lit(","), F.lit("."))).alias("wartosc_numeric"),
        F.lit(raw_archive_file).alias("raw_archive_file"),
        _stamp(as_of),
    )


def bronze_dictionaries(rows: DataFrame, indicator_id: int, as_of: datetime | None = None) -> DataFrame:
    return rows.where("id_elementu is not null").select(
        F.lit(indicator_id).cast("bigint").alias("indicator_id"),
        F.trim("nazwa_kolumny").alias("column_name"),
        F.trim("nazwa_slownika").alias("dictionary_name"),
        F.col("id_elementu").try_cast("bigint").alias("element_id"),
        F.trim("opis").alias("element_name"),
        _stamp(as_of),
    ).distinct()


def read_observations(spark: SparkSession, path: str, indicator_id: int, raw_archive_file: str, as_of: datetime | None = None) -> DataFrame:
    return bronze_observations(read_csv_strict(spark, path, OBSERVATION_HEADINGS), indicator_id, raw_archive_file, as_of)


def read_dictionaries(spark: SparkSession, path: str, indicator_id: int, as_of: datetime | None = None) -> DataFrame:
    return bronze_dictionaries(read_csv_strict(spark, path, DICTIONARY_HEADINGS), indicator_id, as_of)


def bronze_indicators(nodes: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Indicators of the taxonomy with their path, area and domain.

    ``nodes`` is the tree as rows: id, parent_id, name, name_en, type, indicator_id.
    """
    walked = taxonomy_paths(nodes, id="id", parent="parent_id", name="name", kind="type")
    extra = nodes.select(F.col("id").alias("_id"), "indicator_id", F.coalesce("name_en", F.lit("")).alias("indicator_name_en"))
    leaves = walked.where("node_kind = 'INDICATOR'").join(extra.where("indicator_id is not null"), F.col("node_id") == F.col("_id"))
    return leaves.select(
        F.col("indicator_id").cast("int").alias("indicator_id"),
        F.col("node_name").alias("indicator_name"),
        "indicator_name_en",
        "thematic_area",
        F.col("domain").alias("domain_name"),
        "taxonomy_path",
        "node_id",
        "parent_id",
        _stamp(as_of),
    )


def bronze_metadata(sheets: DataFrame, file_column: str, position: list[str], as_of: datetime | None = None) -> DataFrame:
    """Indicator metadata: the first data row of every sheet."""
    rows = first_data_row(sheets, file_column, position)
    texts = [F.trim(F.coalesce(F.col(k), F.lit(""))).alias(v) for k, v in METADATA.items() if k != "id_zmienna" and k in rows.columns]
    return rows.select(whole_number("id_zmienna").alias("indicator_id"), *texts, _stamp(as_of))


def stg_observations(bronze: DataFrame) -> DataFrame:
    whole = [f.name for f in bronze.schema.fields if f.dataType.simpleString() == "bigint" and f.name != "source_row_number"]
    return bronze.withColumns({c: F.col(c).cast("int") for c in whole})


def stg_dictionaries(bronze: DataFrame) -> DataFrame:
    texts = {c: clean_text(c, blank_to_null=False) for c in ("column_name", "dictionary_name", "element_name")}
    return bronze.withColumns({**texts, **{c: F.col(c).cast("int") for c in ("indicator_id", "element_id")}})


def _trimmed(bronze: DataFrame, skip: tuple[str, ...]) -> DataFrame:
    texts = [f.name for f in bronze.schema.fields if f.dataType.simpleString() == "string" and f.name not in skip]
    return bronze.withColumns({**{c: F.trim(c) for c in texts}, "indicator_id": F.col("indicator_id").cast("int")})


def stg_indicators(bronze: DataFrame) -> DataFrame:
    return _trimmed(bronze, ())


def stg_metadata(bronze: DataFrame) -> DataFrame:
    return _trimmed(bronze, ("last_update",))


def dim_indicator(indicators: DataFrame, metadata: DataFrame) -> DataFrame:
    wanted = ["description", "frequency", "measure_unit", "data_source", "legal_basis", "last_update"]
    joined = fact_with_dimensions(indicators.drop("processed_at_utc"), [(metadata, {"indicator_id": "indicator_id"}, wanted)])
    return joined.withColumn("indicator_key", F.col("indicator_id"))


def fact_observations(staged: DataFrame) -> DataFrame:
    return staged.drop("source_row_number").withColumn("indicator_key", F.col("indicator_id"))


def mart_coverage(fact: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return fact.agg(
        F.count_distinct("indicator_id").alias("total_indicators"),
        F.count(F.lit(1)).alias("total_observations"),
        F.min("period_year").alias("earliest_year"),
        F.max("period_year").alias("latest_year"),
    ).withColumn("snapshot_timestamp_utc", F.current_timestamp() if as_of is None else F.lit(as_of))
