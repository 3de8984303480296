"""Territorial register and administrative boundaries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltstone.operators.codes import COUNTY, MUNICIPALITY, REGION, area_rows_check, municipality_code, require_no_errors, street_name, territory_columns
from siltstone.operators.dimensions import fact_with_dimensions, hierarchy_names, union_levels
from siltstone.sources.readers import read_csv_typed

# File layouts of the register, all text but the reference day.
TERRITORY_FILE = "WOJ string, POW string, GMI string, RODZ string, NAZWA string, NAZWA_DOD string, STAN_NA date"
LOCALITY_FILE = (
    "WOJ string, POW string, GMI string, RODZ_GMI string, RM string, MZ string, NAZWA string, SYM string, SYMPOD string, STAN_NA date"
)
STREET_FILE = (
    "WOJ string, POW string, GMI string, RODZ_GMI string, SYM string, SYM_UL string, CECHA string, NAZWA_1 string, NAZWA_2 string, STAN_NA date"
)
COUNTRY_CODE, COUNTRY_LEVEL = "PL", "kraj"


def _stamp(as_of: datetime | None):
    return (F.current_timestamp() if as_of is None else F.lit(as_of)).alias("extracted_at_utc")


def bronze_territories(rows: DataFrame, as_of: datetime | None = None) -> DataFrame:
    codes = territory_columns("WOJ", "POW", "GMI", "RODZ")
    return rows.select(
        *[c.alias(n) for n, c in codes.items()],
        F.col("NAZWA").alias("nazwa"),
        F.col("NAZWA_DOD").alias("nazwa_dod"),
        F.col("STAN_NA").alias("stan_na"),
        _stamp(as_of),
    )


def _municipality(rows: DataFrame) -> list:
    return [
        F.lpad("WOJ", 2, "0").alias("woj"),
        F.lpad("POW", 2, "0").alias("pow"),
        F.lpad("GMI", 2, "0").alias("gmi"),
        F.col("RODZ_GMI").alias("rodz_gmi"),
        municipality_code("WOJ", "POW", "GMI", "RODZ_GMI").alias("teryt_gmina_code"),
    ]


def bronze_localities(rows: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return rows.select(
        *_municipality(rows),
        F.col("RM").alias("rm"),
        F.col("MZ").alias("mz"),
        F.col("NAZWA").alias("nazwa"),
        F.lpad("SYM", 7, "0").alias("sym"),
        F.lpad("SYMPOD", 7, "0").alias("sympod"),
        (F.col("SYM") == F.col("SYMPOD")).alias("is_parent_locality"),
        F.col("STAN_NA").alias("stan_na"),
        _stamp(as_of),
    )


def bronze_streets(rows: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return rows.select(
        *_municipality(rows),
        F.lpad("SYM", 7, "0").alias("sym"),
        F.lpad("SYM_UL", 5, "0").alias("sym_ul"),
        F.col("CECHA").alias("cecha"),
        F.col("NAZWA_1").alias("nazwa_1"),
        F.nullif("NAZWA_2", F.lit("")).alias("nazwa_2"),
        street_name("CECHA", "NAZWA_1", "NAZWA_2").alias("full_street_name"),
        F.col("STAN_NA").alias("stan_na"),
        _stamp(as_of),
    )


def read_register(spark: SparkSession, territories: str, localities: str, streets: str, as_of: datetime | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        bronze_territories(read_csv_typed(spark, territories, TERRITORY_FILE), as_of),
        bronze_localities(read_csv_typed(spark, localities, LOCALITY_FILE), as_of),
        bronze_streets(read_csv_typed(spark, streets, STREET_FILE), as_of),
    )


# Register columns and the names they are published under.
PLACE = {"woj": "voivodeship_code", "pow": "county_code", "gmi": "municipality_code", "stan_na": "effective_date", "extracted_at_utc": "ingested_at_utc"}


def stg_territories(bronze: DataFrame) -> DataFrame:
    return bronze.withColumnsRenamed({**PLACE, "rodz": "municipality_type_code", "nazwa": "unit_name", "nazwa_dod": "unit_type_name"})


def stg_localities(bronze: DataFrame) -> DataFrame:
    return bronze.withColumnsRenamed(
        {
            **PLACE,
            "sym": "locality_id",
            "sympod": "parent_locality_id",
            "rodz_gmi": "municipality_type_code",
            "rm": "locality_type_code",
            "mz": "common_name_presence_code",
            "nazwa": "locality_name",
        }
    )


def stg_streets(bronze: DataFrame) -> DataFrame:
    return bronze.drop("woj", "pow", "gmi", "rodz_gmi").withColumnsRenamed(
        {
            **PLACE,
            "sym": "locality_id",
            "sym_ul": "street_id",
            "cecha": "street_prefix",
            "nazwa_1": "street_primary_name",
            "nazwa_2": "street_secondary_name",
        }
    )


def dim_territory(territories: DataFrame) -> DataFrame:
    return hierarchy_names(
        territories,
        "level",
        "unit_name",
        [
            (REGION, ["voivodeship_code"], "voivodeship_name"),
            (COUNTY, ["voivodeship_code", "county_code"], "county_name"),
        ],
    )


def dim_locality(localities: DataFrame, territory: DataFrame) -> DataFrame:
    parents = localities.where("is_parent_locality").select(F.col("locality_id").alias("_id"), F.col("locality_name").alias("parent_locality_name"))
    places = territory.where(F.col("level") == MUNICIPALITY).withColumnRenamed("unit_name", "municipality_name")
    joined = fact_with_dimensions(
        localities,
        [
            (parents, {"parent_locality_id": "_id"}, ["parent_locality_name"]),
            (places, {"teryt_gmina_code": "teryt_code"}, ["municipality_name", "county_name", "voivodeship_name"]),
        ],
    )
    return joined.select(
        "locality_id",
        "locality_name",
        "is_parent_locality",
        "parent_locality_id",
        "parent_locality_name",
        "teryt_gmina_code",
        "municipality_name",
        "county_name",
        "voivodeship_name",
        "locality_type_code",
        "effective_date",
        "ingested_at_utc",
    )


def dim_street(streets: DataFrame, localities: DataFrame) -> DataFrame:
    names = ["locality_name", "municipality_name", "county_name", "voivodeship_name"]
    return fact_with_dimensions(streets, [(localities, {"locality_id": "locality_id"}, names)])


# --- boundaries -------------------------------------------------------------------------


def stg_boundaries(country: DataFrame, regions: DataFrame, counties: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Boundaries of all levels; the area is given in hectares and square kilometres.

    Each branch has ``unit_name``, ``surface_area_ha``, ``geometry_wkt``, ``extracted_at_utc``;
    all but the country have ``teryt_code`` and ``regon``.
    """
    branches = {
        COUNTRY_LEVEL: country.withColumn("teryt_code", F.lit(COUNTRY_CODE)),
        REGION: regions,
        COUNTY: counties,
        MUNICIPALITY: municipalities,
    }
    return union_levels(branches).withColumn("surface_area_km2", F.col("surface_area_ha") / 100.0).select(
        "teryt_code", "level", "unit_name", "surface_area_ha", "surface_area_km2", "regon", "geometry_wkt", "extracted_at_utc"
    )


REGISTER_COLUMNS = [
    "unit_type_name",
    "voivodeship_code",
    "voivodeship_name",
    "county_code",
    "county_name",
    "municipality_code",
    "parent_teryt_code",
]


def dim_boundary(boundaries: DataFrame, territory: DataFrame | None = None) -> DataFrame:
    """Boundaries with their register columns, typed NULLs where there is no register."""
    if territory is None:
        joined = boundaries.withColumns({c: F.lit(None).cast("string") for c in REGISTER_COLUMNS})
    else:
        joined = fact_with_dimensions(boundaries, [(territory, {"teryt_code": "teryt_code"}, REGISTER_COLUMNS)])
    return joined.withColumnRenamed("extracted_at_utc", "ingested_at_utc")


def surface_areas(sheet: DataFrame, snapshot_date: str) -> DataFrame:
    """Surface areas from sheet rows (TERYT, unit_name, area_m2, area_ha, area_km2, row number).

    A bad row fails the query.
    """
    checked = area_rows_check(sheet, "TERYT", "unit_name", ["area_m2", "area_ha", "area_km2"])
    return require_no_errors(checked).withColumnsRenamed({"code_source": "teryt_code_source", "code": "teryt_code"}).withColumn(
        "snapshot_date", F.lit(snapshot_date).cast("date")
    )
