"""Daily weather: stations, synoptic rows from two companion files, fact and summary."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siltstone.functions.dates import date_from_parts, month_start, year_start
from siltstone.functions.records import surrogate_key
from siltstone.functions.text import code_label, decimal_number
from siltstone.operators.dimensions import fact_with_dimensions
from siltstone.sources.readers import read_positional_csv

# Column positions in the headerless files.
DAY = {"station_code": 0, "station_name": 1, "year_val": 2, "month_val": 3, "day_val": 4}
SYNOPTIC = {
    **DAY,
    "tmax_celsius": 5,
    "tmin_celsius": 7,
    "tmean_celsius": 9,
    "precipitation_mm": 13,
    "precipitation_type": 15,
    "snow_depth_cm": 16,
    "sunshine_hours": 20,
}
COMPANION = {**DAY, "wind_speed_ms": 7, "relative_humidity_pct": 13, "pressure_sea_level_hpa": 17}
STATION = {"station_code": 0, "station_name": 1, "station_num": 2}
SYNOPTIC_MEASURES = ["tmax_celsius", "tmin_celsius", "tmean_celsius", "precipitation_mm", "snow_depth_cm", "sunshine_hours"]
COMPANION_MEASURES = ["wind_speed_ms", "relative_humidity_pct", "pressure_sea_level_hpa"]
PRECIPITATION = {"W": "liquid", "S": "solid", "D": "mixed"}
PROVIDER = "IMGW-PIB"


def _stamp(as_of: datetime | None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of)


def read_stations(spark: SparkSession, path: str, as_of: datetime | None = None, encoding: str = "UTF-8") -> DataFrame:
    rows = read_positional_csv(spark, path, STATION, encoding).drop("raw_archive_file")
    trimmed = rows.select(*[F.trim(c).alias(c) for c in rows.columns])
    return trimmed.where("station_code is not null and station_code <> ''").withColumn("processed_at_utc", _stamp(as_of))


def read_synoptic(spark: SparkSession, folder: str, as_of: datetime | None = None) -> DataFrame:
    """Rows of a folder of extracted files; the name prefix tells the two families apart."""
    main = read_positional_csv(spark, f"{folder}/s_d_{{[^t]*,t[^_]*,t}}.csv", SYNOPTIC)
    companion = read_positional_csv(spark, f"{folder}/s_d_t_*.csv", COMPANION)
    return bronze_synoptic(main, companion, as_of)


def bronze_synoptic(main: DataFrame, companion: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Synoptic days with the measures their companion file holds for the same station and day."""
    day = ["station_code", "year_val", "month_val", "day_val"]
    extra = companion.select(*day, *COMPANION_MEASURES)
    joined = main.where("station_code is not null").join(extra, day, "left")
    return joined.select(
        "station_code",
        "station_name",
        date_from_parts("year_val", "month_val", "day_val").alias("observation_date"),
        *[decimal_number(c).alias(c) for c in SYNOPTIC_MEASURES],
        F.trim("precipitation_type").alias("precipitation_type"),
        *[decimal_number(c).alias(c) for c in COMPANION_MEASURES],
        "raw_archive_file",
        _stamp(as_of).alias("processed_at_utc"),
    )


def stg_stations(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("station_name", F.trim("station_name")).where("station_code is not null and trim(station_code) <> ''")


def stg_synoptic(bronze: DataFrame) -> DataFrame:
    kept = bronze.where("station_code is not null and observation_date is not null")
    return kept.withColumns(
        {
            "station_name": F.trim("station_name"),
            "precipitation_type_standardized": code_label("precipitation_type", PRECIPITATION),
        }
    ).withColumnRenamed("precipitation_type", "precipitation_type_raw")


def dim_station(stations: DataFrame) -> DataFrame:
    return stations.withColumns({"station_key": surrogate_key(["station_code"]), "source_provider": F.lit(PROVIDER)})


def fact_daily(synoptic: DataFrame) -> DataFrame:
    return synoptic.drop("station_name").withColumns(
        {
            "weather_observation_key": F.md5(F.concat("station_code", F.lit("_"), F.col("observation_date").cast("string"))),
            "station_key": surrogate_key(["station_code"]),
        }
    )


# Thresholds of the daily flags.
FLAGS = {
    "has_precipitation": "precipitation_mm > 0.0",
    "is_heavy_rain_day": "precipitation_mm >= 10.0",
    "is_frost_day": "tmin_celsius < 0.0",
    "is_summer_day": "tmax_celsius >= 25.0",
    "is_hot_day": "tmax_celsius >= 30.0",
}


def mart_daily_summary(fact: DataFrame, stations: DataFrame) -> DataFrame:
    joined = fact_with_dimensions(fact, [(stations, {"station_key": "station_key"}, ["station_name"])])
    return joined.select(
        "observation_date",
        month_start("observation_date").alias("observation_month"),
        year_start("observation_date").alias("observation_year"),
        "station_key",
        "station_code",
        "station_name",
        "tmax_celsius",
        "tmin_celsius",
        "tmean_celsius",
        (F.col("tmax_celsius") - F.col("tmin_celsius")).alias("diurnal_temperature_range_celsius"),
        "precipitation_mm",
        "precipitation_type_standardized",
        *[F.when(F.expr(test), 1).otherwise(0).alias(name) for name, test in FLAGS.items()],
        "snow_depth_cm",
        "sunshine_hours",
        *COMPANION_MEASURES,
    )
