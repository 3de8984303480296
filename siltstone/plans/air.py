"""Air quality: stations, sensors, measurements, daily fact."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.functions.dates import parse_timestamp
from siltstone.functions.text import clean_text, decimal_number, round_half_up
from siltstone.operators.dimensions import child_count_dimension
from siltstone.operators.reshape import DEFAULT_POLLUTANT, map_by_fragment, map_by_synonyms, unpivot_matrix

# Headings under which each column is found, best first.
STATION_HEADINGS = {
    "station_code": ["kod stacji", "kod_stacji", "station_code"],
    "old_station_code": ["stary kod stacji", "stary_kod_stacji", "old_station_code"],
    "station_name": ["nazwa stacji", "nazwa_stacji", "station_name"],
    "station_type": ["typ stacji", "typ_stacji", "station_type"],
    "area_type": ["typ obszaru", "typ_obszaru", "area_type"],
    "latitude": ["wgs84 φ n", "wgs84_phi_n", "szerokosc", "latitude", "lat"],
    "longitude": ["wgs84 λ e", "wgs84_lambda_e", "dlugosc", "longitude", "lon"],
    "voivodeship": ["województwo", "wojewodztwo", "voivodeship"],
    "city": ["miejscowość", "miejscowosc", "city"],
    "address": ["adres", "address"],
}
SENSOR_HEADINGS = {
    "sensor_code": ["kod stanowiska", "kod_stanowiska", "sensor_code"],
    "station_code": ["kod stacji", "kod_stacji", "station_code"],
    "pollutant": ["wskaźnik", "wskaznik", "pollutant", "parametr"],
    "averaging_interval": ["czas uśredniania", "czas_usredniania", "averaging_interval"],
    "measurement_type": ["typ pomiaru", "typ_pomiaru", "measurement_type"],
}
# Heading fragments of tabular measurement files.
TABULAR_FRAGMENTS = {
    "station_code": ["stac", "station"],
    "value": ["wart", "val"],
    "time": ["data", "date", "czas"],
    "sensor_code": ["stanowisk", "sensor"],
    "pollutant": ["wskaznik", "wskaźnik", "pollutant"],
}
UNIT, HOURLY = "ug/m3", "1g"


def _stamp(as_of: datetime | None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of)


def _decimal(name: str) -> Column:
    return decimal_number(F.replace(F.col(name), F.lit(","), F.lit(".")))


def bronze_stations(sheet: DataFrame, as_of: datetime | None = None) -> DataFrame:
    mapped = map_by_synonyms(sheet, STATION_HEADINGS, required=["station_code"])
    return mapped.withColumns(
        {
            "station_name": F.coalesce("station_name", "station_code"),
            "latitude": _decimal("latitude"),
            "longitude": _decimal("longitude"),
            "processed_at_utc": _stamp(as_of),
        }
    )


def bronze_sensors(sheet: DataFrame, as_of: datetime | None = None) -> DataFrame:
    mapped = map_by_synonyms(sheet, SENSOR_HEADINGS, required=["sensor_code", "station_code"])
    return mapped.withColumn("processed_at_utc", _stamp(as_of))


def is_tabular(sheet: DataFrame) -> bool:
    headings = [c.strip().lower() for c in sheet.columns]
    return any("kod" in h for h in headings) and any("wart" in h or "value" in h for h in headings)


def bronze_measurements(sheet: DataFrame, file_name: Column, as_of: datetime | None = None) -> DataFrame:
    """Measurements of one sheet layout: a table with named columns, or a sensor matrix."""
    if not is_tabular(sheet):
        return unpivot_matrix(sheet, sheet.columns[0], file_name, UNIT).withColumn("processed_at_utc", _stamp(as_of))
    found = map_by_fragment(sheet, TABULAR_FRAGMENTS)

    def cell(name: str) -> Column:
        return F.trim(F.col(f"`{found[name]}`"))

    time = parse_timestamp(cell("time"))
    rows = sheet.select(
        cell("station_code").alias("station_code"),
        (cell("sensor_code") if "sensor_code" in found else cell("station_code")).alias("sensor_code"),
        (cell("pollutant") if "pollutant" in found else F.lit(DEFAULT_POLLUTANT)).alias("pollutant"),
        F.lit(HOURLY).alias("averaging_interval"),
        time.alias("measurement_timestamp"),
        time.cast("date").alias("observation_date"),
        decimal_number(F.replace(cell("value"), F.lit(","), F.lit("."))).alias("value"),
        F.lit(UNIT).alias("unit"),
    )
    return rows.where("measurement_timestamp is not null and value is not null").withColumn("processed_at_utc", _stamp(as_of))


def stg_stations(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns(
        {"voivodeship": clean_text("voivodeship", False, "upper"), "city": F.trim("city"), "address": F.trim("address")}
    )


def stg_sensors(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns(
        {"pollutant": clean_text("pollutant", False, "upper"), "averaging_interval": clean_text("averaging_interval", False, "lower")}
    )


def stg_measurements(bronze: DataFrame) -> DataFrame:
    """Known, non-negative values."""
    return stg_sensors(bronze).where("value is not null and value >= 0")


def dim_station(stations: DataFrame, sensors: DataFrame) -> DataFrame:
    return child_count_dimension(stations, sensors, "station_code", "sensor_code", "active_sensors_count")


def fact_daily(measurements: DataFrame) -> DataFrame:
    return measurements.groupBy("observation_date", "station_code", "pollutant", "unit").agg(
        round_half_up(F.avg("value"), 2).alias("avg_daily_value"),
        round_half_up(F.min("value"), 2).alias("min_daily_value"),
        round_half_up(F.max("value"), 2).alias("max_daily_value"),
        F.count(F.lit(1)).alias("observations_count"),
        F.max("processed_at_utc").alias("processed_at_utc"),
    )
