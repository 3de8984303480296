"""Wide to long and back."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.functions.dates import parse_timestamp
from siltstone.functions.text import decimal_number

# Fixed pattern: four-digit years of the 19th to 22nd century.
YEAR_PATTERN = r"^(18|19|20|21)[0-9]{2}$"

# What can be read off a measurement file's name.
POLLUTANT_PATTERN = r"(?i)(PM10|PM2\.5|PM25|NO2|SO2|CO|O3|C6H6)"
DEFAULT_POLLUTANT = "PM10"


def unpivot_filled(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Long form of the given columns; NULL cells give no row."""
    return df.unpivot([F.col(f"`{c}`") for c in ids], [F.col(f"`{c}`") for c in columns], name, value).where(F.col(value).isNotNull())


def unpivot_years(df: DataFrame, ids: Sequence[str], name: str = "observation_year", value: str = "observation_value_text") -> DataFrame:
    """Every year column as rows; blank cells and columns not named like a year give none."""
    years = [c for c in df.columns if c not in ids and re.fullmatch(YEAR_PATTERN, c)]
    long = unpivot_filled(df, ids, years, name, value)
    text = F.nullif(F.trim(F.col(value)), F.lit(""))
    return long.withColumn(value, text).where(F.col(value).isNotNull()).withColumn(name, F.col(name).cast("int"))


def file_pollutant(file_name: Column) -> Column:
    """Pollutant named in a file name, in its usual spelling."""
    found = F.upper(F.regexp_extract(file_name, POLLUTANT_PATTERN, 1))
    return F.when(found == "", F.lit(DEFAULT_POLLUTANT)).when(found == "PM25", F.lit("PM2.5")).otherwise(found)


def file_interval(file_name: Column) -> Column:
    """Averaging interval named in a file name: daily if it says so, else hourly."""
    return F.when(F.lower(file_name).contains("24g"), F.lit("24g")).otherwise(F.lit("1g"))


def unpivot_matrix(df: DataFrame, time: str, file_name: Column, unit: str = "ug/m3") -> DataFrame:
    """Sensor matrix (one column per sensor) as measurements.

    Cells are text with a decimal comma; cells that are no number, and rows whose time does
    not parse, give no measurement.
    """
    sensors = [c for c in df.columns if c != time]
    tagged = df.withColumn("_file", file_name)
    long = unpivot_filled(tagged, [time, "_file"], sensors, "_sensor", "_text")
    value = decimal_number(F.replace(F.col("_text"), F.lit(","), F.lit(".")))
    stamp = parse_timestamp(time)
    return (
        long.select(
            F.trim("_sensor").alias("station_code"),
            F.trim("_sensor").alias("sensor_code"),
            file_pollutant(F.col("_file")).alias("pollutant"),
            file_interval(F.col("_file")).alias("averaging_interval"),
            stamp.alias("measurement_timestamp"),
            stamp.cast("date").alias("observation_date"),
            value.alias("value"),
            F.lit(unit).alias("unit"),
        )
        .where("measurement_timestamp is not null and value is not null")
    )


def map_by_synonyms(df: DataFrame, synonyms: Mapping[str, Sequence[str]], required: Sequence[str] = ()) -> DataFrame:
    """Select columns by any of their known headings.

    Headings match without regard to case and outer blanks. The first synonym with a filled
    cell wins; a column with no matching heading is NULL; rows that miss a required column
    are dropped.
    """
    by_heading = {c.strip().lower(): c for c in df.columns}
    picked = []
    for output, names in synonyms.items():
        found = [by_heading[n.lower()] for n in names if n.lower() in by_heading]
        cells = [F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) for c in found]
        picked.append((F.coalesce(*cells) if cells else F.lit(None).cast("string")).alias(output))
    out = df.select(*picked)
    for name in required:
        out = out.where(F.col(name).isNotNull())
    return out


def map_by_fragment(df: DataFrame, fragments: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """First column whose heading contains one of the fragments, per output name."""
    hits = {}
    for output, parts in fragments.items():
        for column in df.columns:
            if any(p in column.strip().lower() for p in parts):
                hits[output] = column
                break
    return hits


def series_in_order(df: DataFrame, series: str, position: Sequence[str], at_most: int = 10_000) -> list[str]:
    """Distinct series values in order of first appearance.

    The values become columns, so their number must be small: more than ``at_most`` is an
    error, never a cut.
    """
    first = df.groupBy(F.coalesce(F.col(series).cast("string"), F.lit("")).alias("s")).agg(
        F.min(F.struct(*position)).alias("p")
    )
    rows = first.orderBy("p", "s").limit(at_most + 1).collect()
    if len(rows) > at_most:
        raise ValueError(f"more than {at_most} series values in {series!r}")
    return [r["s"] for r in rows]


def pivot_series(
    df: DataFrame, x: str, y: str, series: str, position: Sequence[str], values: Sequence[str] | None = None
) -> DataFrame:
    """Long to wide: one column per series value, the last row by ``position`` winning a cell."""
    columns = list(values) if values is not None else series_in_order(df, series, position)
    shaped = df.select(x, F.col(y).alias("_y"), F.coalesce(F.col(series).cast("string"), F.lit("")).alias("_s"), F.struct(*position).alias("_p"))
    return shaped.groupBy(x).pivot("_s", columns).agg(F.max_by("_y", "_p"))
