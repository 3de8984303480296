"""Date and period helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from siltstone.functions.text import as_column

# Timestamp spellings found in measurement files, tried in this order.
TIMESTAMP_FORMATS = (
    "yyyy-M-d H:m:s",
    "yyyy-M-d H:m",
    "d.M.yyyy H:m:s",
    "d.M.yyyy H:m",
    "yyyy-M-d",
)

# Fixed patterns: how each granularity is written in a period key.
PERIOD_PATTERNS = {
    "year": r"^[0-9]{4}$",
    "quarter": r"^[0-9]{4}-Q[1-4]$",
    "month": r"^[0-9]{4}-([0-9]{2}|M(0[1-9]|1[0-2]))$",
    "day": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
}


def parse_timestamp(value: Column | str, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """First format that fits wins; NULL if none does."""
    text = F.trim(as_column(value))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats])


def date_from_parts(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """Date from text parts; month and day may miss their leading zero."""
    return F.concat(
        as_column(year), F.lit("-"), F.lpad(as_column(month), 2, "0"), F.lit("-"), F.lpad(as_column(day), 2, "0")
    ).try_cast("date")


def period_columns(
    key: Column | str, granularities: Sequence[str] = tuple(PERIOD_PATTERNS)
) -> dict[str, Column]:
    """Granularity, first and last day, year and quarter of a text period key.

    Keys in none of the accepted spellings are ``other``; a key that is spelled right but
    names no real date (month 13) keeps its granularity and gets NULL dates.
    """
    key = as_column(key)
    year = F.substring(key, 1, 4)
    digits = F.regexp_replace(F.substring(key, 6, 3), "[QM]", "")
    month_of = {
        "year": F.lit("01"),
        "quarter": F.lpad((digits.try_cast("int") * 3 - 2).cast("string"), 2, "0"),
        "month": F.lpad(digits, 2, "0"),
        "day": F.substring(key, 6, 2),
    }
    months_in = {"year": 12, "quarter": 3, "month": 1}

    granularity, start, end = None, None, None
    for name in granularities:
        hit = key.rlike(PERIOD_PATTERNS[name])
        day = F.substring(key, 9, 2) if name == "day" else F.lit("01")
        first = F.concat_ws("-", year, month_of[name], day).try_cast("date")
        last = first if name == "day" else F.last_day(F.add_months(first, months_in[name] - 1))
        if granularity is None:
            granularity, start, end = F.when(hit, F.lit(name)), F.when(hit, first), F.when(hit, last)
        else:
            granularity, start, end = granularity.when(hit, F.lit(name)), start.when(hit, first), end.when(hit, last)
    return {
        "period_granularity": granularity.otherwise(F.lit("other")),
        "period_start_date": start,
        "period_end_date": end,
        "calendar_year": F.when(key.rlike("^[0-9]{4}"), year.cast("int")),
        "quarter_number": F.when(key.rlike(PERIOD_PATTERNS["quarter"]), digits.try_cast("int")),
    }


def month_start(value: Column | str) -> Column:
    return F.trunc(as_column(value).cast("date"), "month")


def year_start(value: Column | str) -> Column:
    return F.trunc(as_column(value).cast("date"), "year")


def calendar_columns(day: Column | str) -> dict[str, Column]:
    day = as_column(day)
    return {
        "calendar_year": F.year(day),
        "calendar_month": F.month(day),
        "calendar_day": F.dayofmonth(day),
        "iso_weekday": F.weekday(day) + 1,
    }

