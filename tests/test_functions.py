from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltstone.functions import dates, records, text
from conftest import rows


def column(spark, expr, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr("v")).collect()]


def test_clean_text(spark):
    assert column(spark, text.clean_text, ["  a ", "   ", "", None]) == ["a", None, None, None]
    assert column(spark, lambda c: text.clean_text(c, False, "upper"), [" ab ", " "]) == ["AB", ""]


def test_local_number(spark):
    got = column(spark, text.local_number, ["1 234,5", "1 234,50", "2 000", "-", "", None, "1d", "3.25", "1e3"])
    assert got == [1234.5, 1234.5, 2000.0, None, None, None, None, 3.25, 1000.0]


def test_whole_number_and_period_year(spark):
    assert column(spark, text.whole_number, ["12", " 7 ", "12.0", "12.6", "x", None]) == [12, 7, 12, 13, None, None]
    assert column(spark, text.period_year, ["2020", "rok 2019 q1", "q1", None, ""]) == [2020, 2019, None, None, None]


def test_codes(spark):
    assert column(spark, text.unit_code, ["1", "123", "12345", "12345678", "1234567890123", "", None]) == [
        "01", "0123", "0012345", "000012345678", "1234567890123", "", "",
    ]
    got = column(spark, text.territory_code, ["1234567", "234567", "011234567012", "11234567012", "12", None])
    assert got == ["1234567", "0234567", "1234567", "1234567", None, None]


def test_joined_label_and_skip_null(spark):
    df = spark.createDataFrame([("a", "", None, "b")], "w string, x string, y string, z string")
    assert df.select(text.joined_label("w", "x", "y", "z"), text.concat_skip_null("w", "y", "z")).first() == ("a / b", "ab")


def test_code_label_and_zero(spark):
    assert column(spark, lambda c: text.code_label(c, {"a": "A"}), ["a", "b", None]) == ["A", None, None]
    df = spark.createDataFrame([(0.0, None), (None, None), (1.0, 0.0), (1.0, 2.0)], "x double, y double")
    assert [r[0] for r in df.select(text.any_zero("x", "y")).collect()] == [True, False, True, False]


def test_finite_ratio_round(spark):
    got = column(spark, text.is_finite, [1.0, float("nan"), float("inf"), float("-inf"), None], "double")
    assert got == [True, False, False, False, None]
    df = spark.createDataFrame([(1, 2), (1, 0), (1, None)], "p int, w int")
    assert [r[0] for r in df.select(text.ratio("p", "w")).collect()] == [0.5, None, None]
    assert column(spark, lambda c: text.round_half_up(c, 2), [1.005, 2.345, 2.0], "double") == [1.0, 2.35, 2.0]


def test_recode(spark):
    raw = "Łódź".encode("iso8859-2").decode("iso8859-1")
    assert column(spark, lambda c: text.recode(c, "ISO-8859-1", "ISO-8859-2"), [raw]) == ["Łódź"]


def test_parse_timestamp(spark):
    got = column(
        spark, dates.parse_timestamp, ["2024-01-02 03:04:05", "2024-01-02 03:04", "02.01.2024 03:04", "2.1.2024 3:04:05", "2024-01-02", "x", None]
    )
    day = dt.datetime(2024, 1, 2)
    assert got == [
        day.replace(hour=3, minute=4, second=5), day.replace(hour=3, minute=4), day.replace(hour=3, minute=4),
        day.replace(hour=3, minute=4, second=5), day, None, None,
    ]


def test_date_from_parts(spark):
    df = spark.createDataFrame([("2024", "2", "9"), ("2024", "02", "30"), (None, "1", "1")], "y string, m string, d string")
    assert [r[0] for r in df.select(dates.date_from_parts("y", "m", "d")).collect()] == [dt.date(2024, 2, 9), None, None]


@pytest.mark.parametrize(
    "key, expected",
    [
        ("2024", ("year", dt.date(2024, 1, 1), dt.date(2024, 12, 31), 2024, None)),
        ("2024-Q1", ("quarter", dt.date(2024, 1, 1), dt.date(2024, 3, 31), 2024, 1)),
        ("2024-Q4", ("quarter", dt.date(2024, 10, 1), dt.date(2024, 12, 31), 2024, 4)),
        ("2024-02", ("month", dt.date(2024, 2, 1), dt.date(2024, 2, 29), 2024, None)),
        ("2024-M11", ("month", dt.date(2024, 11, 1), dt.date(2024, 11, 30), 2024, None)),
        ("2024-02-29", ("day", dt.date(2024, 2, 29), dt.date(2024, 2, 29), 2024, None)),
        ("2024-13", ("month", None, None, 2024, None)),
        ("2024-M13", ("other", None, None, 2024, None)),
        ("2024-Q5", ("other", None, None, 2024, None)),
        ("abc", ("other", None, None, None, None)),
    ],
)
def test_period_columns(spark, key, expected):
    df = spark.createDataFrame([(key,)], "k string")
    assert tuple(df.select(*dates.period_columns("k").values()).first()) == expected


def test_records(spark):
    df = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    assert df.select(records.canonical_json(["a", "b", "c"])).first()[0] == '{"a":1,"b":null,"c":"x"}'
    assert rows(df.select(records.surrogate_key(["a", "b", "c"]) == F.md5(F.lit("1||x")))) == [(True,)]
    assert df.select(records.differs("b", F.lit(None))).first()[0] is False
    js = spark.createDataFrame([('{"n":5,"t":"x","z":null,"o":{"k":[1]}}',)], "j string")
    got = js.select(records.field("j", "$.n", "int"), records.field("j", "$.t", "int"), records.field("j", "$.z"), records.field("j", "$.o")).first()
    assert tuple(got) == (5, None, None, '{"k":[1]}')
