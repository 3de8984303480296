from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltstone.operators import metrics as m
from siltstone.operators import quality as q
from conftest import rows


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_equivalence_is_a_multiset_comparison(spark):
    a = frame(spark, [(1, None, 9), (1, None, 8), (2, "x", 7)], "a int, b string, tech int")
    b = frame(spark, [(2, "x", 1), (1, None, 1)], "a int, b string, tech int")
    assert tuple(q.dataset_equivalence(a, b, ["tech"]).first()) == (3, 2, 1, 0, False)
    assert tuple(q.dataset_equivalence(a, a.repartition(3), ["tech"]).first()) == (3, 3, 0, 0, True)
    assert rows(q.dataset_differences(a, b, ["tech"])) == [(1, None, "left", 1)]
    with pytest.raises(ValueError, match="schemas differ"):
        q.dataset_equivalence(a, b.drop("b"), ["tech"])


def test_equivalence_of_empty_frames(spark):
    empty = frame(spark, [], "a int")
    assert tuple(q.dataset_equivalence(empty, empty).first()) == (0, 0, 0, 0, True)


def test_exact_key_set(spark):
    seen = frame(spark, [(1,), (2,), (2,), (9,), (None,)], "k int")
    want = frame(spark, [(1,), (2,), (3,)], "k int")
    assert rows(q.exact_key_set(seen, want, ["k"])) == [(2, 2, "repeated"), (3, 0, "missing"), (9, 1, "unexpected"), (None, 1, "unexpected")]


def test_key_regression(spark):
    d = dt.date
    old = frame(spark, [(d(2024, 1, 1), "a"), (d(2024, 1, 2), "a"), (d(2024, 1, 2), None)], "day date, code string")
    new = frame(spark, [(d(2024, 1, 1), "a"), (d(2024, 1, 2), None), (d(2024, 1, 3), "b")], "day date, code string")
    report, lost = q.key_regression(old, new, ["day", "code"], "day", sample=5)
    assert report.first().asDict() == {
        "baseline_distinct_keys": 3, "current_distinct_keys_through_cutoff": 2, "missing_key_count": 1,
        "baseline_max_date": d(2024, 1, 2), "current_max_date": d(2024, 1, 3), "max_date_regressed": False,
    }
    assert rows(lost) == [(d(2024, 1, 2), "a")]
    assert q.key_regression(new, old, ["day", "code"], "day")[0].first()["max_date_regressed"] is True
    assert rows(q.missing_keys(old, new, ["code"])) == []


def test_pending_inputs(spark):
    a, b = frame(spark, [("h1", 1), ("h2", 2)], "h string, n int"), frame(spark, [("h1",), ("h1",)], "x string")
    assert rows(q.pending_inputs(a, b, "h", "x")) == [("h2", 2)]


def test_value_reconciliation(spark):
    api = frame(
        spark,
        [(1, "c", "1.0"), (2, "c", "1"), (3, "c", None), (4, "c", None), (5, "c", "5"), (6, "c", "6"), (7, "c", "7"), (8, "c", "8"), (9, None, "9"), (10, "", "9"), (11, "c", "NaN"), (12, "c", "0.1234567890123456789")],
        "k int, code string, v string",
    )
    bulk = frame(
        spark,
        [(1, " 1 "), (2, "2"), (3, "3"), (5, "5"), (5, "5"), (6, None), (7, "x"), (9, "9"), (11, "1"), (12, "0.1234567890123456789")],
        "k int, b string",
    )
    got = dict(rows(q.value_reconciliation(api, bulk, ["k"], "v", "b", required="code"), "k", "outcome"))
    assert got == {
        1: "exact_numeric_match", 2: "value_conflict", 3: "null_api_value_with_bulk_key", 4: "null_api_value_absent_from_bulk",
        5: "ambiguous_bulk_key", 6: "bulk_value_null", 7: "bulk_value_not_numeric", 8: "missing_bulk_key", 9: "missing_code", 10: "missing_code",
        11: "nonfinite_value", 12: "exact_numeric_match",
    }


def test_values_are_compared_exactly(spark):
    pairs = [("1.0E-19", "2.0E-19", 0), ("0.12345678901234567891", "0.12345678901234567892", 0), ("1e25", "10000000000000000000000000", 1),
             ("1.50", "+1.5e0", 1), ("-0.0", "0e9", 1), ("-1", "1", 0), ("1e-400", "10e-401", 1), ("00120", "12E1", 1), (".5", "5e-1", 1), ("5.", "5", 1), ("9" * 60, "9" * 60 + ".0", 1), ("9" * 60, "9" * 59 + "8", 0)]
    api = frame(spark, [(i, a) for i, (a, _, _) in enumerate(pairs)], "k int, v string")
    bulk = frame(spark, [(i, b) for i, (_, b, _) in enumerate(pairs)], "k int, b string")
    got = dict(rows(q.value_reconciliation(api, bulk, ["k"], "v", "b"), "k", "outcome"))
    assert got == {i: "exact_numeric_match" if same else "value_conflict" for i, (*_, same) in enumerate(pairs)}
    odd = q.value_reconciliation(frame(spark, [(1, "NaN"), (2, "NaN"), (3, "x")], "k int, v string"), frame(spark, [(1, "x"), (2, "1"), (3, "inf")], "k int, b string"), ["k"], "v", "b")
    assert dict(rows(odd, "k", "outcome")) == {1: "bulk_value_not_numeric", 2: "nonfinite_value", 3: "bulk_value_not_numeric"}


def test_rules(spark):
    df = frame(spark, [(1, 5, 4), (2, None, 4), (3, 1, 4)], "k int, bid int, ask int")
    rules = {"bid_above_ask": F.col("bid") > F.col("ask"), "bid_missing": F.col("bid").isNull()}
    assert rows(q.rule_violations(df, ["k"], rules)) == [(1, "bid_above_ask"), (2, "bid_missing")]
    pages = frame(spark, [("p", "u", 1), ("p", "u", 2), ("p", "w", 3), ("r", "u", 4)], "page string, unit string, k int")
    assert rows(q.repeated_in_group(pages, ["page", "unit"], ["k"], "repeated")) == [(1, "repeated"), (2, "repeated")]


def test_page_checks(spark):
    data = [(1, 1, 10, 5, 5), (1, 0, 10, 3, 0), (3, 2, 10, 15, 5), (1, 1, 4, 9, 5), (1, 1, 10, 3, 5), (1, 1, 10, 3, 0), (0, 1, 1, 1, 1), (1, 0, 10, 0, 0)]
    df = frame(spark, data, "page int, pages int, per int, total int, got int")
    got = [r[-1] for r in q.page_checks(df, "page", "pages", "per", "total", "got").collect()]
    assert got == [None, "rows_without_pages", "page_beyond_last", "more_rows_than_page_size", "more_rows_than_total", "empty_page", "invalid_number", None]


def test_profile_and_its_contract(spark):
    df = frame(spark, [(dt.date(2024, 1, 1), 1.0), (dt.date(2024, 2, 1), None)], "day date, v double")
    seen = q.dataset_profile(df, "d", "day")
    assert tuple(seen.first()) == ("d", 2, "2024-01-01", "2024-02-01", "day:date,v:double")
    assert q.profile_differences(seen, seen).count() == 0
    recorded = seen.withColumn("row_count", F.lit(3).cast("long"))
    assert rows(q.profile_differences(seen, recorded)) == [("d", "row_count", "3", "2")]


def test_partition_homogeneity(spark):
    df = frame(spark, [("a", "a"), ("a", None), ("b", "b")], "part string, key string")
    declared = frame(spark, [("a", 2), ("b", 5), ("c", 1)], "partition string, declared_rows bigint")
    got = rows(q.partition_homogeneity(df, F.col("part"), F.col("key"), declared), "partition", "row_count", "foreign_rows", "count_matches")
    assert got == [("a", 2, 1, True), ("b", 1, 0, False), ("c", None, None, False)]


FACT = "effective_date date, source_table_key string, currency_key string, mid double, bid double, ask double"


def quotes(spark, data):
    return frame(spark, [(dt.date.fromisoformat(d), t, c, v, None, None) for d, t, c, v in data], FACT)


def test_metric_query_keeps_its_grain(spark):
    metric = m.find_metric("nbp_table_a_mid")
    df = quotes(spark, [("2024-01-01", "A", "USD", 4.0), ("2024-01-02", "A", "USD", 4.1), ("2024-01-02", "B", "USD", 9.0), ("2024-01-04", "A", "USD", 4.2)])
    got = m.query_metric(metric, df, "2024-01-01", "2024-01-02")
    assert got.columns == ["effective_date", "currency_key", "source_table_key", "nbp_table_a_mid"]
    assert [r[-1] for r in rows(got)] == [4.0, 4.1]
    with pytest.raises(ValueError, match="only at the grain"):
        m.query_metric(metric, df, "2024-01-01", "2024-01-02", ["effective_date"])
    with pytest.raises(ValueError, match="before"):
        m.query_metric(metric, df, "2024-01-02", "2024-01-01")
    with pytest.raises(ValueError):
        m.query_metric(metric, df, "2024-1-2", "2024-01-03")
    with pytest.raises(ValueError, match="unknown metric"):
        m.find_metric("nope")


def test_metric_registry_is_complete():
    assert len(m.METRICS) == 33
    assert m.METRICS["eurostat_catalogue_distribution_total"].column == "catalogue_distributions"
    assert m.METRICS["wdi_modeled_value_coverage_ratio"].kind == "ratio"


def test_grain_check_counts_every_defect(spark):
    metric = m.find_metric("nbp_table_a_mid")
    good = quotes(spark, [("2024-01-01", "A", "USD", 0.0), ("2024-01-01", "A", "EUR", 4.0)])
    m.validate_grain(metric, good, {"source_table_key": ["A", "B", "C"]})
    bad = quotes(spark, [("2024-01-01", "A", "USD", -1.0), ("2024-01-01", "A", "USD", 4.0), ("2024-01-01", "A", "", float("nan"))])
    found = m.grain_check(metric, bad, {"currency_key": ["USD"]}).first().asDict()
    assert found == {"row_count": 3, "blank_key_rows": 1, "unknown_code_rows": 1, "invalid_value_rows": 2, "duplicate_grain_keys": 1, "date_typed": True}
    with pytest.raises(ValueError, match="invalid grain"):
        m.validate_grain(metric, bad)


def test_ratio_metric_must_stay_in_bounds(spark):
    metric = m.find_metric("bdl_modeled_coverage_ratio")
    mart = frame(spark, [(dt.date(2024, 1, 1), 1.2)], "snapshot_date date, modeled_coverage_ratio double")
    assert m.grain_check(metric, mart).first()["invalid_value_rows"] == 1


def test_crosscheck_and_latest_days(spark):
    metric = m.find_metric("nbp_table_a_mid")
    df = quotes(spark, [("2024-01-01", "A", "USD", 1.0), ("2024-01-02", "A", "USD", 2.0), ("2024-01-03", "A", "USD", 3.0), ("2024-01-03", "B", "USD", 9.0)])
    assert m.metric_crosscheck(metric, df).count() == 0
    assert len(rows(m.latest_dates_window(df, "effective_date", 2))) == 3
    twice = df.unionByName(quotes(spark, [("2024-01-03", "A", "USD", 5.0)]))
    assert m.metric_crosscheck(metric, twice).count() == 1
