from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from siltstone.operators import dimensions as d
from siltstone.operators import explore as e
from siltstone.operators.coverage import column_coverage, coverage_mart, one_row, side_by_side, text_member_count
from conftest import rows


def values(spark, data, kind="double"):
    return spark.createDataFrame([(v,) for v in data], f"v {kind}")


def test_box_plot(spark):
    stats, outliers = e.box_plot(values(spark, [1.0, 2.0, 3.0, 4.0, 100.0, None, float("nan")]), "v")
    assert tuple(stats.first()) == (1.0, 2.0, 3.0, 4.0, 4.0, 1)
    assert rows(outliers) == [(100.0,)]
    empty, none = e.box_plot(values(spark, [None]), "v")
    assert empty.count() == 0 and none.count() == 0


def test_histogram(spark):
    got = dict(rows(e.histogram(values(spark, [0.0, 1.0, 10.0, 20.0, None]), "v")))
    assert len(got) == 20 and got[0] == 1 and got[1] == 1 and got[10] == 1 and got[19] == 1 and sum(got.values()) == 4
    assert dict(rows(e.histogram(values(spark, [5, 5], "int"), "v")))[0] == 2
    assert sum(dict(rows(e.histogram(values(spark, [None]), "v"))).values()) == 0


def test_topk(spark):
    assert [tuple(r) for r in e.topk_values(values(spark, ["b", "a", "b", "a", "c", None], "string"), "v", 2).collect()] == [("a", 2), ("b", 2)]


def test_column_stats(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "y", None), (2, None, None)], "n int, s string, z double")
    got = {r["column_name"]: r.asDict(True) for r in e.column_stats(df).collect()}
    assert (got["n"]["total_count"], got["n"]["null_count"], got["n"]["unique_count"], got["n"]["min"], got["n"]["max"]) == (3, 0, 2, 1.0, 2.0)
    assert got["n"]["top_values"] == [{"value": "2", "count": 2}, {"value": "1", "count": 1}]
    assert got["s"]["null_count"] == 1 and [v["value"] for v in got["s"]["top_values"]] == ["x", "y"]
    assert (got["z"]["unique_count"], got["z"]["null_count"]) == (0, 3)


def test_summarize(spark):
    df = spark.createDataFrame([(1, "x"), (3, None)], "n int, s string")
    got = {r["column_name"]: r.asDict() for r in e.summarize(df).collect()}
    assert (got["n"]["min"], got["n"]["max"], got["n"]["avg"], got["n"]["approx_unique"], got["n"]["q50"]) == ("1", "3", 2.0, 2, 1.0)
    assert got["s"]["null_percentage"] == 50 and got["s"]["avg"] is None and got["s"]["count"] == 2


def test_chart_aggregate(spark):
    df = spark.createDataFrame([("a", "1", 1), ("a", "x", 2), ("a", "3", 3), ("b", "x", 4), (None, "9", 5)], "g string, v string, n int")
    assert rows(e.chart_aggregate(df, "g", "v", "sum")) == [("a", 4.0), ("b", 0.0)]
    assert rows(e.chart_aggregate(df, "g", "v", "count")) == [("a", 3.0), ("b", 0.0)]
    assert rows(e.chart_aggregate(df, "g", "v", "avg")) == [("a", 2.0), ("b", 0.0)]
    assert rows(e.chart_aggregate(df, "g", "v", "first", ["n"])) == [("a", 1.0), ("b", 0.0)]
    assert [r["g"] for r in e.chart_transform(df, "g", "v", "max", ("v", True), 1).collect()] == ["a"]


def test_kpi(spark):
    df = spark.createDataFrame([(2, float("nan")), (1, 5.0), (3, 7.0), (0, None)], "n int, v double")
    assert [e.kpi(df, "v", how, ["n"]).first()[0] for how in ("count", "sum", "avg", "min", "max", "first")] == [4.0, 12.0, 6.0, 5.0, 7.0, 5.0]
    assert e.kpi(values(spark, [None]), "v", "sum").first()[0] is None


def test_sort_limit_and_pages(spark):
    df = values(spark, [2, None, 1, 3], "int")
    for descending, want in ((True, [3, 2, 1, None]), (False, [1, 2, 3, None])):
        assert [r[0] for r in e.sort_limit_nulls_last(df, "v", descending).collect()] == want
    assert e.sort_limit_nulls_last(df, "v", True, 0).count() == 1
    assert [r[0] for r in e.result_page(df, [F.asc_nulls_last("v")], 1, 2).collect()] == [2, 3]


def test_capped_result(spark):
    df = values(spark, [3, 1, 2], "int")
    assert [tuple(r) for r in e.capped_result(df, 2, [F.asc("v")]).collect()] == [(1, True), (2, True)]
    assert [tuple(r) for r in e.capped_result(df, 3, [F.asc("v")]).collect()] == [(1, False), (2, False), (3, False)]


def test_stacked_series(spark):
    df = spark.createDataFrame([("x", "b", 2), ("x", "a", 1), ("x", "a", None), ("y", "b", 5)], "x string, s string, v int")
    assert rows(e.stacked_series(df, "x", "s", "v", {"a": 1, "b": 2})) == [("x", "a", 1, 1), ("x", "b", 2, 3), ("y", "b", 5, 5)]


def test_global_text_filter(spark):
    df = spark.createDataFrame([(12, "Abc", None), (3, None, [1, 22]), (4, "z", None)], "n int, s string, a array<int>")
    assert rows(e.global_text_filter(df, "B"), "n") == [(12,)]
    assert rows(e.global_text_filter(df, "2"), "n") == [(12,), (3,)]
    assert e.global_text_filter(df, "nothing").count() == 0


def test_parameters_are_bound_not_spliced(spark):
    values(spark, ["it's", "x' or '1'='1"], "string").createOrReplaceTempView("texts")
    assert rows(e.parameterized_sql(spark, "select v from texts where v = :p", {"p": "x' or '1'='1"})) == [("x' or '1'='1",)]
    assert rows(e.parameterized_sql(spark, "select v from texts where v = :p", {"p": "it's"})) == [("it's",)]


def test_views_are_not_replaced(spark):
    e.create_view(values(spark, [1], "int"), "kept_view")
    with pytest.raises(Exception):
        e.create_view(values(spark, [2], "int"), "kept_view")
    assert rows(e.table_row_counts({"a": values(spark, [1, 2], "int"), "b": values(spark, [], "int")})) == [("a", 2), ("b", 0)]


def test_coverage(spark):
    left, right = one_row(values(spark, [1.0, 2.0]), total=F.count(F.lit(1))), one_row(values(spark, [1.0]), part=F.count("v"), none=F.count_if(F.col("v") > 9))
    got = coverage_mart(left, right, ratios={"r": ("part", "total"), "zero": ("part", "none")}).first().asDict()
    assert got == {"total": 2, "part": 1, "none": 0, "r": 0.5, "zero": None}
    with pytest.raises(Exception):
        side_by_side(left, values(spark, [1.0, 2.0])).collect()
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "x"), ("a", "x")], "p string, q string")
    assert df.agg(text_member_count("p", "q")).first()[0] == 2
    assert rows(column_coverage(df, ["p", "q"]), "column_name", "filled") == [("p", 4), ("q", 3)]


def test_dimensions(spark):
    known = spark.createDataFrame([(1, "one"), (2, "two")], "k int, name string")
    facts = spark.createDataFrame([(1,), (3,), (3,), (None,)], "fk int")
    got = d.inferred_members(known, facts, "k", "fk", {"name": F.concat(F.lit("Key "), F.col("fk").cast("string"))})
    assert rows(got) == [(1, "one"), (2, "two"), (3, "Key 3")]
    assert rows(d.inferred_members(known, facts, "k", "fk", {})) == [(1, "one"), (2, "two"), (3, None)]
    a = spark.createDataFrame([("USD", "b"), ("USD", "a"), (None, "x")], "c string, l string")
    assert rows(d.code_dimension([a, a], "c", "l", "PLN")) == [("PLN", None), ("USD", "a")]
    assert rows(d.code_dimension([a], "c", "l", "USD")) == [("USD", "a")]


def test_evidence_must_be_one_row(spark):
    facts = values(spark, [1.0, 2.0])
    one = spark.createDataFrame([("sha",)], "s string")
    assert rows(d.attach_evidence(facts, one, {"archive": "s"})) == [(1.0, "sha"), (2.0, "sha")]
    with pytest.raises(Exception):
        d.attach_evidence(facts, one.union(one), {"archive": "s"}).collect()


def test_role_parents_keep_every_active_parent(spark):
    people = spark.createDataFrame([("a",), ("b",)], "id string")
    rel = spark.createDataFrame([("a", "p", "D"), ("a", "q", "D"), ("a", "r", "U")], "c string, p string, k string")
    got = d.role_parents(people, rel, "id", "c", "p", {"direct": F.col("k") == "D", "ultimate": F.col("k") == "U"})
    assert rows(got) == [("a", "p", "r"), ("a", "q", "r"), ("b", None, None)]


def test_child_counts_and_spine(spark):
    import datetime as dt

    st = spark.createDataFrame([("s1", "A"), ("s2", None)], "k string, n string")
    se = spark.createDataFrame([("s1", "x"), ("s1", "x"), ("s1", "y"), ("zz", "q")], "k string, c string")
    assert rows(d.child_count_dimension(st, se, "k", "c", "n_children")) == [("s1", "A", 2), ("s2", None, 0)]
    days = spark.createDataFrame([(dt.date(2024, 2, 28),), (None,)], "x date"), spark.createDataFrame([(dt.date(2024, 3, 1),)], "y date")
    assert [r[0].day for r in d.date_spine(*days).orderBy("date_key").collect()] == [28, 29, 1]
