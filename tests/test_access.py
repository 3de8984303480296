"""Clustered tables, keyset pages, bitmaps, sections, schema groups."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators.bitmaps import distinct_bitmaps, distinct_values, merged_bitmaps, value_numbers
from siltstone.operators.pages import By, keyset_page
from siltstone.sources import readers
from siltstone.sources.clustered import ClusteredTable
from conftest import rows


# --- clustered tables -------------------------------------------------------------------


def scanned(df):
    """Rows that the file scans of an executed query gave."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaves, out = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName().endswith("QueryStageExec"):
            continue
        metrics = leaf.metrics()
        if "Scan" in leaf.nodeName():
            out += metrics.apply("numOutputRows").value()
    return out


def test_a_short_list_reads_little(spark, tmp_path):
    df = spark.range(200_000).selectExpr("id * 3 as k", "cast(id % 5 as int) as j", "concat('v', id) as v")
    stored = ClusteredTable.open(spark, str(tmp_path / "t"), df.schema, ["k", "j"], buckets=32)
    stored.append(df)
    listed = spark.createDataFrame([(30, 0), (33, 1), (33, 4), (5, 0), (None, 1), (30, 0)], "k long, j int")
    found = stored.with_keys(listed)
    assert rows(found) == [(30, 0, "v10"), (33, 1, "v11")]
    assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    assert scanned(stored.with_keys(listed)) < 20_000  # two of 32 buckets at most
    again = ClusteredTable.open(spark, str(tmp_path / "t"), df.schema, ["k", "j"], buckets=32)
    assert rows(again.with_keys(listed)) == [(30, 0, "v10"), (33, 1, "v11")]
    assert stored.with_keys(listed.limit(0)).collect() == []


def test_a_long_list_leaves_the_stored_side_where_it_is(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("siltstone.sources.clustered.FEW", 5)
    df = spark.range(20_000).selectExpr("id as k", "id % 7 as g")
    stored = ClusteredTable.open(spark, str(tmp_path / "t"), df.schema, ["k"], buckets=8)
    stored.append(df.where("g < 4"))
    stored.append(df.where("g >= 4"))
    listed = df.where("k % 2 = 0").select("k")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = stored.with_keys(listed)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 10_000 and found.select(F.sum("k")).first()[0] == sum(range(0, 20_000, 2))
        joined = stored.joined(listed.withColumn("x", F.lit(1)))
        assert joined.count() == 10_000 and set(joined.columns) == {"k", "g", "x"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    left = plan[plan.index("SortMergeJoin") :].split("\n")
    stored_side = left[1 : next(i for i, line in enumerate(left) if "Bucketed: true" in line) + 1]
    assert not any("Exchange" in line for line in stored_side)


def test_a_hot_key_is_spread(spark, tmp_path):
    df = spark.range(30_000).selectExpr("case when id % 3 = 0 then -1 else id end as k", "id as v")
    stored = ClusteredTable.open(spark, str(tmp_path / "t"), df.schema, ["k"], buckets=16, spread=8)
    stored.append(df)
    largest = stored.rows().groupBy(F.col("_metadata.file_path")).count().agg(F.max("count")).first()[0]
    assert largest < 6500  # 10,000 rows of one key in several files
    assert stored.with_keys(spark.createDataFrame([(-1,), (7,)], "k long")).count() == 10_001


# --- pages ------------------------------------------------------------------------------


def paged(df, order, n):
    out, token = [], None
    while True:
        page, token = keyset_page(df, order, n, token)
        got = [tuple(r) for r in page.collect()]
        assert len(got) == n or token is None
        out.append(got)
        if token is None:
            return out


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("nulls_first", [False, True])
def test_pages_give_every_row_once(spark, descending, nulls_first):
    rng = random.Random(3)
    data = [
        (rng.choice(["a", "b", None]), rng.choice([1.5, float("nan"), 0.0, None]), rng.choice([dt.datetime(2024, 1, 1, 2, 3, 4, 567), None]), rng.choice([[1], [], None]), rng.choice([b"\x00\xff", None]))
        for _ in range(400)
    ]  # repeats in full
    df = spark.createDataFrame(data, "s string, v double, t timestamp, a array<int>, b binary").repartition(4)
    order = [By("s", descending, nulls_first), By("v", not descending, nulls_first)]
    pages = paged(df, order, 37)
    assert len(pages) == 11
    whole = df.orderBy(*[o.sort() for o in order], *[F.asc_nulls_last(c) for c in "tab"]).collect()
    assert [str(r) for page in pages for r in page] == [str(tuple(r)) for r in whole]


def test_pages_of_equal_rows(spark):
    df = spark.createDataFrame([(1,)] * 25 + [(0,)] * 3, "x int")
    assert [len(p) for p in paged(df, ["x"], 10)] == [10, 10, 8]
    assert paged(df.limit(0), ["x"], 10) == [[]]
    assert [len(p) for p in paged(df, ["x"], 28)] == [28]


@pytest.mark.parametrize("n", [150, 400])
def test_large_pages_stay_out_of_the_driver(spark, monkeypatch, n):
    monkeypatch.setattr("siltstone.operators.pages.SCREEN", 0, raising=False)
    rng = random.Random(5)
    cells = (["a", "b", None], [1.5, float("nan"), 0.0, None], [dt.datetime(2024, 1, 1, 2, 3, 4, 567), None], [[1], [], None])
    df = spark.createDataFrame([tuple(map(rng.choice, cells)) for _ in range(300)] + [("a", 1.5, None, [1])] * 100, "s string, v double, t timestamp, a array<int>").repartition(4)
    order = [By("s", True, True), By("v")]
    whole = [str(tuple(r)) for r in df.orderBy(*[o.sort() for o in order], F.asc_nulls_last("t"), F.asc_nulls_last("a")).collect()]
    most, collect, got, token = [0], type(df).collect, [], None

    def counted(self):
        found = collect(self)
        most[0] = max(most[0], len(found))
        return found

    while True:
        with monkeypatch.context() as patched:
            patched.setattr(type(df), "collect", counted)
            page, token = keyset_page(df, order, n, token)
        got.append([str(tuple(r)) for r in page.collect()])
        if token is None:
            break
    assert [r for page in got for r in page] == whole and all(len(page) == n for page in got[:-1]) and got[-1]
    assert most[0] <= 8  # sizes of the ranges and one key


def test_large_pages_of_equal_rows(spark, monkeypatch):
    monkeypatch.setattr("siltstone.operators.pages.SCREEN", 0)
    df = spark.createDataFrame([(1,)] * 25 + [(0,)] * 3, "x int")
    assert [len(p) for p in paged(df, ["x"], 10)] == [10, 10, 8]
    assert paged(df.limit(0), ["x"], 10) == [[]]


def test_a_token_fits_its_order_only(spark):
    df = spark.range(10).selectExpr("id", "id % 3 as g")
    _, token = keyset_page(df, ["g"], 4)
    with pytest.raises(ValueError, match="another order"):
        keyset_page(df, [By("g", descending=True)], 4, token)


def test_a_page_is_bounded_by_its_key(spark, tmp_path):
    spark.range(1000).selectExpr("id as k").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    from siltstone.operators.pages import at_or_behind

    plan = df.where(at_or_behind(df, [By("k")], ["990"]))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(k,990)" in plan or "GreaterThanOrEqual(k,990)" in plan


# --- bitmaps ----------------------------------------------------------------------------


def test_bitmaps_equal_distinct_counts(spark, monkeypatch):
    monkeypatch.setattr("siltstone.operators.bitmaps.PART", 500)
    rng = random.Random(2)
    data = [(rng.randrange(5), rng.choice("ab"), rng.choice([None, *[f"u{i}" for i in range(3000)]]) if i % 3 else "hot") for i in range(9000)] + [(9, "c", None)]
    df = spark.createDataFrame(data, "day int, g string, u string")
    known = value_numbers(df.where("day < 2"), "u")
    numbers = known.unionByName(value_numbers(df, "u", known))
    found = rows(numbers, "number")
    assert [n for (n,) in sorted(found)] == list(range(len(found)))
    assert numbers.select("value").distinct().count() == len(found)
    bitmaps = distinct_bitmaps(df, ["day", "g"], "u", numbers)
    for by in (["day", "g"], ["day"], ["g"], []):
        want = df.groupBy(*by).agg(F.count_distinct("u").alias("n")).where("n > 0")
        assert rows(distinct_values(bitmaps, by, "n")) == rows(want)
    parts = merged_bitmaps(bitmaps.where("day < 3"), ["g"]).unionByName(merged_bitmaps(bitmaps.where("day >= 3"), ["g"]))
    assert rows(distinct_values(parts, ["g"], "n")) == rows(distinct_values(bitmaps, ["g"], "n"))


# --- sections and schemas ---------------------------------------------------------------


def test_many_sections(spark, tmp_path):
    sections = 100_000
    lines = []
    for i in range(sections):
        lines += [f'  "s{i}": [', *[f"    {i}," for _ in range(i % 3)], "  ],", f"    {i}," if i % 50 == 0 else ""]
    (tmp_path / "f.json").write_text("{\n" + "\n".join(lines) + "\n}\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        attached = readers.read_sectioned_lines(spark, str(tmp_path / "f.json")).where("trim(value) not in ('', '{')")
        assert attached.rdd.getNumPartitions() > 20
        inside = F.col("section") == F.concat(F.lit("s"), F.regexp_extract("value", "([0-9]+)", 1))
        got = attached.agg(F.count(F.lit(1)), F.count_if(inside), F.count_if(F.col("section").isNull()), F.count_distinct("section")).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    held = sum(i % 3 for i in range(sections))
    assert tuple(got) == (held + sections // 50, held, sections // 50, sum(i % 3 > 0 for i in range(sections)))


def test_files_are_grouped_by_schema(spark, tmp_path):
    for i in range(12):
        kind = ("cast(id as int) as x", "id as x", "id as x, 'q' as y")[i % 3]
        spark.range(3).selectExpr(*kind.split(", ")).coalesce(1).write.parquet(str(tmp_path / f"f{i}"))
    paths = [str(tmp_path / f"f{i}") for i in range(12)]
    groups = list(readers.files_by_schema(spark, paths).values())
    assert groups == [paths[0::3], paths[1::3], paths[2::3]]
