"""Digests: additive, order-free, exact about equality; differences by opening unequal buckets only."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest

from siltstone.operators.multisets import (
    SUMS,
    compare_datasets,
    digest_tree,
    located_differences,
    merged,
    multiset_digest,
    opened,
    unequal_buckets,
)
from siltstone.operators.quality import dataset_differences, dataset_equivalence
from conftest import rows

SCHEMA = "k string, v double, d date, m decimal(10,2), a array<int>"


def data(rng, n=300):
    return [
        (
            rng.choice(["a", "b", "", None, "{}"]), rng.choice([0.0, -0.0, 1.5, float("nan"), None]), rng.choice([dt.date(2024, 1, 1), None]),
            rng.choice([Decimal("1.10"), Decimal("0.00"), None]), rng.choice([[1, 2], [], None]),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equal_to_the_signed_count(spark, seed):
    rng = random.Random(seed)
    left = data(rng)
    right = left[:]
    rng.shuffle(right)
    if seed > 1:
        right = right[:-5] + data(rng, 7)
    a, b = spark.createDataFrame(left, SCHEMA).repartition(5), spark.createDataFrame(right, SCHEMA).coalesce(1)
    want = dataset_equivalence(a, b).first()
    got = compare_datasets(a, b, buckets=64).first()
    assert (got["left_rows"], got["right_rows"], got["equivalent"]) == (want["left_rows"], want["right_rows"], want["equivalent"])
    assert str(rows(located_differences(a, b, buckets=64))) == str(rows(dataset_differences(a, b)))  # as text: NaN is no equal of itself


def test_counts_repeats_and_tells_null_from_blank(spark):
    one = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    for other in ([("a",), ("a",), ("b",)], [("a",), ("b",)], [("a",), ("b",), (None,)], [("a",), ("b",), ("",)]):
        assert not compare_datasets(one, spark.createDataFrame(other, "k string")).first()["equivalent"]
    nothing = one.limit(0)
    assert tuple(compare_datasets(nothing, nothing).first()) == (0, 0, 0, True)
    assert not compare_datasets(one, nothing).first()["equivalent"]


def test_digests_add_up_and_trees_sum(spark):
    df = spark.createDataFrame(data(random.Random(5)), SCHEMA)
    columns = df.columns
    parts = multiset_digest(df, columns, by=["k"], buckets=32)
    whole = multiset_digest(df, columns, buckets=32)
    assert rows(merged(parts), "bucket", "n", *SUMS) == rows(whole, "bucket", "n", *SUMS)
    tree = digest_tree(whole, buckets=32, fanout=4)
    assert [tree.where(f"level = {i}").count() for i in range(4)][1:] == [8, 2, 1]
    root = tree.where("level = 3").first()
    assert root["n"] == 300
    assert all(root[s] == sum(r[s] for r in whole.collect()) for s in SUMS)


def test_only_unequal_buckets_are_opened(spark):
    left = spark.range(20_000).selectExpr("id", "id % 7 as g")
    right = left.where("id <> 77")
    digests = [multiset_digest(x, ["id", "g"], buckets=512) for x in (left, right)]
    wrong = unequal_buckets(*digests)
    assert wrong.count() == 1
    assert opened(left, ["id", "g"], wrong, 512).count() < 120
    assert rows(located_differences(left, right, buckets=512)) == [(77, 0, "left", 1)]


def test_rows_are_not_shuffled(spark):
    left = spark.range(1000).selectExpr("id", "id % 7 as g")
    plan = multiset_digest(left, ["id", "g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("partial_sum")


def test_a_hot_row(spark):
    left = spark.range(30_000).selectExpr("case when id % 3 = 0 then 'same' else concat('r', id) end as k")
    assert compare_datasets(left, left.orderBy("k")).first()["equivalent"]
    assert rows(located_differences(left, left.unionByName(left.where("k = 'same'")))) == [("same", "right", 10_000)]


def test_a_kept_digest_is_read_not_computed_again(spark):
    from siltstone.operators.multisets import digest_equivalence, kept_digest

    df = spark.range(50).selectExpr("id", "id % 3 as g")
    kept = kept_digest(df, ["id", "g"])
    assert "Range" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert tuple(digest_equivalence(kept, kept_digest(df.orderBy("g"), ["id", "g"])).first()) == (50, 50, 0, True)
