"""Datasets compared by digests, and replays proved equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltstone.operators.multisets import compare_datasets, digest_equivalence, digest_tree, kept_digest, located_differences, merged, multiset_digest
from siltstone.plans import fx
from siltstone.sources.scratch import scratch_root
from siltstone.suite.pipelines import _QUOTES, _envelopes
from siltstone.suite.registry import query, table

_ORDERS = "select o_custkey, cast(o_orderdate as date) as day, o_orderstatus, o_orderpriority from orders"
#: The right side lacks the pending orders and holds some others twice.
_SIDES = f"""
    l as ({_ORDERS}),
    r as (select * from l where o_orderstatus <> 'P' union all select * from l where o_orderstatus = 'F' and o_orderpriority = '1-URGENT')
"""


def _sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    left = table(spark, folder, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day"), "o_orderstatus", "o_orderpriority")
    return left, left.where("o_orderstatus <> 'P'").unionByName(left.where("o_orderstatus = 'F' and o_orderpriority = '1-URGENT'"))


@query(
    "digest_equivalence",
    f"""
    with {_SIDES}
    select 'release' as comparison, (select count(*) from l) as left_rows, (select count(*) from r) as right_rows,
           not exists (select * from l except all select * from r) and not exists (select * from r except all select * from l) as equivalent
    union all select 'other order', count(*), count(*), true from l
    union all select 'without priority', (select count(*) from l), (select count(*) from r),
           not exists (select o_custkey, day, o_orderstatus from l except all select o_custkey, day, o_orderstatus from r)
    """,
)
def _equivalence(spark, folder):
    left, right = _sides(spark, folder)
    pairs = {"release": (left, right, []), "other order": (left, left.orderBy("day"), []), "without priority": (left, right, ["o_orderpriority"])}
    out = None
    for name, (a, b, technical) in pairs.items():
        found = compare_datasets(a, b, technical).select(F.lit(name).alias("comparison"), "left_rows", "right_rows", "equivalent")
        out = found if out is None else out.unionByName(found)
    return out


@query(
    "digest_differences",
    f"""
    with {_SIDES},
    counted as (select o_custkey, day, o_orderstatus, o_orderpriority, sum(s) as net from (select *, 1 as s from l union all select *, -1 from r) group by all)
    select o_custkey, day, o_orderstatus, o_orderpriority, case when net > 0 then 'left' else 'right' end as side, cast(abs(net) as bigint) as extra_rows
    from counted where net <> 0
    """,
)
def _differences(spark, folder):
    return located_differences(*_sides(spark, folder))


@query(
    "digest_tree",
    """
    select o_orderstatus, count(*) as row_count, true as parts_add_up, true as root_is_the_sum from orders group by o_orderstatus
    """,
)
def _tree(spark, folder):
    """The digests of the days of a status add up to that of the status, and a tree's root has all its rows."""
    orders = table(spark, folder, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]
    days = merged(multiset_digest(orders, columns, ["o_orderstatus", "day"], 256), ["o_orderstatus"])
    whole = multiset_digest(orders, columns, ["o_orderstatus"], 256)
    names = [c for c in whole.columns if c.startswith("s")]
    both = whole.withColumn("from_days", F.lit(0)).unionByName(days.withColumn("from_days", F.lit(1)))
    roots = digest_tree(both, ["o_orderstatus", "from_days"], 256).where("level = 2")
    sums = both.groupBy("o_orderstatus", "from_days").agg(F.struct(*[F.sum(s) for s in names]).alias("sums"))
    joined = roots.join(sums, ["o_orderstatus", "from_days"])
    return joined.groupBy("o_orderstatus").agg(
        F.max("n").alias("row_count"),
        (F.min(F.struct("n", *names)) == F.max(F.struct("n", *names))).alias("parts_add_up"),
        F.bool_and(F.struct(*names).cast(joined.schema["sums"].dataType) == F.col("sums")).alias("root_is_the_sum"),
    )


@query(
    "replay_determinism",
    f"""
    with {_QUOTES}
    select 'fact_fx_quotes' as dataset_id, 'replayed' as input, count(*) as row_count, true as equivalent from newest
    union all select 'fact_gold_prices', 'replayed', count(*), true from gold
    union all select 'fact_fx_quotes', 'one more correction', count(*), count(*) = 0 from newest
    union all select 'fact_gold_prices', 'one more correction', count(*), true from gold
    """,
)
def _replay(spark, folder):
    """Tables rebuilt from responses that come twice and in another order are equal; a correction is noticed."""
    envelopes = _envelopes(spark, folder)
    replayed = envelopes.unionByName(envelopes).repartition("response_sha256")
    last = envelopes.where(F.col("source_id") != fx.GOLD_SOURCE).orderBy(F.desc("ingestion_sequence")).limit(1)
    scratch_root(spark)
    last = last.checkpoint()  # one row, which every table of the corrected responses reads
    price = F.regexp_replace("body_json", r'"(mid|bid)":', '"$1":1')
    corrected = envelopes.unionByName(
        last.withColumns({"ingestion_sequence": F.col("ingestion_sequence") + 1, "batch_id": F.concat("batch_id", F.lit("x")), "response_sha256": F.md5("batch_id"), "body_json": price})
    )

    def tables(rows):
        return {
            "fact_fx_quotes": fx.fact_fx_quotes(*[fx.current_quotes(fx.bronze_quotes(rows, t), t) for t in fx.QUOTE_SOURCES]),
            "fact_gold_prices": fx.fact_gold_prices(fx.current_gold(fx.bronze_gold(rows))),
        }

    first, out = {k: (df.columns, kept_digest(df, df.columns)) for k, df in tables(envelopes).items()}, None
    for name, rows in (("replayed", replayed), ("one more correction", corrected)):
        for dataset, df in tables(rows).items():
            columns, recorded = first[dataset]
            found = digest_equivalence(recorded, kept_digest(df, columns)).select(F.lit(dataset).alias("dataset_id"), F.lit(name).alias("input"), F.col("left_rows").alias("row_count"), "equivalent")
            out = found if out is None else out.unionByName(found)
    return out
