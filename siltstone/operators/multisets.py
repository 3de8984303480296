"""Multiset digests: datasets are compared without shuffling their rows.

Every row has a SHA-256 of its canonical record. Its 64-bit lanes are added up, so a digest does not depend on order, partitions
or file layout, counts repeated rows, and adds under union. Rows are dealt to buckets by their hash; the digests of the buckets
are the leaves of a tree whose nodes are the sums of their children. A scan gives one small row per bucket, combined before the
shuffle. Digests can be kept: a replay, a copy or another day's files are compared with what was recorded, and of two datasets that
differ only the rows in unequal buckets are opened.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from siltstone.functions.records import canonical_json
from siltstone.operators.quality import business_columns, dataset_differences
from siltstone.sources.scratch import scratch_root

#: 64-bit lanes of the row hash, each summed as two halves, so sums are exact up to 2 ** 31 rows a bucket.
LANES = 4
SUMS = tuple(f"s{i}{half}" for i in range(LANES) for half in ("h", "l"))
BUCKETS = 4096
FANOUT = 16


def _canonical(df: DataFrame, column: str) -> Column:
    """Values that are equal are spelled alike: zero has no sign."""
    value = F.col(f"`{column}`")
    return (value + F.lit(0).cast(df.schema[column].dataType)).alias(column) if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)) else value.alias(column)


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 of the canonical record, as hex. NULL, empty text and an absent member are told apart."""
    return F.sha2(canonical_json([_canonical(df, c) for c in columns]), 256)


def bucket_of(row: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(row), F.lit(buckets))


def multiset_digest(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """One row per bucket (and ``by``, such as the file) that has rows: ``n`` and the sums of the lanes.

    The digests of parts add up to the digest of the whole (``merged``).
    """
    named = [F.col(c) for c in by]
    hashed = df.select(*named, row_hash(df, columns).alias("_row")).withColumn("bucket", bucket_of(F.col("_row"), buckets))
    lanes = [F.xxhash64(F.substring("_row", 1 + 16 * i, 16)) for i in range(LANES)]
    halves = [half for lane in lanes for half in (F.shiftrightunsigned(lane, 32), lane.bitwiseAND(F.lit(0xFFFFFFFF)))]
    return hashed.groupBy(*by, "bucket").agg(F.count(F.lit(1)).alias("n"), *[F.sum(h).alias(s) for s, h in zip(SUMS, halves, strict=True)])


def kept_digest(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """A digest that is computed now and read from storage by all that compare with it."""
    scratch_root(df.sparkSession)
    return multiset_digest(df, columns, by, buckets).checkpoint()


def merged(digests: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Digest of the union of what the rows digest, per bucket."""
    return digests.groupBy(*by, "bucket").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in SUMS])


def digest_tree(digest: DataFrame, by: Sequence[str] = (), buckets: int = BUCKETS, fanout: int = FANOUT) -> DataFrame:
    """Nodes of the tree: ``level`` (0: buckets, the last: the root), ``node``, ``n`` and the sums.

    Works on the digest's rows only: at most ``buckets`` for each part.
    """
    level = digest.select(*by, F.lit(0).alias("level"), F.col("bucket").alias("node"), "n", *SUMS)
    out, size, number = level, buckets, 0
    while size > 1:
        size, number = -(-size // fanout), number + 1
        level = level.groupBy(*by, F.floor(F.col("node") / fanout).alias("node")).agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in SUMS])
        out = out.unionByName(level.withColumn("level", F.lit(number)))
    return out


def unequal_buckets(left: DataFrame, right: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Buckets (and parts) whose digests differ, with the number of rows on both sides."""
    key = [*by, "bucket"]
    net = left.select(*key, "n", *SUMS, F.lit(1).alias("_sign")).unionByName(right.select(*key, "n", *SUMS, F.lit(-1).alias("_sign")))
    sides = net.groupBy(*key).agg(
        F.sum(F.when(F.col("_sign") == 1, F.col("n")).otherwise(0)).alias("left_rows"),
        F.sum(F.when(F.col("_sign") == -1, F.col("n")).otherwise(0)).alias("right_rows"),
        *[F.sum(F.col(s) * F.col("_sign")).alias(s) for s in SUMS],
    )
    differs = F.col("left_rows") != F.col("right_rows")
    for s in SUMS:
        differs = differs | (F.col(s) != 0)
    return sides.where(differs).select(*key, "left_rows", "right_rows")


def digest_equivalence(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row that compares two digests: rows on both sides, buckets that differ, ``equivalent``."""
    wrong = unequal_buckets(left, right)
    totals = [F.coalesce(side.agg(F.sum("n").alias("n")).scalar(), F.lit(0)) for side in (left, right)]
    return wrong.agg(F.count(F.lit(1)).alias("unequal_buckets")).select(
        totals[0].alias("left_rows"), totals[1].alias("right_rows"), "unequal_buckets", (F.col("unequal_buckets") == 0).alias("equivalent")
    )


def compare_datasets(left: DataFrame, right: DataFrame, technical: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """Whether two datasets hold the same rows equally often: one scan each, no shuffle of rows."""
    columns = business_columns(left, right, technical)
    return digest_equivalence(*[kept_digest(side, columns, buckets=buckets) for side in (left, right)])


def opened(df: DataFrame, columns: Sequence[str], wrong: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``df`` in the buckets of ``wrong``; at most ``buckets`` short rows are broadcast."""
    tagged = df.withColumn("bucket", bucket_of(row_hash(df, columns), buckets))
    return tagged.join(F.broadcast(wrong.select("bucket")), "bucket", "left_semi").drop("bucket")


def located_differences(left: DataFrame, right: DataFrame, technical: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``dataset_differences``, opening unequal buckets only: rows in equal ones never leave their task."""
    columns = business_columns(left, right, technical)
    wrong = unequal_buckets(multiset_digest(left, columns, buckets=buckets), multiset_digest(right, columns, buckets=buckets))
    scratch_root(left.sparkSession)
    wrong = wrong.checkpoint()  # read by both sides, computed once
    sides = [opened(side.select(*columns), columns, wrong, buckets) for side in (left, right)]
    return dataset_differences(*sides)
