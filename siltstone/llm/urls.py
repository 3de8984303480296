"""URL filtering: a blocked Bloom filter in front of an exact join.

A list holds canonical prefixes: a host and the beginning of a path. A prefix fits its host and every
subdomain. Each url offers the keys (host suffix, path prefix) that could be listed; the filter, whose size
is fixed by the number of entries and bounded by ``MAX_BLOCKS``, lets few others pass; the join with the list
removes those. The longest fitting entry decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A block is 8 words of 32 bits; a key sets one bit in each.
WORDS = 8
KEYS_PER_BLOCK = 16
MAX_BLOCKS = 1 << 18  # 8 MiB


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _key(host: Column, path: Column) -> Column:
    return F.xxhash64(F.concat(host, F.lit("\n"), path))


def _masks(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each key, and its bit in every word of the block."""
    h = keys.view(np.uint64)
    block = ((h >> np.uint64(40)) % np.uint64(blocks)).astype(np.int64)
    bits = (h[:, None] >> np.arange(0, 5 * WORDS, 5, dtype=np.uint64)) & np.uint64(31)
    return block, np.uint32(1) << bits.astype(np.uint32)


def blocked_filter(keys: DataFrame, column: str = "key") -> np.ndarray:
    """The filter over 64-bit keys: words of a block are combined in Spark; the driver gets at most ``MAX_BLOCKS`` blocks."""
    n = keys.count()
    blocks = min(MAX_BLOCKS, max(1, -(-n // KEYS_PER_BLOCK)))

    def bits(batches):
        for batch in batches:
            block, mask = _masks(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), blocks)
            yield pa.RecordBatch.from_pydict({"block": block} | {f"w{i}": mask[:, i].astype(np.int64) for i in range(WORDS)})

    schema = "block long, " + ", ".join(f"w{i} long" for i in range(WORDS))
    rows = keys.select(column).mapInArrow(bits, schema).groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])
    table = np.zeros((blocks, WORDS), np.uint32)
    found = rows.toArrow()
    for i in range(WORDS):
        table[found["block"].to_numpy(), i] = found[f"w{i}"].to_numpy()
    return table


def may_contain(keys: Column, spark: SparkSession, table: np.ndarray) -> Column:
    """Whether the filter may hold a key: never false for a key that it holds."""
    shared = spark.sparkContext.broadcast(table)

    @F.arrow_udf("boolean")
    def probe(column: pa.Array) -> pa.Array:
        table = shared.value
        block, mask = _masks(column.to_numpy(zero_copy_only=False).astype(np.int64), len(table))
        return pa.array(((table[block] & mask) == mask).all(1))

    return probe(keys)


def listed(pages: DataFrame, entries: DataFrame, url: str = "url", otherwise: str = "allow") -> DataFrame:
    """The rows of ``pages`` with host, path, the entry that decides (``rule``) and ``verdict``.

    ``entries`` has host, path and verdict; entries with a null or empty host or a null path fit nothing, and of
    repeated entries the smallest verdict holds. A url without a fitting entry gets ``otherwise``. Null urls and
    urls without ``://`` have an empty host and path and fit nothing. Rows are kept one to one, repeated or not;
    columns of ``pages`` named host, path, rule or verdict are replaced.
    """
    spark = pages.sparkSession
    entries = (
        entries.where("host <> '' and path is not null")
        .groupBy(F.col("host").alias("entry_host"), F.col("path").alias("entry_path"))
        .agg(F.min("verdict").alias("entry_verdict"))
    )
    lengths = sorted(r[0] for r in entries.select(F.length("entry_path")).distinct().collect())  # one per length of a path
    table = blocked_filter(entries.select(_key(F.col("entry_host"), F.col("entry_path")).alias("key")))
    pages = pages.withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    parts = F.split(F.col("host"), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path")),
        lambda n: F.substring(F.col("path"), F.lit(1), n),
    )
    offered = (
        pages.select("host", "path")
        .where("host <> ''")
        .distinct()
        .withColumn("entry_host", F.explode(suffixes))
        .withColumn("entry_path", F.explode(prefixes))
        .withColumn("key", _key(F.col("entry_host"), F.col("entry_path")))
    )
    passed = offered.where(may_contain(F.col("key"), spark, table)).drop("key")
    size = F.struct(F.length("entry_host") + F.length("entry_path"), F.length("entry_host"))
    best = (
        passed.join(entries, ["entry_host", "entry_path"])
        .groupBy("host", "path")
        .agg(F.max_by(F.struct(F.concat("entry_host", "entry_path").alias("rule"), "entry_verdict"), size).alias("best"))
    )
    return (
        pages.drop("rule", "verdict")
        .join(best, ["host", "path"], "left")
        .select("*", F.col("best.rule").alias("rule"), F.coalesce("best.entry_verdict", F.lit(otherwise)).alias("verdict"))
        .drop("best")
    )
