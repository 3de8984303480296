"""Merkle manifest of a table: leaf coordinates by bitmap rank, levels reduced in keyed slot arrays.

A row's coordinate in its group is the number of rows with a smaller id. Ids are never sorted for that: every group has a bitmap
of its ids, cut into blocks of 512 bits of which only those with an id exist. Partial blocks are combined before the
shuffle by ``bit_or``. A popcount directory, a tree of radix 2**14 over the block numbers, says how many rows come before
a block, and a row adds the bits before its own. Where ids repeat, the block also counts the rows of every id.

The leaves of a group are dealt to slot arrays of 1,024 consecutive coordinates. An array places every digest at its slot and reduces
ten levels at once to one digest; these are the leaves of the next round, so a group needs one round for every ten
levels, whatever its size. The siblings of an array travel back down to it as one path, and a second pass over the leaf arrays
adds those inside, so no leaf's proof is ever stored or shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.shared import stored

BLOCK_BITS = 9
DIRECTORY_BITS = 14
#: Levels of the directory: together with a block they cover 64 bits.
DIRECTORIES = 4
LEVELS = 10
SLOTS = 1 << LEVELS
#: Parts of a repeated id's rows, by the first digits of their digest.
PREFIX = 3


def hashed(*parts: Column) -> Column:
    """SHA-256 of the concatenated parts, as lowercase hex."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def spelled(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return hashed(*map(spelled, fields))


def _before(counts: DataFrame, keys: list[str], at: str, level: int) -> DataFrame:
    """``counts`` (keys, at, n) with ``before``, the sum of n at smaller numbers; windows hold one directory node each."""
    if level == DIRECTORIES:
        inside = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    node = f"node{level}"
    counts = counts.withColumn(node, F.shiftright(at, DIRECTORY_BITS))
    inside = Window.partitionBy(*keys, node).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    nodes = counts.groupBy(*keys, node).agg(F.sum("n").alias("n"))
    nodes = _before(nodes, keys, node, level + 1).select(*keys, node, F.col("before").alias("outside"))
    joined = counts.join(nodes, [*keys, node])
    return joined.withColumn("before", F.col("outside") + F.col("within")).drop("outside", "within", node)


def bitmaps(rows: DataFrame) -> DataFrame:
    """One row per block of a group's bitmap: grp, block, eight words of 64 ids, rows ``n`` and those ``before``.

    ``rows`` has grp and id (never null). Combined in each task before the shuffle.
    """
    word = F.shiftright("id", 6).bitwiseAND(F.lit(7))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("id").bitwiseAND(F.lit(63)).cast("int"))
    blocks = rows.groupBy("grp", F.shiftright("id", BLOCK_BITS).alias("block")).agg(
        *[F.bit_or(F.when(word == i, bit).otherwise(F.lit(0))).alias(f"w{i}") for i in range(8)], F.count("*").alias("n")
    )
    return _before(blocks, ["grp"], "block", 1)


def _rank_in_block() -> Column:
    """Bits of the block before the row's own."""
    word, at = F.shiftright("id", 6).bitwiseAND(F.lit(7)), F.col("id").bitwiseAND(F.lit(63)).cast("int")
    own = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), at))
    rank = F.lit(0)
    for i in range(8):
        w = F.col(f"w{i}")
        rank = rank + F.bit_count(F.when(word > i, w).when(word == i, w.bitwiseAND(own)).otherwise(F.lit(0)))
    return rank.cast("long")


def _repeats(rows: DataFrame, uneven: DataFrame) -> DataFrame:
    """(grp, id, row, extra): for the rows of the blocks ``uneven``, in which ids repeat, what the bitmap's rank lacks.

    That is the number of further copies of smaller ids in the block, and the place among the rows of the same id, by digest and then by
    stored row. The rows of one id are counted by the first digits of their digest, then by digest, then by the part of the file
    they were stored from, so no window holds all rows of an id.
    """
    some = rows.select("grp", "id", "digest", "row").withColumn("block", F.shiftright("id", BLOCK_BITS)).join(uneven, ["grp", "block"])
    some = some.withColumn("prefix", F.substring("digest", 1, PREFIX)).withColumn("part", F.shiftright("row", 33))

    def before(keys: list[str], order: str) -> Column:
        line = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(line), F.lit(0))

    key = ["grp", "block", "id"]
    parts = some.groupBy(*key, "prefix", "digest", "part").agg(F.count("*").alias("n"))
    digests = parts.groupBy(*key, "prefix", "digest").agg(F.sum("n").alias("n"))
    prefixes = digests.groupBy(*key, "prefix").agg(F.sum("n").alias("n"))
    ids = prefixes.groupBy(*key).agg(F.sum("n").alias("n")).withColumn("n", F.col("n") - 1)
    ids = ids.select(*key, before(["grp", "block"], "id").alias("b0"))
    prefixes = prefixes.select(*key, "prefix", before(key, "prefix").alias("b1"))
    digests = digests.select(*key, "prefix", "digest", before([*key, "prefix"], "digest").alias("b2"))
    parts = parts.select(*key, "prefix", "digest", "part", before([*key, "prefix", "digest"], "part").alias("b3"))
    starts = parts.join(digests, [*key, "prefix", "digest"]).join(prefixes, [*key, "prefix"]).join(ids, key)
    starts = starts.withColumn("start", F.col("b0") + F.col("b1") + F.col("b2") + F.col("b3")).drop("b0", "b1", "b2", "b3")
    place = F.row_number().over(Window.partitionBy(*key, "digest", "part").orderBy("row")) - 1
    numbered = some.withColumn("place", place).join(starts, [*key, "prefix", "digest", "part"])
    return numbered.select("grp", "id", "row", (F.col("start") + F.col("place")).alias("extra"))


def coordinates(rows: DataFrame) -> DataFrame:
    """``rows`` (grp, id, digest, row, ..) with ``pos``, the place of the row in its group, from 0.

    Order is by id, then digest, then row, which must be unique. Hot ids are ranked in parts.
    """
    blocks = stored(bitmaps(rows), "bitmaps")
    joined = rows.withColumn("block", F.shiftright("id", BLOCK_BITS)).join(blocks.drop("n"), ["grp", "block"])
    ranked = joined.withColumn("pos", F.col("before") + _rank_in_block()).select(*rows.columns, "pos")
    bits = sum((F.bit_count(f"w{i}") for i in range(8)), F.lit(0))
    uneven = blocks.where(F.col("n") > bits).select("grp", "block")
    if uneven.isEmpty():  # ids are unique: nothing to add to the rank
        return ranked
    extra = stored(_repeats(rows, uneven), "repeats")
    return ranked.join(extra, ["grp", "id", "row"], "left").withColumn("pos", F.col("pos") + F.coalesce("extra", F.lit(0))).drop("extra")


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _levels(slots: pa.Table) -> list[list[str]]:
    """The digests of a slot array on every level, up to the one it reduces to."""
    total = slots["total"][0].as_py()
    levels = LEVELS if total > SLOTS else (total - 1).bit_length()
    nodes = [""] * len(slots)
    for at, digest in zip(slots["pos"].to_pylist(), slots["digest"].to_pylist(), strict=True):
        nodes[at & (SLOTS - 1)] = digest
    if "" in nodes:
        raise ValueError("coordinates are not unique and without gaps")
    out = [nodes]
    for _ in range(levels):
        nodes = [_hash("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def _siblings(levels: list[list[str]], slot: int) -> list[str]:
    """The sibling of a slot on each level below the last; empty where the node is alone."""
    return [nodes[(slot >> i) ^ 1] if (slot >> i) ^ 1 < len(nodes) else "" for i, nodes in enumerate(levels[:-1])]


def _folded(digest: str, at: int, siblings: list[str]) -> str:
    for other in siblings:
        digest = _hash(other + digest if at & 1 else digest + other)
        at >>= 1
    return digest


def _dealt(nodes: DataFrame) -> DataFrame:
    """Nodes (grp, pos, ..) with the number of their slot array and the ``total`` of their group."""
    totals = nodes.groupBy("grp").agg(F.count("*").alias("total"))
    return nodes.join(few(totals, "totals"), "grp").withColumn("array", F.shiftright("pos", LEVELS))


#: Groups up to which their small rows are sent to every task; beyond it, Spark joins by its own choice.
FEW = 10_000


def few(rows: DataFrame, label: str) -> DataFrame:
    """One narrow row per group, stored, and broadcast if counted to be at most ``FEW``."""
    rows = stored(rows, label)
    return F.broadcast(rows) if rows.count() <= FEW else rows


def tops(nodes: DataFrame) -> DataFrame:
    """One round: (grp, pos, digest) of what each slot array of ``nodes`` (grp, pos, digest, array, total) reduces to."""

    def reduced(key: tuple, slots: pa.Table) -> pa.Table:
        return pa.table({"grp": pa.array([key[0].as_py()], pa.string()), "pos": pa.array([key[1].as_py()], pa.int64()), "digest": [_levels(slots)[-1][0]]})

    return nodes.groupBy("grp", "array").applyInArrow(reduced, "grp string, pos long, digest string")


def paths(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (grp, pos, digest): (grp, pos, path) with the siblings of every node up to its root, and (grp, root).

    A path has an entry a level, empty where the node is alone. ``pos`` counts from 0 without gaps in every group.
    """

    def own(key: tuple, slots: pa.Table) -> pa.Table:
        levels = _levels(slots)
        path = [_siblings(levels, at & (SLOTS - 1)) for at in slots["pos"].to_pylist()]
        return pa.table({"grp": slots["grp"], "pos": slots["pos"], "path": pa.array(path, pa.list_(pa.string()))})

    dealt = _dealt(nodes)
    inside = dealt.groupBy("grp", "array").applyInArrow(own, "grp string, pos long, path array<string>")
    above = stored(tops(dealt), "tops")
    if above.where("pos > 0").isEmpty():
        return inside, above.select("grp", F.col("digest").alias("root"))
    further, roots = paths(above)
    further = further.select("grp", F.col("pos").alias("array"), F.col("path").alias("further"))
    whole = inside.withColumn("array", F.shiftright("pos", LEVELS)).join(further, ["grp", "array"])
    return whole.select("grp", "pos", F.concat("path", "further").alias("path")), roots


def manifest(rows: DataFrame, fields: Sequence[Column], group: str, doc_id: str, candidate: Column, tampered: Sequence[Column]) -> DataFrame:
    """One row per row of ``rows``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``fields`` make the leaf. Leaves are ordered by their integer id within a group, those without an id first, equal ids by leaf; repeated
    rows each have a leaf. Groups (null first, then bytewise; a window holds one row for each, so they must be kinds, not keys)
    have their subroots under the root. Where ``candidate`` holds, the leaf is made of the ``tampered`` fields and folded with
    the siblings of the original; ``verified`` says whether that gives the root. Null fields and empty texts are told apart; a
    very long text is hashed whole in its task; an empty table gives an empty result. Other columns are not read.
    """
    least = -(1 << 63)  # rows without an id share the place below all ids, with the smallest id itself
    key = F.when(F.col(doc_id).isNull(), F.lit(least)).otherwise(F.col(doc_id).cast("long"))
    named = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = rows.select(
        F.col(doc_id).alias("doc_id"),
        named.alias("grp"),
        key.alias("id"),
        leaf(fields).alias("digest"),
        F.when(candidate, leaf(tampered)).alias("other"),
        F.monotonically_increasing_id().alias("row"),
    )
    placed = stored(coordinates(stored(leaves, "leaves")).select("doc_id", "grp", "digest", "other", "pos"), "placed")
    dealt = _dealt(placed)
    arrays, roots = paths(stored(tops(dealt), "arrays"))
    groups = few(roots.withColumn("place", F.row_number().over(Window.orderBy("grp")).cast("long") - 1), "subroots")
    upper, whole = paths(groups.select(F.lit("").alias("grp"), F.col("place").alias("pos"), F.col("root").alias("digest")))
    top = whole.first()  # one row: the root
    upper = upper.select(F.col("pos").alias("place"), F.col("path").alias("upper"))
    above = few(groups.join(upper, "place").select("grp", F.col("root").alias("subroot"), "place", "upper"), "upper")
    arrays = stored(arrays.join(above, "grp").withColumn("root", F.lit(top["root"] if top else None).cast("string")), "paths")

    def proved(leaves: pa.Table, above: pa.Table) -> pa.Table:
        path, upper, place, subroot, root = (above[c][0].as_py() for c in ("path", "upper", "place", "subroot", "root"))
        levels = _levels(leaves)
        proof, again = [], []
        for at, digest, other in zip(leaves["pos"].to_pylist(), leaves["digest"].to_pylist(), leaves["other"].to_pylist(), strict=True):
            own = _siblings(levels, at & (SLOTS - 1)) + path
            proof.append(_hash("".join(own + upper)))
            again.append(_folded(_folded(other or digest, at, own), place, upper))
        n = len(leaves)
        columns = {"doc_id": leaves["doc_id"], "leaf": leaves["digest"], "subroot": [subroot] * n, "root": [root] * n, "proof_sha256": proof, "folded_root": again}
        return pa.table(columns | {"verified": [x == root for x in again]})

    kind = rows.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    above = arrays.withColumnRenamed("pos", "array")
    return dealt.groupBy("grp", "array").cogroup(above.groupBy("grp", "array")).applyInArrow(proved, schema)
