"""Exact dedup against a persistent index of digests, bucketed and sorted by hash.

The index is a folder of Parquet files with one row for each distinct text ever added: digest, the id that stays, the batch that
brought it and its number of copies there. It is bucketed and sorted by the digest, so a batch meets it bucket by bucket:
the distinct digests of the batch are dealt to the same buckets, a sort-merge anti-join leaves the new ones, and these are
appended. What is stored is never shuffled again. Copies are folded before the shuffle, so a text that a third of all rows
share is one row in every join with the index; only the narrow rows (id, digest) meet their group at the end, in a join
whose hot keys adaptive execution splits.

Batches have names. A batch that runs again, say after it was lost between the append and its result, finds its own entries
and gives the same rows; it appends only what is missing. One batch is added at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.shared import stored
from siltstone.sources.scratch import scratch_path

#: Fixed value: what counts as white space.
SPACES = r"[\x20\x09-\x0D]+"
FIELDS = "digest binary, keep_id {id}, batch string, n long"


def normalised(text: Column) -> Column:
    """Every run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


@dataclass(frozen=True)
class DigestIndex:
    """An index in ``folder``, known to the session as the table ``name``; ``buckets`` belongs to the folder and never changes."""

    spark: SparkSession
    folder: str
    buckets: int
    name: str

    @staticmethod
    def open(spark: SparkSession, folder: str, buckets: int, id_type: str = "bigint") -> DigestIndex:
        """The index in a folder that all executors share, new or existing.

        ``buckets`` should give buckets of about 100 MB when the index is full (a row takes about 60 bytes).
        """
        name = f"digests_{uuid.uuid4().hex}"
        columns = FIELDS.format(id=id_type)
        spark.sql(f"create table {name} ({columns}) using parquet clustered by (digest) sorted by (digest) into {buckets} buckets location '{folder}'")
        return DigestIndex(spark, folder, buckets, name)

    def entries(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def dealt(self, groups: DataFrame) -> DataFrame:
        return groups.repartition(self.buckets, "digest")

    def unseen(self, groups: DataFrame) -> DataFrame:
        """Rows of ``groups`` (one per digest) whose digest the index lacks, by a sort-merge anti-join on the stored buckets."""
        return self.dealt(groups).hint("merge").join(self.entries().select("digest"), "digest", "left_anti")

    def append(self, groups: DataFrame) -> None:
        fields = groups.select("digest", "keep_id", "batch", "n")
        fields.sortWithinPartitions("digest").write.insertInto(self.name)

    def add(self, docs: DataFrame, batch: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """Add a batch; one row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

        Texts are equal when their normalised forms are; null counts as empty. Of the equal texts of a batch the smallest id stays,
        an id before none, and where a row repeats, one of its copies; a text that an earlier batch brought stays there,
        whatever the ids. ``group_size`` counts the rows of this batch. Very long texts are hashed whole in their task. An
        empty batch gives no rows and appends nothing; other columns of ``docs`` are not read, whatever their names.
        """
        rows = docs.select(F.col(doc_id).alias("doc_id"), digest(F.col(text)).alias("digest"))
        # tells repeated rows apart; fixed once stored
        rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "digests")
        order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row")
        groups = rows.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n"))
        groups = stored(groups.select("digest", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("first"), F.lit(batch).alias("batch"), "n"), "groups")
        self.append(self.unseen(groups))
        known = self.entries().select("digest", "keep_id", (F.col("batch") == batch).alias("own"))
        # stored, so the join with the rows has a shuffle of its own, whose hot partitions can be split
        groups = stored(self.dealt(groups.select("digest", "first", "n")).hint("merge").join(known, "digest"), "known")
        kept = F.col("own") & (F.col("row") == F.col("first"))
        found = rows.join(groups, "digest")
        return found.select("doc_id", "keep_id", F.col("n").alias("group_size"), kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def new_index(spark: SparkSession, id_type: str = "bigint") -> DigestIndex:
    """An empty index in the session's shared folder, with as many buckets as a shuffle has partitions."""
    return DigestIndex.open(spark, scratch_path(spark, "index"), int(spark.conf.get("spark.sql.shuffle.partitions")), id_type)
