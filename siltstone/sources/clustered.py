"""Tables clustered by key: bucketed and sorted files with Bloom filters, read by key without a shuffle.

Rows are dealt to slots, 31 bits of the hash of their first key column; a key's rows are spread over ``spread`` neighbouring slots, so a key that
holds a third of all rows is written and read by as many tasks. Files are bucketed by slot and sorted by the keys. A short key list is
pushed down: it selects buckets by slot, row groups by the bounds and Bloom filters of the first key, then rows. A long list is
joined bucket by bucket. In both cases the stored side has no exchange. The folder can be opened again by any session.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

SLOT = "_slot"
#: Keys that a list may have to be pushed down as literals.
FEW = 1000


@dataclass(frozen=True)
class ClusteredTable:
    """A table in ``folder``; ``keys``, ``buckets`` and ``spread`` belong to the folder and never change."""

    spark: SparkSession
    name: str
    columns: tuple[str, ...]
    keys: tuple[str, ...]
    buckets: int
    spread: int

    @staticmethod
    def open(spark: SparkSession, folder: str, schema: str | T.StructType, keys: Sequence[str], buckets: int, spread: int = 1, rows_per_bucket: int = 1_000_000) -> ClusteredTable:
        """The table in a shared folder, new or existing. ``rows_per_bucket`` sizes the Bloom filters."""
        fields = spark.createDataFrame([], schema).schema
        shown = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        name = f"clustered_{uuid.uuid4().hex}"
        options = {
            "compression": "zstd",
            "parquet.block.size": str(16 << 20),
            f"parquet.bloom.filter.enabled#{keys[0]}": "true",
            f"parquet.bloom.filter.expected.ndv#{keys[0]}": str(rows_per_bucket),
        }
        listed = ", ".join(f"'{k}' = '{v}'" for k, v in options.items())
        order = ", ".join(f"`{k}`" for k in (SLOT, *keys))
        spark.sql(
            f"create table {name} ({shown}, {SLOT} int) using parquet options ({listed}) "
            f"clustered by ({SLOT}) sorted by ({order}) into {buckets} buckets location '{folder}'"
        )
        return ClusteredTable(spark, name, tuple(fields.names), tuple(keys), buckets, spread)

    def _first_slot(self) -> Column:
        return F.pmod(F.xxhash64(self.keys[0]), F.lit((1 << 31) - 1 - self.spread)).cast("int")

    def _stored(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def append(self, df: DataFrame) -> None:
        """Add rows: one sorted file for each bucket that gets any."""
        turn = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in self.columns if not isinstance(df.schema[c].dataType, T.MapType)]), F.lit(self.spread)).cast("int")
        placed = df.select(*[F.col(f"`{c}`") for c in self.columns], (self._first_slot() + turn).alias(SLOT))
        placed.repartition(self.buckets, SLOT).sortWithinPartitions(SLOT, *self.keys).write.insertInto(self.name)

    def rows(self) -> DataFrame:
        return self._stored().drop(SLOT)

    def _slotted(self, listed: DataFrame) -> DataFrame:
        """Distinct keys of a list, each with all the slots its rows may be in; a key with a NULL is in no list."""
        keys = listed.select(*self.keys).dropna().distinct()
        first = self._first_slot()
        return keys.withColumn(SLOT, F.explode(F.sequence(first, first + (self.spread - 1))))

    def with_keys(self, listed: DataFrame) -> DataFrame:
        """The rows whose keys are in ``listed`` (columns ``keys``, repeated or not)."""
        wanted = self._slotted(listed)
        short = wanted.limit(FEW * self.spread + 1).collect()  # bounded; more keys than that are joined
        stored = self._stored()
        if len(short) > FEW * self.spread:
            return self._met(wanted, "left_semi").select(*self.columns)
        near = stored.where(F.col(SLOT).isin(sorted({r[SLOT] for r in short})) & F.col(self.keys[0]).isin([*{r[self.keys[0]] for r in short}]))
        if len(self.keys) == 1 or not short:
            return near.select(*self.columns)
        few = self.spark.createDataFrame([*{tuple(r[k] for k in self.keys) for r in short}], T.StructType([wanted.schema[k] for k in self.keys]))
        return near.join(F.broadcast(few), list(self.keys), "left_semi").select(*self.columns)

    def _met(self, other: DataFrame, how: str) -> DataFrame:
        """The stored rows joined with ``other`` (slotted) bucket by bucket.

        Slots alone are the join's key, as the buckets are; that makes the keys equal almost always, the rest is compared.
        """
        left, right = self._stored().alias("l"), other.repartition(self.buckets, SLOT).alias("r")
        same = F.col(f"l.{SLOT}") == F.col(f"r.{SLOT}")
        for k in self.keys:
            same = same & F.col(f"l.{k}").between(F.col(f"r.{k}"), F.col(f"r.{k}"))
        return left.join(right, same, how)

    def joined(self, other: DataFrame) -> DataFrame:
        """``other`` (inner) joined with the stored rows on the keys; only ``other`` is dealt anew, once for each slot of a key."""
        first = self._first_slot()
        slotted = other.withColumn(SLOT, F.explode(F.sequence(first, first + (self.spread - 1))))
        rest = [F.col(f"r.`{c}`") for c in other.columns if c not in self.keys]
        return self._met(slotted, "inner").select(*[F.col(f"l.`{c}`") for c in self.columns], *rest)
