"""A log of committed increments: tables of deltas in a shared folder.

Every increment is an epoch. It writes its rows to one folder per table and then commits with one small row; what an epoch wrote
before it was lost is never read. So an increment that fails, or is run twice at a time, leaves the state as it was.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


class EpochLog:
    """Tables of a folder, each with an ``epoch`` number that rises with every commit."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema("epoch long, folder string, tables array<string>").parquet(f"{self.folder}/commits")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def committed(self) -> list[tuple[int, str, list[str]]]:
        """Epoch, folder and tables of every increment: one short row each, few after ``compact``."""
        commits = self._commits()
        rows = [] if commits is None else [(r["epoch"], r["folder"], r["tables"]) for r in commits.collect()]
        bases = [e for e, f, _ in rows if f.startswith("base-")]
        since = max(bases, default=0)  # a base holds all that came before it
        return sorted(r for r in rows if r[0] >= since)

    def read(self, name: str, schema: str) -> DataFrame:
        """Committed rows of a table with their epoch; none if nothing was written yet."""
        paths = [f"{self.folder}/{folder}/{name}" for _, folder, tables in self.committed() if name in tables]
        full = f"{schema}, epoch long"
        if not paths:
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).parquet(*paths)

    def commit(self, tables: dict[str, DataFrame], base: bool = False) -> int:
        """Write the tables of one increment, then make them visible together; returns the epoch."""
        epoch = max((e for e, _, _ in self.committed()), default=0) + 1
        folder = f"{'base' if base else 'epoch'}-{epoch}-{uuid.uuid4().hex}"
        for name, df in tables.items():
            df.withColumn("epoch", F.lit(epoch).cast("long")).write.option("compression", "zstd").parquet(f"{self.folder}/{folder}/{name}")
        row = self.spark.createDataFrame([(epoch, folder, list(tables))], "epoch long, folder string, tables array<string>")
        row.coalesce(1).write.mode("append").parquet(f"{self.folder}/commits")
        return epoch
