"""Sinks, appends and promotions, each with its proof."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


def write_dataset(df: DataFrame, path: str, mode: str = "overwrite", max_rows_per_file: int = 0) -> DataFrame:
    """Parquet with zstd; returns the written table."""
    df.write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", max_rows_per_file).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_partitioned(df: DataFrame, path: str, key: str, mode: str = "overwrite", max_rows_per_file: int = 5_000_000) -> DataFrame:
    """One folder per key value, the key also kept inside the data.

    ``rebalance`` groups rows by key for few files per folder; adaptive execution merges
    small groups and splits large ones, so a key with a third of all rows is written by
    many tasks.
    """
    spread = df.withColumn("_part", F.col(key)).hint("rebalance", "_part")
    spread.write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", max_rows_per_file).partitionBy("_part").parquet(path)
    # The declared schema keeps folder names from being read as numbers ("02" is no 2).
    return df.sparkSession.read.schema(spread.schema).parquet(path)


def write_by_decade(
    df: DataFrame, path: str, year: str, mode: str = "overwrite", max_rows_per_file: int = 5_000_000
) -> DataFrame:
    """One folder per decade of a year column; files inside cover narrow year ranges.

    Crowded decades are split by size, rows are sorted by year inside each task, and files
    are cut at ``max_rows_per_file``.
    """
    decade = (F.floor(F.col(year) / 10) * 10).cast("int")
    ranged = df.withColumn("decade", decade).hint("rebalance", "decade").sortWithinPartitions("decade", year)
    ranged.write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", max_rows_per_file).partitionBy("decade").parquet(path)
    return df.sparkSession.read.schema(ranged.schema).parquet(path)


def export_result(df: DataFrame, path: str, fmt: str, single_file: bool = False) -> None:
    """A result as CSV (with header), JSON or Parquet.

    ``single_file`` writes one file from one task; it is for short results meant to be looked at.
    """
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "json":
        writer.json(path)
    elif fmt == "parquet":
        writer.option("compression", "zstd").parquet(path)
    else:
        raise ValueError(f"unknown export format {fmt!r}")


def append_missing_keys(incoming: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Append the rows whose key the table does not hold; running it again appends nothing.

    Returns one row of counts: what was there, what was appended, what is there now. The call fails if rows are gone
    or a key is still missing.
    """
    spark = incoming.sparkSession
    held = spark.read.parquet(path)
    before = held.count()
    fresh = incoming.join(held.select(*keys).distinct(), list(keys), "left_anti")
    fresh.write.mode("append").option("compression", "zstd").parquet(path)
    now = spark.read.parquet(path)
    after = now.agg(F.count(F.lit(1)).alias("rows_after"), F.count_distinct(F.struct(*keys)).alias("keys_after"))
    expected = incoming.select(*keys).distinct().join(now.select(*keys).distinct(), list(keys), "left_anti")
    counts = after.select(
        F.lit(before).cast("long").alias("rows_before"),
        (F.col("rows_after") - before).alias("rows_appended"),
        "rows_after",
        "keys_after",
        expected.agg(F.count(F.lit(1)).alias("n")).scalar().alias("keys_missing"),
    )
    found = counts.first()
    if found["rows_appended"] < 0 or found["keys_missing"]:
        raise ValueError(f"append does not add up: {found.asDict()}")
    return spark.createDataFrame([found], counts.schema)


def promote_identity(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copy a table to the next layer unchanged and prove the row count.

    A target of another schema is refused before anything is overwritten, and the call fails if the counts differ.
    """
    df = spark.read.parquet(source)
    try:
        there = spark.read.parquet(target).schema
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    else:
        if there.simpleString() != df.schema.simpleString():
            raise ValueError("promotion would change the schema of its target")
    df.write.mode("overwrite").option("compression", "zstd").parquet(target)
    copy = spark.read.parquet(target)
    counts = df.agg(F.count(F.lit(1)).alias("source_rows"))
    proof = counts.select(
        "source_rows", copy.agg(F.count(F.lit(1)).alias("n")).scalar().alias("target_rows")
    ).withColumn("row_count_equal", F.col("source_rows") == F.col("target_rows"))
    found = proof.first()
    if not found["row_count_equal"]:
        raise ValueError(f"promotion lost rows: {found.asDict()}")
    return spark.createDataFrame([found], proof.schema)


def require_rows(df: DataFrame, label: str) -> DataFrame:
    """Fail if a required dataset is empty."""
    if df.isEmpty():
        raise ValueError(f"required dataset {label!r} is empty")
    return df


def checked_count(written: DataFrame, expected: int, label: str) -> DataFrame:
    """Fail if a written dataset does not hold the expected number of rows."""
    got = written.count()
    if got != expected:
        raise ValueError(f"{label!r}: wrote {got} rows, expected {expected}")
    return written
