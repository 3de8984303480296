"""From documents to packed training sequences, in five stages.

Every stage works on what the one before it kept. Between stages the rows are written as Parquet to the shared folder and
read again. The first four return the columns of ``documents``; the last returns one row per packed piece.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import credentials, decontamination, packing, simhash, toxicity
from siltstone.llm.queries import vocabulary
from siltstone.llm.registry import table
from siltstone.llm.shared import ship, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold of their language."""
    ship(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score(model, docs, F.col("text")) < toxicity.threshold(model, F.col("lang")))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship(spark)
    return simhash.one_of_each_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    ship(spark)
    return docs.where(~decontamination.holds_item(docs, table(spark, sf_dir, "benchmark"), F.col("text")))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every reported span masked and n_chars counted anew where the text has changed."""
    ship(spark)
    masked = credentials.redacted(F.col("text"))
    # both columns are replaced in one projection, so no further name is needed
    held = docs.select(*[F.struct(masked.alias("text"), F.col("n_chars"), F.col("text").alias("before")).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
    length = F.when(F.col("text.text").eqNullSafe(F.col("text.before")), F.col("text.n_chars")).otherwise(F.char_length("text.text").cast("long"))
    return held.withColumns({"n_chars": length, "text": F.col("text.text")})


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    ship(spark)
    return packing.packed(docs, vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("near_duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: SQL cannot express the classifier; tests compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
