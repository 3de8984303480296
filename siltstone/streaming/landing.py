"""Landing of new response files as they arrive.

The work is the batch work: inputs whose content is not represented yet are decoded and
appended. Structured Streaming only keeps track of which files were seen. Nothing here is
needed for correctness: replayed files carry known hashes and are skipped, and late
responses are ordered by their own sequence or retrieval time in the ledgers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from siltstone.operators.quality import pending_inputs


def land_new_files(
    spark: SparkSession,
    folder: str,
    schema: str,
    target: str,
    checkpoint: str,
    decode: Callable[[DataFrame], DataFrame],
    hash_column: str = "response_sha256",
) -> StreamingQuery:
    """Decode new newline-delimited JSON envelopes once and append them to ``target``.

    Returns the started query; it stops by itself when all present files are landed.
    ``decode`` must keep ``hash_column``.
    """

    def append(batch: DataFrame, number: int) -> None:
        fresh = batch.dropDuplicates([hash_column])
        try:
            landed = spark.read.parquet(target)
        except AnalysisException:  # the first batch finds no table
            landed = None
        if landed is not None:
            fresh = pending_inputs(fresh, landed, hash_column)
        decode(fresh).write.mode("append").option("compression", "zstd").parquet(target)

    return (
        spark.readStream.schema(schema)
        .json(folder)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
