"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import time
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from siltstone.sources.scratch import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again: cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()
#: Texts that travel to a Python worker at once, at most: whole documents are long.
BATCH_ROWS = 2000


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, as ``--py-files`` would.

    Nothing is sent where ``PYTHONPATH``, which the workers share, already names its folder. Larger Arrow batches of the
    session are cut down to ``BATCH_ROWS`` rows.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    known = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root in known or context.applicationId in _shipped:
        return
    folder = tempfile.mkdtemp(prefix="siltstone-")  # served to the executors while the application runs
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = shutil.make_archive(f"{folder}/siltstone-llm", "zip", root, "siltstone/llm")
    with zipfile.ZipFile(archive, "a") as z:
        for name in ("siltstone/__init__.py", "siltstone/sources/__init__.py", "siltstone/sources/scratch.py"):
            z.write(root / name, name)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of queries that have ended; it does so when the driver collects garbage.

    The second round finds what the first has let go of.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
