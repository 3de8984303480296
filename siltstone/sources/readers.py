"""File scans with the schema rules of each landing format."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from siltstone.functions.text import local_number, period_year, recode, territory_code, unit_code
from siltstone.operators.decode import decode_wide_tsv
from siltstone.sources.scratch import scratch_path

CORRUPT = "_corrupt_record"

# Encodings Spark reads itself.
SPARK_ENCODINGS = ("ISO-8859-1", "US-ASCII", "UTF-8", "UTF-16", "UTF-16BE", "UTF-16LE", "UTF-32")


def scan_parquet(spark: SparkSession, *paths: str, merge: bool = True, file_column: str | None = None) -> DataFrame:
    """Parquet files united by column name, with the source file name on request.

    ``merge=False`` skips reading every footer where all files share one schema.
    """
    df = spark.read.option("mergeSchema", merge).parquet(*paths)
    return df if file_column is None else df.withColumn(file_column, F.col("_metadata.file_path"))


def spread_scan(df: DataFrame) -> DataFrame:
    """Spread a plain scan over the cores if its files give fewer tasks than there are cores.

    For work that is heavy per row (decoding, sketches) behind files that do not split.
    Where the scan has tasks enough, as over many files, the frame is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def files_by_schema(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """Parquet files grouped by their schema; tasks read the footers.

    Where a store is one that only Spark reads, the driver asks for each schema.
    """
    groups: dict[str, list[str]] = {}
    if not all(urlparse(p).scheme in ("", "file", "s3", "gs", "hdfs") for p in paths):
        for path in paths:
            groups.setdefault(spark.read.parquet(path).schema.json(), []).append(path)
        return groups

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = []
            for path in batch.column(0).to_pylist():
                files, name = fs.FileSystem.from_uri(path)
                if files.get_file_info(name).type == fs.FileType.Directory:  # any of its files tells, as for Spark
                    parts = files.get_file_info(fs.FileSelector(name, recursive=True))
                    name = min(p.path for p in parts if p.type == fs.FileType.File and p.base_name[0] not in "_.")
                with files.open_input_file(name) as f:
                    schema = pq.read_schema(f)
                # what Spark recorded, where Spark wrote the file
                told.append((schema.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata") or schema.remove_metadata().serialize().to_pybytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(told, pa.binary())], ["path", "schema"])

    uris = spark.createDataFrame([(p if urlparse(p).scheme else f"file://{os.path.abspath(p)}", p) for p in paths], "uri string, path string")
    tasks = max(1, min(len(paths) // 16, spark.sparkContext.defaultParallelism * 4))
    told = uris.select("uri").repartition(tasks, "uri").mapInArrow(footers, "uri string, schema binary")
    grouped = told.join(uris, "uri").groupBy(F.sha2("schema", 256).alias("schema")).agg(F.collect_list("path").alias("paths")).collect()
    place = {p: i for i, p in enumerate(paths)}  # the list of files is the driver's already
    listed = [(sorted(r["paths"], key=place.__getitem__), r["schema"]) for r in grouped]
    return {schema: members for members, schema in sorted(listed, key=lambda g: place[g[0][0]])}


def scan_drifted_nested(spark: SparkSession, paths: Sequence[str], nested: Sequence[str], file_column: str | None = None) -> DataFrame:
    """Files whose nested columns differ in type, united after turning those columns to JSON text.

    Files that share a schema are scanned together, so the plan and the driver's calls grow with the number of schemas and
    not with the number of files.
    """
    groups = files_by_schema(spark, paths)
    branches = []
    for members in groups.values():
        df = spark.read.parquet(*members)
        extra = [] if file_column is None else [F.col("_metadata.file_path").alias(file_column)]
        branches.append(
            df.select(
                *[
                    (F.to_json(c, {"ignoreNullFields": "false"}) if not isinstance(df.schema[c].dataType, T.StringType) else F.col(c)).alias(c)
                    if c in nested
                    else F.col(c)
                    for c in df.columns
                ],
                *extra,
            )
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)


def read_envelopes(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Newline-delimited JSON with a declared schema; a broken line fails the scan."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_json_documents(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """JSON documents with an inferred schema: one object or array per file, or one document per line."""
    return spark.read.option("multiLine", not lines).json(path)


def read_csv_text(spark: SparkSession, path: str | Sequence[str], sep: str = ",", **options: str) -> DataFrame:
    """CSV with a header; every column stays text."""
    return spark.read.options(header=True, sep=sep, quote='"', escape='"', **options).csv(path)


def read_csv_typed(spark: SparkSession, path: str, schema: str, sep: str = ";") -> DataFrame:
    """CSV with fixed typed columns and no quoting."""
    return spark.read.schema(schema).options(header=True, sep=sep, quote="", mode="FAILFAST").csv(path)


def read_csv_strict(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], sep: str = ";") -> DataFrame:
    """All-text CSV with known columns; a row that does not fit fails the scan."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(schema).options(header=True, sep=sep, quote='"', escape='"', mode="FAILFAST", enforceSchema=False, columnPruning=False).csv(path)


def read_csv_tolerant(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], sep: str = ",", header: bool = True, **options: str
) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the columns, and the rows that do not (kept as evidence, never just lost)."""
    schema = ", ".join([*[f"`{c}` string" for c in columns], f"{CORRUPT} string"])
    rows = spark.read.schema(schema).options(
        header=header,
        sep=sep,
        quote='"',
        escape='"',
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT,
        columnPruning=False,
        **options,
    ).csv(path)
    # Spark refuses plans that read the reject column alone, as a bare count would.
    parsed = rows.where(F.length(F.coalesce(F.col(f"`{columns[0]}`"), F.lit(""))) >= 0)
    good = parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = parsed.where(F.col(CORRUPT).isNotNull()).select("*", F.col("_metadata.file_path").alias("source_file"))
    return good, bad.withColumnRenamed(CORRUPT, "bad_row")


def read_positional_csv(
    spark: SparkSession, path: str | Sequence[str], picks: Mapping[str, int], encoding: str = "ISO-8859-2", file_column: str = "raw_archive_file"
) -> DataFrame:
    """Headerless CSV in a legacy encoding; columns are picked by position."""
    width = max(picks.values()) + 1
    schema = ", ".join(f"c{i} string" for i in range(width))
    native = encoding.upper() in SPARK_ENCODINGS
    read_as = encoding if native else "ISO-8859-1"
    rows = spark.read.schema(schema).options(header=False, encoding=read_as, quote='"', escape='"', mode="PERMISSIVE").csv(path)
    return rows.select(
        *[(F.col(f"c{i}") if native else recode(f"c{i}", read_as, encoding)).alias(n) for n, i in picks.items()],
        F.col("_metadata.file_name").alias(file_column),
    )


def read_union_by_name(spark: SparkSession, paths: Sequence[str], sep: str = ";", file_column: str | None = None) -> DataFrame:
    """All-text CSV files with differing headers, united by column name.

    Files are grouped by header line, so there is one scan per distinct header.
    """
    heads = (
        spark.read.text(list(paths))
        .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("line"))
        .groupBy("path")
        .agg(F.min_by("value", F.struct("at", "line")).alias("head"))
        .groupBy("head")
        .agg(F.collect_list("path").alias("paths"))
        .collect()
    )
    branches = []
    for row in heads:
        df = read_csv_text(spark, row["paths"], sep)
        branches.append(df if file_column is None else df.withColumn(file_column, F.col("_metadata.file_name")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)


# Headings of the statistics archive files that become columns of their own.
STANDARD_HEADINGS = ("Kod", "Nazwa", "Rok", "Okres", "Wartosc", "Jednostka miary", "Atrybut")


def fold_extra_columns(df: DataFrame, constants: Mapping[str, Column], standard: Sequence[str] = STANDARD_HEADINGS, keep: Sequence[str] = ()) -> DataFrame:
    """Standard observation columns plus one JSON object of every other column.

    Columns are resolved from the frame itself. A missing standard column gives blank text;
    rows without a period are dropped where a period column exists.
    """
    def cell(name: str) -> Column:
        return F.trim(F.coalesce(F.col(f"`{name}`"), F.lit(""))) if name in df.columns else F.lit("")

    extra = [c for c in df.columns if c not in standard and c not in keep and c.strip()]
    folded = (
        F.to_json(F.struct(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in extra])) if extra else F.lit("{}")
    )
    period = next((p for p in ("Rok", "Okres") if p in df.columns), None)
    rows = df if period is None else df.where(cell(period) != "")
    return rows.select(
        *[c.alias(n) for n, c in constants.items()],
        unit_code(cell("Kod")).alias("unit_id"),
        cell("Nazwa").alias("unit_name"),
        territory_code(cell("Kod")).alias("terc_code"),
        cell(period or "").alias("period_raw"),
        (period_year(cell(period)) if period else F.lit(None).cast("int")).alias("period_year"),
        cell("Wartosc").alias("val_raw"),
        local_number(cell("Wartosc")).alias("val_numeric"),
        cell("Jednostka miary").alias("measure_unit"),
        cell("Atrybut").alias("attr_name"),
        folded.alias("dimensions_json"),
        *keep,
    )


def _per_split(side: DataFrame, scan: DataFrame, at_most: int = 10_000) -> DataFrame:
    """Broadcast a side that holds one short row per file split, while splits are few.

    Files and scan partitions are known to the driver before anything is read, and together
    they bound the number of splits.
    """
    splits = len(scan.inputFiles()) + scan.rdd.getNumPartitions()
    return F.broadcast(side) if splits <= at_most else side


def read_wide_tsv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Cells of wide TSV files (plain or gzip), each file decoded by its own header line.

    The header of a file is found by its marker, so a file may be split. Line numbers are
    exact: ids rise by one inside a split, and each split starts behind the lines of the
    splits before it. ``.gz`` files are not splittable: parallelism is the number of files,
    so the lines are spread before the cells explode.
    """
    lines = spark.read.text(path).select(
        F.regexp_replace("value", "^\ufeff", "").alias("line"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"),
    )
    is_header = F.upper(F.split("line", "\t")[0]).contains("\\TIME_PERIOD")
    before = Window.partitionBy("source_file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        lines.groupBy("source_file", "split")
        .agg(
            F.min("id").alias("first_id"),
            F.count(F.lit(1)).alias("n"),
            F.min_by("line", F.when(is_header, F.col("id"))).alias("head"),
        )
        .select(
            "source_file",
            "split",
            "first_id",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lines_before"),
            F.min("head").over(Window.partitionBy("source_file")).alias("header"),
        )
    )
    body = lines.where(~is_header & (F.col("line") != "")).repartition("line")
    numbered = body.join(_per_split(splits, lines), ["source_file", "split"]).withColumn(
        "line_number", F.col("lines_before") + F.col("id") - F.col("first_id") + 1
    )
    return decode_wide_tsv(numbered, "line", "header", ["source_file"], "line_number")


def read_jsonl_lines(spark: SparkSession, path: str) -> DataFrame:
    """Whole lines of JSONL, for one-pass typed extraction."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def attach_last(lines: DataFrame, marker: str, attached: str) -> DataFrame:
    """Every line with the last non-NULL ``marker`` at or before it in its file (columns source_file, split, id).

    Two levels: a pass over the lines gives one row a split, its last marker, and these are carried from split to split; then each
    scan task carries markers from line to line as it reads, without a shuffle, and takes the split's carry where it has
    met none. No line holds more than one marker, however many the file has.
    """
    known = F.when(F.col(marker).isNotNull(), F.col("id"))
    before = Window.partitionBy("source_file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        lines.groupBy("source_file", "split")
        .agg(F.max_by(marker, known).alias("_last"))
        .select("source_file", "split", F.last("_last", ignorenulls=True).over(before).alias("_carry"))
    )
    names = lines.columns
    place = {n: names.index(n) for n in (marker, "source_file", "split")}

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, split, held = None, None, None
        for batch in batches:
            if not len(batch):
                continue
            files, blocks, marks = (batch.column(place[n]) for n in ("source_file", "split", marker))
            changes = np.ones(len(batch), bool)
            changes[1:] = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1])).to_numpy(zero_copy_only=False)
            changes[0] = (files[0].as_py(), blocks[0].as_py()) != (file, split)
            at = np.arange(len(batch))
            begun = np.maximum.accumulate(np.where(changes, at, -1))
            seen = np.maximum.accumulate(np.where(marks.is_valid().to_numpy(zero_copy_only=False), at, -1))
            own = marks.take(pa.array(seen, mask=(seen < 0) | (seen < begun)))
            first = int(changes.argmax()) if changes.any() else len(batch)  # lines before it go on from the last batch
            if first and held is not None:
                own = pa.concat_arrays([pc.fill_null(own[:first], held), own[first:]])
            file, split, held = files[-1].as_py(), blocks[-1].as_py(), own[-1].as_py()
            yield pa.RecordBatch.from_arrays([*batch.columns, own], [*names, attached])

    schema = T.StructType([*lines.schema.fields, T.StructField(attached, lines.schema[marker].dataType)])
    local = lines.mapInArrow(carry, schema)
    carried = local.join(_per_split(splits, lines), ["source_file", "split"], "left")
    return carried.withColumn(attached, F.coalesce(attached, "_carry")).select(*names, attached)


#: Stands for the end of a section among the markers; no name holds it.
_CLOSED = "\0"


def read_sectioned_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines of a pretty-printed JSON file with the array section each one belongs to.

    Such files hold hundreds of millions of short lines in one document. Lines are scanned as splittable text, and every line
    takes the last section marker before it (``attach_last``).
    """
    opens = F.nullif(F.regexp_extract("value", r'^\s*"([^"]+)"\s*:\s*\[', 1), F.lit(""))
    header = F.when(F.col("value").rlike(r'^\s*"[^"]+"\s*:\s*\{'), F.regexp_extract("value", r'^\s*"([^"]+)"', 1))
    closes = F.col("value").rlike(r"^\s*[\]}]")
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"),
        F.coalesce(opens, header, F.when(closes, F.lit(_CLOSED))).alias("_mark"),
    )
    attached = attach_last(lines, "_mark", "section").where("_mark is null")
    at = F.struct(F.col("split").alias("b"), F.col("id").alias("i")).alias("at")
    return attached.select("source_file", "value", at, F.nullif("section", F.lit(_CLOSED)).alias("section"))


#: Bytes of the largest file that is hashed as one cell.
WHOLE_FILE = 32 << 20

# Endings that make Hadoop's line reader unpack a file.
PACKED = r"[.](gz|bz2|zst|snappy|lz4|deflate|passthrough)$"


def _digests_of_long_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """SHA-256 of files of any length: a task streams one file, in order, in batches of its lines.

    Lines are bytes up to a line feed, whatever the bytes mean, so memory follows the longest of them. The hash of a file is
    one chain, which no second task can share.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark, path = b"\xef\xbb\xbf", None  # the line reader leaves out this mark
        for batch in batches:
            if not len(batch):
                continue
            if path is None:
                path, size = batch.column(1)[0].as_py(), batch.column(2)[0].as_py()
                plain, marked, n = hashlib.sha256(), hashlib.sha256(mark), -1
            part = (b"" if n < 0 else b"\n") + b"\n".join(batch.column(0).to_pylist())
            n = max(n, 0) + len(part)
            plain.update(part)
            marked.update(part)
        if path is None:
            return
        if size - n in (1, 4):
            n += 1
            plain.update(b"\n")
            marked.update(b"\n")
        if size - n not in (0, 3):
            raise ValueError(f"{n} bytes read of {size}: {path}")
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([(plain if n == size else marked).hexdigest()])], ["path", "content_sha256"])

    out = scratch_path(spark, "file-digests")
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in held:
            spark.conf.set(k, str(1 << 60))  # no file is split, and none shares a task
        lines = spark.read.option("lineSep", "\n").text(list(paths))
        cells = lines.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
        cells.mapInArrow(hashed, "path string, content_sha256 string").write.parquet(out)
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    return spark.read.parquet(out)


def content_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Name, size and SHA-256 of every file.

    Long files are streamed and hashed at once; packed ones (``.gz`` and the like) are read as one cell, up to 2 GB.
    """
    files = spark.read.format("binaryFile")
    columns = [F.regexp_extract("path", "([^/]+)$", 1).alias("file_name"), F.col("length").alias("size_bytes")]
    content = F.sha2("content", 256).alias("content_sha256")
    long = files.load(path).where(F.col("length") > WHOLE_FILE).select("path", *columns, F.col("_metadata.file_path").alias("_uri"), F.lower("path").rlike(PACKED).alias("_packed"))
    listed = [(r["path"], r["_packed"]) for r in long.collect()]  # names of files alone
    packed, streamed = ([p for p, is_packed in listed if is_packed == kind] for kind in (True, False))
    # a bound on the length alone is known before a file is opened
    out = files.load(path).where(F.col("length") <= WHOLE_FILE).select(*columns, content)
    if packed:
        out = out.unionByName(files.load(packed).select(*columns, content))
    if streamed:
        digests = _digests_of_long_files(spark, streamed).withColumnRenamed("path", "_uri")
        out = out.unionByName(long.join(digests, "_uri").select(*out.columns))
    return out


def inventory_digest(inventory: DataFrame, by: Sequence[str] = (), name: str = "file_name", digest: str = "content_sha256") -> DataFrame:
    """Digest of the ordered name list and of the ordered (name, content hash) list.

    This is for lists of files, whose number is small beside their contents.
    """
    def listed(value: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_list(value)), "\n")

    with_content = F.concat(F.col(name), F.lit("\0"), F.col(digest))
    return inventory.groupBy(*by).agg(
        F.count(F.lit(1)).alias("files"),
        F.sha2(listed(F.col(name)), 256).alias("inventory_sha256"),
        F.sha2(listed(with_content), 256).alias("content_inventory_sha256"),
    )


def require_inventory(inventory: DataFrame, expected: Mapping[str, object]) -> None:
    """Fail unless the digests (and the number of files) are the recorded ones."""
    found = inventory_digest(inventory).first().asDict()
    wrong = {k: found.get(k) for k, v in expected.items() if found.get(k) != v}
    if wrong:
        raise ValueError(f"inventory differs from its record: {wrong}")


def first_data_row(df: DataFrame, file_column: str, position: Sequence[str]) -> DataFrame:
    """The first row of every file (key-value sheets that hold one record)."""
    packed = F.struct(*[c for c in df.columns if c != file_column])
    return df.groupBy(file_column).agg(F.min_by(packed, F.struct(*position)).alias("_row")).select(file_column, "_row.*")


def empty_with_schema(spark: SparkSession, schema: str) -> DataFrame:
    """A table without rows, for an absent input."""
    return spark.createDataFrame([], schema)
