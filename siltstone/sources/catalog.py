"""Layer registration and user imports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from siltstone.sources.writers import write_dataset

# Layer names, also their public schema names.
LAYERS = ("01_landing", "02_bronze", "03_silver", "04_gold")


def register_layer(spark: SparkSession, layer: str, tables: Mapping[str, str | Sequence[str]]) -> dict[str, DataFrame]:
    """Make every table of a layer addressable as ```layer`.`table```.

    A file or folder is registered as an external table. Several files are one table over their union by name: a
    persistent view in the same database, so both kinds are named and listed alike.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
    out = {}
    for name, where in tables.items():
        full = f"`{layer}`.`{name}`"
        if spark.catalog.tableExists(full):
            kind = "VIEW" if spark.catalog.getTable(full).tableType == "VIEW" else "TABLE"
            spark.sql(f"DROP {kind} {full}")
        if isinstance(where, str):
            spark.catalog.createTable(full, path=where, source="parquet")
        else:
            wide = spark.read.option("mergeSchema", True).parquet(*where).schema
            parts = []
            for path in where:
                has = set(spark.read.parquet(path).columns)
                cells = ", ".join(f"`{f.name}`" if f.name in has else f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in wide.fields)
                parts.append(f"SELECT {cells} FROM parquet.`{path}`")
            spark.sql(f"CREATE VIEW {full} AS " + " UNION ALL ".join(parts))
        out[name] = spark.table(full)
    return out


def layer_tables(spark: SparkSession, layer: str) -> dict[str, DataFrame]:
    """The registered tables of a layer by name, for listings and row counts."""
    return {t.name: spark.table(f"`{layer}`.`{t.name}`") for t in spark.catalog.listTables(layer) if not t.isTemporary}


def layer_views(spark: SparkSession, layer: str, tables: Mapping[str, DataFrame]) -> None:
    """Session views ``layer__table`` over frames that are not materialised."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{layer}__{name}")


def import_file(
    spark: SparkSession,
    path: str,
    fmt: str,
    name: str,
    *,
    as_view: bool = True,
    columns: Sequence[str] | None = None,
    table_path: str | None = None,
    header: bool = True,
    delimiter: str = ",",
    all_text: bool = False,
    null_padding: bool = True,
    ignore_errors: bool = False,
    schema: StructType | None = None,
) -> DataFrame:
    """Load a user file (csv, json, parquet) as a view or as a stored table.

    Types of a CSV file are those of ``schema``, text (``all_text``), or found by reading the file once more. A row with too few
    cells is padded with NULL, or does not fit without ``null_padding``. Rows with too many cells, and cells that are not of
    their column's type, never fit. Rows that do not fit are left out with ``ignore_errors``; otherwise they fail the query
    that reads them.
    """
    if fmt == "csv":
        df = _read_csv(spark, path, header, delimiter, all_text, null_padding, ignore_errors, schema)
    elif fmt == "json":
        df = spark.read.option("mode", "DROPMALFORMED" if ignore_errors else "FAILFAST").json(path)
    elif fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"unknown import format {fmt!r}")
    if columns is not None:
        df = df.select(*columns)
    if not as_view:
        if table_path is None:
            raise ValueError("a stored import needs table_path")
        df = write_dataset(df, table_path)
    df.createOrReplaceTempView(name)
    return df


def _read_csv(
    spark: SparkSession, path: str, header: bool, delimiter: str, all_text: bool, null_padding: bool, ignore_errors: bool, schema: StructType | None
) -> DataFrame:
    options = dict(header=header, sep=delimiter, quote='"', escape='"')
    if schema is None:
        schema = spark.read.options(**options, inferSchema=not all_text).csv(path).schema
    bad = "_unfit_row"
    names = [f.name for f in schema.fields]
    df = spark.read.options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=bad).schema(StructType([*schema.fields, StructField(bad, StringType())])).csv(path)
    # Spark keeps the text of every row that does not match; only a short one may stay
    unquoted = F.regexp_replace(bad, r'"(?:[^"]|"")*"', "")
    short = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(delimiter), F.lit(""))) < len(delimiter) * (len(names) - 1)
    # of a short row the cells that are there must have been read
    texts = F.from_csv(bad, ", ".join(f"c{i} string" for i in range(len(names))), {k: str(v) for k, v in options.items() if k != "header"})
    read_whole = F.lit(True)
    for i, n in enumerate(names):
        read_whole = read_whole & (F.col(f"`{n}`").isNotNull() | (F.coalesce(texts[f"c{i}"], F.lit("")) == ""))
    fits = F.col(bad).isNull() | (short & read_whole) if null_padding else F.col(bad).isNull()
    # always true, but it reads the cells: Spark refuses a plan that needs nothing but the text of unfit rows
    read = F.length(F.concat_ws("", *[F.col(f"`{n}`").cast("string") for n in names])) >= 0
    wrong = F.raise_error(F.concat(F.lit("row does not fit: "), bad)).cast("boolean")
    return df.where(F.when(fits, read).otherwise(F.lit(False) if ignore_errors else wrong)).drop(bad)


def materialize(df: DataFrame, how: str, path: str | None = None) -> DataFrame:
    """Keep a model as a lazy view, or store it and read it back."""
    if how == "view":
        return df
    if how == "table" and path:
        return write_dataset(df, path)
    raise ValueError("materialize takes 'view', or 'table' with a path")
