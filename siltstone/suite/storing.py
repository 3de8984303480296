"""Scans, imports, sinks, promotions: tables written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from siltstone.functions.text import recode
from siltstone.operators.decode import first_feature
from siltstone.sources.catalog import LAYERS, import_file, materialize, register_layer
from siltstone.sources.readers import (
    content_inventory,
    empty_with_schema,
    inventory_digest,
    read_csv_strict,
    read_csv_text,
    read_csv_tolerant,
    read_csv_typed,
    read_envelopes,
    read_json_documents,
    read_jsonl_lines,
    read_positional_csv,
    read_union_by_name,
    read_wide_tsv,
    scan_drifted_nested,
    scan_parquet,
)
from siltstone.sources.scratch import scratch_path
from siltstone.sources.writers import (
    append_missing_keys,
    export_result,
    promote_identity,
    write_by_decade,
    write_dataset,
    write_partitioned,
)
from siltstone.suite.registry import query, table


def _csv(df: DataFrame, label: str, header: bool = True, sep: str = ",", encoding: str = "UTF-8") -> str:
    path = scratch_path(df.sparkSession, label)
    df.write.options(header=header, sep=sep, quote='"', escape='"', encoding=encoding).csv(path)
    return path


@query("scan_parquet_with_file", "select 'lineitem.parquet' as source_file, count(*) as row_count, max(l_shipdate) as last_ship from lineitem")
def _scan_with_file(spark, folder):
    df = scan_parquet(spark, f"{folder}/lineitem.parquet", merge=False, file_column="path")
    return df.groupBy(F.regexp_extract("path", r"([^/]+\.parquet)", 1).alias("source_file")).agg(
        F.count(F.lit(1)).alias("row_count"), F.max("l_shipdate").alias("last_ship")
    )


@query(
    "scan_parquet_united",
    """
    select 'a' as source, o_orderkey as key, o_custkey as customer, cast(null as double) as price, null as status from orders where o_orderstatus = 'F'
    union all select 'b', o_orderkey, null, o_totalprice, o_orderstatus from orders where o_orderstatus <> 'F'
    union all select 'b', l_orderkey, null, null, l_returnflag from lineitem where l_linenumber = 1
    """,
)
def _scan_united(spark, folder):
    """Files of one folder with different columns, united by name."""
    path = scratch_path(spark, "united")
    orders, lines = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    orders.where("o_orderstatus = 'F'").selectExpr("o_orderkey as key", "o_custkey as customer").write.parquet(f"{path}/source=a/part=1")
    orders.where("o_orderstatus <> 'F'").selectExpr("o_orderkey as key", "o_totalprice as price", "o_orderstatus as status").write.parquet(f"{path}/source=b/part=1")
    lines.where("l_linenumber = 1").selectExpr("l_returnflag as status", "l_orderkey as key").write.parquet(f"{path}/source=b/part=2")
    df = scan_parquet(spark, path, file_column="path")
    return df.select(F.regexp_extract("path", "source=([a-z])", 1).alias("source"), "key", "customer", "price", "status")


@query(
    "scan_drifted_nested",
    """
    select o_orderkey, o_orderstatus as code, case when o_orderpriority = '1-URGENT' then null else o_orderpriority end as label, cast(o_custkey as varchar) as number from orders
    """,
)
def _drifted(spark, folder):
    orders = table(spark, folder, "orders")

    def nested(*fields):
        return F.array(F.struct(*fields)).alias("rates")

    code, number = F.col("o_orderstatus").alias("code"), F.col("o_custkey").alias("number")
    old, new = scratch_path(spark, "drift-old"), scratch_path(spark, "drift-new")
    orders.where("o_orderpriority = '1-URGENT'").select("o_orderkey", nested(code, number)).write.parquet(old)
    orders.where("o_orderpriority <> '1-URGENT'").select(
        nested(code, F.col("o_orderpriority").alias("label"), number.cast("string").alias("number")), "o_orderkey"
    ).write.parquet(new)
    scanned = scan_drifted_nested(spark, [old, new], ["rates"])
    rates = F.from_json("rates", "array<map<string,string>>")
    return scanned.select("o_orderkey", *[first_feature(rates, k).alias(k) for k in ("code", "label", "number")])


@query("scan_csv_text", "select cast(c_custkey as varchar) as c_custkey, c_name, '\"quoted\", ' || c_mktsegment as note from customer")
def _csv_text(spark, folder):
    df = table(spark, folder, "customer").select("c_custkey", "c_name", F.concat(F.lit('"quoted", '), "c_mktsegment").alias("note"))
    return read_csv_text(spark, _csv(df, "csv-text"))


@query("csv_typed", "select s_suppkey, s_name, s_nationkey, cast('2024-01-01' as date) as day from supplier")
def _csv_typed(spark, folder):
    df = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey", F.lit("2024-01-01").alias("day"))
    return read_csv_typed(spark, _csv(df, "csv-typed", sep=";"), "s_suppkey bigint, s_name string, s_nationkey int, day date")


@query("read_envelopes", "select cast(o_orderkey as varchar) as batch_id, o_custkey as sequence, o_orderstatus as body_json from orders")
def _envelopes(spark, folder):
    path = scratch_path(spark, "envelopes")
    orders = table(spark, folder, "orders")
    orders.select(F.col("o_orderkey").cast("string").alias("batch_id"), F.col("o_custkey").alias("sequence"), F.col("o_orderstatus").alias("body_json")).write.json(path)
    return read_envelopes(spark, path, "batch_id string, sequence bigint, body_json string")


@query("json_documents", "select o_custkey, count(*) as orders, cast(sum(o_orderkey) as bigint) as keys from orders group by 1")
def _json_documents(spark, folder):
    """Documents with an array of rows inside, types found by reading."""
    path = scratch_path(spark, "documents")
    rows = F.collect_list(F.struct(F.col("o_orderkey").alias("key"), "o_orderstatus"))
    table(spark, folder, "orders").groupBy("o_custkey").agg(rows.alias("rows")).write.json(path)
    documents = read_json_documents(spark, path, lines=True).select("o_custkey", F.explode("rows").alias("r"))
    return documents.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.sum("r.key").alias("keys"))


@query("jsonl_lines", "select cast(o_orderkey as varchar) as key, o_orderpriority as priority from orders where o_orderstatus = 'F'")
def _jsonl_lines(spark, folder):
    path = scratch_path(spark, "jsonl")
    table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus").write.json(path)
    lines = read_jsonl_lines(spark, path)
    fields = {c: F.get_json_object("line", f"$.{c}") for c in ("o_orderkey", "o_orderpriority", "o_orderstatus")}
    return lines.where(fields["o_orderstatus"] == "F").select(fields["o_orderkey"].alias("key"), fields["o_orderpriority"].alias("priority"))


@query("csv_tolerant", "select cast(c_custkey as varchar) as id, c_name as name, c_mktsegment as segment from customer where c_nationkey <> 7")
def _csv_tolerant(spark, folder):
    path = scratch_path(spark, "csv-tolerant")
    extra = F.when(F.col("c_nationkey") == 7, F.lit(",surplus,cells")).otherwise(F.lit(""))
    table(spark, folder, "customer").select(
        F.concat(F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment"), extra)
    ).write.text(path)
    return read_csv_tolerant(spark, path, ["id", "name", "segment"], header=False)[0]


@query("csv_tolerant_rejects", "select cast(c_custkey as varchar) as id, c_custkey || ',' || c_name || ',' || c_mktsegment || ',surplus' as bad_row from customer where c_nationkey = 7")
def _csv_rejects(spark, folder):
    path = scratch_path(spark, "csv-rejects")
    extra = F.when(F.col("c_nationkey") == 7, F.lit(",surplus")).otherwise(F.lit(""))
    table(spark, folder, "customer").select(
        F.concat(F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment"), extra)
    ).write.text(path)
    return read_csv_tolerant(spark, path, ["id", "name", "segment"], header=False)[1].select("id", "bad_row")


@query("csv_strict", "select cast(s_suppkey as varchar) as s_suppkey, s_name, cast(s_nationkey as varchar) as s_nationkey from supplier")
def _csv_strict(spark, folder):
    df = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return read_csv_strict(spark, _csv(df, "csv-strict", sep=";"), df.columns)


@query("csv_positional", "select cast(c_custkey as varchar) as station_code, 'Łódź ' || c_name as station_name, c_mktsegment as kind from customer")
def _csv_positional(spark, folder):
    # The bytes of ISO-8859-2, which Spark does not write, are those of this text in ISO-8859-1.
    name = recode(F.concat(F.lit("Łódź "), "c_name"), "ISO-8859-2", "ISO-8859-1")
    df = table(spark, folder, "customer").select("c_custkey", name, "c_nationkey", "c_mktsegment")
    path = _csv(df, "csv-positional", header=False, encoding="ISO-8859-1")
    return read_positional_csv(spark, path, {"station_code": 0, "station_name": 1, "kind": 3}).drop("raw_archive_file")


@query(
    "csv_union_by_name",
    """
    select cast(c_custkey as varchar) as id, c_name as name, c_mktsegment as segment, cast(null as varchar) as nation from customer
    union all select cast(s_suppkey as varchar), s_name, null, cast(s_nationkey as varchar) from supplier
    """,
)
def _csv_union(spark, folder):
    a = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, folder, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"))
    return read_union_by_name(spark, [_csv(a, "union-a", sep=";"), _csv(b, "union-b", sep=";")])


@query(
    "read_wide_tsv",
    """
    select 'A,' || o_orderstatus as series, cast(extract(year from o_orderdate) as varchar) as period_key, cast(count(*) as double) as value_numeric from orders group by all
    union all select 'B,' || l_returnflag, cast(extract(year from l_shipdate) as varchar), cast(count(*) as double) from lineitem group by all
    """,
)
def _wide_tsv_files(spark, folder):
    """Two gzip distributions with different dimensions and periods, decoded in one scan."""

    def distribution(name, code, column, day, dims):
        counted = table(spark, folder, name).groupBy(column, F.date_format(day, "yyyy").alias("y")).agg(F.count(F.lit(1)).alias("n"))
        years = [r[0] for r in counted.select("y").where("y is not null").distinct().orderBy("y").collect()]
        wide = counted.groupBy(column).pivot("y", years).agg(F.max("n"))
        line = F.concat_ws("\t", F.concat(F.lit(f"{code},"), column), *[F.coalesce(F.col(f"`{y}`").cast("string"), F.lit(":")) for y in years])
        head = spark.range(1).select(F.lit(dims + "\\TIME_PERIOD\t" + "\t".join(years)).alias("line"), F.lit(0).alias("o"))
        path = scratch_path(spark, f"tsv-{name}")
        rows = wide.select(line.alias("line"), F.lit(1).alias("o")).unionByName(head)
        rows.coalesce(1).sortWithinPartitions("o").select("line").write.option("compression", "gzip").text(path)
        return path

    paths = [
        distribution("orders", "A", "o_orderstatus", "o_orderdate", "freq,status"),
        distribution("lineitem", "B", "l_returnflag", "l_shipdate", "source,flag"),
    ]
    cells = read_wide_tsv(spark, paths).where("not is_missing")
    code = F.concat_ws(",", F.coalesce(F.try_element_at("dimensions", F.lit("freq")), F.try_element_at("dimensions", F.lit("source"))), F.coalesce(F.try_element_at("dimensions", F.lit("status")), F.try_element_at("dimensions", F.lit("flag"))))
    return cells.select(code.alias("series"), "period_key", "value_numeric")


@query("content_inventory")
def _inventory(spark, folder):
    """Every table file with its size and hash, and the digests of the ordered lists."""
    path = scratch_path(spark, "inventory")
    content_inventory(spark, f"{folder}/*.parquet").write.parquet(path)  # one short row a file, hashed once
    files = spark.read.parquet(path)
    digest = inventory_digest(files)
    return files.select("*", *[digest.select(c).scalar().alias(c) for c in ("inventory_sha256", "content_inventory_sha256")])


@query(
    "inventory_digest",
    """
    with parts as (select c_mktsegment, 'part-' || lpad(cast(c_nationkey as varchar), 3, '0') as name, sha256(cast(count(*) as varchar)) as content from customer group by c_mktsegment, c_nationkey)
    select c_mktsegment, count(*) as files, sha256(string_agg(name, chr(10) order by name)) as inventory_sha256,
           sha256(string_agg(name || chr(0) || content, chr(10) order by name)) as content_inventory_sha256
    from parts group by c_mktsegment
    """,
)
def _digest(spark, folder):
    """One part per segment and nation, so a list has as many entries as there are nations."""
    counted = table(spark, folder, "customer").groupBy("c_mktsegment", "c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    parts = counted.select(
        "c_mktsegment",
        F.concat(F.lit("part-"), F.lpad(F.col("c_nationkey").cast("string"), 3, "0")).alias("file_name"),
        F.sha2(F.col("n").cast("string"), 256).alias("content_sha256"),
    )
    return inventory_digest(parts, ["c_mktsegment"])


@query("import_file", "select c_custkey, c_name, c_acctbal from customer where c_nationkey = 3")
def _import(spark, folder):
    df = table(spark, folder, "customer")
    import_file(spark, _csv(df, "import"), "csv", "imported_customers", columns=["c_custkey", "c_name", "c_acctbal", "c_nationkey"])
    return spark.sql("select cast(c_custkey as bigint) as c_custkey, c_name, c_acctbal from imported_customers where c_nationkey = 3")


@query(
    "import_ragged_file",
    """
    select c_custkey, c_name, case when c_custkey % 3 = 1 then null else c_mktsegment end as c_mktsegment, 'padded' as kind from customer where c_custkey % 3 <> 2
    union all select c_custkey, c_name, c_mktsegment, 'strict' from customer where c_custkey % 3 = 0
    """,
)
def _import_ragged(spark, folder):
    """A third of the rows lacks a cell, a third has one too many."""
    row = F.concat_ws(",", F.col("c_custkey").cast("string"), F.concat(F.lit('"'), "c_name", F.lit(',"')))
    cells = F.when(F.col("c_custkey") % 3 == 1, row).when(F.col("c_custkey") % 3 == 0, F.concat_ws(",", row, "c_mktsegment")).otherwise(F.concat_ws(",", row, "c_mktsegment", F.lit("more")))
    path = scratch_path(spark, "ragged")
    table(spark, folder, "customer").select(cells).write.text(path)
    schema = StructType.fromDDL("c_custkey bigint, c_name string, c_mktsegment string")
    padded, strict = (
        import_file(spark, path, "csv", f"ragged_{p}", header=False, ignore_errors=True, null_padding=p, schema=schema).withColumn("kind", F.lit(k))
        for p, k in ((True, "padded"), (False, "strict"))
    )
    return padded.unionByName(strict).withColumn("c_name", F.rtrim("c_name", F.lit(",")))


@query("register_layer", "select o_orderstatus, count(*) as orders from orders join customer on o_custkey = c_custkey group by 1")
def _register(spark, folder):
    register_layer(spark, LAYERS[3], {t: f"{folder}/{t}.parquet" for t in ("orders", "customer")})
    return spark.sql(
        "select o.o_orderstatus, count(*) as orders from `04_gold`.`orders` o join `04_gold`.`customer` c on o.o_custkey = c.c_custkey group by 1"
    )


@query(
    "sql_cte_query",
    """
    with big as (select o_custkey, o_orderkey, cast(o_orderdate as date) as day from orders where o_totalprice > 300000)
    select c_mktsegment, day, count(*) as orders from big join customer on o_custkey = c_custkey
    where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R') group by all
    """,
)
def _cte(spark, folder):
    register_layer(spark, LAYERS[2], {t: f"{folder}/{t}.parquet" for t in ("orders", "customer", "lineitem")})
    return spark.sql(
        """
        with big as (select o_custkey, o_orderkey, cast(o_orderdate as date) as day from `03_silver`.orders where o_totalprice > 300000)
        select c_mktsegment, day, count(*) as orders from big join `03_silver`.customer on o_custkey = c_custkey
        where o_orderkey in (select l_orderkey from `03_silver`.lineitem where l_returnflag = 'R') group by all
        """
    )


@query("write_dataset", "select * from orders")
def _write(spark, folder):
    return write_dataset(table(spark, folder, "orders"), scratch_path(spark, "dataset"), max_rows_per_file=1_000_000)


@query("materialize", "select o_custkey, count(*) as orders from orders group by 1")
def _materialize(spark, folder):
    counted = table(spark, folder, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    return materialize(materialize(counted, "view"), "table", scratch_path(spark, "model"))


@query("write_partitioned", "select *, l_returnflag as _part from lineitem")
def _write_partitioned(spark, folder):
    return write_partitioned(table(spark, folder, "lineitem"), scratch_path(spark, "by-flag"), "l_returnflag")


@query(
    "write_by_decade",
    "select l_orderkey, l_linenumber, l_partkey, cast(extract(year from l_shipdate) as integer) as ship_year, cast(floor(extract(year from l_shipdate) / 10.0) * 10 as integer) as decade from lineitem",
)
def _write_by_decade(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.year("l_shipdate").alias("ship_year"))
    return write_by_decade(lines, scratch_path(spark, "by-decade"), "ship_year")


@query("empty_with_schema", "select o_orderkey, o_totalprice from orders where false union all select o_orderkey, o_totalprice from orders")
def _empty(spark, folder):
    """An absent input stands in as an empty table and unites with what exists."""
    absent = empty_with_schema(spark, "o_orderkey bigint, o_totalprice double")
    return absent.unionByName(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"))


@query(
    "append_missing_keys",
    """
    with held as (select * from orders where o_orderstatus <> 'P'), fresh as (select * from orders where o_custkey not in (select o_custkey from held))
    select (select count(*) from held) as rows_before, (select count(*) from fresh) as rows_appended,
           (select count(*) from held) + (select count(*) from fresh) as rows_after, (select count(distinct o_custkey) from orders) as keys_after, cast(0 as bigint) as keys_missing
    """,
)
def _append(spark, folder):
    orders = table(spark, folder, "orders")
    path = scratch_path(spark, "append")
    write_dataset(orders.where("o_orderstatus <> 'P'"), path)
    return append_missing_keys(orders, path, ["o_custkey"])


@query("promote_identity", "select count(*) as source_rows, count(*) as target_rows, true as row_count_equal from customer")
def _promote(spark, folder):
    return promote_identity(spark, f"{folder}/customer.parquet", scratch_path(spark, "promoted"))


@query("export_result", "select o_orderpriority, cast(count(*) as bigint) as orders from orders group by 1")
def _export(spark, folder):
    path = scratch_path(spark, "export")
    export_result(table(spark, folder, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders")), path, "json")
    return spark.read.schema("o_orderpriority string, orders bigint").json(path)
