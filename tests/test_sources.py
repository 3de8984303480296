from __future__ import annotations

import gzip
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from siltstone.plans import fx
from siltstone.sources import catalog, readers, scratch, writers
from siltstone.streaming.landing import land_new_files
from conftest import rows


def test_scratch_follows_the_session(spark):
    assert scratch.scratch_path(spark, "x").startswith(scratch.scratch_root(spark) + "/x-")
    assert scratch.scratch_path(spark, "x") != scratch.scratch_path(spark, "x")


def test_strict_csv_fails_on_a_bad_row(spark, tmp_path):
    (tmp_path / "ok.csv").write_text('a;b\n1;"x;y"\n')
    (tmp_path / "bad.csv").write_text("a;b\n1;2;3\n")
    (tmp_path / "head.csv").write_text("a;c\n1;2\n")
    assert rows(readers.read_csv_strict(spark, str(tmp_path / "ok.csv"), ["a", "b"])) == [("1", "x;y")]
    for name in ("bad", "head"):
        with pytest.raises(Exception):
            readers.read_csv_strict(spark, str(tmp_path / f"{name}.csv"), ["a", "b"]).collect()


def test_tolerant_csv_reports_what_it_skips(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,2\n3,4,5\n6\n")
    good, bad = readers.read_csv_tolerant(spark, str(tmp_path / "t.csv"), ["a", "b"])
    assert rows(good) == [("1", "2")]
    assert rows(bad, "bad_row") == [("3,4,5",), ("6",)]
    assert good.count() == 1 and bad.count() == 2


def test_typed_csv_without_quotes(spark, tmp_path):
    (tmp_path / "r.csv").write_text('WOJ;NAZWA;STAN_NA\n02;"A" B;2024-01-01\n')
    got = readers.read_csv_typed(spark, str(tmp_path / "r.csv"), "WOJ string, NAZWA string, STAN_NA date").first()
    assert got["NAZWA"] == '"A" B' and got["STAN_NA"].year == 2024


def test_union_by_name_and_fold(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Kod;Nazwa;Plec;Rok;Wartosc;Jednostka miary;Atrybut\n0200000;Dolny;kobiety;2020;"1 234,5";os.;\n0200000;Dolny;x;;9;os.;\n')
    (tmp_path / "b.csv").write_text("Nazwa;Kod;Wiek;Rok;Wartosc\n Gmina ;011201011024;0-4;2021 r.;-\n")
    df = readers.read_union_by_name(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    got = readers.fold_extra_columns(df, {"subgroup_id": F.lit("P1")})
    assert rows(got, "unit_id", "unit_name", "terc_code", "period_raw", "period_year", "val_numeric", "val_raw") == [
        ("011201011024", "Gmina", "1201011", "2021 r.", 2021, None, "-"), ("0200000", "Dolny", "0200000", "2020", 2020, 1234.5, "1 234,5"),
    ]
    extra = [json.loads(r[0]) for r in got.orderBy("period_year").select("dimensions_json").collect()]
    assert extra == [{"Plec": "kobiety", "Wiek": ""}, {"Plec": "", "Wiek": "0-4"}]


def test_drifted_nested_columns(spark, tmp_path):
    spark.sql("select 1 as d, array(named_struct('code', 'USD', 'mid', 4.1D)) as rates").write.parquet(str(tmp_path / "a"))
    spark.sql("select 2 as d, array(named_struct('code', 'EUR', 'mid', 4.3D, 'currency', 'euro')) as rates").write.parquet(str(tmp_path / "b"))
    spark.sql("select 3 as d, '[{\"code\":\"CHF\"}]' as rates").write.parquet(str(tmp_path / "c"))
    got = readers.scan_drifted_nested(spark, [str(tmp_path / n) for n in "abc"], ["rates"], "source_file")
    quotes = fx.legacy_quotes(got.selectExpr("date_add(date'2024-01-01', d) as effectiveDate", "rates as rates_json"), "A")
    assert rows(quotes, "currency", "code", "mid") == [("euro", "EUR", 4.3), (None, "CHF", None), (None, "USD", 4.1)]


def test_scan_parquet_unites_by_name(spark, tmp_path):
    spark.range(1).selectExpr("1 as a").write.parquet(str(tmp_path / "p" / "x=1"))
    spark.range(1).selectExpr("2 as b").write.parquet(str(tmp_path / "p" / "x=2"))
    assert rows(readers.scan_parquet(spark, str(tmp_path / "p"), file_column="f").select("a", "b", F.col("f").isNotNull())) == [(1, None, True), (None, 2, True)]


def test_inventory(spark, tmp_path):
    for name, body in (("b.bin", b"two"), ("a.bin", b"one")):
        (tmp_path / name).write_bytes(body)
    sha = {n: hashlib.sha256(b).hexdigest() for n, b in (("a.bin", b"one"), ("b.bin", b"two"))}
    files = readers.content_inventory(spark, str(tmp_path))
    assert rows(files) == [("a.bin", 3, sha["a.bin"]), ("b.bin", 3, sha["b.bin"])]
    got = readers.inventory_digest(files).first()
    assert got["inventory_sha256"] == hashlib.sha256(b"a.bin\nb.bin").hexdigest()
    assert got["content_inventory_sha256"] == hashlib.sha256(f"a.bin\0{sha['a.bin']}\nb.bin\0{sha['b.bin']}".encode()).hexdigest()


def test_long_files_are_streamed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "WHOLE_FILE", 20)
    noise = random.Random(1).randbytes(600_000)
    bodies = {"n.bin": noise, "l.bin": noise + b"\n", "m.bin": b"\xef\xbb\xbf" + noise, "b.txt": b"\xef\xbb\xbfa\r\n\n\nb\r\n" * 9 + b"\n", "z.bin": bytes(50_000), "f.txt": b"\n" * 30, "s": b"x", "a b.txt": b"x\n" * 20, "p.gz": gzip.compress(noise)}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    files = readers.content_inventory(spark, str(tmp_path))
    assert rows(files) == sorted((n, len(b), hashlib.sha256(b).hexdigest()) for n, b in bodies.items())
    held = readers._digests_of_long_files(spark, [str(tmp_path / "n.bin")])
    assert [r["content_sha256"] for r in held.collect()] == [hashlib.sha256(noise).hexdigest()]


def test_inventory_gate(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"one")
    files = readers.content_inventory(spark, str(tmp_path))
    readers.require_inventory(files, {"files": 1, "inventory_sha256": hashlib.sha256(b"a.bin").hexdigest()})
    with pytest.raises(ValueError, match="differs"):
        readers.require_inventory(files, {"files": 2})


def test_json_documents_and_first_row(spark, tmp_path):
    (tmp_path / "d.json").write_text('{\n "a": 1,\n "b": ["x"]\n}')
    assert readers.read_json_documents(spark, str(tmp_path / "d.json")).first().asDict() == {"a": 1, "b": ["x"]}
    df = spark.createDataFrame([("f", 2, "late"), ("f", 1, "early"), ("g", 5, "only")], "file string, n int, v string")
    assert rows(readers.first_data_row(df, "file", ["n"])) == [("f", 1, "early"), ("g", 5, "only")]


def test_sinks_keep_every_row(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "cast(id % 3 as string) as k", "cast(1995 + id % 20 as int) as y")
    part = writers.write_partitioned(df, str(tmp_path / "p"), "k", max_rows_per_file=100)
    assert rows(part.groupBy("k").count()) == rows(df.groupBy("k").count()) and part.where("cast(_part as string) <> k").count() == 0
    decades = writers.write_by_decade(df, str(tmp_path / "d"), "y", max_rows_per_file=200)
    assert rows(decades.groupBy("decade").count()) == [(1990, 250), (2000, 500), (2010, 250)]
    assert all(f.count() <= 200 for f in [spark.read.parquet(p) for p in decades.inputFiles()])
    assert writers.checked_count(writers.write_dataset(df, str(tmp_path / "w")), 1000, "w").count() == 1000
    with pytest.raises(ValueError, match="expected"):
        writers.checked_count(df, 999, "w")
    with pytest.raises(ValueError, match="empty"):
        writers.require_rows(df.where("id < 0"), "w")


def test_append_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_dataset(spark.sql("select 1 as k, 'a' as v"), path)
    incoming = spark.sql("select * from values (1, 'z'), (2, 'b'), (2, 'c') t(k, v)")
    assert tuple(writers.append_missing_keys(incoming, path, ["k"]).first()) == (1, 2, 3, 2, 0)
    assert tuple(writers.append_missing_keys(incoming, path, ["k"]).first()) == (3, 0, 3, 2, 0)
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "b"), (2, "c")]


def test_promotion_export_and_materialize(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    df = writers.write_dataset(spark.range(5).selectExpr("id", "id * 2 as x"), source)
    assert tuple(writers.promote_identity(spark, source, target).first()) == (5, 5, True)
    other = str(tmp_path / "other")
    spark.range(1).selectExpr("id as x").write.parquet(other)
    with pytest.raises(ValueError, match="schema"):
        writers.promote_identity(spark, source, other)
    assert spark.read.parquet(other).columns == ["x"]
    writers.export_result(df, str(tmp_path / "c"), "csv")
    assert readers.read_csv_text(spark, str(tmp_path / "c")).count() == 5
    with pytest.raises(ValueError):
        writers.export_result(df, str(tmp_path / "z"), "xlsx")
    assert catalog.materialize(df, "view") is df
    assert catalog.materialize(df, "table", str(tmp_path / "m")).count() == 5


def test_layers(spark, tmp_path):
    path = str(tmp_path / "q")
    writers.write_dataset(spark.sql("select 'USD' as code"), path)
    catalog.register_layer(spark, "02_bronze", {"quotes": path})
    assert rows(spark.sql("select code from `02_bronze`.`quotes`")) == [("USD",)]
    assert [t.count() for t in catalog.layer_tables(spark, "02_bronze").values()] == [1]
    wider = str(tmp_path / "w")
    writers.write_dataset(spark.sql("select 'EUR' as code, 2 as n"), wider)
    for _ in range(2):
        catalog.register_layer(spark, "02_bronze", {"many": [path, wider]})
        assert rows(spark.table("`02_bronze`.`many`"), "code", "n") == [("EUR", 2), ("USD", None)]
    assert sorted(catalog.layer_tables(spark, "02_bronze")) == ["many", "quotes"]


def test_imports(spark, tmp_path):
    (tmp_path / "i.csv").write_text("a|b\n1|x\n2\n")
    got = catalog.import_file(spark, str(tmp_path / "i.csv"), "csv", "imported_csv", delimiter="|")
    assert rows(got) == [(1, "x"), (2, None)]
    text = catalog.import_file(spark, str(tmp_path / "i.csv"), "csv", "imported_text", delimiter="|", all_text=True, columns=["a"])
    assert rows(text) == [("1",), ("2",)]
    stored = catalog.import_file(spark, str(tmp_path / "i.csv"), "csv", "imported_table", delimiter="|", as_view=False, table_path=str(tmp_path / "st"))
    assert stored.count() == 2 and spark.table("imported_table").count() == 2
    ragged = str(tmp_path / "r.csv")
    (tmp_path / "r.csv").write_text('a,b\n1,"x,y"\n2\n3,z,9\nq,"""w"\n4,v\n')
    schema = StructType.fromDDL("a int, b string")
    kept = catalog.import_file(spark, ragged, "csv", "ragged", schema=schema, ignore_errors=True)
    assert rows(kept) == [(1, "x,y"), (2, None), (4, "v")] and kept.count() == 3
    whole = catalog.import_file(spark, ragged, "csv", "ragged", schema=schema, ignore_errors=True, null_padding=False)
    assert rows(whole) == [(1, "x,y"), (4, "v")] and whole.count() == 2
    for padding in (True, False):
        with pytest.raises(Exception, match="row does not fit"):
            catalog.import_file(spark, ragged, "csv", "ragged", schema=schema, null_padding=padding).count()
    (tmp_path / "i.json").write_text('{"a": 1}\n{"a": 2}\n')
    assert catalog.import_file(spark, str(tmp_path / "i.json"), "json", "imported_json").count() == 2


def test_empty_table_keeps_its_schema(spark):
    assert readers.empty_with_schema(spark, "a int, b string").dtypes == [("a", "int"), ("b", "string")]


def envelope(number, sha, mid):
    body = [{"table": "A", "no": "1", "effectiveDate": "2024-01-02", "rates": [{"currency": "dollar", "code": "USD", "mid": mid}]}]
    return json.dumps(
        {
            "source_id": "nbp_exchange_rates_table_a", "batch_id": f"b{number}", "ingestion_sequence": number, "requested_start_date": "2024-01-01",
            "requested_end_date": "2024-01-03", "retrieved_at_utc": f"2024-01-0{number} 10:00:00", "response_sha256": sha, "raw_file_id": f"f{number}", "body_json": json.dumps(body),
        }
    )


def test_new_files_land_once(spark, tmp_path):
    folder, target = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    run = lambda: land_new_files(
        spark, str(folder), fx.ENVELOPE_SCHEMA, target, str(tmp_path / "cp"), lambda df: fx.bronze_quotes(df, "A")
    ).awaitTermination(120)
    (folder / "one.json").write_text(envelope(1, "s1", 4.0) + "\n")
    run()
    (folder / "two.json").write_text(envelope(2, "s2", 4.1) + "\n" + envelope(3, "s1", 4.0) + "\n")
    run()
    run()
    assert rows(spark.read.parquet(target), "ingestion_sequence", "mid") == [(1, 4.0), (2, 4.1)]


def test_short_rows_with_wrong_cells_do_not_fit(spark, tmp_path):
    (tmp_path / "w.csv").write_text('a,b,c\n1,2\nx,5\n,7\n3,"y"\n4\n"",8\n')
    schema = T.StructType([T.StructField(n, T.IntegerType()) for n in "abc"])
    kept = catalog.import_file(spark, str(tmp_path / "w.csv"), "csv", "wrong_cells", schema=schema, ignore_errors=True)
    assert rows(kept) == [(1, 2, None), (4, None, None), (None, 7, None), (None, 8, None)]
    with pytest.raises(Exception, match="row does not fit"):
        catalog.import_file(spark, str(tmp_path / "w.csv"), "csv", "wrong_cells", schema=schema).collect()
