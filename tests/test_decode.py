from __future__ import annotations

import gzip
import hashlib
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators import codes, decode, reshape
from siltstone.sources.readers import read_sectioned_lines, read_wide_tsv
from conftest import rows


def bodies(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, body string")


def test_two_level_envelopes(spark):
    text = json.dumps([{"no": "1", "rates": [{"code": "USD", "mid": 4.10}, {"code": "EUR"}]}, {"no": "2", "rates": []}, {"no": "3"}])
    got = decode.decode_envelopes(
        bodies(spark, text, "[]"), "body", "array<struct<no: string, rates: array<struct<code: string, mid: double>>>>",
        ["body", "item0.rates"], {"no": "item0.no", "code": "item1.code", "mid": "item1.mid"}, ["id"],
    )
    assert rows(got) == [(0, "1", "EUR", None), (0, "1", "USD", 4.1)]


def test_broken_envelope_fails(spark):
    with pytest.raises(Exception):
        decode.decode_envelopes(bodies(spark, "{oops"), "body", "array<struct<no: string>>", ["body"], {"no": "item0.no"}).collect()


def test_catalogue_and_detail(spark):
    page = json.dumps({"totalRecords": 7, "page": 0, "results": [{"id": "A", "children": ["x", "y"], "flag": True}, {"id": "B"}]})
    df = bodies(spark, page, json.dumps({"id": "C", "flag": False})).withColumn("kind", F.when(F.col("id") == 0, "list").otherwise("one"))
    got = decode.decode_catalogue_detail(
        df, "body", is_catalogue=F.col("kind") == "list", is_detail=F.col("kind") == "one", items="$.results",
        page_fields={"total": "bigint $.totalRecords"}, fields={"code": "string $.id", "children": "string $.children", "flag": "boolean $.flag"}, keep=["id"],
    )
    assert rows(got.drop("source_record_json")) == [
        (0, "catalogue", 7, "A", '["x","y"]', True), (0, "catalogue", 7, "B", None, None), (1, "detail", None, "C", None, False),
    ]


def cube(rng, list_index, sparse):
    dims = {"freq": 1, "unit": rng.randrange(1, 3), "geo": rng.randrange(1, 4), "time": rng.randrange(1, 5)}
    codes_of = {d: [f"{d[0].upper()}{i}" for i in range(n)] for d, n in dims.items()}
    total = 1
    for n in dims.values():
        total *= n
    cells = [rng.choice([None, 1, 2.5, -3]) for _ in range(total)]
    if sparse:
        value = {str(i): v for i, v in enumerate(cells) if v is not None}
        items = list(value.items())
        rng.shuffle(items)
        value = dict(items)
    else:
        value = cells
    status = {str(i): "p" for i in range(total) if rng.random() < 0.3}
    doc = {
        "version": "2.0", "class": "dataset", "label": "L", "updated": "2024-01-01T00:00:00Z", "id": list(dims), "size": list(dims.values()), "value": value,
        "dimension": {d: {"category": {"index": c if list_index else {k: i for i, k in enumerate(c)}}} for d, c in codes_of.items()},
    }
    if status or rng.random() < 0.5:
        doc["status"] = status
    want = []
    for pos, combo in enumerate(itertools.product(*codes_of.values())):
        key = dict(zip(dims, combo))
        text = json.dumps(key, sort_keys=True, separators=(",", ":"))
        want.append((pos, text, hashlib.sha256(text.encode()).hexdigest(), None if cells[pos] is None else float(cells[pos]), status.get(str(pos)), cells[pos] is None))
    return json.dumps(doc), want


@pytest.mark.parametrize("list_index", [True, False])
@pytest.mark.parametrize("sparse", [True, False])
def test_cube_cells_in_row_major_order(spark, list_index, sparse):
    rng = random.Random(3)
    made = [cube(rng, list_index, sparse) for _ in range(6)]
    got = decode.decode_cube(bodies(spark, *[b for b, _ in made]), "body", ["id"])
    picked = got.select("id", "position", "dimension_key_json", "dimension_key_sha256", "value_numeric", "status_code", "is_missing").collect()
    assert sorted(map(tuple, picked)) == sorted((i, *w) for i, (_, want) in enumerate(made) for w in want)


def test_cube_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(decode, "CUBE_BLOCK", 5)
    made = [cube(random.Random(n), True, True) for n in range(4)]
    got = decode.decode_cube(bodies(spark, *[b for b, _ in made]), "body", ["id"]).select("id", "position", "dimension_key_json", "value_numeric").collect()
    assert sorted(map(tuple, got)) == sorted((i, w[0], w[1], w[3]) for i, (_, want) in enumerate(made) for w in want)


def test_step_into_keeps_the_rest_of_the_parent(spark):
    df = bodies(spark, json.dumps([{"no": "1", "rates": [{"code": "USD"}]}]))
    got = decode.decode_envelopes(df, "body", "array<struct<no: string, rates: array<struct<code: string>>>>", ["body", "item0.rates"], {"no": "item0.no", "code": "item1.code"})
    assert rows(got) == [("1", "USD")]
    only = decode.decode_envelopes(bodies(spark, '[{"rates":["a","b"]}]'), "body", "array<struct<rates: array<string>>>", ["body", "item0.rates"], {"v": "item1"})
    assert rows(only) == [("a",), ("b",)]


def test_cube_that_does_not_add_up_fails(spark):
    text, _ = cube(random.Random(1), True, False)
    doc = json.loads(text)
    doc["value"] = doc["value"] + [1]
    with pytest.raises(Exception, match="inconsistent statistical cube"):
        decode.decode_cube(bodies(spark, json.dumps(doc)), "body").collect()


def broken_cubes():
    base = {
        "version": "2.0", "class": "dataset", "label": "l", "updated": "u", "id": ["a", "b"], "size": [2, 2], "value": [1, 2, 3, 4],
        "dimension": {"a": {"category": {"index": {"p": 0, "q": 1}}}, "b": {"category": {"index": ["x", "y"]}}},
    }
    yield base, True
    yield {**base, "value": {}}, True
    yield {k: v for k, v in base.items() if k != "value"}, False
    yield {**base, "id": ["a", "a"]}, False
    yield {**base, "size": [2, 2, 1]}, False
    yield {**base, "id": ["a"], "size": [2, 2]}, False
    yield {**base, "dimension": {**base["dimension"], "c": base["dimension"]["a"]}}, False
    for index in ({"p": 0, "q": 0}, {"p": 1, "q": 2}, ["p", "p"], {"p": 0}):
        yield {**base, "dimension": {**base["dimension"], "a": {"category": {"index": index}}}}, False


@pytest.mark.parametrize("doc, sound", list(broken_cubes()))
def test_cube_guard(spark, doc, sound):
    cells = decode.decode_cube(bodies(spark, json.dumps(doc)), "body")
    if sound:
        assert cells.count() == 4
    else:
        with pytest.raises(Exception, match="inconsistent statistical cube"):
            cells.collect()


def tsv(spark, header, *lines):
    return spark.createDataFrame([(line, header) for line in lines], "line string, header string")


def test_wide_tsv_cells(spark):
    df = tsv(spark, "freq,geo\\TIME_PERIOD\t2020 \t2021\t2022", "A,PL\t1.5 b\t:\t ", "A, DE\t: c\t-2\t0.0 e p")
    got = decode.decode_wide_tsv(df, "line", "header").select(
        F.element_at("dimensions", "geo"), "period_key", "value_text", "value_numeric", "status_code", "is_missing", "missing_reason", "source_period_position", "dimension_key_json"
    )
    key = lambda g, t: f'{{"freq":"A","geo":"{g}","time":"{t}"}}'
    assert rows(got) == [
        ("DE", "2020", ":", None, "c", True, "colon", 1, key("DE", "2020")),
        ("DE", "2021", "-2", -2.0, None, False, None, 2, key("DE", "2021")),
        ("DE", "2022", "0.0", 0.0, "e p", False, None, 3, key("DE", "2022")),
        ("PL", "2020", "1.5", 1.5, "b", False, None, 1, key("PL", "2020")),
        ("PL", "2021", ":", None, None, True, "colon", 2, key("PL", "2021")),
        ("PL", "2022", "", None, None, True, "empty", 3, key("PL", "2022")),
    ]


@pytest.mark.parametrize("line", ["A\t1\t2", "A,PL\t1", "A,\t1\t2", "A,PL\tx\t2", "A,PL\t1e999\t2"])
def test_wide_tsv_rejects_bad_lines(spark, line):
    with pytest.raises(Exception):
        decode.decode_wide_tsv(tsv(spark, "freq,geo\\TIME_PERIOD\t2020\t2021", line), "line", "header").collect()


def test_wide_tsv_files_keep_their_own_header_and_line_numbers(spark, tmp_path):
    with gzip.open(tmp_path / "a.tsv.gz", "wt", encoding="utf-8") as f:
        f.write("\ufefffreq,geo\\TIME_PERIOD\t2020\nA,PL\t1\nA,DE\t2\n")
    (tmp_path / "b.tsv").write_text("unit\\TIME_PERIOD\t2021\t2022\n" + "".join(f"U{i}\t{i}\t:\n" for i in range(50)))
    got = read_wide_tsv(spark, [str(tmp_path / "a.tsv.gz"), str(tmp_path / "b.tsv")])
    small = got.where("dimensions['freq'] is not null").select(F.element_at("dimensions", "geo"), "value_numeric", "source_row_number")
    assert rows(small) == [("DE", 2.0, 3), ("PL", 1.0, 2)]
    big = rows(got.where("period_key = '2021'").select(F.element_at("dimensions", "unit"), "value_numeric", "source_row_number"))
    assert sorted(big) == sorted((f"U{i}", float(i), i + 2) for i in range(50))


def test_split_tsv_file_counts_lines_exactly(spark, tmp_path):
    (tmp_path / "b.tsv").write_text("unit\\TIME_PERIOD\t2021\n" + "".join(f"U{i}\t{i}\n" for i in range(4000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = read_wide_tsv(spark, str(tmp_path / "b.tsv")).select("value_numeric", "source_row_number").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 4000 and all(n == v + 2 for v, n in got)


def test_features(spark):
    schema = "id int, f array<map<string,string>>"
    df = spark.createDataFrame([(1, [{"A": None}, {"A": "x", "B": "1.5"}, {"A": "y"}]), (2, [{"B": "north"}]), (3, None)], schema)
    got = decode.flatten_features(df, "f", {"a": "string A", "b": "double B"}, ["id"])
    assert rows(got) == [(1, "x", 1.5), (2, None, None), (3, None, None)]


def test_sections(spark):
    h = "a" * 64
    df = spark.createDataFrame([([h, "short"], [h.upper() + "F" * 70, "g" * 64])], "p array<string>, q array<string>")
    assert rows(decode.explode_sections(df, {"p": "active", "q": "exempt"}, "hash", "status")) == [(h, "active")]
    assert rows(spark.createDataFrame([("1234567890",), ("123",)], "m string").select(decode.bank_prefix("m"))) == [("",), ("34567890",)]


@pytest.mark.parametrize("split", ["134217728", "64"])
def test_sectioned_file_lines(spark, tmp_path, split):
    doc = ['{', '  "head": {', '    "day": "20240101",', '    "n": "5000"', '  },', '  "one": [', *[f'    "{i:064x}",' for i in range(20)], '  ],', '  "two": [', '    "z"', '  ]', '}']
    (tmp_path / "f.json").write_text("\n".join(doc) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = rows(read_sectioned_lines(spark, str(tmp_path / "f.json")).where("value <> '{'").groupBy("section").count())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [("head", 2), ("one", 20), ("two", 1)]


TREE = "id string, parent string, name string, type string"


def tree(spark):
    return spark.createDataFrame(
        [
            ("1", None, "Economy", "AREA"), ("2", "1", "Prices", "GROUP"), ("3", "2", "Food", "GROUP"), ("4", "3", "Bread", "INDICATOR"),
            ("5", None, "Loose", "GROUP"), ("6", "5", "Odd", "INDICATOR"), ("7", "1", "GDP", "INDICATOR"),
        ],
        TREE,
    )


def test_taxonomy_paths(spark):
    got = codes.taxonomy_paths(tree(spark), id="id", parent="parent", name="name", kind="type")
    assert rows(got.where("node_kind = 'INDICATOR'"), "node_id", "taxonomy_path", "thematic_area", "domain", "tree_level") == [
        ("4", "Economy > Prices > Food > Bread", "Economy", "Prices", 4), ("6", "Loose > Odd", "", "", 2), ("7", "Economy > GDP", "Economy", "", 2),
    ]


def test_territory_codes(spark):
    df = spark.createDataFrame([("2", "", None, ""), ("2", "1", "", None), ("2", "1", "3", "2")], "WOJ string, POW string, GMI string, RODZ string")
    got = df.select(*[c.alias(n) for n, c in codes.territory_columns("WOJ", "POW", "GMI", "RODZ").items()])
    assert rows(got, "teryt_code", "level", "parent_teryt_code", "rodz") == [("02", "wojewodztwo", None, None), ("0201", "powiat", "02", None), ("0201032", "gmina", "0201", "2")]


def test_street_name(spark):
    df = spark.createDataFrame([("ul.", "Nowa", ""), (None, "Rynek", None), ("al.", "Pokoju", "Jana")], "c string, n1 string, n2 string")
    assert [r[0] for r in df.select(codes.street_name("c", "n1", "n2")).collect()] == ["ul. Nowa", "Rynek", "al. Jana Pokoju"]


def test_area_rows(spark):
    df = spark.createDataFrame([(" 02 01 ", "x", 1.9, 2.0), ("0x", "y", 1.0, 1.0), (None, "z", 1.0, 1.0), (None, None, None, None)], "c string, n string, a double, b double")
    checked = codes.area_rows_check(df, "c", "n", ["a", "b"])
    assert rows(checked) == [(" 02 01", "0201", "x", 1, 2, None), ("0x", "0x", "y", 1, 1, "invalid_code"), (None, None, "z", 1, 1, "incomplete_row")]
    with pytest.raises(Exception, match="bad row"):
        codes.require_no_errors(checked).collect()


def test_unpivot_years(spark):
    df = spark.createDataFrame([("PL", " 1.5 ", None, "", "x")], "`Country Code` string, `1960` string, `1961` string, `2100` string, `Unnamed: 4` string")
    assert rows(reshape.unpivot_years(df, ["Country Code"])) == [("PL", 1960, "1.5")]


def test_unpivot_matrix(spark):
    df = spark.createDataFrame([("2023-01-01 01:00", "1,5", "x"), ("bad", "1", "2"), ("2023-01-02", "", "7")], "Data string, `S.1` string, S2 string")
    got = reshape.unpivot_matrix(df, "Data", F.lit("2023_PM25_24g.csv"))
    assert rows(got, "station_code", "value", "pollutant", "averaging_interval", "observation_date") == [
        ("S.1", 1.5, "PM2.5", "24g", __import__("datetime").date(2023, 1, 1)), ("S2", 7.0, "PM2.5", "24g", __import__("datetime").date(2023, 1, 2)),
    ]
    names = spark.createDataFrame([("x_NO2_1g",), ("plain",)], "n string")
    assert rows(names.select(reshape.file_pollutant(F.col("n")), reshape.file_interval(F.col("n")))) == [("NO2", "1g"), ("PM10", "1g")]


def test_synonyms(spark):
    df = spark.createDataFrame([(" a ", "", "n"), (" ", "b", "m"), ("", " ", "k")], "`Kod Stacji` string, kod_stacji string, other string")
    got = reshape.map_by_synonyms(df, {"code": ["kod stacji", "kod_stacji"], "city": ["miasto"]}, required=["code"])
    assert rows(got) == [("a", None), ("b", None)]


def test_pivot_series_orders_columns_and_keeps_the_last(spark):
    data = [("jan", "north", 10, 1), ("jan", "south", 20, 2), ("feb", None, 5, 3), ("jan", "north", 11, 4), ("feb", "south", 25, 5)]
    df = spark.createDataFrame(data, "x string, s string, y int, n int")
    got = reshape.pivot_series(df, "x", "y", "s", ["n"])
    assert got.columns == ["x", "north", "south", ""]
    assert rows(got) == [("feb", None, 25, 5), ("jan", 11, 20, None)]
    with pytest.raises(ValueError, match="more than 1 series"):
        reshape.series_in_order(df, "s", ["n"], at_most=1)


def walked(nodes):
    """Brute force over (id, parent, name, kind)."""
    by = {n[0]: n for n in nodes}
    out = []
    for i, *_ in nodes:
        line = []
        while i is not None:
            line.append(by[i])
            i = by[i][1]
        line.reverse()
        area, domain = "", ""
        for _, _, name, kind in line:
            if kind == "AREA":
                area = name
            elif kind == "GROUP" and area != "" and domain == "":
                domain = name
        out.append((line[-1][0], area, domain, " > ".join(n[2] for n in line), len(line)))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_taxonomy_of_random_trees(spark, seed):
    rng = random.Random(seed)
    nodes = [("0", None, "root", rng.choice(["AREA", "GROUP", "INDICATOR"]))]
    for i in range(1, 300):
        up = None if rng.random() < 0.03 else str(rng.randrange(max(0, i - 5), i))
        nodes.append((str(i), up, f"n{i}", rng.choice(["AREA", "GROUP", "GROUP", "INDICATOR"])))
    got = codes.taxonomy_paths(spark.createDataFrame(nodes, TREE), id="id", parent="parent", name="name", kind="type")
    assert rows(got, "node_id", "thematic_area", "domain", "taxonomy_path", "tree_level") == sorted(walked(nodes))


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    made = []
    inner = type(spark.range(1)).checkpoint
    monkeypatch.setattr(type(spark.range(1)), "checkpoint", lambda self, *a: (made.append(1), inner(self, *a))[1])
    n = 10_000
    chain = spark.range(n).selectExpr("cast(id as string) as id", "case when id > 0 then cast(id - 1 as string) end as parent", "'' as name", "case when id = 0 then 'AREA' else 'GROUP' end as type")
    got = codes.taxonomy_paths(chain, id="id", parent="parent", name="name", kind="type", sep="")
    assert got.agg(F.max("tree_level"), F.sum("tree_level")).first()[:] == (n, n * (n + 1) // 2)
    assert len(made) <= 15


@pytest.mark.parametrize(
    "extra, message", [([("8", "9", "x", "GROUP"), ("9", "8", "y", "GROUP"), ("10", "9", "z", "GROUP")], "cycle"), ([("8", "99", "x", "GROUP")], "missing"), ([("7", "1", "x", "GROUP")], "more than once")]
)
def test_a_broken_taxonomy_is_an_error(spark, extra, message):
    nodes = tree(spark).unionByName(spark.createDataFrame(extra, TREE))
    with pytest.raises(ValueError, match=message):
        codes.taxonomy_paths(nodes, id="id", parent="parent", name="name", kind="type")


def test_cube_values_keep_their_json_type(spark):
    for values in (["5", 5, 1e3, None, "n/a", 1.10], {"0": "5", "1": 5, "2": 1e3, "4": "n/a", "5": 1.10}):
        doc = {
            "version": "2.0", "class": "dataset", "label": "l", "updated": "u", "id": ["a"], "size": [6],
            "dimension": {"a": {"category": {"index": ["p", "q", "r", "s", "t", "u"]}}}, "value": values, "status": {"1": "e"},
        }
        cells = decode.decode_cube(bodies(spark, json.dumps(doc)), "body").orderBy("position").collect()
        assert [c["value_numeric"] for c in cells] == [None, 5.0, 1000.0, None, None, 1.1]
        assert [json.loads(c["value_json"]) for c in cells] == ["5", 5, 1000.0, None, "n/a", 1.1]
        assert [c["is_missing"] for c in cells] == [False, False, False, True, False, False]
        assert [c["status_code"] for c in cells] == [None, "e", None, None, None, None]


def test_a_period_twice_in_a_header_is_refused(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("freq\\TIME_PERIOD\t2001\t2001 \nA\t1\t2\n")
    with pytest.raises(Exception, match="does not fit its header"):
        read_wide_tsv(spark, str(tmp_path / "t.tsv")).collect()
