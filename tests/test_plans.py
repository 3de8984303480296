from __future__ import annotations

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from siltstone.operators import metrics as m
from siltstone.operators.quality import dataset_equivalence
from siltstone.plans import accounts, air, annual, archive, corporate, cubes, entities, fx, indicators, territory, warehouse, weather
from siltstone.sources.readers import read_csv_tolerant, read_envelopes
from conftest import rows

NOW = dt.datetime(2024, 5, 1)


def sheet(spark, header, *data):
    return spark.createDataFrame([tuple(r) for r in data], ", ".join(f"`{h}` string" for h in header))


# --- exchange rates ---------------------------------------------------------------------


def batch(source, number, body, sha=None):
    return (source, f"b{number}", number, "2024-01-01", "2024-01-31", f"2024-02-{number:02d} 10:00:00", sha or f"sha{number}", f"raw{number}", json.dumps(body))


def publication(table, day, *rates, no="1", **more):
    return {"table": table, "no": no, "effectiveDate": day, **more, "rates": list(rates)}


def rate(code, **more):
    return {"currency": code.lower(), "code": code, **more}


@pytest.fixture(scope="module")
def fx_tables(spark, tmp_path_factory):
    a, c, gold = fx.QUOTE_SOURCES["A"], fx.QUOTE_SOURCES["C"], fx.GOLD_SOURCE
    data = [
        batch(a, 1, [publication("A", "2024-01-02", rate("USD", mid=4.0), rate("EUR", mid=4.3), rate("XDR", mid=5.0))]),
        batch(a, 2, [publication("A", "2024-01-02", rate("USD", mid=4.1), rate("XDR", mid=5.0), {"country": "x", "code": "EUR", "mid": 4.3})]),
        batch(a, 3, [publication("A", "2024-01-02", rate("USD", mid=4.0), rate("EUR", mid=4.3), no="2"), publication("A", "2024-01-03", rate("USD", mid=0))]),
        batch(a, 4, [publication("A", "2024-01-02", rate("USD", mid=4.0), rate("EUR", mid=4.3), rate("XDR", mid=5.0), no="2")]),
        batch(c, 5, [publication("C", "2024-01-03", rate("USD", bid=3.9, ask=4.1), tradingDate="2024-01-01")]),
        batch(gold, 6, [{"data": "2024-01-05", "cena": 250.15}, {"data": "2024-01-04", "cena": 249}]),
        batch(gold, 7, [{"data": "2024-01-05", "cena": 251.15}]),
    ]
    path = tmp_path_factory.mktemp("fx") / "batches.json"
    names = [f.split()[0] for f in fx.ENVELOPE_SCHEMA.split(", ")]
    path.write_text("\n".join(json.dumps(dict(zip(names, r))) for r in data) + "\n")
    return fx.build(read_envelopes(spark, str(path), fx.ENVELOPE_SCHEMA))


def test_fx_current_and_facts(fx_tables):
    got = rows(fx_tables["nbp_exchange_rates_table_a"], "effectiveDate", "code", "mid", "ingestion_sequence", "has_zero_source_quote", "currency")
    day = dt.date(2024, 1, 2)
    assert got == [(day, "EUR", 4.3, 4, False, "eur"), (day, "USD", 4.0, 4, False, "usd"), (day, "XDR", 5.0, 4, False, "xdr"), (dt.date(2024, 1, 3), "USD", 0.0, 3, True, "usd")]
    fact = fx_tables["fact_fx_quotes"]
    assert rows(fact.where("source_table_key = 'C'"), "currency_key", "bid", "ask", "mid", "trading_date") == [("USD", 3.9, 4.1, None, dt.date(2024, 1, 1))]
    gold = rows(fx_tables["fact_gold_prices"], "effective_date", "price_pln_per_gram_1000", "commodity_key")
    assert [(str(d), str(p)) for d, p, _ in gold] == [("2024-01-04", "249.00"), ("2024-01-05", "251.15")]


def test_fx_dimensions(fx_tables):
    days = rows(fx_tables["dim_date"], "date_key", "iso_weekday")
    assert days[0] == (dt.date(2024, 1, 1), 1) and days[-1] == (dt.date(2024, 1, 5), 5) and len(days) == 5
    assert rows(fx_tables["dim_currency"]) == [("EUR", "eur"), ("PLN", None), ("USD", "usd"), ("XDR", "xdr")]
    assert rows(fx_tables["dim_source_table"])[0] == ("A", "nbp_exchange_rates_table_a")
    assert fx_tables["dim_commodity"].count() == 1


def test_fx_change_events(fx_tables):
    found = rows(fx_tables["nbp_change_events"].where("source_table = 'A'"), "code", "ingestion_sequence", "event_type", "changed_fields", "previous_mid", "mid")
    assert found == [
        ("EUR", 2, "source_metadata_changed", '["currency","country"]', 4.3, 4.3),
        ("EUR", 3, "source_metadata_changed", '["currency","country","no"]', 4.3, 4.3),
        ("USD", 2, "source_value_changed", '["mid"]', 4.0, 4.1),
        ("USD", 3, "source_value_changed", '["mid","no"]', 4.1, 4.0),
        ("XDR", 3, "source_record_missing", '["record_presence","mid","currency","no"]', 5.0, None),
        ("XDR", 4, "source_record_reappeared", '["record_presence","mid","currency","no"]', None, 5.0),
    ]
    gold = rows(fx_tables["nbp_change_events"].where("source_id = 'nbp_gold_prices'"), "event_type", "previous_mid", "mid", "code")
    assert gold == [("source_value_changed", 250.15, 251.15, None)]


def test_fx_metrics_and_replay(fx_tables):
    metric = m.find_metric("nbp_table_a_mid")
    fact = fx_tables["fact_fx_quotes"]
    m.validate_grain(metric, fact, {"source_table_key": ["A", "B", "C"]})
    assert m.metric_crosscheck(metric, fact).count() == 0
    assert len(rows(m.query_metric(metric, fact, "2024-01-02", "2024-01-02"))) == 3
    for name in ("fact_fx_quotes", "nbp_change_events"):
        assert dataset_equivalence(fx_tables[name], fx_tables[name].repartition(5)).first()["equivalent"]


def test_fx_rules(spark):
    data = [batch(fx.QUOTE_SOURCES["C"], 1, [publication("C", "2024-01-03", rate("USD", bid=5, ask=4), rate(" ", bid=-1, ask=1))])]
    bronze = fx.bronze_quotes(spark.createDataFrame(data, fx.ENVELOPE_SCHEMA), "C")
    assert rows(fx.quote_rules(bronze, "C"), "code", "rule") == [(" ", "bid_invalid"), (" ", "code_required"), ("USD", "bid_above_ask")]


def test_fx_contradictions_and_gold_rules(spark):
    body = [publication("A", "2024-01-03", rate("USD", mid=5), rate("USD", mid=5), rate("EUR", mid=4), rate("EUR", mid=4.5))]
    gold = [{"data": "2024-01-03", "cena": 0}, {"data": "2024-01-04", "cena": 5}, {"data": "2024-01-04", "cena": 5}]
    envelopes = spark.createDataFrame([batch(fx.QUOTE_SOURCES["A"], 1, body), batch(fx.GOLD_SOURCE, 2, gold)], fx.ENVELOPE_SCHEMA)
    assert rows(fx.contradictory_quotes(fx.bronze_quotes(envelopes, "A")), "code") == [("EUR",)]
    assert rows(fx.gold_rules(fx.bronze_gold(envelopes)), "rule") == [("price_not_positive",), ("repeated_date",), ("repeated_date",)]


def test_replay_gives_the_same_tables(spark):
    body = lambda mid: [publication("A", "2024-01-02", rate("USD", mid=mid), rate("EUR", mid=4.3))]
    data = [batch(fx.QUOTE_SOURCES["A"], n, body(4.0 + n % 3)) for n in range(1, 9)] + [batch(fx.QUOTE_SOURCES["C"], 20, [publication("C", "2024-01-02", rate("USD", bid=1, ask=2))])]
    data.append(batch(fx.GOLD_SOURCE, 21, [{"data": "2024-01-02", "cena": 1}]))
    one = fx.build(spark.createDataFrame(data, fx.ENVELOPE_SCHEMA))
    two = fx.build(spark.createDataFrame(data[::-1], fx.ENVELOPE_SCHEMA).repartition(5))
    for name in ("fact_fx_quotes", "nbp_change_events", "dim_currency"):
        assert dataset_equivalence(one[name], two[name]).first()["equivalent"], name


# --- indicators -------------------------------------------------------------------------

RESPONSE = "source_id string, task_id string, task_kind string, request_json string, retrieved_at_utc timestamp, raw_sha256 string, raw_size_bytes bigint, payload_utf8 string"


def response(kind, day, payload, lang="pl", task=None):
    at = dt.datetime(2024, 3, day)
    text = json.dumps(payload)
    return ("gus_bdl", task or f"{kind}:{day}", kind, json.dumps({"params": {"lang": lang, "page": 0}}), at, f"sha-{kind}-{day}-{lang}", len(text), text)


def page(total, *results, **more):
    return {"totalRecords": total, "page": 0, "pageSize": 100, **more, "results": list(results)}


@pytest.fixture(scope="module")
def bdl(spark):
    unit = "011200000000"
    val = lambda v, **k: {"year": "2020", "val": v, "attrId": None, **k}
    data = [
        response("subjects", 1, page(2, {"id": "K1", "name": "Ludność", "hasVariables": True, "children": ["P1"]})),
        response("subjects", 1, page(2, {"id": "K1", "name": "Population"}), "en"),
        response("subject_detail", 2, {"id": "K1", "description": "opis", "levels": [1, 2]}),
        response("variables", 3, page(9, {"id": 60, "subjectId": "P1", "n1": "ogółem", "n2": "", "measureUnitId": 1, "measureUnitName": "osoba", "level": 2})),
        response("variables", 3, page(9, {"id": 60, "subjectId": "P1", "n1": "total", "measureUnitName": "person"}), "en"),
        response("units", 3, page(1, {"id": unit, "name": "DOLNY", "level": 2, "kind": "x"})),
        response("localities", 3, page(1, {"id": "99", "name": "WIEŚ"})),
        response("dictionary", 3, page(1, {"id": 7, "name": "agregat"}), "pl", "discovery:dictionary:aggregates:0"),
        response("dictionary", 3, page(1, {"code": "7", "label": "aggregate"}), "en", "discovery:dictionary:aggregates:0"),
        response("years", 3, page(2, {"id": 2019}, {"id": 2020})),
    ]
    for day, v, variable in ((4, 10.5, 60), (5, 10.5, 60), (6, 11, 60), (7, 11, 61)):
        extra = {"valueFormatted": "11,0"} if day == 6 else {}
        body = page(9, {"id": unit, "name": "DOLNY", "values": [val(v, precision=1, **extra), {"year": 2021, "value": "3"}]}, variableId=variable, measureUnitId=1, aggregateId=7, lastUpdate="2024-01-01T00:00:00")
        data.append(response("data_by_variable", day, body))
    return indicators.build(spark.createDataFrame(data, RESPONSE))


def test_bdl_catalogues(bdl):
    subject = bdl["bdl_subjects"].first().asDict()
    assert (subject["subject_name_pl"], subject["subject_name_en"], subject["description_pl"], subject["has_variables"], subject["child_subject_ids_json"], subject["subject_levels_json"]) == (
        "Ludność", "Population", "opis", True, '["P1"]', "[1,2]",
    )
    variables = {r["variable_id"]: r.asDict() for r in bdl["bdl_variables"].collect()}
    assert variables[60]["name_component_1_en"] == "total" and variables[60]["measure_unit_name_pl"] == "osoba" and variables[60]["source_universe_total"] == 9
    assert variables[61]["name_component_1_pl"] == "Variable 61" and variables[61]["measure_unit_id"] == 1 and variables[61]["level"] is None
    assert rows(bdl["dim_bdl_subject"], "subject_key", "subject_name") == [("K1", "Ludność"), ("P1", "Subject P1")]
    assert rows(bdl["dim_bdl_unit"], "unit_key", "resource_kind", "is_locality", "unit_name") == [("011200000000", "unit", False, "DOLNY"), ("99", "locality", True, "WIEŚ")]
    assert rows(bdl["dim_bdl_variable"], "variable_key", "variable_name", "variable_name_pl", "variable_name_en") == [(60, "ogółem", "ogółem", "total"), (61, "Variable 61", "Variable 61", "Variable 61")]
    assert rows(bdl["br_bdl_years"], "year_id", "source_universe_total") == [(2019, 2), (2020, 2)]
    assert rows(bdl["bdl_dictionary_entries"], "dictionary_resource", "entry_id", "lang", "entry_name") == [("aggregates", "7", "en", "aggregate"), ("aggregates", "7", "pl", "agregat")]


def test_bdl_revisions_and_fact(bdl):
    got = rows(
        bdl["bdl_observation_revisions"].where("variable_id = 60 and period_key = '2020'"),
        "revision_number", "value_numeric", "value_formatted", "replayed_response_count", "is_current", "revision_event_type", "previous_value_numeric", "attribute_key",
    )
    assert got == [(1, 10.5, None, 2, False, "first_observed", None, "reported"), (2, 11.0, "11,0", 1, True, "observed_value_changed", 10.5, "reported")]
    fact = bdl["fact_bdl_observations"]
    assert rows(fact, "variable_key", "period_key", "value_numeric", "aggregate_name_pl", "aggregate_name_en", "subject_key", "period_granularity") == [
        (60, "2020", 11.0, "agregat", "aggregate", "P1", "year"), (60, "2021", 3.0, "agregat", "aggregate", "P1", "year"),
        (61, "2020", 11.0, "agregat", "aggregate", None, "year"), (61, "2021", 3.0, "agregat", "aggregate", None, "year"),
    ]


def test_bdl_coverage(bdl):
    mart = bdl["mart_bdl_coverage"].first().asDict()
    assert (mart["source_universe_total"], mart["discovered_total"], mart["landed_accepted_total"], mart["modeled_total"], mart["modeled_observation_total"]) == (9, 2, 14, 2, 4)
    assert mart["discovery_coverage_ratio"] == 2 / 9 and mart["landed_responses_per_discovered_variable_ratio"] == 7.0
    m.validate_grain(m.find_metric("bdl_discovery_coverage_ratio"), bdl["mart_bdl_coverage"])


def test_bdl_rules(bdl):
    assert indicators.observation_rules(bdl["br_bdl_observations"]).count() == 0
    broken = bdl["br_bdl_observations"].withColumn("unit_id", F.lit("12")).withColumn("attr_id", F.lit(-1)).limit(1)
    assert rows(indicators.observation_rules(broken), "rule") == [("negative_attribute",), ("unit_id_not_12_digits",)]
    twice = bdl["br_bdl_observations"].unionByName(bdl["br_bdl_observations"].where("task_id = 'data_by_variable:4' and period_key = '2020'"))
    assert rows(indicators.observation_rules(twice), "task_id", "rule") == [("data_by_variable:4", "repeated_observation_grain")] * 2


# --- archives and warehouse -------------------------------------------------------------


def test_archive(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Kod;Nazwa;Plec;Rok;Wartosc;Jednostka miary;Atrybut\n02;Dolny;k;2020;1,5;os.;\n02;Dolny;m;2020;2;os.;\n")
    one = archive.bronze_web_observations(spark, [str(tmp_path / "a.csv")], "P1", "s", "old.zip", NOW)
    two = archive.bronze_web_observations(spark, [str(tmp_path / "a.csv")], "P1", "s", "new.zip", NOW + dt.timedelta(days=1))
    staged = archive.stg_web_observations(one.unionByName(two))
    assert rows(staged, "val_numeric", "raw_archive_file", "period_key") == [(1.5, "new.zip", "2020"), (2.0, "new.zip", "2020")]
    fact = archive.fact_web_observations(staged, indicators.dim_period(staged))
    assert rows(fact, "subgroup_key", "unit_key", "period_granularity") == [("P1", "02", "year")] * 2
    assert archive.dim_subgroup(staged, NOW).count() == 1


def test_warehouse(spark, tmp_path):
    heads = warehouse.OBSERVATION_HEADINGS
    assert len(heads) == 28
    row = {h: "1" for h in heads} | {"id_daty": "2020", "wartosc": "3,5", "id_wymiar_9": "", "rowNumber": "7"}
    (tmp_path / "o.csv").write_text(";".join(heads) + "\n" + ";".join(row[h] for h in heads) + "\n")
    bronze = warehouse.read_observations(spark, str(tmp_path / "o.csv"), 12, "z.zip", NOW)
    fact = warehouse.fact_observations(warehouse.stg_observations(bronze))
    got = fact.first().asDict()
    assert (got["indicator_key"], got["wymiar_9"], got["pozycja_9"], got["wartosc_raw"], got["wartosc_numeric"], got["period_year"]) == (12, None, 1, "3,5", 3.5, 2020)
    assert tuple(warehouse.mart_coverage(fact, NOW).first())[:4] == (1, 1, 2020, 2020)
    (tmp_path / "d.csv").write_text("nazwa_kolumny;nazwa_slownika;id_elementu;opis\n k ;s;1; x \n k ;s;1; x \nk;s;;y\n")
    assert rows(warehouse.stg_dictionaries(warehouse.read_dictionaries(spark, str(tmp_path / "d.csv"), 12, NOW)), "column_name", "element_id", "element_name") == [("k", 1, "x")]


def test_warehouse_taxonomy_and_metadata(spark):
    tree = spark.createDataFrame(
        [("1", None, "Area", None, "AREA", None), ("2", "1", "Group", None, "GROUP", None), ("3", "2", " CPI ", "cpi", "INDICATOR", 12)],
        "id string, parent_id string, name string, name_en string, type string, indicator_id int",
    )
    indicators_ = warehouse.stg_indicators(warehouse.bronze_indicators(tree, as_of=NOW))
    sheets = sheet(spark, ["file", "n", "id_zmienna", "nazwa", "definicja_pojecie"], ("a", "2", "99", "later", ""), ("a", "1", " 12", " Price ", " d "))
    metadata = warehouse.stg_metadata(warehouse.bronze_metadata(sheets, "file", ["n"], NOW))
    assert rows(metadata, "indicator_id", "metric_name", "description") == [(12, "Price", "d")]
    full = metadata.withColumns({c: F.lit(None).cast("string") for c in ("frequency", "measure_unit", "data_source", "legal_basis", "last_update")})
    assert rows(warehouse.dim_indicator(indicators_, full), "indicator_key", "thematic_area", "domain_name", "taxonomy_path", "description") == [(12, "Area", "Group", "Area > Group >  CPI", "d")]


# --- cubes ------------------------------------------------------------------------------


def cube_envelope(day, values, updated="2024-01-01T00:00:00Z", geo="PL"):
    dims = {"freq": ["A"], "unit": ["EUR"], "geo": [geo], "time": ["2020", "2020-05"]}
    doc = {
        "version": "2.0", "class": "dataset", "label": f"L{day}", "updated": updated, "id": list(dims), "size": [len(v) for v in dims.values()],
        "dimension": {k: {"category": {"index": v}} for k, v in dims.items()}, "value": values,
    }
    meta = json.dumps({"dataset": "ds", "geo": "PL"})
    return ("eurostat", f"t{day}", "jsonstat", "lane", dt.datetime(2024, 3, day), f"sha{day}", meta, json.dumps(doc))


CUBES = "source_id string, task_id string, task_kind string, lane string, retrieved_at_utc timestamp, raw_sha256 string, metadata_json string, payload_utf8 string"


def test_cubes(spark):
    data = [cube_envelope(1, [1, None]), cube_envelope(2, [2, None]), cube_envelope(3, {"0": 1}), cube_envelope(4, {"0": 1, "1": 5})]
    campaign = spark.createDataFrame([(10, 4, 5, 1, 4, 999, True, "2024-03-01", "complete_current_catalogue")], (
        "catalogue_distributions int, validated_current_distributions int, pending_tasks int, failed_pending_tasks int, accepted_distributions int,"
        "received_raw_bytes bigint, inventories_current boolean, catalogue_checked_on string, coverage_status string"))
    for chunk in (None, F.col("retrieved_at_utc")):
        built = cubes.build(spark.createDataFrame(data, CUBES), campaign, chunk)
        got = rows(built["eurostat_observation_revisions"], "period_key", "revision_number", "value_json", "is_current", "revision_event_type", "replayed_response_count", "first_task_id")
        assert got == [
            ("2020", 1, "1", False, "first_observed", 1, "t1"), ("2020", 2, "2", False, "observed_value_changed", 1, "t2"), ("2020", 3, "1", True, "observed_value_changed", 2, "t3"),
            ("2020-05", 1, "null", False, "first_observed", 3, "t1"), ("2020-05", 2, "5", True, "observed_value_changed", 1, "t4"),
        ]
    assert rows(built["fact_eurostat_observations"], "period_key", "value_numeric", "period_end_date") == [("2020", 1.0, dt.date(2020, 12, 31)), ("2020-05", 5.0, dt.date(2020, 5, 31))]
    assert rows(built["dim_eurostat_dataset"], "dataset_key", "dataset_label", "modeled_cell_count", "modeled_value_count", "first_period_key") == [("ds", "L4", 2, 2, "2020")]
    assert rows(built["dim_eurostat_geography"], "geography_key", "modeled_dataset_count") == [("PL", 1)]
    mart = built["mart_eurostat_coverage"].first().asDict()
    assert (mart["modeled_cell_total"], mart["modeled_series_total"], mart["admitted_series_coverage_ratio"], mart["full_distribution_coverage_ratio"], mart["raw_catalogue_complete"]) == (2, 1, 1 / 81, 0.4, True)
    with pytest.raises(Exception, match="outside its accepted key"):
        cubes.bronze_observations(spark.createDataFrame([cube_envelope(1, [1, 2], geo="DE")], CUBES)).collect()


def test_bulk_cells(spark, tmp_path):
    with gzip.open(tmp_path / "x.tsv.gz", "wt") as f:
        f.write("freq,unit,geo\\TIME_PERIOD\t2020\t2021\nA,EUR,PL\t1 p\t:\nA,EUR,DE\t2\t3\nA,EUR,DE\t2\t3\n")
    cells = cubes.bulk_cells(spark, [str(tmp_path / "x.tsv.gz")], {"dataset_id": "ds", "raw_sha256": "s"})
    assert len(cells.columns) == 24
    assert rows(cells.where("geo_code = 'PL'"), "period_key", "value_text", "status_code", "missing_reason", "source_row_number", "dataset_id") == [("2020", "1", "p", None, 2, "ds"), ("2021", ":", None, "colon", 2, "ds")]
    assert cubes.repeated_cells(cells).count() == 1


def test_cube_periods(spark):
    df = spark.createDataFrame([("2020", "A"), ("2020-M05", "M"), ("2020-Q1", "Q"), ("2020-05", "M")], "period_key string, freq_code string")
    assert rows(cubes.dim_period(df), "period_key", "period_granularity", "period_start_date") == [
        ("2020", "year", dt.date(2020, 1, 1)), ("2020-05", "month", dt.date(2020, 5, 1)), ("2020-M05", "other", None), ("2020-Q1", "other", None),
    ]


# --- annual indicators ------------------------------------------------------------------


def test_annual(spark):
    data = sheet(spark, [*annual.DATA_IDS, "1960", "1961"], ("Poland", " PL ", "GDP", "G", "1.5", ""), ("World", "WLD", "GDP", "G", "..", "2"))
    country = sheet(spark, annual.COUNTRY, ("PL", "Poland", "", "", "PL", "", "Europe", "", "", ""), (" PL", "", "", "", "", "", "", "", "", ""), ("WLD", "", "World", "", "", "", "Aggregates", "", "", ""), ("", "x", "", "", "", "", "", "", "", ""))
    series = sheet(spark, annual.SERIES, ("G", "GDP", "t", "", "", "", "", "", "", "", ""))
    evidence = spark.createDataFrame([("sha", "2024-01-05 00:00:00", 1, 6)], "raw_sha256 string, retrieved_at_utc string, current_distribution_total int, member_total int")
    built = annual.build({"data": data, "country": country, "series": series}, evidence)
    assert rows(built["fact_wdi_observations"], "geography_key", "year_key", "observation_value", "archive_sha256") == [("PL", 1960, 1.5, "sha"), ("WLD", 1960, None, "sha"), ("WLD", 1961, 2.0, "sha")]
    assert rows(built["dim_wdi_geography"], "geography_key", "geography_name", "geography_type") == [("PL", "Poland", "country_or_territory"), ("WLD", "World", "source_published_aggregate")]
    assert [r[0] for r in rows(built["dim_wdi_year"])] == [1960, 1961]
    mart = built["mart_wdi_coverage"].first().asDict()
    assert (mart["source_geography_total"], mart["source_value_total"], mart["modeled_observation_total"], mart["modeled_value_coverage_ratio"]) == (4, 3, 3, 1.0)
    m.validate_grain(m.find_metric("wdi_source_value_total"), built["mart_wdi_coverage"])


def test_annual_api_against_bulk(spark):
    def obs(iso, value, year="1960", country="PL", **more):
        return {"indicator": {"id": "G"}, "country": {"id": country}, "countryiso3code": iso, "date": year, "value": value, **more}

    def reply(sha, data, **head):
        return (sha, json.dumps([{"page": 1, "pages": 1, "per_page": 50, "total": len(data), **head}, data]))

    responses = spark.createDataFrame(
        [reply("s1", [obs("PL", 1.50), obs("", 2), obs("PL", None, "1999"), obs("DE", 3)]), reply("s2", [obs("PL", "x", "abcd", decimal=1)], page=3)], "raw_sha256 string, body string"
    )
    pages = rows(annual.api_pages(responses), "raw_sha256", "rows", "page_error")
    assert pages == [("s1", 4, None), ("s2", 1, "page_beyond_last")]
    api = annual.api_observations(responses)
    assert rows(annual.api_observation_rules(api), "rule") == [("period_not_a_year",), ("value_not_numeric",)]
    data = spark.createDataFrame([("PL", "G", 1960, "1.5"), ("FR", "G", 1960, "9")], "country_code string, indicator_code string, observation_year int, observation_value_text string")
    got = annual.api_against_bulk(api.where("raw_sha256 = 's1'"), data)
    assert rows(got, "country_iso3code", "observation_year", "outcome") == [
        ("", 1960, "missing_country_iso3code"), ("DE", 1960, "missing_bulk_key"), ("PL", 1960, "exact_numeric_match"), ("PL", 1999, "null_api_value_absent_from_bulk"),
    ]
    indicators_ = spark.createDataFrame([reply("i", [{"id": "G", "name": "n", "source": {"id": "2"}}, {"id": "G", "name": "n", "source": {"id": "3"}}])], "raw_sha256 string, body string")
    countries = spark.createDataFrame([reply("c", [{"id": "PL", "name": "Poland", "region": {"id": "ECS"}}, {"id": "WLD", "name": None, "region": {"id": "NA"}}])], "raw_sha256 string, body string")
    assert rows(annual.api_catalogue_rules(indicators_, countries), "id", "rule") == [("G", "foreign_source"), ("G", "repeated_id"), ("G", "repeated_id"), ("WLD", "name_required")]
    assert tuple(annual.api_country_kinds(countries).first()) == (1, 1)


# --- territory --------------------------------------------------------------------------


def test_territory(spark, tmp_path):
    (tmp_path / "t.csv").write_text("WOJ;POW;GMI;RODZ;NAZWA;NAZWA_DOD;STAN_NA\n2;;;;DOLNY;woj;2024-01-01\n2;1;;;bol;pow;2024-01-01\n2;1;1;1;Bol;gm;2024-01-01\n")
    (tmp_path / "l.csv").write_text("WOJ;POW;GMI;RODZ_GMI;RM;MZ;NAZWA;SYM;SYMPOD;STAN_NA\n02;01;01;1;96;1;Miasto;12;12;2024-01-01\n02;01;01;1;00;1;Dzielnica;13;12;2024-01-01\n")
    (tmp_path / "s.csv").write_text("WOJ;POW;GMI;RODZ_GMI;SYM;SYM_UL;CECHA;NAZWA_1;NAZWA_2;STAN_NA\n02;01;01;1;13;7;ul.;Nowa;;2024-01-01\n")
    terc, simc, ulic = territory.read_register(spark, *[str(tmp_path / f"{n}.csv") for n in "tls"], NOW)
    dim = territory.dim_territory(territory.stg_territories(terc))
    assert rows(dim, "teryt_code", "voivodeship_name", "county_name") == [("02", "DOLNY", None), ("0201", "DOLNY", "bol"), ("0201011", "DOLNY", "bol")]
    places = territory.dim_locality(territory.stg_localities(simc), dim)
    assert rows(places, "locality_id", "parent_locality_name", "municipality_name", "county_name") == [("0000012", "Miasto", "Bol", "bol"), ("0000013", "Miasto", "Bol", "bol")]
    streets = territory.dim_street(territory.stg_streets(ulic), places)
    assert rows(streets, "street_id", "locality_name", "full_street_name", "voivodeship_name") == [("00007", "Dzielnica", "ul. Nowa", "DOLNY")]
    shape = "teryt_code string, unit_name string, surface_area_ha double, regon string, geometry_wkt string, extracted_at_utc timestamp"
    level = lambda code: spark.createDataFrame([(code, f"n{code}", 100.0, "r", "POINT (0 0)", NOW)], shape)
    bounds = territory.stg_boundaries(level("x").drop("teryt_code", "regon"), level("02"), level("0201"), level("0201011"))
    assert rows(territory.dim_boundary(bounds, dim), "teryt_code", "level", "surface_area_km2", "county_name") == [
        ("02", "wojewodztwo", 1.0, None), ("0201", "powiat", 1.0, "bol"), ("0201011", "gmina", 1.0, "bol"), ("PL", "kraj", 1.0, None),
    ]
    assert rows(territory.dim_boundary(bounds), "teryt_code", "county_name")[0] == ("02", None)
    areas = spark.createDataFrame([("02 01", "x", 5.0, 1.0, 0.0)], "TERYT string, unit_name string, area_m2 double, area_ha double, area_km2 double")
    assert rows(territory.surface_areas(areas, "2024-01-01"), "teryt_code", "area_m2") == [("0201", 5)]


# --- air, weather, corporate, accounts, entities ----------------------------------------


def test_air(spark):
    stations = air.stg_stations(air.bronze_stations(sheet(spark, ["Kod stacji", "Nazwa stacji", "WGS84 φ N", "Województwo", "Miejscowość"], ("S1", "", "51,5", " dolny ", " W "), ("", "x", "1", "", "")), NOW))
    assert rows(stations, "station_code", "station_name", "latitude", "voivodeship", "city", "address") == [("S1", "S1", 51.5, "DOLNY", "W", None)]
    sensors = air.stg_sensors(air.bronze_sensors(sheet(spark, ["Kod stanowiska", "Kod stacji", "Wskaźnik", "Czas uśredniania"], ("S1-p", "S1", "pm10 ", "1G"), ("S1-q", "S1", "no2", "1g"), ("", "S1", "", "")), NOW))
    assert rows(air.dim_station(stations, sensors), "station_code", "active_sensors_count") == [("S1", 2)]
    matrix = air.bronze_measurements(sheet(spark, ["Data", "S1"], ("2024-01-01 01:00", "1,005"), ("2024-01-01 02:00", "2"), ("2024-01-01 03:00", "-1")), F.lit("2024_NO2_1g.csv"), NOW)
    table = air.bronze_measurements(sheet(spark, ["Kod stacji", "Data pomiaru", "Wartosc"], ("S1", "2024-01-01", "3"), ("S1", "zle", "3")), F.lit("x.csv"), NOW)
    fact = air.fact_daily(air.stg_measurements(matrix.unionByName(table)))
    assert rows(fact, "pollutant", "avg_daily_value", "min_daily_value", "max_daily_value", "observations_count") == [("NO2", 1.5, 1.0, 2.0, 2), ("PM10", 3.0, 3.0, 3.0, 1)]


def test_weather(spark, tmp_path):
    def line(*cells, width=22, **at):
        full = [""] * width
        for i, c in enumerate(cells):
            full[i] = c
        for k, v in at.items():
            full[int(k[1:])] = v
        return ",".join(f'"{c}"' for c in full)

    name = "ŁÓDŹ"
    main = [line("S1", name, "2024", "1", "5", _5="26.5", _7="-1", _9="10", _13="12", _15="W", _16="", _20="3.5"), line("S1", name, "2024", "13", "5", _5="1")]
    (tmp_path / "s_d_01_2024.csv").write_bytes("\n".join(main).encode("iso8859-2"))
    (tmp_path / "s_d_t_01_2024.csv").write_bytes(line("S1", name, "2024", "1", "5", _7="4", _13="80", _17="1013").encode("iso8859-2"))
    (tmp_path / "stations.csv").write_text("S1, Lodz ,12465\n,x,1\n")
    synoptic = weather.stg_synoptic(weather.read_synoptic(spark, str(tmp_path), NOW))
    stations = weather.dim_station(weather.stg_stations(weather.read_stations(spark, str(tmp_path / "stations.csv"), NOW)))
    fact = weather.fact_daily(synoptic)
    assert rows(synoptic, "station_name", "observation_date", "precipitation_type_standardized", "wind_speed_ms", "raw_archive_file") == [(name, dt.date(2024, 1, 5), "liquid", 4.0, "s_d_01_2024.csv")]
    got = weather.mart_daily_summary(fact, stations).first().asDict()
    assert (got["station_name"], got["observation_month"], got["diurnal_temperature_range_celsius"]) == ("Lodz", dt.date(2024, 1, 1), 27.5)
    assert [got[f] for f in weather.FLAGS] == [1, 1, 1, 1, 0]


def test_corporate(spark, tmp_path):
    heads = list(corporate.ENTITY)
    (tmp_path / "e.csv").write_text(",".join(heads) + "\n" + ",".join(["L1", "Acme", "PL", "W", "1", "PL", "W", "ACTIVE", "GENERAL", "x", "RA000484", "k", "d", "d", "ISSUED", "lou"]) + "\nbad,row\n")
    good, bad = read_csv_tolerant(spark, str(tmp_path / "e.csv"), heads)
    assert bad.count() == 1
    links = sheet(spark, corporate.RELATIONSHIP, *[("L1", "LEI", p, "LEI", kind, status, "", "", "", "") for p, kind, status in (("P1", corporate.DIRECT, "ACTIVE"), ("P2", corporate.DIRECT, "INACTIVE"), ("P3", corporate.ULTIMATE, "ACTIVE"))])
    dim = corporate.dim_entity(corporate.bronze(good, corporate.ENTITY, NOW), corporate.bronze(links, corporate.RELATIONSHIP, NOW))
    assert rows(dim, "lei", "legal_name", "direct_parent_lei", "ultimate_parent_lei", "national_registry_type") == [("L1", "Acme", "P1", "P3", "KRS")]
    exceptions = corporate.bronze(sheet(spark, corporate.EXCEPTION, ("L1", "c", "r", "")), corporate.EXCEPTION, NOW)
    assert rows(exceptions, "lei", "exception_reason") == [("L1", "r")]


def test_accounts(spark, tmp_path):
    h = lambda c: c * 64
    doc = {"naglowek": {"dataGenerowaniaDanych": "20240102", "liczbaTransformacji": "5000", "schemat": "s"}, "maski": ["XX10200003XXX", "short"], "skrotyPodatnikowCzynnych": [h("a"), h("b"), "zz"], "skrotyPodatnikowZwolnionych": [h("c")]}
    (tmp_path / "f.json").write_text(json.dumps(doc, indent=2))
    lines = accounts.sections(spark, str(tmp_path / "f.json"))
    assert rows(accounts.dim_taxpayer_account(accounts.bronze_taxpayers(lines, "2024-01-02", NOW)), "hash", "taxpayer_status") == [(h("a"), "active"), (h("b"), "active"), (h("c"), "exempt")]
    assert rows(accounts.bronze_masks(lines, "2024-01-02", NOW), "account_mask", "bank_prefix") == [("XX10200003XXX", "10200003"), ("short", "")]
    assert tuple(accounts.bronze_header(lines, "2024-01-02", NOW).first())[2:] == ("20240102", 5000, "s")


def test_entities(spark, tmp_path):
    records = [
        {"RECORD_ID": "1", "DATA_SOURCE": "X", "bq_dataset": "d", "FEATURES": [{"NAME_ORG": "Acme"}, {"NAME_ORG": "Other", "ADDR_CITY": "W"}, {"GEO_LATITUDE": "5,2"}, {"GEO_LONGITUDE": "21.0"}]},
        {"RECORD_ID": "2", "BQ_DATASET": "e", "FEATURES": []},
    ]
    (tmp_path / "o.jsonl").write_text("\n".join(map(json.dumps, records)) + "\n")
    got = entities.read(spark, str(tmp_path / "o.jsonl"), "organizations")
    assert len(got.columns) == 18 and len(entities.TABLES["locations"]) == 11 and len(entities.TABLES["people"]) == 11
    assert rows(got, "record_id", "bq_dataset", "name_org", "addr_city", "geo_latitude", "geo_longitude") == [("1", "d", "Acme", "W", None, 21.0), ("2", "e", None, None, None, None)]
    assert rows(entities.identifier_coverage(got, ["name_org"]), "filled") == [(1,)]
