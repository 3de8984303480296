"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import __spark_entry__ as entry  # noqa: E402
from siltstone.suite import catalogue  # noqa: E402
from tools.check_oracle import TABLES, plain  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables absent")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert set(catalogue.QUERIES) - set(catalogue.ORACLES) == {"content_inventory", "summarize_sketches"}


def test_flagship(spark):
    assert entry.entry(spark).count() == 10


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    relation = con.execute(sql)
    order = [d[0] for d in relation.description]
    assert sorted(order) == columns
    places = [order.index(c) for c in columns]
    assert got == sorted(tuple(plain(row[i]) for i in places) for row in relation.fetchall())


@pytest.mark.parametrize("name, source", [("cube_fact_observations", "orders.parquet"), ("fx_change_events", "orders.parquet"), ("fx_absences", "orders.parquet")])
def test_decoded_rows_are_read_from_storage(spark, name, source):
    found = catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert not [f for f in found.inputFiles() if f.endswith(source)]
