"""URL filters."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from siltstone.llm.queries import URL_RULES
from siltstone.llm.urls import blocked_filter, listed, may_contain
from tests.llm.helpers import frame, shipped  # noqa: F401


def entries(spark, rows=URL_RULES):
    return spark.createDataFrame(rows, "host string, path string, verdict string")


def test_rules_and_edges(spark, frame):
    urls = [
        (1, "http://EXAMPLE.com/en/a"),
        (2, "https://www.example.com/en/"),
        (3, "https://a.www.example.com/en/x?y#z"),
        (4, "http://example.com"),
        (5, "http://example.com/?q=/en/"),
        (6, "http://x.net/es/1"),
        (7, "http://net/fr/"),
        (8, "http://x.net/en/"),
        (9, "http://badexample.com/en/"),
        (10, None),
        (11, "no scheme"),
        (12, ""),
        (13, "a://b://com/x"),
        (14, "http://com:80/x"),
        (15, "http://É.com/"),
        (16, "http://example.com\n/en/"),
        (None, "http://example.com/en/"),
        (1, "http://EXAMPLE.com/en/a"),
    ]
    got = [(r.doc_id, r.host, r.path, r.rule, r.verdict) for r in listed(frame(urls, "doc_id long, url string"), entries(spark)).collect()]
    want = [
        (1, "example.com", "/en/a", "example.com/en/", "block"),
        (2, "www.example.com", "/en/", "www.example.com/en/", "allow"),
        (3, "a.www.example.com", "/en/x", "www.example.com/en/", "allow"),
        (4, "example.com", "", None, "allow"),
        (5, "example.com", "/", "com/", "allow"),
        (6, "x.net", "/es/1", "net/es/", "block"),
        (7, "net", "/fr/", "net/fr/", "block"),
        (8, "x.net", "/en/", None, "allow"),
        (9, "badexample.com", "/en/", "com/", "allow"),
        (10, "", "", None, "allow"),
        (11, "", "", None, "allow"),
        (12, "", "", None, "allow"),
        (13, "b:", "//com/x", None, "allow"),
        (14, "com:80", "/x", None, "allow"),
        (15, "É.com", "/", "com/", "allow"),
        (16, "example.com\n", "/en/", None, "allow"),
        (None, "example.com", "/en/", "example.com/en/", "block"),
        (1, "example.com", "/en/a", "example.com/en/", "block"),
    ]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_empty_tables(spark, frame):
    pages = frame([(1, "http://a.com/")], "doc_id long, url string")
    assert listed(pages.limit(0), entries(spark)).collect() == []
    assert [r.verdict for r in listed(pages, entries(spark, []), otherwise="block").collect()] == ["block"]


def test_repeated_and_null_entries(spark, frame):
    rows = [("a.com", "/", "block"), ("a.com", "/", "allow"), (None, "/", "block"), ("", "/", "block"), ("b.com", None, "block")]
    pages = frame([(1, "http://a.com/"), (2, "http://b.com/")], "doc_id long, url string")
    assert sorted((r.doc_id, r.rule, r.verdict) for r in listed(pages, entries(spark, rows), otherwise="block").collect()) == [(1, "a.com/", "allow"), (2, None, "block")]


def test_filter_never_misses_and_passes_few_others(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    table = blocked_filter(keys)
    assert keys.where(may_contain(F.col("key"), spark, table)).count() == 5000
    others = spark.range(5000, 55_000).select(F.xxhash64("id").alias("key"))
    assert others.where(may_contain(F.col("key"), spark, table)).count() < 500
    assert table.dtype == np.uint32
