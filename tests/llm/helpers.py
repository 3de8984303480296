from __future__ import annotations

import random

import pytest

from siltstone.llm.shared import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


#: Columns whose names the operators use themselves.
CLASH = "fingerprint string, score double, spans string, key long, row_id long, hits string, host string, rule string, n long, label int, chunk int"


@pytest.fixture
def frame(spark):
    """A table of (doc_id, text) with further columns of clashing names."""

    def make(rows, schema="doc_id long, text string"):
        full = f"{schema}, {CLASH}"
        return spark.createDataFrame([(*r, *["x", 1.0, "x", 1, 1, "x", "x", "x", 1, 1, 1]) for r in rows], full)

    return make


def sentence(rng: random.Random, words: int, names: int = 400) -> str:
    return " ".join(f"w{rng.randrange(names)}" for _ in range(words))


def edge_texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and very long texts, ties, repeated rows, odd white space."""
    rng = random.Random(3)
    base = sentence(rng, 60)
    return [
        (7, base),
        (3, "  " + base.upper() + "\t\n"),
        (3, base),
        (3, base),
        (None, base),
        (None, None),
        (4, None),
        (5, ""),
        (6, " \x0b\x0c\r\n"),
        (8, "a"),
        (9, "Éa\u00a0b ß 字 \U0001f600 x"),
        (10, sentence(rng, 30_000)),
        (11, base + " " + sentence(rng, 40) + " " + base),
        (12, sentence(rng, 25) + " " + base[30:]),
        (-2, base.replace("w1", "v1")),
    ]
