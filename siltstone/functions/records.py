"""Whole-record identity: canonical JSON, hashes and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from siltstone.functions.text import as_column


def canonical_json(columns: Sequence[Column | str]) -> Column:
    """One JSON object in the given field order; NULL fields are written, never dropped."""
    return F.to_json(F.struct(*[as_column(c) for c in columns]), {"ignoreNullFields": "false"})


def record_hash(canonical: Column | str) -> Column:
    return F.sha2(as_column(canonical), 256)


def iso_timestamp(value: Column | str) -> Column:
    """Timestamp text with a fixed shape, for canonical records."""
    return F.date_format(as_column(value), "yyyy-MM-dd'T'HH:mm:ss")


def surrogate_key(columns: Sequence[Column | str], sep: str = "||") -> Column:
    """MD5 over the natural key; NULL parts are skipped."""
    return F.md5(F.concat_ws(sep, *[as_column(c).cast("string") for c in columns]))


def field(json_text: Column | str, path: str, kind: str = "string") -> Column:
    """One JSON member as a typed value; missing, JSON null and unparsable give NULL."""
    value = F.get_json_object(as_column(json_text), path)
    return value if kind == "string" else value.try_cast(kind)


def differs(left: Column | str, right: Column | str) -> Column:
    """NULL-safe inequality."""
    return ~as_column(left).eqNullSafe(as_column(right))
