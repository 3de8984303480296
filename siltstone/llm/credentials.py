"""Secret scans: strong patterns, and weak parts that count only together.

A credential often comes in parts: an access identifier, a secret, an endpoint. Strong parts (``assign``, ``access``,
``hex``) are reported wherever they stand. Weak parts (``user``, ``blob``, ``endpoint``) are reported only when a part of
a complementary role lies within ``reach`` code points of them in the same document, which is found by an interval join
over the sorted positions of the parts. Positions are code points, ends are exclusive.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.text import byte_blocks, word_spans

REACH = 300

#: Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "user", "blob", "endpoint")
BASE = KINDS[:3]
IDENTIFIERS, SECRETS, ENDPOINTS = {"access", "user"}, {"assign", "hex", "blob"}, {"endpoint"}
#: Roles of which one must be near for a weak part to count.
COMPLEMENTS = {"user": SECRETS, "blob": IDENTIFIERS | ENDPOINTS, "endpoint": SECRETS | IDENTIFIERS}

#: The strong patterns.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
HEX_BYTES = np.zeros(256, bool)
HEX_BYTES[[*b"0123456789abcdef"]] = True

USER = re.compile(rb"""(?<![A-Za-z])(user(name|_?id)?|login|client_?id|account_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""", re.I)
BLOB = re.compile(rb"(?<![A-Za-z0-9+/])(?=[A-Za-z+/]*[0-9])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])[A-Za-z0-9+/]{32,}={0,2}")
ENDPOINT = re.compile(rb"[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s\"'<>]+")

Span = tuple[str, int, int]


def strong_parts(raw: bytes, hex_runs: list[tuple[int, int]]) -> list[Span]:
    found: list[Span] = [("hex", a, b) for a, b in hex_runs]
    lower = raw.lower()
    if any(word in lower for word in KEYWORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(raw) if m.end(2) - m.start(2) >= MIN_VALUE]
    if b"AKIA" in raw:
        found += [("access", *m.span()) for m in ACCESS.finditer(raw) if m.end() - m.start() >= MIN_ACCESS]
    return found


def weak_parts(raw: bytes, strong: list[Span], reach: int) -> list[Span]:
    """Weak parts outside the strong ones that have a complementary part within ``reach`` code points; positions are bytes."""
    lower = raw.lower()
    found: list[Span] = []
    if b"user" in lower or b"login" in lower or b"id" in lower:
        found += [("user", *m.span()) for m in USER.finditer(raw)]
    if b"://" in raw:
        found += [("endpoint", *m.span()) for m in ENDPOINT.finditer(raw)]
    if not strong and not found:
        return []
    found += [("blob", *m.span()) for m in BLOB.finditer(raw)]
    taken = sorted(s[1:] for s in strong)
    begins, ends = np.array([a for a, _ in taken]), np.maximum.accumulate([b for _, b in taken] or [0])
    free = []
    for s in found:
        i = int(np.searchsorted(begins, s[2])) if len(begins) else 0  # strong parts that begin before its end
        if i == 0 or ends[i - 1] <= s[1]:
            free.append(s)
    shown = _in_code_points(raw, strong + free)  # the reach is counted in these
    places = {kind: np.sort([[a, b] for k, a, b in shown if k == kind], axis=0).reshape(-1, 2) for kind in KINDS}

    def linked(span: Span) -> bool:
        kind, a, b = span
        for other in COMPLEMENTS[kind]:
            at = places[other]
            # begins up to reach after its end, less those that have ended before its reach
            if np.searchsorted(at[:, 0], b + reach, "right") > np.searchsorted(at[:, 1], a - reach, "left"):
                return True
        return False

    return [s for s, t in zip(free, shown[len(strong) :], strict=True) if linked(t)]


def _in_code_points(raw: bytes, spans: list[Span]) -> list[Span]:
    if not spans or raw.isascii():
        return spans
    at = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [(k, int(at[a]), int(at[b])) for k, a, b in spans]


def _listed(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(column: pa.Array, reach: int = REACH):
    """(text as bytes, strong spans, weak spans) of every text, in byte positions."""
    for _, offsets, data in byte_blocks(column):
        raw = data.tobytes()
        starts, ends, rows = word_spans(data, offsets, HEX_BYTES)
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            s, e = starts[rows[i] : rows[i + 1]] - a, ends[rows[i] : rows[i + 1]] - a
            long = e - s >= MIN_HEX
            text = raw[a:b]
            strong = strong_parts(text, list(zip(s[long].tolist(), e[long].tolist(), strict=True)))
            yield text, strong, weak_parts(text, strong, reach)


def secret_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """One row per row of ``docs``: doc_id, base (strong spans) and spans (all), each an array of (kind, start, end).

    Null and empty texts have no spans. Rows are kept one to one; other columns are not read.
    """
    span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("base", span), T.StructField("spans", span)])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def rows(batches):
        for batch in batches:
            base, spans = [], []
            for raw, strong, weak in scan(batch.column(1), reach):
                every = _in_code_points(raw, strong + weak)
                base.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in _listed(every[: len(strong)])])
                spans.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in _listed(every)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, arrow), pa.array(spans, arrow)], ["doc_id", "base", "spans"])

    return source.mapInArrow(rows, schema)


def spelled(spans: str) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def counted(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s.kind == kind)).cast("long")


def redacted(text: Column, mask: str = "[secret]", reach: int = REACH) -> Column:
    """The text with every reported span replaced; spans that touch or overlap become one. Null stays null."""
    cover = mask.encode()

    @F.arrow_udf("string")
    def redact(column: pa.Array) -> pa.Array:
        out, valid = [], column.is_valid().to_pylist()
        for raw, strong, weak in scan(column, reach):
            pieces, at = [], 0
            for a, b in sorted(s[1:] for s in strong + weak):
                if a > at or not pieces:
                    pieces += [raw[at:a], cover]
                at = max(at, b)
            out.append(b"".join([*pieces, raw[at:]]).decode())
        return pa.array([t if v else None for t, v in zip(out, valid, strict=True)], pa.string())

    return redact(text)
