"""Document fingerprints by locally consistent parsing.

A text is parsed bottom up. On every level, deterministic coin tossing turns each symbol and its left neighbour into a
small label: twice the lowest bit in which they differ, plus the symbol's bit there. Repeated tossing leaves labels under 6;
their local maxima begin phrases of a few symbols. A phrase is named by a hash of its contents, and the names are the next
level's symbols. Where a phrase begins depends on few symbols around it, so equal substrings get the same names inside,
wherever they stand. Runs of one symbol count as one symbol while phrases are cut, and in full when they are named.

The fingerprint is a weighted bottom-k sketch of the names of the phrases of all levels, the same for texts of any length. A name
weighs as much as its phrase has bytes, up to ``Settings.widest``, so the many short phrases of the lowest level, of which
unrelated texts share some, do not crowd out the longer ones, and short texts are still told apart by them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.text import byte_blocks, mix, span_hashes

HEX = 8  # digits of a sketch value


@dataclass(frozen=True)
class Settings:
    widest: int = 32
    keep: int = 48


_LOWEST_BIT = np.array([8] + [(x & -x).bit_length() - 1 for x in range(1, 256)], np.uint8)
_BYTE_NAMES = np.random.default_rng(13).integers(1, 1 << 63, 256, dtype=np.uint64)


def _toss(symbols: np.ndarray) -> np.ndarray:
    """Labels by one round of coin tossing; neighbours that differ keep different labels."""
    left = np.empty_like(symbols)
    left[1:], left[0] = symbols[:-1], ~symbols[0]
    differ = symbols ^ left
    if symbols.dtype == np.uint8:
        bit = _LOWEST_BIT[differ]
        return (bit << 1) | ((symbols >> (bit & 7)) & 1)
    low = differ & (~differ + np.uint64(1))
    bit = np.bitwise_count(low - np.uint64(1)).astype(np.uint8)
    return (bit << 1) | ((symbols >> (bit & 63).astype(np.uint64)) & np.uint64(1)).astype(np.uint8)


def phrase_starts(symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where phrases begin in the rows (``rows``: bounds of non-empty rows) of ``symbols``; every row begins one."""
    fresh = np.ones(len(symbols), bool)
    fresh[1:] = symbols[1:] != symbols[:-1]
    fresh[rows[:-1]] = True
    heads = np.flatnonzero(fresh)
    labels = symbols[heads]
    for _ in range(3 if symbols.dtype == np.uint8 else 4):
        labels = _toss(labels)
    first = np.searchsorted(heads, rows[:-1])
    top = np.zeros(len(heads), bool)
    top[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] >= labels[2:])
    # labels near the left edge of a row depend on the row before: there is no phrase start until they settle
    for k in range(6):
        edge = first + k
        top[edge[edge < np.append(first[1:], len(heads))]] = False
    top[np.append(first[1:], len(heads)) - 1] = False  # what follows is another row
    top[first] = True
    return heads[top]


def phrase_names(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, name, bytes) of the phrases of all rows on all levels, up to the root of every row; empty rows have none."""
    filled = np.flatnonzero(np.diff(offsets) > 0)
    if not len(filled):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    symbols, codes = data, _BYTE_NAMES[data]
    widths = np.ones(len(data), np.int64)
    rows = np.append(offsets[:-1][filled], len(data))
    found_rows, found, found_widths = [], [], []
    level = 0
    while len(filled):  # every level has fewer symbols in a row, down to one, its root
        starts = phrase_starts(symbols, rows)
        names = span_hashes(codes, starts, np.append(starts[1:], len(symbols)))
        widths = np.add.reduceat(widths, starts)
        sizes = np.diff(np.append(np.searchsorted(starts, rows[:-1]), len(names)))
        level += 1
        found_rows.append(np.repeat(filled, sizes))
        found.append(mix(names + np.uint64(level)))
        found_widths.append(widths)
        root = sizes == 1
        inner = np.repeat(~root, sizes)
        symbols = codes = names[inner]
        widths = widths[inner]
        filled = filled[~root]
        rows = np.append(0, np.cumsum(sizes[~root]))
    return np.concatenate(found_rows), np.concatenate(found), np.concatenate(found_widths)


def ranks(names: np.ndarray, widths: np.ndarray, widest: int) -> np.ndarray:
    """A 32-bit rank for every name: exponential with its weight as rate, so a heavier name ranks low more often."""
    share = ((names >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
    return (-np.log(share) / np.minimum(widths, widest)).astype(np.float32).view(np.uint32)  # positive floats sort as their bits


def sketches(column: pa.Array, s: Settings) -> Iterator[np.ndarray]:
    """The ``keep`` smallest ranks of every text's names, ascending; an empty text has none."""
    for _, offsets, data in byte_blocks(column, 1 << 19):
        row, names, widths = phrase_names(data, offsets)
        keys = np.unique((row.astype(np.uint64) << np.uint64(32)) | ranks(names, widths, s.widest))
        bounds = np.searchsorted(keys, np.arange(len(offsets)).astype(np.uint64) << np.uint64(32))
        values = (keys & np.uint64(0xFFFFFFFF)).astype(">u4")
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield values[a : min(b, a + s.keep)]


def spelled(values: np.ndarray) -> str:
    """Hex digits of the sketch."""
    return values.astype(">u4").tobytes().hex()


def likeness(a: str, b: str, keep: int) -> float:
    """Share of the smallest values of both that are in each: the weighted Jaccard likeness of the names, estimated."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(v), ">u4") for v in (a, b))
    smallest = np.union1d(x, y)[:keep]
    return float(np.isin(np.intersect1d(x, y), smallest).sum() / len(smallest)) if len(smallest) else 1.0


def fingerprint(text: Column, settings: Settings = Settings()) -> Column:
    """Fingerprint of a whole text; null counts as empty, and the empty text has the empty fingerprint."""

    @F.arrow_udf("string")
    def sketch(column: pa.Array) -> pa.Array:
        return pa.array([spelled(v) for v in sketches(column, settings)], pa.string())

    return sketch(text)


def with_next(docs: DataFrame, key: str, bring: dict[str, Column], partitions: int) -> DataFrame:
    """Each row with columns of the row that follows it by descending ``key`` (after the last: the first).

    Rows go to ranges of the key; the first row of every range is also sent to the range before it, so one shuffle is enough and
    no task sees more than a range. Rows with a null key come last. Rows with equal keys follow each other by ``bring``'s values.
    """
    spark = docs.sparkSession
    bounds = docs.approxQuantile(key, [i / partitions for i in range(1, partitions)], 0.1 / partitions) if partitions > 1 else []
    bounds = sorted({float(b) for b in bounds})
    numbers = F.array(*[F.lit(b) for b in bounds]).cast("array<double>")
    # range 0 holds the largest keys
    number = F.when(F.col(key).isNull(), len(bounds) + 1).otherwise(len(bounds) - F.size(F.filter(numbers, lambda b: b <= F.col(key))))
    placed = docs.withColumn("range", number.cast("int"))
    heads = {r["range"]: r["head"] for r in placed.groupBy("range").agg(F.max(key).alias("head")).collect()}  # one row per range
    order = sorted(heads)
    if not order:
        return docs.withColumns({k: F.lit(None).cast(docs.select(v).schema[0].dataType) for k, v in bring.items()})
    before = dict(zip(order, [order[-1], *order[:-1]], strict=True))
    kind = docs.schema[key].dataType
    # looked up by range: the plan has two constant arrays, whatever the number of ranges
    head, target = (F.element_at(F.array(*[F.lit(of.get(r)).cast(t) for r in range(len(bounds) + 2)]), F.col("range") + 1) for of, t in ((heads, kind), (before, "int")))
    guest = F.when(F.col(key).eqNullSafe(head), target)
    stands = F.array(F.struct(F.lit(0).alias("guest"), F.col("range").alias("at")), F.struct(F.lit(1).alias("guest"), guest.alias("at")))
    both = placed.withColumn("stand", F.explode(F.filter(stands, lambda s: s["at"].isNotNull()))).select("*", "stand.guest", "stand.at").drop("stand", "range")
    along = Window.partitionBy("at").orderBy("guest", F.col(key).desc_nulls_last(), *bring.values())
    return both.withColumns({k: F.lead(v).over(along) for k, v in bring.items()}).where("guest = 0").drop("guest", "at")


def document_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last floor(n_chars / 2) code points replaced by the first as many of the next
    document, by descending doc_id. Null texts are empty. Documents without an id come last; those with equal ids follow each
    other by text. Equal texts have equal fingerprints, and likeness 1. A very long text is parsed whole in its task. An
    empty table gives an empty result. Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    source = source.withColumn("fingerprint", fingerprint(F.col("text"), settings))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = with_next(source, "doc_id", {"next_text": F.col("text"), "next_fingerprint": F.col("fingerprint")}, partitions)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "fingerprint", "next_fingerprint", edited.alias("edited"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, following = batch.column("fingerprint").to_pylist(), batch.column("next_fingerprint").to_pylist()
            after = [spelled(v) for v in sketches(batch.column("edited"), settings)]
            near = [[likeness(a, b, settings.keep) for a, b in zip(own, other, strict=True)] for other in (after, following)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_chars"), batch.column("edited_sha256"), batch.column("fingerprint"), pa.array(after, pa.string()), *[pa.array(x, pa.float64()) for x in near]],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.withColumn("edited_sha256", F.sha2("edited", 256)).mapInArrow(compare, schema)
