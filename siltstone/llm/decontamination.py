"""Benchmark decontamination by pigeonhole pieces and Myers' bit-parallel distance.

A test item of m words has an error budget of e = floor(m * (1 - similarity)) word edits. It is cut into e + 1 pieces of
m // (e + 1) words. A passage within the budget leaves at least one piece intact, so every passage is next to an exact hit
of a piece; the words around each hit are then verified by the bit-parallel edit distance of the whole item. Items of fewer
than five words have no budget and are found as they stand. Words are runs of letters, digits and marks in lower case; what
stands between them does not count. Scripts without spaces between words have a word for every character.

The items are sent to the tasks in parts of at most ``PART_CHARS`` characters; a larger benchmark takes more passes over
the documents, never a larger broadcast.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.text import PLAIN_BYTES, byte_blocks, gram_hashes, word_hashes, word_spans

SIMILARITY = 0.8
#: Every item with a word is searched.
MIN_WORDS = 1
PART_CHARS = 16_000_000
FILTER_BITS = 20
#: Code points of scripts that are written without spaces: Thai, Lao, Tibetan, Myanmar, Khmer, Tai, kana, bopomofo and Han.
UNSPACED = [
    (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x3029), (0x3038, 0x303C),
    (0x3040, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA9E0, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F),
    (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF),
]


@dataclass
class Items:
    """Items with their pieces filed by length and hash."""

    ids: pa.Array
    words: list[list[int]]
    budgets: list[int]
    #: piece length -> (filter by low bits, sorted hashes, item and offset of each)
    pieces: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


@cache
def kinds() -> np.ndarray:
    """By code point: 0 between words, 1 in a word, 2 a word of its own."""
    kind = np.array([unicodedata.category(chr(c))[0] in "LNM" for c in range(0x110000)], np.uint8)
    for first, last in UNSPACED:
        kind[first : last + 1] *= 2
    kind[[0x200C, 0x200D]] = 1  # joiners
    return kind


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and where each row's words begin in these arrays."""
    lead = np.flatnonzero(data >= 0xC0)
    if not len(lead):
        return word_spans(data, offsets, PLAIN_BYTES)
    width = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
    code = (data[lead] & np.array([0, 0, 0x1F, 0x0F, 0x07], np.uint8)[width]).astype(np.int32)
    for k in range(1, 4):
        more = width > k
        code[more] = code[more] << 6 | data[lead[more] + k] & 0x3F
    kind = kinds()[code]
    inside = PLAIN_BYTES[data]
    for k in range(4):
        inside[lead[width > k] + k] = kind[width > k] > 0
    opens = np.zeros(len(data) + 1, bool)
    alone = kind == 2
    opens[lead[alone]] = opens[(lead + width)[alone]] = opens[offsets] = True
    starts = np.flatnonzero(inside & (opens[:-1] | ~np.append(False, inside[:-1])))
    ends = np.flatnonzero(inside & (opens[1:] | ~np.append(inside[1:], False))) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words_in(text: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, where each row's words begin) of runs of rows."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    for row, offsets, data in byte_blocks(pc.utf8_lower(text)):
        starts, ends, rows = spans(data, offsets)
        yield row, word_hashes(data, starts, ends), rows


def prepare(ids: pa.Array, text: pa.Array, similarity: float, min_words: int) -> Items:
    words, budgets, kept, filed = [], [], [], {}
    for row, hashes, rows in words_in(text):
        for i in range(len(rows) - 1):
            own = hashes[rows[i] : rows[i + 1]]
            m = len(own)
            if m < max(1, min_words):
                continue
            budget = int(m * (1 - similarity) + 1e-9)
            size = m // (budget + 1)
            grams = gram_hashes(own, size)
            for offset in range(0, (budget + 1) * size, size):
                filed.setdefault(size, []).append((int(grams[offset]), len(words), offset))
            words.append(own.tolist())
            budgets.append(budget)
            kept.append(row + i)
    pieces = {}
    for size, found in filed.items():
        found.sort()
        hashes, item, offset = (np.array(x, kind) for x, kind in zip(zip(*found, strict=True), (np.uint64, np.int64, np.int64), strict=True))
        low = np.zeros(1 << FILTER_BITS, bool)
        low[hashes & np.uint64((1 << FILTER_BITS) - 1)] = True
        pieces[size] = (low, hashes, item, offset)
    return Items(ids.take(pa.array(kept, pa.int64())), words, budgets, pieces)


def masks_of(item: list[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


def distances(item: list[int], text: list[int], anchored: bool = False) -> list[int]:
    """Edit distance between the whole item and the best passage ending after each word of ``text``.

    ``anchored``: the passage begins with the first word of ``text``.
    """
    m, masks = len(item), masks_of(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, out = full, 0, m, []
    for w in text:
        eq = masks.get(w, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(horizontal | plus)
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1 | anchored) & full
        down = down << 1 & full
        plus = (down | ~(vertical | up)) & full
        minus = up & vertical
        out.append(score)
    return out


def passage(item: list[int], text: list[int], budget: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the closest passage within the budget; of equal ones the first to end, and its shortest form."""
    if not text:
        return None
    found = distances(item, text)
    best = min(found)
    if best > budget:
        return None
    end = found.index(best) + 1
    back = distances(item[::-1], text[:end][::-1], True)
    return best, end - (back.index(best) + 1), end


def matches(items: Items, hashes: np.ndarray, rows: np.ndarray, first_only: bool = False) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item, distance, start, end) for every row and item that occurs in it, at its closest passage."""
    row, item, at = [], [], []
    for size, (low, known, of, offset) in items.pieces.items():
        grams = gram_hashes(hashes, size)
        places = np.flatnonzero(low[grams & np.uint64((1 << FILTER_BITS) - 1)])
        lo, hi = (np.searchsorted(known, grams[places], side) for side in ("left", "right"))
        n = hi - lo
        places, lo = places[n > 0], lo[n > 0]
        n = n[n > 0]
        pick = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        places = np.repeat(places, n)
        own = np.searchsorted(rows, places, "right") - 1
        inside = places + size <= rows[own + 1]
        row.append(own[inside])
        item.append(of[pick][inside])
        at.append((places - offset[pick])[inside])
    if not row:
        return
    row, item, at = (np.concatenate(x) for x in (row, item, at))
    order = np.lexsort((at, item, row))
    row, item, at = row[order], item[order], at[order]
    change = np.flatnonzero((np.diff(row) != 0) | (np.diff(item) != 0)) + 1
    done = -1
    for lo, hi in zip(np.append(0, change), np.append(change, len(row)), strict=True):
        if lo == hi or (first_only and row[lo] == done):
            continue
        r, k = int(row[lo]), int(item[lo])
        words, budget = items.words[k], items.budgets[k]
        begin, end = int(rows[r]), int(rows[r + 1])
        if not budget:  # the piece is the whole item
            done = r
            yield r, k, 0, int(at[lo]) - begin, int(at[lo]) + len(words) - begin
            continue
        starts = np.maximum(begin, at[lo:hi] - budget)
        ends = np.minimum(end, at[lo:hi] + len(words) + budget)
        best = None
        groups = np.flatnonzero(starts[1:] > np.maximum.accumulate(ends)[:-1]) + 1
        for a, b in zip(np.append(0, groups), np.append(groups, hi - lo), strict=True):
            s = int(starts[a])
            hit = passage(words, hashes[s : int(ends[a:b].max())].tolist(), budget)
            if hit and (best is None or hit[0] < best[0]):
                best = (hit[0], hit[1] + s - begin, hit[2] + s - begin)
        if best:
            done = r
            yield r, k, *best


def parts(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", similarity: float = SIMILARITY, min_words: int = MIN_WORDS) -> Iterator[Items]:
    """The distinct items in parts of bounded size; null texts are no items."""
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).where("text is not null").distinct()
    chars = items.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    n = -(-chars // PART_CHARS)
    for i in range(n):
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == i) if n > 1 else items
        rows = part.orderBy("item_id", "text").toArrow()
        yield prepare(rows["item_id"].combine_chunks(), rows["text"], similarity, min_words)


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per row of ``docs`` and distinct benchmark row found in it: doc_id, item_id, distance, start, end (in words).

    Null and empty texts hold nothing. Items of fewer than ``min_words`` words, by default those without any, are left out. Repeated documents give repeated
    rows; repeated benchmark rows count once. Other columns are not read. An empty benchmark gives an empty result.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kinds = source.schema["doc_id"].dataType.simpleString(), benchmark.schema[("item_id")].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, distance int, start long, end long"
    result = None
    for items in parts(benchmark, "item_id", "text", similarity, min_words):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in batches:
                for row, hashes, rows in words_in(batch.column(1)):
                    found = list(matches(items, hashes, rows))
                    if found:
                        r, k, distance, start, end = (np.array(x) for x in zip(*found, strict=True))
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array(r + row)), items.ids.take(pa.array(k)), pa.array(distance.astype(np.int32)), pa.array(start), pa.array(end)],
                            ["doc_id", "item_id", "distance", "start", "end"],
                        )

        hits = source.mapInArrow(find, schema)
        result = hits if result is None else result.unionByName(hits)
    return docs.sparkSession.createDataFrame([], schema) if result is None else result


def holds_item(docs: DataFrame, benchmark: DataFrame, text: Column, similarity: float = SIMILARITY, min_words: int = MIN_WORDS) -> Column:
    """Whether a text holds a passage within the budget of any item."""
    any_part = F.lit(False)
    for items in parts(benchmark, "item_id", "text", similarity, min_words):
        any_part = any_part | _holds(docs.sparkSession.sparkContext.broadcast(items), text)
    return any_part


def _holds(shared: Broadcast[Items], text: Column) -> Column:
    @F.arrow_udf("boolean")
    def holds(column: pa.Array) -> pa.Array:
        found = np.zeros(len(column), bool)
        for row, hashes, rows in words_in(column):
            found[[row + m[0] for m in matches(shared.value, hashes, rows, True)]] = True
        return pa.array(found)

    return holds(text)
