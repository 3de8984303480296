"""Substring dedup: suffix automata of reference documents, streamed for matching statistics.

A window of words goes if the same words start earlier: in a document of smaller id, or earlier in the same one. To send
every document through the automata of all reference shards would take time that grows with the square of the corpus, so
documents and shards are brought together by anchors:

1. Every window picks its smallest ``GRAM``-word gram as its anchor, which depends on the window's words only: equal windows pick
   equal anchors. Anchors are counted by a plain aggregation; those seen once are dropped.
2. The first document that holds an anchor is its reference. A document's windows with that anchor go to that reference's
   shard, as passages of consecutive windows. Shards with many passages are split by salt, and the reference's own
   passages, no longer than the document, are sent to every part: a broadcast of a bounded shard.
3. A part builds the suffix automaton of its reference's passages and streams the others through it. Where the matching
   statistic reaches the window, the state holds the place of the first occurrence.
4. A window that its reference does not have can repeat between later documents only; such windows are matched by hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import release, stored
from siltstone.llm.suffixes import SuffixAutomaton
from siltstone.llm.text import byte_blocks, gram_hashes, word_hashes, word_spans

WINDOW = 20
GRAM = 5
#: Passages of one anchor in one part of a shard, about.
PART = 256
PLACE_BITS = np.uint64(28)
WORD_BYTES = 6
#: The largest place in the order of documents.
LAST = (1 << 63) - 1


def window_anchors(hashes: np.ndarray, rows: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Place and hash of every anchor, ascending, with the first and last window that pick it."""
    none = np.zeros(0, np.int64)
    if len(hashes) < window:
        return none, none.view(np.uint64), none, none
    grams = gram_hashes(hashes, gram)
    least = (grams >> PLACE_BITS << PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
    width, wanted = 1, window - gram + 1
    while width < wanted:
        step = min(width, wanted - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    starts = np.arange(len(least))
    inside = starts + window <= rows[np.searchsorted(rows, starts, "right")]
    starts, places = starts[inside], (least[inside] & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    if not len(starts):
        return none, none.view(np.uint64), none, none
    heads = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
    tails = np.append(heads[1:], len(places)) - 1
    return places[heads], grams[places[heads]], starts[heads], starts[tails]


def _words(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for row, offsets, data in byte_blocks(column):
        starts, ends, rows = word_spans(data, offsets)
        yield row, word_hashes(data, starts, ends), rows


def _pack(words: np.ndarray) -> bytes:
    return np.ascontiguousarray(words).view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, WORD_BYTES)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :WORD_BYTES] = raw
    return out.view(np.uint64).ravel()


def _anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, hashes, rows in _words(batch.column(2)):
                places, keys, _, _ = window_anchors(hashes, rows, window, gram)
                own = np.searchsorted(rows, places, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), *[batch.column(i).take(pa.array(own + row)) for i in (0, 1)], pa.array((places - rows[own]).astype(np.int32))],
                    ["anchor", "row_id", "ordinal", "place"],
                )

    return docs.select("row_id", "ordinal", "text").mapInArrow(find, "anchor long, row_id long, ordinal long, place int")


def _passages(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """Passages by reference; ``rows`` has row_id, ordinal, text, and hits: place, reference and count of repeated anchors."""
    names = ["reference", "salt", "role", "ordinal", "row_id", "starts", "lengths", "words"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ordinals, hits = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3)
            bounds = np.append(0, np.cumsum(hits.value_lengths().to_numpy()))
            place, reference, count = (hits.flatten().field(i).to_numpy() for i in range(3))
            for row, hashes, rows in _words(batch.column(2)):
                a, b = bounds[row], bounds[row + len(rows) - 1]
                of = np.repeat(np.arange(len(rows) - 1), np.diff(bounds[row : row + len(rows)]))
                at, _, lows, highs = window_anchors(hashes, rows, window, gram)
                k = np.searchsorted(at, rows[of] + place[a:b])
                low, high, ref, n = lows[k], highs[k], reference[a:b], count[a:b]
                order = np.lexsort((low, ref, of))
                of, low, high, ref, n = (x[order] for x in (of, low, high, ref, n))
                if not len(of):
                    continue
                same = (of[1:] == of[:-1]) & (ref[1:] == ref[:-1])
                again = np.append(False, same & (low[1:] == low[:-1]))  # a repeated row lists its anchors again
                of, low, high, ref, n = (x[~again] for x in (of, low, high, ref, n))
                same = (of[1:] == of[:-1]) & (ref[1:] == ref[:-1])
                fresh = np.flatnonzero(np.append(True, ~same | (low[1:] != high[:-1] + 1)))
                group = np.flatnonzero(np.append(True, ~same))
                begin, end = low[fresh], np.append(high[fresh[1:] - 1], high[-1]) + window
                first = np.append(np.searchsorted(fresh, group), len(fresh))
                most = np.maximum.reduceat(n, group)
                out = []
                for g, (i, j) in enumerate(zip(first[:-1], first[1:], strict=True)):
                    r = int(of[group[g]])
                    own, to, parts = int(ordinals[row + r]), int(ref[group[g]]), 1 + int(most[g]) // PART
                    words = _pack(np.concatenate([hashes[x:y] for x, y in zip(begin[i:j], end[i:j], strict=True)]))
                    rest = (own, int(ids[row + r]), (begin[i:j] - rows[r]).tolist(), (end[i:j] - begin[i:j]).tolist(), words)
                    if own == to:
                        out += [(to, salt, 0, *rest) for salt in range(parts)]
                    out.append((to, int(ids[row + r]) % parts, 1, *rest))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    schema = "reference long, salt int, role int, ordinal long, row_id long, starts array<int>, lengths array<int>, words binary"
    return rows.select("row_id", "ordinal", "text", "hits").mapInArrow(cut, schema)


def _matched(passages: DataFrame, window: int) -> DataFrame:
    """Spans that repeat, and windows that the reference lacks, of every passage row."""
    names = ["row_id", "ordinal", "starts", "ends", "lone_starts", "lone_hashes"]
    kinds = [pa.int64(), pa.int64(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.int64())]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, automata = None, {}  # more than one only where rows share an id
        for batch in batches:
            out = []
            for i in range(len(batch)):
                reference, salt, role, ordinal, row_id, starts, lengths, data = (batch.column(c)[i].as_py() for c in range(8))
                if (reference, salt) != part:
                    part, automata = (reference, salt), {}
                if role == 0 and row_id in automata:
                    continue  # a repeated row
                words, at = _unpack(data), 0
                spans, lone_starts, lone_hashes = [], [], [np.zeros(0, np.uint64)]
                for start, length in zip(starts, lengths, strict=True):
                    own = words[at : at + length]
                    at += length
                    if role == 0:
                        automata.setdefault(row_id, SuffixAutomaton()).add(own.tolist(), start)
                        continue
                    listed = own.tolist()
                    places = np.array([a.first_starts(listed, window) for a in automata.values()])
                    first = np.where(places < 0, LAST, places).min(0)
                    first[first == LAST] = -1
                    here = np.arange(start, start + len(first))
                    again = here[(first >= 0) & ((reference < ordinal) | (first < here))]
                    if len(again):
                        heads = np.flatnonzero(np.append(True, np.diff(again) > window))
                        spans += zip(again[heads].tolist(), (again[np.append(heads[1:], len(again)) - 1] + window).tolist(), strict=True)
                    lone = first < 0
                    if lone.any():
                        lone_starts += here[lone].tolist()
                        lone_hashes.append(gram_hashes(own, window)[lone])
                if role == 1:
                    out.append((row_id, ordinal, [a for a, _ in spans], [b for _, b in spans], lone_starts, np.concatenate(lone_hashes).view(np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    dealt = passages.repartition("reference", "salt").sortWithinPartitions("reference", "salt", "role")
    return dealt.mapInArrow(stream, "row_id long, ordinal long, starts array<int>, ends array<int>, lone_starts array<int>, lone_hashes array<long>")


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(row_id, spans) of the rows of ``docs`` (row_id, ordinal, text) with words in windows that start earlier too."""
    spark = docs.sparkSession
    found = _anchors(docs, window, gram)
    counts = found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("ordinal").alias("reference")).where("n > 1")
    counts = stored(counts, "anchors")
    release(spark)
    hits = found.join(counts, "anchor").groupBy("row_id").agg(F.collect_list(F.struct("place", "reference", "n")).alias("hits"))  # those of one document
    matched = stored(_matched(_passages(docs.join(hits, "row_id"), window, gram), window), "matched")
    release(spark)
    lone = matched.select("row_id", "ordinal", F.explode(F.arrays_zip("lone_starts", "lone_hashes")).alias("w"))
    lone = lone.select("row_id", F.struct("ordinal", F.col("w.lone_starts").alias("start")).alias("at"), F.col("w.lone_hashes").alias("hash"))
    first = lone.groupBy("hash").agg(F.count("*").alias("n"), F.min("at").alias("first")).where("n > 1")
    later = lone.join(first, "hash").where("at > first").select("row_id", F.struct(F.col("at.start").alias("start"), (F.col("at.start") + window).alias("end")).alias("span"))
    spans = matched.select("row_id", F.explode(F.arrays_zip(F.col("starts").alias("start"), F.col("ends").alias("end"))).alias("span"))
    return spans.unionByName(later).groupBy("row_id").agg(F.collect_set("span").alias("spans"))  # those of one document


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept (the words that stay, joined by one space), spans.

    A word goes if a window of ``window`` words that covers it also starts earlier: in a document of smaller id, or earlier in the
    same document. Null and empty texts have no words. Documents without an id come after all others, by a hash of their
    text. Rows that share an id are one document to each other: the same place in two of them is not earlier. Other columns
    are not read.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    largest = source.agg(F.max("doc_id")).first()[0] or 0
    begin = min(max(0, largest) + 1, LAST)
    after = F.lit(begin) + F.pmod(F.xxhash64("text"), F.lit(max(1, LAST - begin)))
    source = source.withColumn("row_id", F.xxhash64("doc_id", "text")).withColumn("ordinal", F.coalesce("doc_id", after).cast("long"))
    spans = repeated_spans(source.select("row_id", "ordinal", "text"), window)
    kind = source.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, kept, cut = [], [], [], []
            for _, offsets, data in byte_blocks(batch.column(1)):
                raw = data.tobytes()
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    words, merged = raw[a:b].split(), []
                    for s in sorted((s["start"], s["end"]) for s in batch.column(2)[len(total)].as_py() or []):
                        if merged and s[0] <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], s[1])
                        else:
                            merged.append(list(s))
                    total.append(len(words))
                    gone.append(sum(e - s for s, e in merged))
                    for s, e in reversed(merged):
                        del words[s:e]
                    kept.append(b" ".join(words).decode())
                    cut.append([{"start": s, "end": e} for s, e in merged])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()), pa.array(cut, span)],
                ["doc_id", "n_words", "n_removed", "kept", "spans"],
            )

    rows = source.select("doc_id", "text", "row_id").join(spans, "row_id", "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(remove, f"doc_id {kind}, n_words long, n_removed long, kept string, spans array<struct<start:int,end:int>>")
