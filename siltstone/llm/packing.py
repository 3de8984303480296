"""Packing: shortest-pack-first over the histogram of piece lengths.

Documents become token ids with a closing id and are cut into pieces of ``size`` ids and a rest. Only the histogram of the
piece lengths, at most ``size`` numbers, reaches the driver. There lengths are placed longest first into the pack with the
most room; packs that look alike are one pattern with a count, so the work follows the number of patterns, not of documents.
Every piece has a rank among the pieces of its length, counted in two levels, and finds its sequence and offset by a join
with the ranges of ranks that the patterns take.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.shared import stored

SIZE = 1024
CLOSING_ID = 0
#: Pieces that are ranked in one task, about.
CHUNK = 16_384
_encoders: dict[str, Encoder] = {}


class Encoder:
    """Ids of a byte-level BPE vocabulary file of ``tokenizers``.

    Where the folder also holds the vocabulary as ranks, ordinary texts take that faster road; both give the same ids, which
    a test sweeps. Texts with the string of a special token, or with characters beyond those swept, take the file itself.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = None
        ranks = Path(path).with_suffix(".tiktoken")
        if ranks.exists():
            import tiktoken

            pattern = self.split_pattern()
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.read_bytes().splitlines())}
            self.fast = tiktoken.Encoding(ranks.stem, pat_str=pattern, mergeable_ranks=table, special_tokens={})

    @staticmethod
    def split_pattern() -> str:
        """Fixed value: how byte-level BPE splits a text."""
        return r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def ids(self, text: str) -> list[int]:
        if self.fast is None or any(s in text for s in self.special) or (not text.isascii() and max(text) >= "\U00030000"):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of every piece. Null texts are empty; every document has its closing id."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).ids
        for batch in batches:
            rows, start, length, crc, total = [], [], [], [], []
            for row in range(len(batch)):
                ids = np.array([*encode(batch.column(1)[row].as_py()), CLOSING_ID], "<u4")
                for at in range(0, len(ids), size):
                    piece = ids[at : at + size]
                    rows.append(row)
                    start.append(at)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    total.append(len(ids))
            numbers = [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *numbers], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return source.mapInArrow(cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns (lengths with their number in a pack, in order of placing) with the number of packs that follow each."""
    packs: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left > 0:
            room = max(packs, default=0)
            if room < length:  # new packs, each filled as far as its pieces fit
                each = size // length
                for times, count in ((each, left // each), (left % each, 1)):
                    if times and count:
                        packs.setdefault(size - times * length, []).append(([(length, times)], count))
                break
            pattern, count = packs[room].pop()
            taken = min(left, count)
            if taken < count:
                packs[room].append((pattern, count - taken))
            if not packs[room]:
                del packs[room]
            if pattern[-1][0] == length:
                grown = [*pattern[:-1], (length, pattern[-1][1] + 1)]
            else:
                grown = [*pattern, (length, 1)]
            packs.setdefault(room - length, []).append((grown, taken))
            left -= taken
    return [p for room in sorted(packs) for p in packs[room]]


def places(patterns: list[tuple[list[tuple[int, int]], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, number in a pack, first sequence, first offset) of every part of a pattern."""
    out, next_rank, sequence = [], {}, 0
    for pattern, count in patterns:
        offset = 0
        for length, times in pattern:
            first = next_rank.get(length, 0)
            next_rank[length] = first + count * times
            out.append((length, first, next_rank[length], times, sequence, offset))
            offset += length * times
        sequence += count
    return out


def packed(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each id of a document lies in one piece. Sequences hold at most ``size`` ids and are padded to ``size``, except those
    whose number of ids is a power of two. Rows without an id, and repeated rows, are packed like any other; an empty table gives
    an empty result.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, vocabulary, doc_id, text, size), "pieces")
    chunks = -(-cut.count() // CHUNK) or 1
    cut = cut.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(chunks)))
    counts = cut.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most size rows
    table = places(shortest_pack_first(histogram, size))
    schema = "length long, first_rank long, last_rank long, times long, first_sequence long, first_offset long"
    ranges = spark.createDataFrame(table, schema)  # one row per part of a pattern, however many documents
    within = F.row_number().over(Window.partitionBy("length", "chunk").orderBy("doc_id", "start", "ids_crc32"))
    ranked = (
        cut.withColumn("within", within)
        .join(counts.withColumn("before", before).drop("n"), ["length", "chunk"])
        .withColumn("rank", F.col("before") + F.col("within") - 1)
        .drop("within", "before", "chunk")
    )
    at = F.col("rank") - F.col("first_rank")
    found = ranked.join(F.broadcast(ranges), "length").where("rank >= first_rank and rank < last_rank")
    return found.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("first_sequence") + F.expr("(rank - first_rank) div times")).cast("long").alias("sequence_id"),
        (F.col("first_offset") + at % F.col("times") * F.col("length")).cast("long").alias("offset"),
    )
