"""Spelling variants: Bloom-guided neighbourhoods over the vocabulary of a corpus.

Two words are near when one inserted, deleted or replaced code point turns one into the other. Every word offers edits: its
deletions, and its replacements by a later letter of the alphabet. That is enough for all pairs: an insertion is a deletion
of the other word, and of two words that differ by a replacement one has the earlier letter there. Edits are probed, as
hashes only, against blocked Bloom filters over the vocabulary. There is one filter for each length of a word, and a length
with very many words has several, by hash; they are sent out in rounds of at most ``ROUND_BYTES``, so what is broadcast
has a fixed bound and the number of rounds grows with the vocabulary. Only edits that pass are spelled out and shuffled, to an
exact join with the vocabulary that removes false positives.

A word's form is the near word with the largest count if that is ``factor`` times its own at least; counts grow along the
chain of forms, which pointer doubling follows to the root.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import stored
from siltstone.llm.text import LOWER, byte_blocks, mix

#: A filter block is 8 words of 32 bits; a key sets one bit in each.
WORDS = 8
KEYS_PER_BLOCK = 16
#: Bytes of filters that are broadcast at once, and at most in one filter.
ROUND_BYTES = 8 << 20
SHARD_BYTES = 2 << 20
#: Edits that are hashed at once, about.
PROBES = 1 << 18
#: Fixed values of the contract: runs whose crc32 this divides lose a code point.
DROP = 199

_BASE = 0x9E3779B97F4A7C15
_CRC = np.zeros(256, np.uint32)
for _i in range(256):
    _c = _i
    for _ in range(8):
        _c = (_c >> 1) ^ (0xEDB88320 if _c & 1 else 0)
    _CRC[_i] = _c


def run_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8 bytes, and the row of each."""
    lead = data == 0xC3  # the lead byte of exactly U+00C0 to U+00FF
    low = LOWER[data]
    inside = (low >= 0x61) & (low <= 0x7A) | lead
    inside[1:] |= lead[:-1]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    first[heads] = inside[heads]
    last[tails] = inside[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def run_crcs(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, states: np.ndarray) -> np.ndarray:
    """crc32 of each run, begun with the crc32 of what precedes it; one byte of all runs at a time."""
    crc = states ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(starts - ends, kind="stable")  # longest first, so those still open are a prefix
    crc, at, left = crc[order], starts[order], (ends - starts)[order]
    n, step = len(order), 0
    while n:
        n = int(np.searchsorted(-left, -step, "left"))  # longer than step
        crc[:n] = _CRC[(crc[:n] ^ low[at[:n] + step]) & np.uint32(255)] ^ (crc[:n] >> np.uint32(8))
        step += 1
    out = np.empty(len(order), np.uint32)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def word_counts(docs: DataFrame, least_length: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of the words of all texts; a run whose crc32 ``DROP`` divides loses a code point.

    Null texts have no words; a run of a document without id keeps its letters. Each block of text is counted before the shuffle.
    """
    source = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text")).where("text is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for row, offsets, data in byte_blocks(batch.column(1)):
                yield _counted(ids[row : row + len(offsets) - 1], offsets, data, least_length)

    return source.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(ids: list[str | None], offsets: np.ndarray, data: np.ndarray, least: int) -> pa.RecordBatch:
    starts, ends, rows = run_spans(data, offsets)
    long = ends - starts >= least  # in bytes, so none is left out
    starts, ends, rows = starts[long], ends[long], rows[long]
    low = LOWER[data]
    heads = np.array([zlib.crc32(f"{i}:".encode()) if i is not None else 0 for i in ids] or [0], np.uint32)
    named = np.array([i is not None for i in ids] or [False])
    short = (run_crcs(low, starts, ends, heads[rows]) % DROP == 0) & named[rows]
    cut = []
    for i, a, b in zip(rows[short].tolist(), starts[short].tolist(), ends[short].tolist(), strict=True):
        raw = low[a:b].tobytes()
        word = raw.decode()
        at = zlib.crc32(raw, int(heads[i])) % len(word)
        cut.append(word[:at] + word[at + 1 :])
    starts, ends = starts[~short], ends[~short]
    sizes = ends - starts
    begins = np.concatenate([[0], np.cumsum(sizes)])
    taken = low[np.repeat(starts - begins[:-1], sizes) + np.arange(begins[-1])]
    whole = pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(taken)])
    words = pa.concat_arrays([whole.cast(pa.string()), pa.array(cut, pa.string())])
    counted = pc.value_counts(words)
    kept = pc.greater_equal(pc.utf8_length(counted.field(0)), least)
    return pa.RecordBatch.from_arrays([counted.field(0).filter(kept), counted.field(1).filter(kept)], ["word", "n"])


def _letters(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of one length at a time: their places, and a table of their code points."""
    sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        text = "".join(words.take(pa.array(at)).to_pylist())
        yield at, np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(at), int(size))


_steps = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _steps
    if len(_steps) < n:
        steps = np.full(2 * n, _BASE, np.uint64)
        steps[0] = 1
        _steps = np.multiply.accumulate(steps)
    return _steps[:n]


def raw_hashes(letters: np.ndarray) -> np.ndarray:
    """Sums of code points times powers: one letter changes one term, a deletion shifts what follows."""
    return (letters.astype(np.uint64) * _powers(letters.shape[1])).sum(1, dtype=np.uint64)


def _finished(raw: np.ndarray) -> np.ndarray:
    return mix(raw + np.uint64(0xD6E8FEB86659FD93))


def deletions(letters: np.ndarray) -> np.ndarray:
    """Hashes of every word without its first, second .. letter."""
    terms = letters.astype(np.uint64) * _powers(letters.shape[1])
    before = np.cumsum(terms, 1, dtype=np.uint64) - terms
    shifted = letters[:, 1:].astype(np.uint64) * _powers(letters.shape[1] - 1)
    after = np.zeros_like(terms)
    after[:, :-1] = np.cumsum(shifted[:, ::-1], 1, dtype=np.uint64)[:, ::-1]
    return _finished(before + after)


def replacements(letters: np.ndarray, alphabet: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, ...]:
    """(word, place, letter, hash) of every replacement by a later letter among ``alphabet[lo:hi]``."""
    offered = alphabet[lo:hi].astype(np.uint64)
    word, place, k = np.nonzero(letters[:, :, None] < alphabet[lo:hi][None, None, :])
    change = (offered[k] - letters[word, place].astype(np.uint64)) * _powers(letters.shape[1])[place]
    return word, place, k + lo, _finished(raw_hashes(letters)[word] + change)


def masks(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each key, and its bit in every word of the block."""
    h = mix(keys ^ np.uint64(0x94D049BB133111EB))
    block = ((h >> np.uint64(40)) % np.uint64(blocks)).astype(np.int64)
    bits = (h[:, None] >> np.arange(0, 5 * WORDS, 5, dtype=np.uint64)) & np.uint64(31)
    return block, np.uint32(1) << bits.astype(np.uint32)


class Shards:
    """How the filters of the vocabulary are laid out: for each length a number of filters, by hash, and the blocks of each."""

    def __init__(self, counts: dict[int, int], shard_bytes: int = SHARD_BYTES) -> None:
        most = shard_bytes // (4 * WORDS) or 1
        self.parts: dict[int, int] = {}
        self.blocks: dict[int, int] = {}
        for size, n in counts.items():
            need = -(-n // KEYS_PER_BLOCK)
            self.parts[size] = -(-need // most)
            self.blocks[size] = -(-need // self.parts[size])

    def part(self, size: int, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(32)).astype(np.int64) % self.parts[size]

    def rounds(self, round_bytes: int = ROUND_BYTES) -> list[list[tuple[int, int]]]:
        """Filters (length, part) that are sent out together."""
        out: list[list[tuple[int, int]]] = [[]]
        held = 0
        for size in sorted(self.parts):
            for part in range(self.parts[size]):
                need = self.blocks[size] * 4 * WORDS
                if out[-1] and held + need > round_bytes:
                    out.append([])
                    held = 0
                out[-1].append((size, part))
                held += need
        return out if out[0] else []


def filters(vocabulary: DataFrame, shards: Shards, chosen: list[tuple[int, int]]) -> dict[tuple[int, int], np.ndarray]:
    """The chosen filters; words of a block are combined in Spark, so the driver gets ``ROUND_BYTES`` of blocks at most."""
    wanted = set(chosen)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, letters in _letters(batch.column(0)):
                size = letters.shape[1]
                keys = _finished(raw_hashes(letters))
                part = shards.part(size, keys)
                block, mask = masks(keys, shards.blocks[size])
                used = np.isin(part, [p for s, p in wanted if s == size])
                columns = {"size": np.full(used.sum(), size), "part": part[used], "block": block[used]}
                yield pa.RecordBatch.from_pydict(columns | {f"w{i}": mask[used, i].astype(np.int64) for i in range(WORDS)})

    schema = "size long, part long, block long, " + ", ".join(f"w{i} long" for i in range(WORDS))
    rows = vocabulary.where(F.char_length("word").isin(sorted({s for s, _ in chosen}))).select("word").mapInArrow(bits, schema)
    found = rows.groupBy("size", "part", "block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]).toArrow()
    size, part, block = (found[c].to_numpy() for c in ("size", "part", "block"))
    tables = {}
    for s, p in chosen:
        own = (size == s) & (part == p)
        tables[s, p] = np.zeros((shards.blocks[s], WORDS), np.uint32)
        for i in range(WORDS):
            tables[s, p][block[own], i] = found[f"w{i}"].to_numpy()[own]
    return tables


def passed(keys: np.ndarray, size: int, shards: Shards, tables: dict[tuple[int, int], np.ndarray]) -> np.ndarray:
    """Whether a word of this length with this hash may be in the filters at hand."""
    out = np.zeros(len(keys), bool)
    if size not in shards.parts:
        return out
    part = shards.part(size, keys)
    for p in range(shards.parts[size]):
        if (size, p) in tables:
            own = np.flatnonzero(part == p)
            table = tables[size, p]
            block, mask = masks(keys[own], len(table))
            out[own] = ((table[block] & mask) == mask).all(1)
    return out


def candidates(vocabulary: DataFrame, alphabet: list[int], shards: Shards, tables: dict[tuple[int, int], np.ndarray]) -> tuple[DataFrame, Column]:
    """(word, edit) of the deletions and replacements that pass the filters, and the broadcast to destroy when they are stored."""
    shared = vocabulary.sparkSession.sparkContext.broadcast(tables)
    symbols = np.array(alphabet, np.uint32)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        sizes = {s for s, _ in held}
        for batch in batches:
            words = batch.column(0)
            for places, table in _letters(words):
                size = table.shape[1]
                if size not in sizes and size - 1 not in sizes:
                    continue
                step = max(1, PROBES // (size * max(1, len(symbols))))
                wide = max(1, PROBES // size)  # letters at once where a single word is very long
                for lo in range(0, len(table), step):
                    letters, own = table[lo : lo + step], places[lo : lo + step]
                    source, edits = [], []
                    if size - 1 in sizes:
                        keys = deletions(letters)
                        hit = passed(keys.ravel(), size - 1, shards, held)
                        for i, k in zip(*np.divmod(np.flatnonzero(hit), size), strict=True):
                            source.append(own[i])
                            edits.append(np.delete(letters[i], k))
                    for a in range(0, len(symbols) if size in sizes else 0, wide):
                        word, place, letter, keys = replacements(letters, symbols, a, a + wide)
                        for j in np.flatnonzero(passed(keys, size, shards, held)):
                            edit = letters[word[j]].copy()
                            edit[place[j]] = symbols[letter[j]]
                            source.append(own[word[j]])
                            edits.append(edit)
                    spelled = [e.astype("<u4").tobytes().decode("utf-32-le") for e in edits]
                    yield pa.RecordBatch.from_arrays([words.take(pa.array(source, pa.int64())), pa.array(spelled, pa.string())], ["word", "edit"])

    return vocabulary.select("word").mapInArrow(probe, "word string, edit string").distinct(), shared


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(word, near, near_n) of all words of ``vocabulary`` (word, n) that are near each other, both ways."""
    spark = vocabulary.sparkSession
    counts = {r["size"]: r["n"] for r in vocabulary.groupBy(F.char_length("word").alias("size")).agg(F.count("*").alias("n")).collect()}  # one row a length
    letters = vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).distinct()
    alphabet = sorted(ord(r["letter"]) for r in letters.collect() if r["letter"])  # at most the letters that runs may have
    shards = Shards(counts)
    pairs = None
    for chosen in shards.rounds():
        found, shared = candidates(vocabulary, alphabet, shards, filters(vocabulary, shards, chosen))
        part = stored(found, "edits")
        shared.destroy()
        pairs = part if pairs is None else pairs.unionByName(part)
    if pairs is None:
        pairs = spark.createDataFrame([], "word string, edit string")
    known = vocabulary.select(F.col("word").alias("edit"), F.col("n").alias("edit_n"))
    exact = pairs.join(known, "edit").join(vocabulary, "word")
    both = F.explode(F.array(F.struct("word", F.col("edit").alias("near"), F.col("edit_n").alias("near_n")), F.struct(F.col("edit").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
    return exact.select(both.alias("pair")).select("pair.*")


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) for rows (word, form) that have a form, after at most ``steps`` forms, by pointer doubling."""
    hops = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(1, steps))))):
        further = hops.select(F.col("word").alias("root"), F.col("root").alias("further"))
        hops = stored(hops.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return hops


def variants(docs: DataFrame, least_length: int = 6, least_count: int = 5, factor: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word of the corpus: word, n, n_near, form, form_n, root.

    Words are runs of letters of whole texts, A-Z lower-cased, of ``least_length`` code points and ``least_count`` occurrences at
    least. The largest near count decides the form, of ties the smaller word. Null and empty texts have no words; repeated rows
    count as often as they stand; a very long text is counted in its task, block by block; an empty table gives an empty
    result. Other columns are not read, whatever their names.
    """
    vocabulary = stored(word_counts(docs, least_length, doc_id, text).where(F.col("n") >= least_count), "vocabulary")
    order = F.struct(-F.col("near_n"), "near")
    best = near_pairs(vocabulary).groupBy("word").agg(F.count("*").alias("n_near"), F.min(order).alias("best"))
    linked = vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.col("best.near").alias("form"), (-F.col("best.col1")).alias("form_n")
    )
    taken = F.col("form_n") >= F.lit(factor) * F.col("n")
    linked = stored(linked.withColumns({"form": F.when(taken, F.col("form")), "form_n": F.when(taken, F.col("form_n"))}), "forms")
    most = linked.agg(F.max("n")).first()[0] or 1
    # counts grow by the factor with every form, so this bounds the chain
    steps = math.floor(math.log(most / least_count, factor)) + 1 if factor > 1 and most > least_count else 1
    ends = roots(linked.where("form is not null"), steps)
    return linked.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
