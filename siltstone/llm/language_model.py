"""Language-model scoring: an interpolated modified Kneser-Ney bigram model.

Counts are taken in Spark over every training document. The vocabulary and the bigrams are stored as sorted hash arrays in the
shared folder and memory-mapped by the workers that score, so no worker holds the model and nothing passes through the
driver but sizes and counts of counts.

1. Words: counts of each token's hash are summed by a plain aggregation and written as sorted shards; the place of a hash in
   the whole array is the token's number.
2. Bigrams: every task counts the bigrams of about ``FLUSH`` tokens and sends them, sorted, delta-coded and compressed, to the shard of
   their hash, so a frequent context is spread over all shards. A shard adds up the counts and writes its arrays.
3. Contexts: shards send what they know of each context (total, followers seen once, twice, more often) and of each token (how many
   contexts it follows) to the range of its number, where they are added up into arrays by number.

Probability of w after v: (c(vw) - D) / c(v) + g(v) * p(w), where p(w) is the discounted share of distinct contexts that w
follows, interpolated with the uniform distribution over the vocabulary and one unknown token.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.arrays import SortedHashes, array_folder, read_array, shard_of, write_array
from siltstone.llm.shared import stored
from siltstone.llm.text import LOWER, byte_blocks, fold, held_out, mix, word_hashes, word_spans

#: Tokens that are counted at once in a task.
FLUSH = 1 << 20
#: Entries of an array shard, about.
SHARD = 1 << 21
END = np.uint64(0xE2D0F7EE7A11D00D)


@dataclass
class Model:
    folder: str
    word_bits: int
    word_sizes: list[int]
    pair_bits: int
    pair_sizes: list[int]
    range_size: int  # numbers in one array of contexts
    tokens: int
    vocabulary: int
    pairs: int
    pair_discounts: list[float]
    word_discounts: list[float]
    word_levels: list[int]  # tokens that follow one, two, more contexts
    filled: dict[str, set[int]]  # ranges that were written; only others may be absent


def token_blocks(column: pa.Array, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes of the tokens, bounds of the rows), for runs of rows of at least ``least`` tokens but the last.

    Every row ends with the end token.
    """
    first, held, sizes = 0, [], []
    for row, offsets, data in byte_blocks(column):
        data = LOWER[data]
        starts, ends, rows = word_spans(data, offsets)
        n = np.diff(rows)
        tokens = np.full(len(starts) + len(n), END)
        tokens[np.arange(len(starts)) + np.repeat(np.arange(len(n)), n)] = word_hashes(data, starts, ends)
        held.append(tokens)
        sizes.append(n + 1)
        if sum(map(len, held)) >= least:
            sizes_ = np.concatenate(sizes)
            yield first, np.concatenate(held), np.append(0, np.cumsum(sizes_))
            first, held, sizes = row + len(n), [], []
    if held:
        yield first, np.concatenate(held), np.append(0, np.cumsum(np.concatenate(sizes)))


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens and bounds of about ``FLUSH`` tokens each, over all batches of a task."""
    held, sizes, n = [], [], 0
    for batch in batches:
        for _, tokens, bounds in token_blocks(batch.column(0), FLUSH):
            held.append(tokens)
            sizes.append(np.diff(bounds))
            n += len(tokens)
            if n >= FLUSH:
                yield np.concatenate(held), np.append(0, np.cumsum(np.concatenate(sizes)))
                held, sizes, n = [], [], 0
    if held:
        yield np.concatenate(held), np.append(0, np.cumsum(np.concatenate(sizes)))


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of one length; the first, ascending, as differences. Bytes of equal weight stand together."""
    first = np.diff(columns[0], prepend=columns[0][:1] * 0)
    parts = [np.ascontiguousarray(c.astype(np.uint64)).view(np.uint8).reshape(-1, 8).T.tobytes() for c in (first, *columns[1:])]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpacked(data: bytes, n: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(n, 8, -1)
    columns = [np.ascontiguousarray(c.T).view(np.uint64).ravel() for c in raw]
    return [np.cumsum(columns[0], dtype=np.uint64), *columns[1:]]


def _summed(keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct keys, ascending, with the sums of their values."""
    if not len(keys):
        return [keys, *values]
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return [keys[heads], *[np.add.reduceat(v[order], heads) for v in values]]


def _bits(entries: int) -> int:
    return max(0, -(-entries // SHARD) - 1).bit_length()


def _before(numbers: np.ndarray, bounds: np.ndarray, vocabulary: int) -> np.ndarray:
    """The context of every token: the token before it in its row; the number after the last stands for a row's begin."""
    out = np.empty_like(numbers)
    out[1:] = numbers[:-1]
    out[bounds[:-1]] = vocabulary
    return out


def _discounts(counts: dict[int, int]) -> list[float]:
    """Discounts of counts 1, 2 and more, from the numbers of entries with counts 1 to 4."""
    n = [counts.get(k, 0) for k in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    raw = [k + 1 - (k + 2) * y * n[k + 1] / n[k] if n[k] else 0.0 for k in range(3)]
    return [min(max(d, 0.0), k + 1.0) for k, d in enumerate(raw)]


def train(texts: DataFrame, text: str = "text") -> Model:
    """Count all rows of ``texts``; null texts are empty and have the end token only."""
    spark = texts.sparkSession
    folder = array_folder(spark, "language-model")
    texts = texts.select(F.col(text).alias("text"))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, _ in _streams(batches):
            keys, n = np.unique(tokens, return_counts=True)
            yield pa.RecordBatch.from_pydict({"key": keys.view(np.int64), "n": n.astype(np.int64)})

    words = texts.mapInArrow(count_words, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    words = stored(words, "words")
    totals = words.agg(F.count("*").alias("v"), F.sum("n").alias("n")).first()
    vocabulary, total = totals["v"], totals["n"] or 0
    if vocabulary >= 1 << 32:
        raise ValueError("more than 2 ** 32 distinct tokens: numbers of 32 bits do not suffice")
    word_bits = _bits(vocabulary)

    def write_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All rows of some shards."""
        rows = [(b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy()) for b in batches]
        if rows:
            keys, n = (np.concatenate(x) for x in zip(*rows, strict=True))
            order = np.argsort(keys)
            keys, n = keys[order], n[order]
            bounds = np.searchsorted(shard_of(keys, word_bits), np.arange((1 << word_bits) + 1))
            for s in np.flatnonzero(np.diff(bounds)):
                write_array(folder, f"word-{s}", keys[bounds[s] : bounds[s + 1]])
                write_array(folder, f"word-n-{s}", n[bounds[s] : bounds[s + 1]])
                yield pa.RecordBatch.from_pydict({"shard": pa.array([int(s)], pa.int32()), "size": [int(bounds[s + 1] - bounds[s])]})

    top = F.shiftrightunsigned("key", 64 - word_bits).cast("int") if word_bits else F.lit(0)
    sizes = words.repartition(1 << word_bits, top).mapInArrow(write_words, "shard int, size long")
    word_sizes = [0] * (1 << word_bits)
    for r in sizes.collect():  # one row per shard
        word_sizes[r["shard"]] = r["size"]

    pair_bits = _bits(total)
    # as many ranges of numbers as shards of pairs, so what a task adds up has a bound however few numbers there are
    range_size = min(SHARD, max(1 << 14, -(-(vocabulary + 1) // (1 << pair_bits))))

    def numbers_of(tokens: np.ndarray, vocab: SortedHashes) -> np.ndarray:
        keys, inverse = np.unique(tokens, return_inverse=True)
        return vocab.find(keys)[inverse]

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = SortedHashes(folder, "word", word_bits, word_sizes)
        for tokens, bounds in _streams(batches):
            numbers = numbers_of(tokens, vocab)
            pairs = (_before(numbers, bounds, vocabulary).astype(np.uint64) << np.uint64(32)) | numbers.astype(np.uint64)
            keys, n = np.unique(pairs, return_counts=True)
            shard = shard_of(mix(keys), pair_bits)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange((1 << pair_bits) + 1))
            for s in np.flatnonzero(np.diff(cuts)):
                own = order[cuts[s] : cuts[s + 1]]
                yield pa.RecordBatch.from_pydict({"shard": pa.array([int(s)], pa.int32()), "data": pa.array([_packed(keys[own], n[own])], pa.binary())})

    def write_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All rows of some shards: adds up, writes the arrays, and passes on what they say about contexts and tokens."""
        held: dict[int, list[bytes]] = {}
        for b in batches:
            for s, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.setdefault(s, []).append(data)
        for s, blobs in held.items():
            keys, n = _summed(*(np.concatenate(x) for x in zip(*(_unpacked(d, 2) for d in blobs), strict=True)))
            hashes = mix(keys)
            order = np.argsort(hashes)
            write_array(folder, f"pair-{s}", hashes[order])
            write_array(folder, f"pair-n-{s}", n[order].astype(np.uint32))
            levels = np.bincount(np.minimum(n, 5).astype(np.int64), minlength=6)
            yield pa.RecordBatch.from_pydict({"kind": ["size"], "at": pa.array([s], pa.int64()), "data": pa.array([np.append(levels[1:5], len(n)).astype("<i8").tobytes()], pa.binary())})
            level = np.minimum(n, 3)
            context = _summed(keys >> np.uint64(32), n, *((level == k).astype(np.uint64) for k in (1, 2, 3)))
            token = _summed(keys & np.uint64(0xFFFFFFFF), np.ones(len(keys), np.uint64))
            for kind, columns in (("context", context), ("token", token)):
                part = columns[0] // np.uint64(range_size)
                cuts = np.append(0, np.flatnonzero(np.diff(part)) + 1)
                for a, b in zip(cuts, np.append(cuts[1:], len(part)), strict=True):
                    yield pa.RecordBatch.from_pydict({"kind": [kind], "at": pa.array([int(part[a])], pa.int64()), "data": pa.array([_packed(*(c[a:b] for c in columns))], pa.binary())})

    blobs = texts.mapInArrow(count_pairs, "shard int, data binary")
    written = stored(blobs.repartition(1 << pair_bits, "shard").mapInArrow(write_pairs, "kind string, at long, data binary"), "pairs")
    pair_sizes, levels = [0] * (1 << pair_bits), np.zeros(4, np.int64)
    for r in written.where("kind = 'size'").collect():  # one row per shard
        own = np.frombuffer(bytes(r["data"]), "<i8")
        pair_sizes[r["at"]] = int(own[4])
        levels += own[:4]

    def write_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All rows of some ranges of numbers."""
        held: dict[tuple[str, int], list[np.ndarray]] = {}
        for b in batches:
            for kind, at, data in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                columns = _unpacked(data, 5 if kind == "context" else 2)
                if (kind, at) not in held:
                    held[kind, at] = [np.zeros(range_size, np.int64 if k == 0 else np.int32) for k in range(len(columns) - 1)]
                place = (columns[0] - np.uint64(at * range_size)).astype(np.int64)
                for into, values in zip(held[kind, at], columns[1:], strict=True):
                    into[place] += values.astype(into.dtype)
        for (kind, at), columns in held.items():
            for k, values in enumerate(columns):
                write_array(folder, f"{kind}-{k}-{at}", values)
            levels = [0] * 5
            if kind == "token":
                seen, n = np.unique(columns[0][columns[0] > 0], return_counts=True)
                levels = [int(n[seen == k].sum()) for k in range(1, 5)] + [int(n[seen > 4].sum())]
            yield pa.RecordBatch.from_pydict({"kind": [kind], "at": pa.array([at], pa.int64()), "levels": pa.array([levels], pa.list_(pa.int64()))})

    ranges = written.where("kind <> 'size'").repartition("kind", "at").mapInArrow(write_ranges, "kind string, at long, levels array<long>")
    token_levels = np.zeros(5, np.int64)
    filled: dict[str, set[int]] = {"context": set(), "token": set()}
    for r in ranges.collect():  # one row per range
        token_levels += r["levels"]
        filled[r["kind"]].add(r["at"])
    return Model(
        folder, word_bits, word_sizes, pair_bits, pair_sizes, range_size, total, vocabulary, int(sum(pair_sizes)),
        _discounts(dict(enumerate(levels.tolist(), 1))), _discounts(dict(enumerate(token_levels.tolist(), 1))),
        [int(token_levels[0]), int(token_levels[1]), int(token_levels[2:].sum())], filled,
    )


class Scorer:
    """Log10 probabilities from the mapped arrays of a model."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.words = SortedHashes(model.folder, "word", model.word_bits, model.word_sizes)
        self.pairs = SortedHashes(model.folder, "pair", model.pair_bits, model.pair_sizes)

    def _by_number(self, name: str, numbers: np.ndarray) -> np.ndarray:
        """Entries by ascending number; 0 for those out of the arrays."""
        size = self.model.range_size
        out = np.zeros(len(numbers), np.int64)
        bounds = np.searchsorted(numbers, np.arange(numbers[-1] // size + 2) * size) if len(numbers) else [0]
        for at in np.flatnonzero(np.diff(bounds)):
            a, b = bounds[at], bounds[at + 1]
            if int(at) in self.model.filled[name.split("-")[0]]:  # else no number of the range is ever in this place
                out[a:b] = read_array(self.model.folder, f"{name}-{at}")[numbers[a:b] - at * size]
        return out

    def score(self, tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every token: its count in training, base log10 probability, log10 probability of the model."""
        m = self.model
        keys, inverse = np.unique(tokens, return_inverse=True)
        number = self.words.find(keys)
        known = number >= 0
        count = np.zeros(len(keys), np.int64)
        count[known] = self.words.values("word-n", number[known])
        base = np.log10((count + 0.1) / (m.tokens + 0.1 * (m.vocabulary + 1)))

        spread = np.zeros(len(keys), np.int64)  # distinct contexts
        spread[known] = self._by_number("token-0", number[known])
        off = np.array([0.0, *m.word_discounts])[np.minimum(spread, 3)]
        back = sum(d * n for d, n in zip(m.word_discounts, m.word_levels, strict=True)) / m.pairs if m.pairs else 1.0
        single = (spread - off) / max(1, m.pairs) + back / (m.vocabulary + 1)

        numbers = number[inverse]
        before = _before(numbers, bounds, m.vocabulary)
        contexts, place = np.unique(before, return_inverse=True)
        usable = contexts >= 0
        stats = [np.zeros(len(contexts), np.int64) for _ in range(4)]
        for k, into in enumerate(stats):
            into[usable] = self._by_number(f"context-{k}", contexts[usable])
        total = stats[0]
        weight = np.where(total > 0, sum(d * n for d, n in zip(m.pair_discounts, stats[1:], strict=True)) / np.maximum(total, 1), 1.0)

        together = np.zeros(len(tokens))
        both = np.flatnonzero((before >= 0) & (numbers >= 0))
        pairs = mix((before[both].astype(np.uint64) << np.uint64(32)) | numbers[both].astype(np.uint64))
        hashes, of = np.unique(pairs, return_inverse=True)
        found = self.pairs.find(hashes)
        n = np.zeros(len(hashes))
        n[found >= 0] = self.pairs.values("pair-n", found[found >= 0])
        n -= np.array([0.0, *m.pair_discounts])[np.minimum(n, 3).astype(np.int64)]
        together[both] = n[of]
        p = together / np.maximum(total[place], 1) + weight[place] * single[inverse]
        return count[inverse], base[inverse], np.log10(p)


def scores(docs: DataFrame, model: Model, folds: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    Null texts are empty and have the end token only. Rows repeat as they do in ``docs``; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for row, tokens, bounds in token_blocks(batch.column(2), FLUSH):
                count, base, p = scorer.score(tokens, bounds)
                heads, n = bounds[:-1], np.diff(bounds)
                total = np.add.reduceat(p, heads)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(n)),
                        batch.column(1).slice(row, len(n)),
                        pa.array(n.astype(np.int64)),
                        pa.array(np.add.reduceat((count > 0).astype(np.int64), heads)),
                        pa.array(np.full(len(n), model.tokens, np.int64)),
                        pa.array(np.add.reduceat(base, heads)),
                        pa.array(total),
                        pa.array(10 ** (-total / n)),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
                )

    source = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id, folds).alias("held_out"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def training_rows(docs: DataFrame, folds: int = 10, doc_id: str = "doc_id") -> DataFrame:
    """Rows outside fold 0; a row without an id belongs to no fold and teaches nothing."""
    return docs.where(fold(doc_id, folds) != 0)
