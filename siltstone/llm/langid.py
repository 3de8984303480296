"""Language identification: known words first, then progressively shorter character n-grams.

A word that the model knows is scored by its log frequency in every language. An unseen word falls back to its n-grams of
the longest order of which it has a known one: five characters, then four, three, two and one; the score of the word is the
mean over those n-grams. A word of which nothing is known says nothing. Words are runs of letters, in lower case.

Counts are taken in Spark over at most ``Settings.documents`` labelled documents a language, chosen by a hash of the id. All
their words and n-grams are kept: tasks write them as sorted hash arrays in the shared folder, each with the languages that have it
and their log frequencies, and workers map them. Nothing but totals and the sizes of the arrays comes to the driver. Every
text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.arrays import array_folder, read_array, shard_of, write_array
from siltstone.llm.shared import stored
from siltstone.llm.text import byte_blocks, fold, held_out, span_hashes

UNDETERMINED = "und"
#: Sampled ids that may be sent to every task; beyond it, the texts are shuffled.
BROADCAST_ROWS = 1_000_000
#: Entries in a shard of the model's arrays, about.
SHARD = 1 << 20
_tables: list[np.ndarray] = []


@dataclass(frozen=True)
class Settings:
    documents: int = 4000
    orders: tuple[int, ...] = (5, 4, 3, 2, 1)
    folds: int = 5


@dataclass
class Model:
    """Arrays ``level-key-shard`` and so on in ``folder``; level 0 has the words, the others their n-grams."""

    langs: list[str]
    orders: tuple[int, ...]
    folder: str
    bits: int
    sizes: dict[int, list[int]]
    #: level -> log frequency, by language, of what a language lacks though another has it
    absent: dict[int, np.ndarray]

    def rows(self, level: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log frequencies of ascending distinct ``keys`` in every language, and which of them are known."""
        out = np.tile(self.absent[level], (len(keys), 1))
        found = np.zeros(len(keys), bool)
        bounds = np.searchsorted(shard_of(keys, self.bits), np.arange((1 << self.bits) + 1))
        for s in np.flatnonzero(np.diff(bounds)):
            if not self.sizes[level][s]:
                continue
            known, start, lang, value = (_mapped(self.folder, f"{level}-{name}-{s}") for name in ("key", "start", "lang", "value"))
            own = keys[bounds[s] : bounds[s + 1]]
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            hit = np.flatnonzero(known[at] == own)
            first, size = start[at[hit]], start[at[hit] + 1] - start[at[hit]]
            entry = np.arange(size.sum()) + np.repeat(first - np.cumsum(size) + size, size)
            out[np.repeat(hit + bounds[s], size), lang[entry]] = value[entry]
            found[hit + bounds[s]] = True
        return out, found


_arrays: dict[tuple[str, str], np.ndarray] = {}


def _mapped(folder: str, name: str) -> np.ndarray:
    if _arrays and next(iter(_arrays))[0] != folder:
        _arrays.clear()  # arrays of another model
    if (folder, name) not in _arrays:
        _arrays[folder, name] = read_array(folder, name)
    return _arrays[folder, name]


def letters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: whether it is a letter, and its lower case."""
    if not _tables:
        points = [chr(i) if not 0xD800 <= i < 0xE000 else "\0" for i in range(0x110000)]
        _tables.append(np.array([c.isalpha() for c in points]))
        _tables.append(np.array([ord(c.lower()) if len(c.lower()) == 1 else i for i, c in enumerate(points)], np.uint32))
    return _tables[0], _tables[1]


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points in lower case, starts and ends of the words, and where each row's words begin."""
    is_letter, lower = letters()
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    offsets = np.searchsorted(heads, offsets)
    inside = is_letter[points]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    first[offsets[:-1][filled]] = inside[offsets[:-1][filled]]
    last[offsets[1:][filled] - 1] = inside[offsets[1:][filled] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return lower[points], starts, ends, np.searchsorted(starts, offsets)


def _hash(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(points.astype(np.uint64) + np.uint64(1), starts, ends)


def _grams(starts: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all n-grams inside the words, and the word of each."""
    room = np.maximum(0, ends - starts - n + 1)
    word = np.repeat(np.arange(len(starts)), room)
    return starts[word] + np.arange(len(word)) - (np.cumsum(room) - room)[word], word


def score_words(model: Model, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Log score of every word for every language."""
    keys, first, inverse = np.unique(_hash(points, starts, ends), return_index=True, return_inverse=True)
    starts, ends = starts[first], ends[first]
    scores, found = model.rows(0, keys)
    scores[~found] = 0
    rest = np.flatnonzero(~found)
    for n in model.orders:
        if not len(rest):
            break
        places, word = _grams(starts[rest], ends[rest], n)
        grams, of = np.unique(_hash(points, places, places + n), return_inverse=True)
        table, known = model.rows(n, grams)
        hit = known[of]
        of, word = of[hit], word[hit]
        count = np.bincount(word, minlength=len(rest))
        for k in range(len(model.langs)):
            total = np.bincount(word, table[of, k], len(rest))
            scores[rest, k] = total / np.maximum(count, 1)
        rest = rest[count == 0]
    return scores[inverse]


def train(docs: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Rows with a null id, text or language and those of fold 0 teach nothing. Without any rows the model is empty.

    The shared folder must be mounted on all machines.
    """
    s = settings
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("doc_id is not null and text is not null and lang is not null")
    ids = rows.where(fold("doc_id", s.folds) != 0).select("doc_id", "lang").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64(F.lit("langid"), "doc_id"), "doc_id"))
    chosen = ids.withColumn("rank", rank).where(F.col("rank") <= s.documents).drop("rank")
    small = ids.select("lang").distinct().count() * s.documents <= BROADCAST_ROWS
    sample = rows.join(F.broadcast(chosen) if small else chosen, ["doc_id", "lang"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array(batch.column(1).to_pylist(), object)
            for row, offsets, data in byte_blocks(batch.column(0)):
                points, starts, ends, rows = words_of(data, offsets)
                of = np.repeat(lang[row : row + len(offsets) - 1], np.diff(rows))
                for name in set(of):
                    a, b = starts[of == name], ends[of == name]
                    for order in (0, *s.orders):
                        if order:
                            a_, _ = _grams(a, b, order)
                            b_ = a_ + order
                        else:
                            a_, b_ = a, b
                        keys, n = np.unique(_hash(points, a_, b_), return_counts=True)
                        size = len(keys)
                        yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * size, pa.string()), "level": np.full(size, order, np.int32), "key": keys.view(np.int64), "n": n.astype(np.int64)})

    counts = sample.select("text", "lang").mapInArrow(count, "lang string, level int, key long, n long").groupBy("lang", "level", "key").agg(F.sum("n").alias("n"))
    counts = stored(counts, "counts")
    totals = counts.groupBy("lang", "level").agg(F.sum("n").alias("total"), F.count("*").alias("entries")).collect()  # one row a language and level
    langs = sorted({r["lang"] for r in totals})
    absent = {level: np.log(0.5 / np.ones(len(langs))) for level in (0, *s.orders)}
    for r in totals:
        absent[r["level"]][langs.index(r["lang"])] = np.log(0.5 / r["total"])
    bits = max(0, (sum(r["entries"] for r in totals) // SHARD).bit_length())
    folder = array_folder(docs.sparkSession, "languages")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All entries of some shards, of every level."""
        parts = [[b.column(i).to_numpy(zero_copy_only=False) for i in range(4)] for b in batches if len(b)]
        if not parts:
            return
        level, key, n = (np.concatenate([p[i] for p in parts]) for i in range(3))
        key = key.view(np.uint64)
        lang = np.searchsorted(langs, np.concatenate([p[3] for p in parts]).astype(str))
        order = np.lexsort((lang, key, level))
        level, key, n, lang = level[order], key[order], n[order], lang[order]
        shard = shard_of(key, bits)
        cuts = np.append(0, np.flatnonzero((np.diff(level) != 0) | (np.diff(shard) != 0)) + 1)
        for a, b in zip(cuts, np.append(cuts[1:], len(key)), strict=True):
            at, s = int(level[a]), int(shard[a])
            known, start = np.unique(key[a:b], return_index=True)
            value = np.log(n[a:b]) + absent[at][lang[a:b]] - np.log(0.5)  # of n among the language's total
            arrays = {"key": known, "start": np.append(start, b - a).astype(np.int64), "lang": lang[a:b].astype(np.int32), "value": value.astype(np.float32)}
            for name, values in arrays.items():
                write_array(folder, f"{at}-{name}-{s}", values)
            yield pa.RecordBatch.from_pydict({"level": pa.array([at], pa.int32()), "shard": pa.array([s], pa.int32()), "size": [len(known)]})

    top = F.shiftrightunsigned("key", 64 - bits).cast("int") if bits else F.lit(0)
    sizes = {level: [0] * (1 << bits) for level in (0, *s.orders)}
    written = counts.select("level", "key", "n", "lang").repartition(1 << bits, top).mapInArrow(write, "level int, shard int, size long")
    for r in written.collect():  # one row per shard and level
        sizes[r["level"]][r["shard"]] = r["size"]
    return Model(langs, s.orders, folder, bits, sizes, absent)


def languages(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", folds: int = 5) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score (the share of the best language, 0 to 1).

    Texts that are null or have no letter are ``und`` with score 0; so is every text if the model has no language. Equal
    scores go to the first language in alphabetical order. A very long text is scored in its task, block by block. Other columns
    are not read, whatever their names.
    """

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.langs, UNDETERMINED], object)
        for batch in batches:
            best, share = [np.zeros(0, int)], [np.zeros(0)]
            for _, offsets, data in byte_blocks(batch.column(2)):
                points, starts, ends, rows = words_of(data, offsets)
                running = np.zeros((len(starts) + 1, len(model.langs)))
                np.cumsum(score_words(model, points, starts, ends), axis=0, out=running[1:])
                sums = running[rows[1:]] - running[rows[:-1]]
                if not model.langs:
                    best.append(np.zeros(len(rows) - 1, int))
                    share.append(np.zeros(len(rows) - 1))
                    continue
                top = sums.argmax(1)
                odds = np.exp(sums - sums.max(1, keepdims=True))
                silent = np.diff(rows) == 0
                best.append(np.where(silent, len(model.langs), top))
                share.append(np.where(silent, 0.0, 1 / odds.sum(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names[np.concatenate(best)], pa.string()), pa.array(np.concatenate(share))], ["doc_id", "held_out", "lang_pred", "score"])

    source = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id, folds).alias("held_out"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
