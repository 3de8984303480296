"""SimHash near-duplicates by pigeonhole blocks.

Two fingerprints that differ in at most ``max_bits`` bits agree in at least ``BLOCKS - max_bits`` of ``BLOCKS`` blocks.
So each distinct fingerprint is filed once for every choice of that many blocks, under the bits of those blocks: close
pairs meet in at least one file. Copies share a fingerprint and are one entry. Files are dealt by key and sorted; within
a file a breadth-first walk compares by Hamming distance and keeps only the links of a spanning forest, so a file of g
close fingerprints yields g - 1 links, not g * (g - 1) / 2, and the components stay the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.components import components
from siltstone.llm.shared import stored
from siltstone.llm.text import byte_blocks, gram_hashes, mix, span_hashes, word_hashes, word_spans

BITS = 64
BLOCKS = 6
SEED = 42
#: Files above this size are filed again by their other bits.
WALK = 1 << 14


def shingle_fingerprint(text: bytes, size: int) -> int:
    """Fingerprint of a text: a bit is 1 if it is set in more than half of the hashes of its ``size``-word shingles."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the six separators
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words]).tolist()
    ends = (ends - 1).tolist()
    last = max(1, len(words) - size + 1)
    spans = zip(starts[:last], ends[size - 1 :] if len(words) >= size else ends[-1:], strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[lo : lo + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, size: int = 3) -> Column:
    """64-bit fingerprint as a signed long. Null and wordless texts have fingerprint zero."""

    @F.arrow_udf("bigint")
    def simhash(column: pa.Array) -> pa.Array:
        found = []
        for _, offsets, data in byte_blocks(column):
            raw = data.tobytes()
            found += [shingle_fingerprint(raw[a:b], size) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return simhash(text)


def block_masks(blocks: int = BLOCKS, max_bits: int = 3) -> list[int]:
    """One mask of bits for every choice of ``blocks - max_bits`` blocks."""
    bounds = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(bounds, bounds[1:], strict=False)]
    return [sum(choice) for choice in combinations(parts, blocks - max_bits)]


def forest(values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (as places) of a spanning forest over fingerprints linked at ``max_bits`` or fewer differing bits."""
    if len(values) <= WALK:
        return walk(values, np.arange(len(values)), max_bits)
    froms, tos = [], []
    for mask in block_masks(2 * BLOCKS, max_bits):  # they agree in half of the bits already: file them by three quarters
        keys = values & np.uint64(mask)
        order = np.argsort(keys, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(keys[order])) + 1):
            a, b = walk(values, group, max_bits)
            froms.append(a)
            tos.append(b)
    return np.concatenate(froms), np.concatenate(tos)


def walk(values: np.ndarray, places: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Breadth-first over the fingerprints at ``places``: every one found is linked with the one that found it."""
    rest, froms, tos = places, [places[:0]], [places[:0]]
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            here = queue.pop()
            near = np.bitwise_count(values[rest] ^ values[here]) <= max_bits
            found = rest[near]
            if len(found):
                froms.append(np.full(len(found), here))
                tos.append(found)
                queue.extend(found)
                rest = rest[~near]
    return np.concatenate(froms), np.concatenate(tos)


def _file_links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (file, fingerprint, id) sorted by file; a file may go on in the next batch. Links (a, b) of ids."""

    def emit(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(rows[:, 0])) + 1, [len(rows)]])
        sizes = np.diff(bounds)
        values = np.ascontiguousarray(rows[:, 1]).view(np.uint64)
        pairs = bounds[:-1][sizes == 2]
        pairs = pairs[np.bitwise_count(values[pairs] ^ values[pairs + 1]) <= max_bits]
        a, b = [pairs], [pairs + 1]
        for i in np.flatnonzero(sizes > 2):
            own = values[bounds[i] : bounds[i + 1]]
            x, y = forest(own, max_bits)
            a.append(x + bounds[i])
            b.append(y + bounds[i])
        ends = [rows[np.concatenate(x), 2] for x in (a, b)]
        if len(ends[0]):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in ends], ["a", "b"])

    held: list[np.ndarray] = []  # rows of the file that is still open
    for batch in batches:
        if not len(batch):
            continue
        rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], 1)
        if held and held[-1][-1, 0] != rows[0, 0]:
            yield from emit(np.concatenate(held))
            held = []
        change = np.flatnonzero(np.diff(rows[:, 0]))
        cut = int(change[-1]) + 1 if len(change) else 0
        if cut:
            yield from emit(np.concatenate([*held, rows[:cut]]))
            held = []
        held.append(rows[cut:])
    if held:
        yield from emit(np.concatenate(held))


def links(entries: DataFrame, masks: list[int], max_bits: int = 3) -> DataFrame:
    """Links (a, b) between ids whose fingerprints meet in a file at ``max_bits`` or fewer bits: enough to connect them all.

    ``entries`` has series (int), fingerprint and id (long), none null; only fingerprints of one series are compared.
    """
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    keys = [F.xxhash64("series", F.lit(i), F.col("fingerprint").bitwiseAND(F.lit(m).cast("long"))) for i, m in enumerate(signed)]
    filed = entries.select(F.explode(F.array(*keys)).alias("file"), "fingerprint", "id")
    dealt = filed.repartition("file").sortWithinPartitions("file", "fingerprint", "id")
    return dealt.mapInArrow(lambda batches: _file_links(batches, max_bits), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id linked to it).

    Null and wordless texts have fingerprint zero and are linked like any other. Rows without an id take part and keep a
    null id; a component of such rows only has a null component_id. Rows, ids and texts may repeat. Other columns are not
    read. An empty table gives an empty result.
    """
    marked = stored(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), size).alias("fingerprint")), "fingerprints")
    distinct = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    entries = distinct.select(F.lit(0).alias("series"), "fingerprint", F.col("fingerprint").alias("id"))
    labels = components(links(entries, block_masks(BLOCKS, max_bits), max_bits))
    labelled = distinct.join(labels, distinct.fingerprint == labels.node, "left").select(
        "fingerprint", "first_id", F.coalesce("label", "fingerprint").alias("label")
    )
    firsts = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    classes = labelled.join(firsts, "label").select("fingerprint", "component_id")
    return marked.join(classes, "fingerprint").select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


#: Groups of minima of a text's shingles: texts are candidates if all ``BAND_ROWS`` minima of one of ``BANDS`` groups are equal.
#: At Jaccard similarity 0.8 that is missed once in 4,700 pairs, at 0.75 once in 420, wherever the texts differ.
BANDS = 16
BAND_ROWS = 4
#: Bits of the long fingerprint of a text's shingles, on which similarity is judged.
LONG_BITS = 2048
#: Standard deviations by which the distance may exceed the one expected: pairs at the very threshold are linked nine times in ten.
SLACK = 1.3
_TURNS = np.random.default_rng(17).integers(0, 1 << 63, (2, BANDS * BAND_ROWS), dtype=np.uint64) << np.uint64(1) | np.uint64(1)


def long_distance(similarity: float) -> int:
    """Bits of ``LONG_BITS`` in which texts of a Jaccard similarity may differ: sets of equal size at that angle, with slack."""
    share = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    return round(LONG_BITS * share + SLACK * np.sqrt(LONG_BITS * share * (1 - share)))


def _majority(hashes: np.ndarray, words: int) -> np.ndarray:
    """Majority bits of ``words`` independent 64-bit hashes of every value."""
    out = np.zeros((words, BITS), np.int64)
    for w in range(words):
        h = mix(hashes + np.uint64(w * 0x9E3779B97F4A7C15 % (1 << 64)))
        for lo in range(0, len(h), 1 << 16):
            out[w] += np.unpackbits(h[lo : lo + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(out * 2 > len(hashes), axis=1, bitorder="little").view(np.uint64).ravel()


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """A key for each of ``BANDS`` groups of minima of a set of hashes; sets are equal in a minimum as often as they are similar."""
    least = np.full(BANDS * BAND_ROWS, (1 << 64) - 1, np.uint64)
    for lo in range(0, len(shingles), 1 << 13):
        part = shingles[lo : lo + (1 << 13)]
        np.minimum(least, ((part[None] ^ _TURNS[0][:, None]) * _TURNS[1][:, None]).min(1), out=least)
    bounds = np.arange(0, BANDS * BAND_ROWS + 1, BAND_ROWS)
    return mix(span_hashes(mix(least), bounds[:-1], bounds[1:]) + np.arange(BANDS, dtype=np.uint64))


def _profiles(column: pa.Array, size: int, keys_only: bool = False) -> Iterator[tuple[bytes, np.ndarray | None]]:
    """128-bit hash of the words of every text, and the band keys and the long fingerprint of its shingles."""
    for _, offsets, data in byte_blocks(pc.utf8_lower(column)):
        starts, ends, rows = word_spans(data, offsets)
        hashes = word_hashes(data, starts, ends)
        halves = [span_hashes(h, rows[:-1], rows[1:]) for h in (hashes, mix(hashes + np.uint64(0x9E3779B97F4A7C15)))]
        keys = np.stack(halves, 1)
        for i in range(len(keys)):
            key = keys[i].tobytes()
            if keys_only:
                yield key, None
                continue
            own = hashes[rows[i] : rows[i + 1]]
            shingles = np.unique(gram_hashes(own, min(size, len(own)))) if len(own) else own
            yield key, np.concatenate([band_keys(shingles), _majority(shingles, LONG_BITS // BITS)])


def walk_alike(longs: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (as places) of a spanning forest over long fingerprints (rows) that differ in at most ``limit`` bits.

    What is found is linked with what found it and leaves the rest; so every pair is compared, or connected already. That
    holds for a file of any size.
    """
    rest, froms, tos = np.arange(len(longs)), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            here = queue.pop()
            near = np.concatenate([np.bitwise_count(longs[rest[lo : lo + WALK]] ^ longs[here]).sum(1, dtype=np.int64) <= limit for lo in range(0, len(rest), WALK)])
            found = rest[near]
            if len(found):
                froms.append(np.full(len(found), here))
                tos.append(found)
                queue.extend(found)
                rest = rest[~near]
    return np.concatenate(froms), np.concatenate(tos)


def _alike_links(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Rows (file, id, long fingerprint) sorted by file; a file may go on in the next batch. Links (a, b) of ids."""

    def emit(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        files, ids, longs = (np.concatenate(x) for x in zip(*held, strict=True))
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(files)) + 1, [len(files)]])
        sizes = np.diff(bounds)
        pairs = bounds[:-1][sizes == 2]
        pairs = pairs[np.bitwise_count(longs[pairs] ^ longs[pairs + 1]).sum(1, dtype=np.int64) <= limit]
        a, b = [pairs], [pairs + 1]
        for i in np.flatnonzero(sizes > 2):
            x, y = walk_alike(longs[bounds[i] : bounds[i + 1]], limit)
            a.append(x + bounds[i])
            b.append(y + bounds[i])
        ends = [ids[np.concatenate(x)] for x in (a, b)]
        if len(ends[0]):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in ends], ["a", "b"])

    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # the last ones: rows of the file that is still open
    for batch in batches:
        if not len(batch):
            continue
        files, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))  # ids are bytes
        longs = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint64).reshape(len(batch), -1)
        if held and held[-1][0][-1] != files[0]:
            yield from emit(held)
            held = []
        change = np.flatnonzero(np.diff(files))
        cut = int(change[-1]) + 1 if len(change) else 0
        if cut:
            yield from emit([*held, (files[:cut], ids[:cut], longs[:cut])])
            held = []
        held.append((files[cut:], ids[cut:], longs[cut:]))
    if held:
        yield from emit(held)


def words_key(text: Column) -> Column:
    """A hash of a text's lower-cased words; equal for texts that differ in case and white space only."""

    @F.arrow_udf("binary")
    def key(column: pa.Array) -> pa.Array:
        return pa.array([k for k, _ in _profiles(column, 1, True)], pa.binary())

    return key(text)


def _in_company(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (file, key) sorted by file those whose file has another row; only the last row of a batch is held back."""
    last: tuple[int, bytes, bool] | None = None
    for batch in batches:
        if not len(batch):
            continue
        files = batch.column(0).to_numpy()
        same = np.zeros(len(files) + 1, bool)  # whether a row's file is that of the row before
        same[1:-1] = files[1:] == files[:-1]
        same[0] = last is not None and last[0] == files[0]
        if last is not None and (last[2] or same[0]):
            yield pa.RecordBatch.from_arrays([pa.array([last[0]], pa.int64()), pa.array([last[1]], pa.binary())], ["file", "key"])
        kept = same[:-1] | same[1:]
        last = (int(files[-1]), batch.column(1)[-1].as_py(), bool(same[-2]))
        kept[-1] = False
        yield pa.RecordBatch.from_arrays([c.filter(pa.array(kept)) for c in batch.columns], ["file", "key"])
    if last is not None and last[2]:
        yield pa.RecordBatch.from_arrays([pa.array([last[0]], pa.int64()), pa.array([last[1]], pa.binary())], ["file", "key"])


def _free(name: str, taken: list[str]) -> str:
    """A column name that the input lacks."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def one_of_each_group(docs: DataFrame, size: int = 5, similarity: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one with the smallest id (a null id only if all are null).

    Texts are candidates if they agree in one of ``BANDS`` groups of minima of their ``size``-word shingles; they are linked if
    their long fingerprints of the same shingles are as close as sets of that Jaccard similarity. Every two candidates are
    compared, or connected already, whatever the number of texts that agree. Groups are
    connected components. Null and wordless texts are one group. Of rows that share id and words the one that stays is the
    smallest by the hash of all its columns. A very long text is hashed whole in its task. All columns are kept, whatever their names.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, profiles = zip(*_profiles(batch.column(1), size), strict=True) if len(batch) else ((), ())
            parts = [pa.array([p[cut].tobytes() for p in profiles], pa.binary()) for cut in (slice(BANDS), slice(BANDS, None))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), *parts], ["doc_id", "key", "bands", "long"])

    marks = stored(source.mapInArrow(profile, f"doc_id {kind}, key binary, bands binary, long binary"), "profiles")
    shown = F.min(F.struct("bands", "long")).alias("shown")  # the same for all rows of a key
    counts = marks.groupBy("key", "doc_id").agg(F.count("*").alias("n"), shown)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "n")).alias("first")
    distinct = stored(counts.groupBy("key").agg(first, F.min("shown").alias("shown")).select("key", "first", "shown.*"), "texts")

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                files = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(files), batch.column(0).take(pa.array(np.repeat(np.arange(len(batch)), BANDS)))], ["file", "key"])

    limit = long_distance(similarity)
    filed = distinct.select("key", "bands").mapInArrow(entries, "file long, key binary")
    # most texts share no file; fingerprints travel only for those that do
    shared = stored(filed.repartition("file").sortWithinPartitions("file").mapInArrow(_in_company, "file long, key binary"), "files")
    judged = shared.join(distinct.select("key", "long"), "key").select("file", F.col("key").alias("id"), "long")
    dealt = judged.repartition("file").sortWithinPartitions("file", "id")
    linked = dealt.mapInArrow(lambda batches: _alike_links(batches, limit), "a binary, b binary").distinct()
    labels = components(linked)
    grouped = distinct.join(labels, distinct.key == labels.node, "left").select("key", "first", F.coalesce("label", "key").alias("label"))
    chosen = grouped.groupBy("label").agg(F.min(F.struct("first", "key")).alias("least"))
    key, id_, again, order = (_free(n, docs.columns) for n in ("_words", "_id", "_again", "_order"))
    chosen = chosen.select(F.col("least.key").alias(key), F.col("least.first.doc_id").alias(id_), (F.col("least.first.n") > 1).alias(again))
    kept = docs.withColumn(key, words_key(F.col(text))).join(chosen, key).where(F.col(doc_id).eqNullSafe(F.col(id_)))
    # few rows share an id: only these are ordered
    whole = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema.fields])
    line = Window.partitionBy(key).orderBy(order)
    single = kept.where(again).withColumn(order, whole).withColumn(id_, F.row_number().over(line)).where(F.col(id_) == 1)
    return kept.where(~F.col(again)).select(*docs.columns).unionByName(single.select(*docs.columns))
