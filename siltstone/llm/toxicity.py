"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word is the sum of three hashed embeddings: two of the whole word, so that one unlucky collision is not taken for the
word, and one of its first bytes. Case does not count. Filters of several widths run over the words of the whole text; the maximum of each
filter goes into a logistic layer. The classifier is fitted on at most ``Settings.positives`` + ``Settings.negatives``
labelled documents, chosen by a hash of their id, in one task; the intercept is moved back to the share of positives among
all labelled rows. A second classifier is fitted without a fifth of the sample. It scores all labelled rows, and what it was not
fitted on places a threshold for each language, with the weight that both kinds have among all labelled rows.
"""

from __future__ import annotations

import io
import os
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.arrays import array_folder, is_mounted, read_array, write_array
from siltstone.llm.shared import stored
from siltstone.llm.text import PLAIN_BYTES, byte_blocks, fold, held_out, mix, word_hashes, word_spans

TABLES = 3
PADS = 3  # at least the widest filter


@dataclass(frozen=True)
class Settings:
    positives: int = 3000
    negatives: int = 5000
    bits: int = 17
    size: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    prefix: int = 6
    epochs: int = 8
    batch: int = 64
    rate: float = 0.1
    folds: int = 5


@dataclass
class Model:
    """The classifier; ``folder`` names where its arrays lie if they are in the shared folder, for workers to map."""

    settings: Settings
    arrays: dict[str, np.ndarray]
    thresholds: dict[str, float] = field(default_factory=dict)
    folder: str | None = None

    def rounded(self) -> dict[str, np.ndarray]:
        """The arrays as they are kept: embeddings to half precision."""
        return {k: v.astype(np.float16).astype(np.float32) if k == "words" else v for k, v in self.arrays.items()}

    def save(self, folder: str) -> None:
        os.makedirs(folder, exist_ok=True)
        for name, values in self.rounded().items():
            write_array(folder, name, values)

    @staticmethod
    def mapped(folder: str, settings: Settings, thresholds: dict[str, float] | None = None) -> Model:
        names = sorted(n[: -len(".npy")] for n in os.listdir(folder) if n.endswith(".npy"))
        return Model(settings, {n: read_array(folder, n) for n in names}, thresholds or {}, folder)

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, **{k: v.astype(np.float16) if k == "words" else v for k, v in self.arrays.items()})
        return out.getvalue()

    @staticmethod
    def unpack(data: bytes, settings: Settings, thresholds: dict[str, float]) -> Model:
        with np.load(io.BytesIO(data)) as z:
            return Model(settings, {k: z[k].astype(np.float32) for k in z.files}, thresholds)


def word_ids(data: np.ndarray, offsets: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the embedding tables (one column a table) of all words, and where each text's words begin."""
    starts, ends, rows = word_spans(data, offsets, PLAIN_BYTES)
    whole = word_hashes(data, starts, ends)
    begin = word_hashes(data, starts, np.minimum(ends, starts + s.prefix))
    mask = np.uint64((1 << s.bits) - 1)
    ids = [whole & mask, (mix(whole) >> np.uint64(20)) & mask, begin & mask]
    return np.stack(ids, 1).astype(np.int32) + (np.arange(TABLES, dtype=np.int32) << s.bits), rows


def _laid_out(ids: np.ndarray, rows: np.ndarray, empty: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids with pads after every text, where texts begin, and the places where a window may not begin."""
    sizes = np.diff(rows)
    begins = rows[:-1] + PADS * np.arange(len(sizes))
    out = np.full((len(ids) + PADS * len(sizes) + PADS, TABLES), empty, np.int32)
    out[np.arange(len(ids)) + PADS * np.repeat(np.arange(len(sizes)), sizes)] = ids
    closed = (begins + sizes)[:, None] + np.arange(1, PADS)
    return out, begins, closed.ravel()


def _pooled(a: dict[str, np.ndarray], s: Settings, ids: np.ndarray, rows: np.ndarray, places: bool = False):
    """Maxima of every filter for every text; with ``places``, also the windows that gave them."""
    laid, begins, closed = _laid_out(ids, rows, TABLES << s.bits)
    x = a["words"][laid[:, 0]]
    for t in range(1, TABLES):
        x = x + a["words"][laid[:, t]]
    last = len(laid) - PADS
    maxima, at = [], []
    for w in s.widths:
        out = sum(x[o : last + o] @ a[f"w{w}"][o] for o in range(w)) + a[f"b{w}"]
        out[closed] = -1e9
        top = np.maximum.reduceat(out, begins, axis=0)
        maxima.append(top)
        if places:
            text = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, last)))
            hit = out == top[text]
            where = np.where(hit, np.arange(last)[:, None], last)
            at.append(np.minimum.reduceat(where, begins, axis=0))
    return np.maximum(np.concatenate(maxima, 1), 0), at, laid, x


def probabilities(model: Model, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    a = model.arrays
    pooled = _pooled(a, model.settings, ids, rows)[0]
    return 1 / (1 + np.exp(-np.clip(pooled @ a["out"] + a["bias"], -30, 30)))


def fit(texts: list[bytes], labels: np.ndarray, s: Settings, share: float) -> Model:
    """Train on texts with labels 0 and 1; ``share`` is the share of ones where the model will be used."""
    rng = np.random.default_rng(11)
    n_filters = s.filters * len(s.widths)
    a = {"words": rng.normal(0, 0.05, ((TABLES << s.bits) + 1, s.size)).astype(np.float32)}
    a["words"][-1] = 0
    for w in s.widths:
        a[f"w{w}"] = rng.normal(0, 0.4, (w, s.size, s.filters)).astype(np.float32)
        a[f"b{w}"] = np.zeros(s.filters, np.float32)
    a["out"] = np.abs(rng.normal(0, 0.4, n_filters)).astype(np.float32)
    a["bias"] = np.array([-1.0], np.float32)
    grown = {k: np.full_like(v, 1e-2) for k, v in a.items()}

    docs = []
    for text in texts:
        data = np.frombuffer(text, np.uint8)
        docs.append(word_ids(data, np.array([0, len(data)]), s)[0] if len(data) else np.zeros((0, TABLES), np.int32))

    def step(name: str, grad: np.ndarray, at: np.ndarray | None = None) -> None:
        if at is None:
            grown[name] += grad * grad
            a[name] -= s.rate * grad / np.sqrt(grown[name])
        else:
            keys, inverse = np.unique(at, return_inverse=True)
            total = np.zeros((len(keys), grad.shape[1]), np.float32)
            np.add.at(total, inverse, grad)
            grown[name][keys] += total * total
            a[name][keys] -= s.rate * total / np.sqrt(grown[name][keys])

    for _ in range(s.epochs if len(docs) else 0):
        order = rng.permutation(len(docs))
        for lo in range(0, len(order), s.batch):
            chosen = order[lo : lo + s.batch]
            ids = np.concatenate([docs[i] for i in chosen])
            rows = np.concatenate([[0], np.cumsum([len(docs[i]) for i in chosen])])
            pooled, at, laid, x = _pooled(a, s, ids, rows, True)
            p = 1 / (1 + np.exp(-np.clip(pooled @ a["out"] + a["bias"], -30, 30)))
            dz = ((p - labels[chosen]) / len(chosen)).astype(np.float32)
            dpool = dz[:, None] * a["out"] * (pooled > 0)
            grads, places = [], []
            for k, w in enumerate(s.widths):
                d = dpool[:, k * s.filters : (k + 1) * s.filters]  # texts x filters
                for o in range(w):
                    xs = x[at[k] + o]  # texts x filters x size
                    grads.append((d[:, :, None] * a[f"w{w}"][o].T[None]).reshape(-1, s.size))
                    places.append((at[k] + o).ravel())
                    a_grad = np.einsum("bf,bfd->df", d, xs)
                    full = np.zeros_like(a[f"w{w}"])
                    full[o] = a_grad
                    step(f"w{w}", full)
                step(f"b{w}", d.sum(0))
            step("out", pooled.T @ dz)
            step("bias", dz.sum(keepdims=True))
            g, where = np.concatenate(grads), np.concatenate(places)
            for t in range(TABLES):
                step("words", g, laid[where, t])
            a["words"][-1] = 0
    ones = labels.mean() if len(labels) else 0.5
    if 0 < ones < 1 and 0 < share < 1:
        a["bias"] += np.float32(np.log(share / (1 - share)) - np.log(ones / (1 - ones)))
    return Model(s, a)


def best_cut(low: np.ndarray, high: np.ndarray, ones: np.ndarray, rows: np.ndarray) -> float:
    """The cut with the best F1 between bins of scores, in the middle of the gap below the lowest score that is taken.

    Bins do not overlap; each has its lowest and highest score, the weight of its ones and of all its rows.
    """
    order = np.argsort(-low, kind="stable")
    f1 = 2 * np.cumsum(ones[order]) / (np.cumsum(rows[order]) + ones.sum())
    best = int(np.argmax(f1))
    below = high[order][best + 1] if best + 1 < len(order) else 0.0
    return float((low[order][best] + below) / 2)


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The cut of single scores; equal scores fall on one side."""
    values, at = np.unique(scores, return_inverse=True)
    return best_cut(values, values, np.bincount(at, labels), np.bincount(at).astype(float))


#: Bins of scores, for each unit of log odds.
BINS = 64
#: A language's own threshold counts as so many rows more than it has of its rarer kind would; the rest is the general one.
LEAST = 10


def _odds(share: float) -> float:
    share = min(max(share, 1e-12), 1 - 1e-12)
    return float(np.log(share / (1 - share)))


def thresholds(scored: DataFrame) -> dict[str, float]:
    """Threshold by language, and for "" that of all, from rows (lang, label, score, fitted).

    Rows that the model was fitted on count for the totals only: the others of a language and label stand for them. A
    language's threshold lies between its own and the general one, the nearer to its own the more rows it has.
    """
    odds = F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-7), F.col("score")))
    own = F.coalesce("lang", F.lit(""))
    fresh = ~F.col("fitted")
    bins = (
        scored.select(own.alias("lang"), "label", "score", "fitted", F.floor(F.log(odds / (1 - odds)) * BINS).alias("bin"))
        .groupBy("lang", "label", "bin")
        .agg(F.count("*").alias("total"), F.count_if(fresh).alias("n"), F.min(F.when(fresh, F.col("score"))).alias("low"), F.max(F.when(fresh, F.col("score"))).alias("high"))
        .withColumn("group", F.explode(F.array_distinct(F.array("lang", F.lit("")))))
        .groupBy("group", "label", "bin")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    )

    def cut(key: tuple, rows: pa.Table) -> pa.Table:
        label, bin_, total, n = (rows[c].to_numpy().astype(np.int64) for c in ("label", "bin", "total", "n"))
        name = key[0].as_py()
        counts = [n[label == y].sum() for y in (0, 1)]
        if not min(counts):
            return pa.table({"name": pa.array([], pa.string()), "cut": pa.array([], pa.float64()), "n": pa.array([], pa.int64())})
        weight = n * np.array([total[label == y].sum() / counts[y] for y in (0, 1)])[label]
        used = n > 0
        _, at = np.unique(bin_[used], return_inverse=True)
        low, high = np.full(at.max() + 1, np.inf), np.zeros(at.max() + 1)
        np.minimum.at(low, at, rows["low"].to_numpy()[used])
        np.maximum.at(high, at, rows["high"].to_numpy()[used])
        found = best_cut(low, high, np.bincount(at, (weight * label)[used]), np.bincount(at, weight[used]))
        return pa.table({"name": pa.array([name], pa.string()), "cut": pa.array([found], pa.float64()), "n": pa.array([int(min(counts))], pa.int64())})

    found = {r["name"]: r for r in bins.groupBy("group").applyInArrow(cut, "name string, cut double, n long").collect()}  # one row a language
    general = _odds(found[""]["cut"]) if "" in found else 0.0
    shrunk = {name: (r["n"] * _odds(r["cut"]) + LEAST * general) / (r["n"] + LEAST) for name, r in found.items()}
    return {name: float(1 / (1 + np.exp(-x))) if name else found[name]["cut"] for name, x in shrunk.items()}


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Fit on labelled documents outside fold 0 of ``settings.folds``; of repeated labels the larger one holds.

    Rows with a null id or label are left out. Without labels of both kinds every score is the share of ones.
    """
    s = settings
    marked = (
        labels.where("doc_id is not null and toxic is not null")
        .where(fold("doc_id", s.folds) != 0)
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("label"))
    )
    known = docs.select(F.col(doc_id).alias("doc_id")).distinct()
    marked = marked.join(known, "doc_id", "left_semi")
    totals = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    mixed = F.xxhash64(F.lit("sample"), "doc_id")
    coin = (F.pmod(F.xxhash64(F.lit("held back"), "doc_id"), F.lit(5)) == 0).alias("coin")
    sample = marked.where("label = 1").orderBy(mixed).limit(s.positives).unionByName(marked.where("label = 0").orderBy(mixed).limit(s.negatives))
    sample = stored(sample.select("doc_id", "label", coin), "sample")
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    # at most positives + negatives ids, so they may be sent to every task
    rows = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.max("label").alias("label"), F.max("coin").alias("coin"), F.min("text").alias("text"))

    spark = docs.sparkSession
    folder = array_folder(spark, "classifier") if is_mounted(spark) else None

    def kept(model: Model, name: str) -> bytes:
        """Where the model was saved, or the model itself where workers cannot map files."""
        if folder is None:
            return model.pack()
        model.save(f"{folder}/{name}")
        return f"{folder}/{name}".encode()

    def learn(batches):
        found = [r for b in batches for r in b.to_pylist()]
        found.sort(key=lambda r: r["doc_id"])
        y = np.array([r["label"] for r in found], np.float64)
        held = np.array([r["coin"] for r in found], bool)
        lower = pc.utf8_lower(pa.array([r.pop("text") or "" for r in found], pa.string()))  # as texts are scored
        raw = [t.encode() for t in lower.to_pylist()]
        pa.default_memory_pool().release_unused()
        part = None
        if 0 < y[~held].sum() < (~held).sum():
            part = kept(fit([t for t, h in zip(raw, held, strict=True) if not h], y[~held], s, share), "part")
        model = kept(fit(raw, y, s, share) if 0 < y.sum() < len(y) else constant(s, share), "model")
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary()), pa.array([part], pa.binary())], ["model", "part"])

    def opened(told: bytes, cuts: dict[str, float]) -> Model:
        return Model.unpack(bytes(told), s, cuts) if folder is None else Model.mapped(bytes(told).decode(), s, cuts)

    # the sample has a bound, so one task may hold it; what comes back is two names, or two models of fixed size
    row = rows.repartition(1).mapInArrow(learn, "model binary, part binary").first()
    if row is None:
        return constant(s, share)
    if row["part"] is None:
        return opened(row["model"], {})
    part = opened(row["part"], {})
    scored = texts.where(fold("doc_id", s.folds) != 0).select("doc_id", "lang", score(part, docs, F.col("text")).alias("score"))
    fitted = sample.where("not coin").select("doc_id", F.lit(True).alias("fitted"))
    labelled = scored.join(marked, "doc_id").join(F.broadcast(fitted), "doc_id", "left")
    one = labelled.groupBy("doc_id").agg(F.max("label").alias("label"), F.min(F.struct("lang", "score")).alias("at"), F.max(F.coalesce("fitted", F.lit(False))).alias("fitted"))
    return opened(row["model"], thresholds(one.select("label", "at.lang", "at.score", "fitted")))


def constant(s: Settings, share: float) -> Model:
    """A model that gives every text the share of ones: there is nothing to tell the two kinds apart by."""
    model = fit([], np.zeros(0), s, share)
    model.arrays["out"][:] = 0
    model.arrays["bias"][:] = np.log((share + 1e-6) / (1 - share + 1e-6))
    return model


def _one(model: Model, text: bytes) -> float:
    data = np.frombuffer(text, np.uint8)
    ids, rows = word_ids(data, np.array([0, len(data)]), model.settings) if len(data) else (np.zeros((0, TABLES), np.int64), np.array([0, 0]))
    return float(probabilities(model, ids, rows)[0])


_mapped: dict[str, Model] = {}


def _at(folder: str, settings: Settings) -> Model:
    """The model of a folder, mapped once in each worker."""
    if folder not in _mapped:
        _mapped.clear()
        _mapped[folder] = Model.mapped(folder, settings)
    return _mapped[folder]


def score(model: Model, docs: DataFrame, text: Column) -> Column:
    """Probability of toxicity of a whole text; null texts are scored as empty. A very long text is scored whole in its task."""
    folder, settings = model.folder, model.settings
    shared = None if folder else docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def classify(column: pa.Array) -> pa.Array:
        model, found = _at(folder, settings) if folder else shared.value, [np.zeros(0)]
        for _, offsets, data in byte_blocks(pc.utf8_lower(column), 1 << 18):
            ids, rows = word_ids(data, offsets, model.settings)
            found.append(probabilities(model, ids, rows))
        return pa.array(np.concatenate(found).astype(np.float64))

    return classify(text)


def threshold(model: Model, lang: Column) -> Column:
    """The language's threshold; that of all languages where it has no labelled rows of both kinds."""
    general = F.lit(model.thresholds.get("", 0.5))
    cuts = [x for k, v in model.thresholds.items() if k for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.create_map(*cuts)[F.coalesce(lang, F.lit(""))], general) if cuts else general


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (score >= 0.5), threshold of the language, rejected."""
    model = train(docs, labels, settings)
    scored = docs.select("doc_id", held_out("doc_id", settings.folds).alias("held_out"), score(model, docs, F.col("text")).alias("score"), threshold(model, F.col("lang")).alias("threshold"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "threshold", (F.col("score") >= F.col("threshold")).alias("rejected"))
