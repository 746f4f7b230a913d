"""Toxicity of whole texts by a convolutional text classifier, trained and applied in numpy.

A word is the sum of hashed embeddings of itself and of its first 4, 6 and 8 bytes. Filters of several widths slide over
the words, their maxima over the text go through a rectifier, and a logistic layer gives the score. Training starts the
first embedding coordinate at the association of its bucket with the label and then moves everything by Adam; only the
windows that hold a maximum get a gradient. A last part of the training rows calibrates the score.

The classifier is fitted on at most about ``SAMPLE`` labelled rows, taken by a hash of the id; scoring reads every text whole.
The thresholds, of all and by language, come from the scores of all labelled rows that are not held out, counted on Spark
in ``STEPS`` steps.

Defined results: null and empty texts and texts without words get the score of an empty text; rows stay as they are,
repeated ones included; a null id is never held out of scoring; without both labels to learn from every score is 0; an
empty table gives an empty result; languages without enough examples use the threshold of all. Labels that are neither
0 nor 1 are not learnt from; of repeated labels each counts. Columns of any name are kept, as scores stand beside the row.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkcat.llm import text as tx
from linkcat.llm.registry import query, table

SAMPLE = 4_000
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 16, 16, 8, (1, 2, 3)
PREFIXES = (4, 6, 8)
#: Steps of the score in which rows are counted for the thresholds, and toxic rows that a language needs for its own.
STEPS, ENOUGH = 10_000, 10
EPOCHS, BATCH, RATE = 4, 128, 0.003
_PAD = max(WIDTHS) - 1


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word (one row a word, padding rows of bucket ``BUCKETS`` after each text) and where texts begin."""
    data, offsets = tx.buffers(texts)
    words = tx.Words(tx.LOWER[data], offsets, tx.LETTERS)
    wide = words.data.astype(np.uint64)
    ends = [words.end, *(np.minimum(words.start + k, words.end) for k in PREFIXES)]
    n = len(offsets) - 1
    first = words.first + _PAD * np.arange(n + 1)
    out = np.full((first[-1], len(ends)), BUCKETS, np.int32)
    at = np.arange(len(words)) + _PAD * words.text
    for j, end in enumerate(ends):
        salt = np.uint64(0x9E3779B97F4A7C15 * (j + 1) & (1 << 64) - 1)
        out[at, j] = (tx.mix(tx.run_hashes(wide, words.start, end, tx._BYTES) ^ salt) >> np.uint64(48)).astype(np.int32)
    return out, first


def sample_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``features`` of all texts, worked out slice by slice."""
    _, offsets = tx.buffers(texts)
    parts = [features(texts.slice(low, high - low)) for low, high in tx.slices(offsets)]
    size = np.concatenate([np.diff(first) for _, first in parts])
    return np.concatenate([ids for ids, _ in parts]), np.concatenate([[0], np.cumsum(size)])


@dataclass
class Model:
    """Weights of the classifier; ``thresholds`` by language, ``threshold`` for all others."""

    embed: np.ndarray
    conv: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    last: float = 0.0
    scale: tuple[float, float] = (1.0, 0.0)
    threshold: float = 0.5
    thresholds: dict[str, float] = field(default_factory=dict)

    def pooled(self, ids: np.ndarray, first: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Maxima of all filters over each text, and the windows that hold them."""
        x = self.embed[ids[:, 0]]
        for j in range(1, ids.shape[1]):
            x += self.embed[ids[:, j]]
        n, most, at = len(first) - 1, [], []
        x = np.concatenate([x, np.zeros((_PAD, DIM), np.float32)])
        rows = len(ids)
        for w, weights in zip(WIDTHS, self.conv, strict=True):
            y = x[:rows] @ weights[0]
            for j in range(1, w):
                y += x[j : j + rows] @ weights[j]
            for j in range(1, w):
                y[first[1:] - j] = -1e9  # windows that would reach into the next text
            most.append(np.maximum.reduceat(y, first[:-1], axis=0) if n else np.zeros((0, FILTERS), np.float32))
            if where:
                text = np.repeat(np.arange(n), np.diff(first))
                r, c = np.nonzero(y == most[-1][text])
                place = np.zeros((n, FILTERS), np.int64)
                place[text[r], c] = r
                at.append(place)
        return np.concatenate(most, 1) + self.bias, np.concatenate(at, 1) if where else None

    def logits(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        pooled, _ = self.pooled(ids, first)
        return np.maximum(pooled, 0) @ self.out + self.last

    def scores(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        a, b = self.scale
        z = np.clip(a * self.logits(ids, first).astype(np.float64) + b, -30, 30)
        return 1 / (1 + np.exp(-z))


def _association(ids: np.ndarray, first: np.ndarray, y: np.ndarray, part: np.ndarray) -> np.ndarray:
    """How far each bucket's number of texts with label 1 exceeds chance among the texts ``part``, in standard deviations."""
    kinds = ids.shape[1]
    n, hits = np.zeros((kinds, BUCKETS + 1)), np.zeros((kinds, BUCKETS + 1))
    for i in part.tolist():
        for j in range(kinds):
            seen = np.unique(ids[first[i] : first[i + 1], j])
            n[j, seen] += 1
            hits[j, seen] += y[i]
    p = y[part].mean()
    z = (hits - n * p) / np.sqrt(n * p * (1 - p) + 1)
    out = np.take_along_axis(z, np.abs(z).argmax(0)[None], 0)[0].astype(np.float32)
    out[BUCKETS] = 0
    return out


def train(texts: pa.Array, y: np.ndarray, langs: list[str | None], seed: int = 7) -> Model:
    """Fit, calibrate and set first thresholds; every fourth row is for calibration only."""
    rng = np.random.default_rng(seed)
    k = len(WIDTHS) * FILTERS
    model = Model(rng.normal(0, 0.05, (BUCKETS + 1, DIM)).astype(np.float32), [rng.normal(0, 0.3 / w, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
                  np.zeros(k, np.float32), np.abs(rng.normal(0.3, 0.1, k)).astype(np.float32))
    model.embed[BUCKETS] = 0
    if len(y) < 8 or not 0 < y.sum() < len(y):
        model.scale, model.threshold = (0.0, -30.0), 1.0
        return model
    ids, first = sample_features(texts)
    size = np.diff(first)
    held = np.arange(len(y)) % 4 == 3
    fit = np.flatnonzero(~held)

    def rows(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts of ``part``, side by side."""
        begin = np.concatenate([[0], np.cumsum(size[part])])
        return ids[np.repeat(first[part] - begin[:-1], size[part]) + np.arange(begin[-1])], begin

    model.embed[:, 0] = np.clip(_association(ids, first, y, fit) / 4, -2, 4)
    for w, weights in zip(WIDTHS, model.conv, strict=True):
        weights[:, 0, : FILTERS // 2] = np.abs(weights[:, 0, : FILTERS // 2]) + 0.3 / w
    model.bias -= 1.0
    model.last = float(np.log(y.mean() / (1 - y.mean())))
    params = {"embed": model.embed, "bias": model.bias, "out": model.out, **{f"conv{i}": w for i, w in enumerate(model.conv)}}
    state = {n: (np.zeros_like(p), np.zeros_like(p)) for n, p in params.items()}
    last_m = last_v = 0.0
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(fit)
        for low in range(0, len(order), BATCH):
            part = order[low : low + BATCH]
            x_ids, begin = rows(part)
            pooled, at = model.pooled(x_ids, begin, where=True)
            hidden = np.maximum(pooled, 0)
            z = hidden @ model.out + model.last
            error = ((1 / (1 + np.exp(-np.clip(z, -30, 30)))) - y[part]).astype(np.float32) / len(part)
            back = error[:, None] * model.out * (pooled > 0)
            grads = {"bias": back.sum(0), "out": hidden.T @ error + 1e-4 * model.out}
            touched, moved = [], []
            for i, w in enumerate(WIDTHS):
                g, place = back[:, i * FILTERS : (i + 1) * FILTERS], at[:, i * FILTERS : (i + 1) * FILTERS]
                r, c = np.nonzero(g)
                gw = np.zeros_like(model.conv[i])
                for j in range(w):
                    spot = np.minimum(place[r, c] + j, len(x_ids) - 1)
                    word = x_ids[spot]
                    vector = model.embed[word].sum(1)
                    np.add.at(gw[j].T, c, vector * g[r, c][:, None])
                    touched.append(word.ravel())
                    moved.append(np.repeat(g[r, c][:, None] * model.conv[i][j].T[c], word.shape[1], axis=0))
                grads[f"conv{i}"] = gw + 1e-4 * model.conv[i]
            step += 1
            rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for name, grad in grads.items():
                m, v = state[name]
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                params[name] -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
            if touched and sum(map(len, touched)):
                word, of = np.unique(np.concatenate(touched), return_inverse=True)
                grad = np.zeros((len(word), DIM), np.float32)
                np.add.at(grad, of, np.concatenate(moved))
                m, v = state["embed"]
                m[word] += 0.1 * (grad - m[word])
                v[word] += 0.001 * (grad * grad - v[word])
                model.embed[word] -= rate * m[word] / (np.sqrt(v[word]) + 1e-8)
                model.embed[BUCKETS] = 0
            g = float(error.sum())
            last_m, last_v = last_m + 0.1 * (g - last_m), last_v + 0.001 * (g * g - last_v)
            model.last -= rate * last_m / (np.sqrt(last_v) + 1e-8)
    rest = np.flatnonzero(held)
    z = np.concatenate([model.logits(*rows(part)) for part in np.array_split(rest, max(1, len(rest) // 256))]).astype(np.float64)
    model.scale = _platt(z, y[rest])
    scores = 1 / (1 + np.exp(-np.clip(model.scale[0] * z + model.scale[1], -30, 30)))
    model.threshold = _threshold(scores, y[rest], 0.5)
    spoken = np.array([str(langs[i]) for i in rest])
    for lang in sorted(set(spoken)):
        mine = spoken == lang
        if y[rest][mine].sum() >= ENOUGH:
            model.thresholds[lang] = _threshold(scores[mine], y[rest][mine], model.threshold)
    return model


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logits that fit the labels best, by Newton's method on smoothed labels."""
    a, b = 1.0, 0.0
    pos = y.sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (len(y) - pos + 2))
    x = np.stack([z, np.ones_like(z)], 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        da, db = np.linalg.solve(hess, x.T @ (p - target) + 1e-3 * np.array([a - 1, b]))
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -1, 1)
    return float(max(a, 1e-3)), float(b)


def _threshold(scores: np.ndarray, y: np.ndarray, default: float) -> float:
    """The middle between the neighbouring scores whose cut gives the largest F1."""
    if not 0 < y.sum() < len(y):
        return default
    order = np.argsort(-scores, kind="stable")
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    cut = int(np.argmax(f1))
    low = scores[order[cut + 1]] if cut + 1 < len(order) else 0.0
    return float(np.clip((scores[order[cut]] + low) / 2, 0.05, 0.95))


def _threshold_of_counts(step: np.ndarray, n: np.ndarray, hits: np.ndarray, default: float) -> float:
    """As ``_threshold``, from the numbers of rows and of hits in each step of the score."""
    if not 0 < hits.sum() < n.sum():
        return default
    step, of = np.unique(step, return_inverse=True)
    n, hits = (np.bincount(of, weights=x)[::-1] for x in (n, hits))
    step = np.append(step[::-1], -1)
    cut = int(np.argmax(2 * np.cumsum(hits) / (np.cumsum(n) + hits.sum())))
    return float(np.clip((step[cut] + step[cut + 1] + 1) / 2 / STEPS, 0.05, 0.95))


def _set_thresholds(model: Model, rows: DataFrame, labels: DataFrame) -> None:
    """Thresholds from all ``rows`` (id, text, lang) that have ``labels`` (label_id, y)."""
    scored = score(rows, model).select("row.id", "row.lang", F.floor(F.col("score") * STEPS).alias("step"))  # before the join, so that no text is shuffled
    found = scored.join(labels, F.col("id") == F.col("label_id"))
    counts = found.groupBy("lang", "step").agg(F.count("*").alias("n"), F.sum("y").alias("hits")).toArrow()
    step, n, hits = (np.asarray(counts.column(c)).astype(np.float64) for c in ("step", "n", "hits"))
    model.threshold, model.thresholds = _threshold_of_counts(step, n, hits, model.threshold), {}
    spoken = np.array(counts.column("lang").to_pylist(), object)
    for lang in sorted({x for x in spoken if x is not None}):
        mine = spoken == lang
        if hits[mine].sum() >= ENOUGH:
            model.thresholds[lang] = _threshold_of_counts(step[mine], n[mine], hits[mine], model.threshold)


def is_held_out(id: Column) -> Column:
    """Rows whose labels no model may see."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _train_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pickled model of a sample that comes as one partition."""
    held = list(batches)
    if sum(b.num_rows for b in held):
        found = pa.Table.from_batches(held).sort_by([("label_id", "ascending"), ("text", "ascending")]).combine_chunks()
        texts = found.column("text")
        model = train(texts.chunk(0), np.asarray(found.column("y")).astype(np.float64), found.column("lang").to_pylist())
        trained = pickle.dumps(model)
        del found, texts, model, held
        tx.give_back()  # the worker goes on with other tasks
        yield pa.RecordBatch.from_arrays([pa.array([trained], pa.binary())], ["model"])


def _trained(rows: DataFrame) -> Model:
    """A model of a bounded sample, worked out in one task; only the weights come to the driver."""
    found = rows.repartition(1).mapInArrow(_train_one, "model binary").first()
    return pickle.loads(found["model"]) if found else train(pa.array([], pa.string()), np.zeros(0), [])


def fit(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", lang: str = "lang", label: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model from at most about ``sample`` labelled rows that are not held out, with thresholds from all of those."""
    usable = labels.where(labels[label].isin(0, 1) & labels[id].isNotNull() & ~is_held_out(labels[id])).select(labels[id].alias("label_id"), labels[label].alias("y"))
    share = max(1, -(-usable.count() // sample))
    some = usable.where(F.pmod(F.xxhash64("label_id"), F.lit(share)) == 0)
    spoken = docs[lang].cast("string") if lang in docs.columns else F.lit(None).cast("string")
    texts = docs.select(docs[id].alias("label_id"), docs[text].alias("text"), spoken.alias("lang"))
    rows = texts.join(F.broadcast(some), "label_id")  # about ``sample`` rows
    model = _trained(rows.select("label_id", "text", "lang", "y"))
    if model.scale[0]:  # else there was nothing to learn from
        seen = docs.where(docs[id].isNotNull() & ~is_held_out(docs[id])).select(docs[id].alias("id"), docs[text].alias("text"), spoken.alias("lang"))
        _set_thresholds(model, seen, usable)
    return model


def score(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """Each row as the struct ``row`` with its ``score``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def work(texts: pa.Array) -> dict[str, pa.Array]:
        ids, first = features(texts)
        return {"score": pa.array(held.value.scores(ids, first))}

    return tx.add_columns(docs, "score double", lambda: work, text)


def clean(docs: DataFrame, model: Model, *, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose score is under the threshold of their language."""
    scored = score(docs, model, text=text)
    limit = F.lit(model.threshold)
    if lang in docs.columns:
        for name, value in model.thresholds.items():
            limit = F.when(F.col(f"row.`{lang}`").cast("string") == name, F.lit(value)).otherwise(limit)
    return scored.where(F.col("score") < limit).select("row.*")


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored by a model of labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("row.doc_id", is_held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
