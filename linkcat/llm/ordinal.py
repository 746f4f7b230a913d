"""Text quality by ordinal cumulative-link regression on graded ratings.

All grades share one vector of weights over hashed text features; ordered thresholds ``t_1 < ... < t_m`` cut the score into
the grades that occur in the training rows: ``P(grade > g_j) = sigmoid(w.x - t_j)``. That gives the expected grade, which ranks
documents, and the tail probability of a grade or better, which selects them.

Features of a text are the hashed words and pairs of words, by the share of their occurrences (square root, so that
frequent ones don't drown the others), and shares of character kinds (letters, digits, marks, capitals, spaces), repeated
words, and the logarithm of the length. The fit uses at most about ``SAMPLE`` labelled rows, taken by a hash of the id;
every text is scored whole.

Defined results: null and empty texts have the features of an empty text; rows stay as they are, repeated ones included;
null ratings are not learnt from; of repeated ratings each counts; with fewer than two grades every expected grade is
that grade (or 0) and every tail probability 1; an empty table gives an empty result; columns of any name are kept, as
results stand beside the row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkcat.llm import text as tx
from linkcat.llm.registry import query, table
from linkcat.llm.toxicity import is_held_out

SAMPLE = 4_000
BUCKETS = 1 << 16
EPOCHS, BATCH, RATE = 12, 256, 0.02
SHAPE = 12

_BYTE = np.arange(256)
_KINDS = np.stack([(_BYTE >= 0x61) & (_BYTE <= 0x7A), (_BYTE >= 0x41) & (_BYTE <= 0x5A), (_BYTE >= 0x30) & (_BYTE <= 0x39), np.isin(_BYTE, [0x20, 0x09, 0x0A, 0x0D]),
                   np.isin(_BYTE, list(b".,;:!?'\"-()")), (_BYTE >= 0x80), (_BYTE > 0x20) & (_BYTE < 0x7F) & ~np.isin(_BYTE, list(b".,;:!?'\"-()"))
                   & ~(((_BYTE | 32) >= 0x61) & ((_BYTE | 32) <= 0x7A)) & ~((_BYTE >= 0x30) & (_BYTE <= 0x39))])


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and values of the hashed features, where each text's begin, and the features of the text's shape."""
    data, offsets = tx.buffers(texts)
    words = tx.Words(tx.LOWER[data], offsets, tx.LETTERS)
    n, hashes, of = len(offsets) - 1, words.hashes(), words.text
    start, pairs = tx.shingles(hashes, words.first, 2)
    bucket = (np.concatenate([tx.mix(hashes), tx.mix(pairs + np.uint64(1))]) >> np.uint64(48)).astype(np.int64)
    text = np.concatenate([of, of[start]])
    key, count = np.unique(text * BUCKETS + bucket, return_counts=True)
    text, bucket = key // BUCKETS, key % BUCKETS
    first = np.searchsorted(text, np.arange(n + 1))
    value = np.sqrt(count / np.maximum(words.counts, 1)[text]).astype(np.float32)
    value /= np.sqrt(np.maximum(np.bincount(text, value * value, n), 1e-9))[text].astype(np.float32)
    size = np.maximum(np.diff(offsets), 1)
    shape = np.zeros((n, SHAPE), np.float32)
    for j, kind in enumerate(_KINDS):
        total = np.concatenate([[0], np.cumsum(kind[data], dtype=np.int64)])
        shape[:, j] = np.diff(total[offsets]) / size
    distinct = np.unique(of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ hashes, return_index=True)[1]
    most = np.maximum(words.counts, 1)
    shape[:, 7] = np.bincount(of[distinct], minlength=n) / most
    same = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1]) if len(hashes) else np.zeros(0, bool)
    shape[:, 8] = np.bincount(of[1:][same], minlength=n) / most if len(same) else 0
    shape[:, 9] = np.log1p(words.counts) / 10
    shape[:, 10] = size / most / 20
    shape[:, 11] = words.counts == 0
    return bucket.astype(np.int32), value, first, shape


def sample_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``features`` of all texts, worked out slice by slice."""
    _, offsets = tx.buffers(texts)
    parts = [features(texts.slice(low, high - low)) for low, high in tx.slices(offsets)]
    size = np.concatenate([np.diff(first) for _, _, first, _ in parts])
    bucket, value, shape = (np.concatenate([p[i] for p in parts]) for i in (0, 1, 3))
    return bucket, value, np.concatenate([[0], np.cumsum(size)]), shape


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Model:
    """Shared weights, weights of the shape features with their scaling, ordered thresholds between the grades."""

    weights: np.ndarray
    shape: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    thresholds: np.ndarray
    grades: np.ndarray

    def raw(self, bucket: np.ndarray, value: np.ndarray, first: np.ndarray, shape: np.ndarray) -> np.ndarray:
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        hashed = np.bincount(text, self.weights[bucket] * value, len(first) - 1)
        return hashed + np.clip((shape - self.mean) / self.spread, -6, 6) @ self.shape

    def tails(self, score: np.ndarray) -> np.ndarray:
        """``P(grade > g_j)`` for every threshold."""
        return _sigmoid(score[:, None] - self.thresholds)

    def expected(self, tails: np.ndarray) -> np.ndarray:
        return (self.grades[0] if len(self.grades) else 0.0) + tails @ np.diff(self.grades) if len(self.grades) > 1 else np.full(len(tails), float(self.grades[0]) if len(self.grades) else 0.0)


def train(texts: pa.Array, ratings: np.ndarray, seed: int = 3) -> Model:
    """Maximum likelihood with L2 by Adam; thresholds stay ordered as they are a first one plus positive steps."""
    rng = np.random.default_rng(seed)
    grades = np.unique(ratings)
    m = max(len(grades) - 1, 0)
    model = Model(np.zeros(BUCKETS), np.zeros(SHAPE), np.zeros(SHAPE), np.ones(SHAPE), np.zeros(m), grades.astype(np.float64))
    if not m:
        return model
    bucket, value, first, shape = sample_features(texts)
    model.mean, model.spread = shape.mean(0), shape.std(0) + 1e-3
    level = np.searchsorted(grades, ratings)
    above = np.clip(np.array([(level > j).mean() for j in range(m)]), 1e-3, 1 - 1e-3)
    raw = -np.log(above / (1 - above))
    free = np.concatenate([raw[:1], np.log(np.expm1(np.maximum(np.diff(raw), 1e-2)))])
    params = [model.weights, model.shape, free]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    size, step = np.diff(first), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(level))
        for low in range(0, len(order), BATCH):
            part = order[low : low + BATCH]
            begin = np.concatenate([[0], np.cumsum(size[part])])
            at = np.repeat(first[part] - begin[:-1], size[part]) + np.arange(begin[-1])
            b, v, y = bucket[at], value[at], level[part]
            gaps = np.log1p(np.exp(free[1:]))
            model.thresholds = free[0] + np.concatenate([[0], np.cumsum(gaps)])
            score = model.raw(b, v, begin, shape[part])
            # A grade's probability is the difference of the tails beside it.
            edges = np.concatenate([np.full((len(part), 1), np.inf), score[:, None] - model.thresholds, np.full((len(part), 1), -np.inf)], 1)
            tail = np.where(np.isinf(edges), edges > 0, _sigmoid(np.where(np.isinf(edges), 0, edges)))
            rows = np.arange(len(part))
            p = np.maximum(tail[rows, y] - tail[rows, y + 1], 1e-9)
            slope = tail * (1 - tail)
            d_edges = np.zeros_like(tail)
            d_edges[rows, y] -= slope[rows, y] / p
            d_edges[rows, y + 1] += slope[rows, y + 1] / p
            d_edges /= len(part)
            d_score, d_threshold = d_edges.sum(1), -d_edges[:, 1:-1].sum(0)
            text = np.repeat(rows, np.diff(begin))
            d_free = np.concatenate([[d_threshold.sum()], np.cumsum(d_threshold[::-1])[::-1][1:] * (1 - np.exp(-gaps))])
            scaled = np.clip((shape[part] - model.mean) / model.spread, -6, 6)
            grads = [np.bincount(b, d_score[text] * v, BUCKETS) + 1e-5 * model.weights, scaled.T @ d_score + 1e-4 * model.shape, d_free]
            step += 1
            rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for w, g, (a, c) in zip(params, grads, moments, strict=True):
                a += 0.1 * (g - a)
                c += 0.001 * (g * g - c)
                w -= rate * a / (np.sqrt(c) + 1e-8)
    model.thresholds = free[0] + np.concatenate([[0], np.cumsum(np.log1p(np.exp(free[1:])))])
    return model


def fit(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", rating: str = "quality", sample: int = SAMPLE) -> Model:
    """A model from at most about ``sample`` rated rows that are not held out."""
    rated = labels.where(labels[rating].isNotNull() & labels[id].isNotNull() & ~is_held_out(labels[id])).select(labels[id].alias("label_id"), labels[rating].cast("double").alias("y"))
    share = max(1, -(-rated.count() // sample))
    rated = rated.where(F.pmod(F.xxhash64("label_id"), F.lit(share)) == 0)
    texts = docs.select(docs[id].alias("label_id"), docs[text].alias("text"))
    rows = texts.join(F.broadcast(rated), "label_id")  # about ``sample`` rows
    found = rows.select("label_id", "text", "y").toArrow().sort_by([("label_id", "ascending"), ("text", "ascending"), ("y", "ascending")])
    texts = found.column("text")
    return train(pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string()), np.asarray(found.column("y")))


def grade(docs: DataFrame, model: Model, *, at_least: float | None = None, text: str = "text") -> DataFrame:
    """Each row as the struct ``row`` with ``expected_grade`` and ``tail``, the probability of ``at_least`` (the best grade by default) or better."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def work(texts: pa.Array) -> dict[str, pa.Array]:
        model: Model = held.value
        tails = model.tails(model.raw(*features(texts)))
        wanted = model.grades[-1] if at_least is None and len(model.grades) else at_least or 0.0
        passed = np.searchsorted(model.grades, wanted)  # grades under the wanted one
        full = np.concatenate([np.ones((len(tails), 1)), tails, np.zeros((len(tails), 1))], 1)
        return {"expected_grade": pa.array(model.expected(tails)), "tail": pa.array(full[:, min(passed, full.shape[1] - 1)])}

    return tx.add_columns(docs, "expected_grade double, tail double", lambda: work, text)


def select(docs: DataFrame, model: Model, *, probability: float = 0.5, at_least: float | None = None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose tail probability is ``probability`` or more."""
    return grade(docs, model, at_least=at_least, text=text).where(F.col("tail") >= probability).select("row.*")


@query("op8_ordinal_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, graded by a model of rated rows that are not held out; kept if the best grade is likelier than not."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    graded = grade(docs, fit(docs, table(spark, sf_dir, "labels")))
    return graded.select("row.doc_id", is_held_out(F.col("row.doc_id")).alias("held_out"), "expected_grade", F.col("tail").alias("tail_probability"), (F.col("tail") >= 0.5).alias("kept"))
