"""Quality classifier: hashed word n-gram logistic regression, trained with
follow-the-regularised-leader updates and scored as sparse dot products."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, arrow_map, carried, crc_mod, mix64, schema_with, span_hashes, table, text_bytes

#: Byte classes: white space, letters (and all beyond ASCII), digits, marks.  A token is a run of one class.
_CLASS = np.full(256, 3, np.int8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_CLASS[0x30:0x3A] = 2
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LOWER = np.frombuffer(LOWER, np.uint8)
#: Weights of the model; labelled rows that training takes at most (a hash of the id chooses them).
BUCKETS, MOST_LABELLED = 1 << 18, 20_000
THRESHOLD = 0.3


def grams(texts: list[str | None], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of the n-grams of all texts, one after the other, and where each text's begin (and the last ends).

    The n-grams of a text are those of its words and marks (n = 1, 2; letter case apart in n = 1,
    any number alike), of their shapes (n = 1, 2) and one for each word that repeats the last."""
    parts = [text_bytes(t) + b"\n" for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends_of = np.cumsum([len(p) for p in parts])
    kind = _CLASS[data]
    turn = np.flatnonzero(np.diff(kind)) + 1
    starts = np.concatenate([np.zeros(1, np.int64), turn])[: len(data)]
    ends = np.concatenate([turn, np.array([len(data)])])[: len(starts)]
    keep = kind[starts] > 0
    starts, ends = starts[keep], ends[keep]
    if not len(starts):
        return np.empty(0, np.int32), np.zeros(len(parts) + 1, np.int64)
    kind, length = kind[starts], ends - starts
    raw, low = span_hashes(data, starts, ends), span_hashes(_LOWER[data], starts, ends)
    upper = np.cumsum(np.concatenate([np.zeros(1, np.int32), _UPPER[data]]))
    case = np.where(upper[ends] - upper[starts] == length, 2, _UPPER[data[starts]])
    shape = kind * 64 + case * 16 + np.minimum(length, 15) // 3
    shape[kind == 2] = 128
    raw[kind == 2] = low[kind == 2] = 2
    of = np.searchsorted(ends_of, starts, side="right")
    last = np.flatnonzero(of[1:] == of[:-1])
    same = last[low[last] == low[last + 1]]
    salt = lambda h, k: mix64(h.astype(np.uint64) * np.uint64(8) + np.uint64(k))
    codes = np.concatenate([salt(raw, 0), salt(shape, 1), salt(low[last] * np.uint64(31) + mix64(low[last + 1]), 2), salt(shape[last] * 4096 + shape[last + 1], 3), salt(np.full(len(same), 7), 4)])
    owner = np.concatenate([of, of, of[last], of[last], of[same]])
    order = np.argsort(owner, kind="stable")
    return (codes[order] % np.uint64(buckets)).astype(np.int32), np.searchsorted(owner[order], np.arange(len(parts) + 1))


def features(index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of one text's n-grams and their counts over the root of the number of n-grams."""
    i, n = np.unique(index, return_counts=True)
    return i, (n / np.sqrt(max(1, len(index)))).astype(np.float32)


class Ftrl:
    """Per-coordinate FTRL-proximal logistic regression; the last coordinate is the bias."""

    def __init__(self, size: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, i=slice(None)) -> np.ndarray:
        z = self.z[i]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(self.n[i])) / self.alpha + self.l2)

    def update(self, index: np.ndarray, value: np.ndarray, label: int, importance: float = 1.0) -> None:
        i = np.append(index, len(self.z) - 1)
        x = np.append(value, 1.0)
        w = self.weights(i)
        g = (1 / (1 + np.exp(-np.dot(w, x))) - label) * x * importance
        g2 = g * g
        sigma = (np.sqrt(self.n[i] + g2) - np.sqrt(self.n[i])) / self.alpha
        self.z[i] += g - sigma * w
        self.n[i] += g2


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], buckets: int = BUCKETS, epochs: int = 3) -> np.ndarray:
    """Weights and bias from rows (buckets, values, label), in the given order; classes count alike.

    The bias ends where the threshold best separates the training rows by balanced accuracy."""
    model, n = Ftrl(buckets), max(1, len(rows))
    share = [sum(1 for r in rows if r[2] == k) / n for k in (0, 1)]
    for _ in range(epochs):
        for index, value, label in rows:
            model.update(index, value, label, 0.5 / share[label])
    w = model.weights().astype(np.float32)
    if min(share) > 0:
        raw = np.array([np.dot(w[i], v) for i, v, _ in rows])
        w[-1] = np.log(THRESHOLD / (1 - THRESHOLD)) - best_cut(raw, np.array([r[2] for r in rows]))
    return w


def best_cut(raw: np.ndarray, label: np.ndarray) -> float:
    """The middle of the widest best range of cuts, by balanced accuracy."""
    order = np.argsort(raw, kind="stable")
    raw, label = raw[order], label[order]
    below = np.cumsum(label == 0) / max(1, (label == 0).sum())
    above = 1 - np.cumsum(label == 1) / max(1, (label == 1).sum())
    good = below + above
    good[:-1][raw[1:] == raw[:-1]] = -1
    best = np.flatnonzero(good >= good.max() - 1e-12)
    upper = raw[np.minimum(best + 1, len(raw) - 1)]
    k = int(np.argmax(upper - raw[best]))
    return float((raw[best[k]] + upper[k]) / 2)


def scores(texts: list[str | None], w: np.ndarray) -> np.ndarray:
    """Probabilities of label 1: sparse dot products of the n-gram counts and the weights."""
    index, at = grams(texts, len(w) - 1)
    sums = np.concatenate([np.zeros(1), np.cumsum(w[index], dtype=np.float64)])
    n = np.diff(at)
    raw = (sums[at[1:]] - sums[at[:-1]]) / np.sqrt(np.maximum(1, n)) + float(w[-1])
    return 1 / (1 + np.exp(-raw))


def bounded_labels(labels: DataFrame, label: str, most: int) -> DataFrame:
    """Labelled rows (doc_id, label), about ``most`` at most: a hash of the id chooses them, alike at every size."""
    rows = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    n = rows.count()
    if n <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(most / n * (1 << 30)))


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, buckets: int = BUCKETS, epochs: int = 2) -> np.ndarray:
    """Weights learnt from docs (doc_id, text) and labels (doc_id, label 0 or 1).

    Texts become n-gram counts where they lie; one task then makes the updates in the order
    of a hash of the id.  Its input is bounded by ``most`` rows, its result by ``buckets``.
    Rows without an id, a document or a 0/1 label teach nothing; without any row all weights are 0.
    """
    chosen = docs.select("doc_id", "text").join(F.broadcast(bounded_labels(labels, "label", most)), "doc_id")

    def counts(batch: pa.RecordBatch) -> pa.RecordBatch:
        index, at = grams(batch.column("text").to_pylist(), buckets)
        x = [features(index[a:b]) for a, b in zip(at, at[1:])]
        return pa.record_batch({"doc_id": batch.column("doc_id").cast(pa.string()), "label": batch.column("label"), "i": pa.array([i.tobytes() for i, _ in x], pa.binary()), "v": pa.array([v.tobytes() for _, v in x], pa.binary())})

    def learn(batches):
        rows = sorted(((mix64(np.array([hash_text(d)], np.uint64))[0], d, y, i, v) for b in batches for d, y, i, v in zip(*(c.to_pylist() for c in b.columns))), key=lambda r: r[:3] + (r[3],))
        w = train([(np.frombuffer(i, np.int32), np.frombuffer(v, np.float32), y) for _, _, y, i, v in rows], buckets, epochs)
        yield pa.record_batch({"w": pa.array([w.tobytes()], pa.binary())})

    counted = arrow_map(chosen, counts, "doc_id string, label int, i binary, v binary")
    learnt = counted.repartition(1).mapInArrow(learn, "w binary").first()
    return np.frombuffer(learnt[0], np.float32) if learnt else train([], buckets)


def hash_text(text: str) -> int:
    h = 0xCBF29CE484222325
    for b in text.encode():
        h = ((h ^ b) * 0x100000001B3) & 0xFFFFFFFFFFFFFFFF
    return h


def scored(docs: DataFrame, w: np.ndarray, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of docs and the score of each text; the weights (fixed size) are broadcast.

    A kept column named ``score`` is an error."""
    shared = docs.sparkSession.sparkContext.broadcast(w)
    docs = carried(docs, keep, ("score",), "text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = pa.array(scores(batch.column("text").to_pylist(), shared.value), pa.float64())
        return pa.record_batch([batch.column("row"), s], names=["row", "score"])

    return arrow_map(docs, run, schema_with(docs, ("row",), "score double")).select("row.*", "score")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts have no n-grams and get the score of the bias; a null id counts as
    held out, as nothing is learnt from it; equal texts, and so repeated rows, get equal scores, and a score at the
    threshold is predicted 1; an id with several labels teaches each of them.
    """
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    w = fit(docs, training_labels(spark, sf_dir))
    held = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(True))
    return scored(docs, w).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels", "doc_id", F.col("quality").alias("label"))
    return labels.where(crc_mod("doc_id", 5) != 0)


QUERIES = {"op5_quality_classifier": op5_quality_classifier}
ORACLES: dict[str, str] = {}
