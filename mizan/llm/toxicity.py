"""Toxicity by compression distance: two zstandard dictionaries, one trained on ordinary
and one on toxic text; each window of a text is compressed with either, and how much
shorter the toxic dictionary makes the windows is held against calibrated thresholds.

Toxic text is ordinary but for a word in some 75, so its dictionary is trained on those of its
windows that tell: around pieces, as long as the shortest match, that recur in toxic text and
hardly in ordinary text.  Whoever compresses with it has the ordinary dictionary, too, so that
windows differ in length by what is toxic and not by what either dictionary happens to lack."""

from __future__ import annotations

import random
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, carried, crc_mod, mix64, schema_with, span_hashes, table, text_bytes, word_spans
from .quality import bounded_labels

#: Labelled rows of each class that training takes at most (a hash of the id chooses them).
MOST_TOXIC, MOST_ORDINARY = 2_000, 4_000
#: Bytes of a window, of the part both dictionaries share, and of what only the toxic one has.
WINDOW, SHARED, OWN = 240, 6_144, 2_400
#: Bytes of a piece, the shortest match, and of what is taken before and after one.
PIECE, BEFORE, AFTER = 6, 1, 4
THRESHOLD = 0.3
#: A window speaks for toxicity from this many saved bytes on.
SAVED = 1
#: What a clean text taken for toxic weighs in calibration, against a toxic one that is missed.
CLEAN_WEIGHT = 4
#: Cuts whose F1 is that near to the best count as equal; the middle one of them is taken.
NEARLY = 0.01
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass
class Model:
    """Contents of both dictionaries and the calibration: probability = 1 / (1 + exp(-(slope * (evidence - cut) + offset)))."""

    ordinary: bytes
    toxic: bytes
    cut: float
    slope: float

    def compressors(self) -> tuple:
        return compressor(self.ordinary), compressor(self.toxic)


def lowered(text: str | None) -> bytes:
    return text_bytes((text or "").lower())


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Matches of PIECE bytes at least, without anything in the frame that does not depend on the window."""
    words = zstandard.ZstdCompressionDict(content or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    how = zstandard.ZstdCompressionParameters(compression_level=3, min_match=PIECE, window_log=14, hash_log=14, chain_log=14, search_log=6, target_length=64, strategy=zstandard.STRATEGY_BTOPT, write_content_size=0, write_dict_id=0, write_checksum=0)
    return zstandard.ZstdCompressor(dict_data=words, compression_params=how)


def windows(data: bytes, size: int = WINDOW) -> list[bytes]:
    """The whole text in pieces of about ``size`` bytes, cut at a space where the second half has one."""
    out, i, n = [], 0, len(data)
    while i < n:
        j = min(n, i + size)
        if j < n and (k := data.rfind(b" ", i + size // 2, j)) > 0:
            j = k
        out.append(data[i:j])
        i = j
    return out


def evidence(text: str | None, ordinary, toxic) -> tuple[float, int]:
    """Squares of the bytes saved beyond SAVED, summed over all windows and divided by the root of their number; and the most in one window."""
    a, b, total, most, n = ordinary.compress, toxic.compress, 0, 0, 0
    for w in windows(lowered(text)):
        saved = len(a(w)) - len(b(w))
        n += 1
        if saved > SAVED:
            total += (saved - SAVED) ** 2
            most = max(most, saved)
    return total / max(1, n) ** 0.5, most


def contexts(texts: list[bytes]) -> dict[bytes, int]:
    """Each word and the number of different words before it: copies of a text count once."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    starts, ends = word_spans(data, _LETTERS)
    if not len(starts):
        return {}
    h = span_hashes(data, starts, ends)
    pair = mix64(h ^ mix64(np.concatenate([h[:1], h[:-1]]) + np.uint64(1)))
    first = np.unique(pair, return_index=True)[1]
    _, at, n = np.unique(h[first], return_index=True, return_counts=True)
    raw, at = data.tobytes(), first[at]
    return {raw[starts[i] : ends[i]]: int(k) for i, k in zip(at, n)}


def pieces(word: bytes) -> list[bytes]:
    word = b" " + word + b" "
    return [word[i : i + PIECE] for i in range(max(1, len(word) - PIECE + 1))]


def typical(toxic: dict[bytes, int], ordinary: dict[bytes, int], least: int = 8, lift: float = 10.0) -> set[bytes]:
    """Pieces that would save bytes of other toxic text and not of ordinary text: they have many contexts in the one and ``lift`` times fewer, at least, in the other."""
    counts = []
    for words in (toxic, ordinary):
        n: Counter = Counter()
        for w, k in words.items():
            for g in set(pieces(w)):
                n[g] += k
        counts.append(n)
    x, y = max(1, sum(toxic.values())), max(1, sum(ordinary.values()))
    return {g for g, k in counts[0].items() if len(g) == PIECE and k >= least and k / x >= lift * (counts[1][g] + 2) / y}


def packed(data: np.ndarray) -> np.ndarray:
    """Each PIECE bytes in a row as one number."""
    n = len(data) - PIECE + 1
    return sum(data[k : n + k].astype(np.uint64) << np.uint64(8 * k) for k in range(PIECE)) if n > 0 else np.empty(0, np.uint64)


def telling(texts: list[bytes], good: set[bytes]) -> list[bytes]:
    """The windows of texts around places where one of the pieces stands, with BEFORE and AFTER bytes; none overlaps the next's piece."""
    known = packed(np.frombuffer(b"".join(sorted(good)), np.uint8))[::PIECE] if good else np.empty(0, np.uint64)
    out = []
    for t in texts:
        t = t.replace(b"\n", b" ")
        free = 0
        for i in np.flatnonzero(np.isin(packed(np.frombuffer(t, np.uint8)), known)).tolist():
            if i >= free:
                free = i + PIECE + AFTER
                out.append(t[max(0, i - BEFORE) : free])
    return out


def dictionary(samples: list[bytes], size: int, k: int, d: int) -> bytes:
    """The content of a trained zstandard dictionary without its tables; where there is too little to train on, the samples."""
    try:
        trained = zstandard.train_dictionary(size + 400, samples, k=k, d=d).as_bytes()
        return trained[-size:]
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def train(toxic: list[str], ordinary: list[str]) -> Model:
    """A model from texts of both classes; a quarter of each only calibrates. Without toxic texts nothing is toxic."""
    known, held = [[], []], [[], []]
    for side, texts in enumerate((ordinary, toxic)):
        for t in sorted({lowered(t) for t in texts if t}):
            (held if zlib.crc32(t) % 4 == 0 else known)[side].append(t)
    shared = dictionary([t[i : i + WINDOW * 12] for t in known[0] for i in range(0, len(t), WINDOW * 12)], SHARED, 64, 8)
    found = telling(known[1], typical(contexts(known[1]), contexts(known[0])))
    random.Random(7).shuffle(found)
    own = dictionary([b"".join(found[i : i + 8]) for i in range(0, len(found), 8)], OWN, 32, 6) if found else b""
    model = Model(shared, own + shared, 1.0, 4.0)
    pair = model.compressors()
    e = [np.array([evidence(t.decode("utf-8", "surrogatepass"), *pair)[0] for t in side]) for side in (held if held[1] and held[0] else known)]
    if len(e[1]):
        model.cut, model.slope = calibrated(*e)
    return model


def calibrated(ordinary: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """The cut with the best F1, clean texts weighted (halfway to the next value below it) and a slope from the spread of toxic evidence."""
    values = np.unique(np.concatenate([ordinary, toxic]))
    values = values[values > 0]
    if not len(values):
        return 1.0, 4.0
    f1 = np.array([2 * (toxic >= v).sum() / (len(toxic) + (toxic >= v).sum() + CLEAN_WEIGHT * (ordinary >= v).sum()) for v in values])
    near = np.flatnonzero(f1 >= f1.max() - NEARLY)
    k = int(near[(len(near) - 1) // 2])
    below = values[k - 1] if k else 0.0
    return float((values[k] + below) / 2), float(3 / max(0.1, np.median(toxic) - below))


def probability(e: float, model: Model) -> float:
    x = model.slope * (e - model.cut) + np.log(THRESHOLD / (1 - THRESHOLD))
    return float(1 / (1 + np.exp(-x)))


def fit(docs: DataFrame, labels: DataFrame, most: tuple[int, int] = (MOST_ORDINARY, MOST_TOXIC)) -> Model:
    """Learns from docs (doc_id, text) and labels (doc_id, label 0 or 1); one task trains on the bounded sample.

    Rows without an id, a text or a 0/1 label teach nothing."""
    chosen = [bounded_labels(labels.where(F.col("label") == k), "label", most[k]) for k in (0, 1)]
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id").select("label", "text")

    def learn(batches):
        texts = [[], []]
        for b in batches:
            for y, t in zip(b.column("label").to_pylist(), b.column("text").to_pylist()):
                texts[y].append(t)
        m = train(texts[1], texts[0])
        yield pa.record_batch({"ordinary": pa.array([m.ordinary]), "toxic": pa.array([m.toxic]), "cut": [m.cut], "slope": [m.slope]})

    learnt = rows.repartition(1).mapInArrow(learn, "ordinary binary, toxic binary, cut double, slope double").first()
    return Model(*learnt) if learnt else train([], [])


def scored(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of docs, the score of each text and the bytes saved in its most telling window.

    A kept column named like a new one is an error."""
    docs = carried(docs, keep, ("score", "most_saved"), "text")

    def run(batch: pa.RecordBatch, pair) -> pa.RecordBatch:
        e = [evidence(t, *pair) for t in batch.column("text").to_pylist()]
        new = [pa.array([probability(x, model) for x, _ in e], pa.float64()), pa.array([m for _, m in e], pa.int32())]
        return pa.record_batch([batch.column("row"), *new], names=["row", "score", "most_saved"])

    out = arrow_map(docs, run, schema_with(docs, ("row",), "score double, most_saved int"), model.compressors)
    return out.select("row.*", "score", "most_saved")


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels", "doc_id", F.col("toxic").alias("label"))
    return labels.where(crc_mod("doc_id", 4) != 2)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts have no window and get the score of no evidence; a null id counts
    as held out, as nothing is learnt from it; equal texts, and so repeated rows, get equal scores, and a score at the
    threshold is predicted 1; an id with several labels teaches each of them.
    """
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = fit(docs, training_labels(spark, sf_dir))
    held = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(True))
    return scored(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op10_toxicity": op10_toxicity}
ORACLES: dict[str, str] = {}
