"""Approximate nearest neighbours by stable projections.

Vectors are projected to a few dimensions by a Gaussian (2-stable) matrix; kd-trees index the
projections.  A query takes projected neighbours in rising order, leaf by leaf, and verifies them
on the original vectors until the chi-square test says that a nearer one is unlikely to follow
(Sun et al., "SRS: Solving c-Approximate Nearest Neighbor Queries", 2014).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import arrow_map, discard, mix64, slices, staged, table

#: Projected dimensions (even), leaf size, vectors of a block, and rows of the sample that fits the blocks' bounds.
DIMENSIONS, LEAF, BLOCK, SAMPLE = 8, 64, 8192, 65_536
#: The test stops a search when a neighbour nearer than the k-th would have come before with this probability.
CERTAINTY = 0.98
#: Points of the sample that a block's bounds follow from, at least; queries that one task holds at most, about.
POINTS, QUERIES_AT_ONCE = 16, 65_536
#: Rows of a batch of queries on their way to blocks, about.
SENT = 8192


def chi2_cdf(x: float, m: int) -> float:
    """The chi-square distribution with an even number m of degrees of freedom."""
    h = x / 2
    return 1 - math.exp(-h) * sum(h**i / math.factorial(i) for i in range(m // 2))


def chi2_quantile(p: float, m: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, m) < p else (low, mid)
    return high


def projection(dim: int, m: int = DIMENSIONS) -> np.ndarray:
    return np.random.default_rng([20140601, dim]).standard_normal((dim, m))


def splits(points: np.ndarray, parts: int) -> list[tuple[int, float]]:
    """A kd-tree over a sample as a heap of (dimension, bound); its 2**depth leaves, ``parts`` at least, are the blocks."""
    depth = max(0, math.ceil(math.log2(max(1, parts))))
    tree: list[tuple[int, float]] = [(0, 0.0)] * (2**depth - 1)
    held = {0: points}
    for node in range(2**depth - 1):
        p = held.pop(node)
        d = int(np.argmax(np.ptp(p, axis=0))) if len(p) else 0
        cut = float(np.median(p[:, d])) if len(p) else 0.0
        tree[node] = (d, cut)
        left = p[:, d] <= cut
        held[2 * node + 1], held[2 * node + 2] = p[left], p[~left]
    return tree


def place(points: np.ndarray, tree: list[tuple[int, float]]) -> np.ndarray:
    """The block of each projected point."""
    node = np.zeros(len(points), np.int64)
    dims, cuts = np.array([d for d, _ in tree] or [0]), np.array([c for _, c in tree] or [0.0])
    rows = np.arange(len(points))
    for _ in range((len(tree) + 1).bit_length() - 1):
        node = 2 * node + 1 + (points[rows, dims[node]] > cuts[node])
    return node - len(tree)


class Tree:
    """The leaves of a kd-tree over projected points, and their bounds."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.leaves = points, []
        todo = [np.arange(len(points))]
        while todo:
            i = todo.pop()
            if len(i) <= leaf:
                self.leaves.append(i)
                continue
            p = points[i]
            d, half = int(np.argmax(np.ptp(p, axis=0))), len(i) // 2
            order = np.argpartition(p[:, d], half)
            todo += [i[order[:half]], i[order[half:]]]
        self.low = np.array([points[i].min(axis=0) for i in self.leaves if len(i)]).reshape(-1, points.shape[1])
        self.high = np.array([points[i].max(axis=0) for i in self.leaves if len(i)]).reshape(-1, points.shape[1])

    def search(self, q: np.ndarray, original: np.ndarray, vectors: np.ndarray, ids: np.ndarray, own: int, k: int, stop: float, bound: float) -> list[tuple[float, int]]:
        """The k nearest verified (distance, id), ties to the smaller id; ``bound``: a k-th distance known before."""
        gap = np.maximum(0, np.maximum(self.low - q, q - self.high))
        reach = (gap * gap).sum(axis=1)
        best: list[tuple[float, int]] = []
        slack = 1e-12 * (1 + float(q @ q))  # projections of equal vectors can differ in their last bits
        for n in np.argsort(reach, kind="stable"):
            if reach[n] > stop * bound * bound + slack:
                break
            i = self.leaves[n]
            away = self.points[i] - q
            i = i[((away * away).sum(axis=1) <= stop * bound * bound + slack) & (ids[i] != own)]
            if not len(i):
                continue
            off = vectors[i] - original
            d = np.sqrt((off * off).sum(axis=1))
            near = d <= bound
            if near.any():
                best = sorted([*best, *zip(d[near].tolist(), ids[i][near].tolist())])[:k]
                if len(best) == k:
                    bound = best[-1][0]
        return best


def stacked(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)


def nearest(vectors: DataFrame, queries: DataFrame, dim: int, k: int = 10, certainty: float = CERTAINTY, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """The k nearest of vectors (id long, v array<double>) to each of queries (the same columns), all of ``dim`` finite components.

    Every vector is indexed; a bounded sample only places the cells' bounds, and where a cell has too many
    vectors a hash deals them to blocks, each with a tree of its own.  Equal vectors beyond the k + 1 smallest
    ids, or beyond k rows of an id, can be in no answer and are left out before the shuffle.
    First a query searches a block of its own cell, then those that the test does not rule out by their bounds;
    a block is copied only if more queries come to it than one task should hold, once for each such number.
    Candidates with the query's id are its own; candidates that repeat are neighbours each; a query that
    repeats is searched once and gets its answer as often. Returns query_id, rank, vec_id, score.
    """
    spark = vectors.sparkSession
    matrix, stop = projection(dim), chi2_quantile(certainty, DIMENSIONS)
    same = Window.partitionBy("v").orderBy("id")
    again = Window.partitionBy("v", "id").orderBy("id")
    vectors = vectors.withColumn("nth", F.dense_rank().over(same)).withColumn("row", F.row_number().over(again)).where((F.col("nth") <= k + 1) & (F.col("row") <= k)).drop("nth", "row")
    vectors = staged(vectors, "neighbours-vectors")
    n = vectors.count()
    chosen = vectors if n <= sample else vectors.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(sample / n * (1 << 30)))

    def projected(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = stacked(batch.column("v"), dim) @ matrix
        return pa.record_batch({"p": pa.array([x.tobytes() for x in p], pa.binary())})

    points = [np.frombuffer(r[0]) for r in arrow_map(chosen.select("v"), projected, "p binary").collect()]
    tree = splits(np.array(points).reshape(-1, DIMENSIONS), min(-(-n // block), max(1, sample // POINTS)))
    cells = len(tree) + 1
    dealt = max(1, -(-n // (cells * block)))  # blocks of a cell
    blocks = cells * dealt

    def placed(batch: pa.RecordBatch) -> pa.RecordBatch:
        v = stacked(batch.column("v"), dim)
        own = mix64(batch.column("id").to_numpy(zero_copy_only=False).astype(np.uint64)) % np.uint64(dealt)
        where = place(v @ matrix, tree) * dealt + own.astype(np.int64)
        return pa.record_batch({"id": batch.column("id"), "v": pa.array([x.tobytes() for x in v], pa.binary()), "block": pa.array(where, pa.int64())})

    put = "id bigint, v binary, block bigint"
    data = arrow_map(vectors.select("id", "v"), placed, put)
    asked = staged(queries.groupBy("id", "v").agg(F.count("*").alias("times")), "neighbours-queries")
    again = asked.where("times > 1")
    own = arrow_map(asked.select("id", "v"), placed, put).withColumn("bound", F.lit(float("inf")))

    def meeting(asking: DataFrame) -> DataFrame:
        """What the blocks answer to queries (id, v, block, bound), which are staged."""
        chunks = asking.groupBy("block").agg(F.ceil(F.count("*") / QUERIES_AT_ONCE).cast("int").alias("chunks"))
        # As many rows as there are blocks, BLOCK times fewer than vectors.
        copied = data.join(chunks, "block").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        sent = asking.join(chunks, "block").withColumn("chunk", F.pmod(F.xxhash64("id", "v"), F.col("chunks").cast("bigint")).cast("int"))
        by = lambda df: df.groupBy("block", "chunk")
        return by(copied.select("id", "v", "block", "chunk")).cogroup(by(sent.select("id", "v", "block", "chunk", "bound"))).applyInPandas(search, found)

    def search(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(left) and len(right):
            v = np.frombuffer(b"".join(left["v"]), np.float64).reshape(-1, dim)
            ids, t = left["id"].to_numpy(), Tree(v @ matrix)
            for own, raw, bound in zip(right["id"], right["v"], right["bound"]):
                q = np.frombuffer(raw, np.float64)
                out += [(own, raw, i, d) for d, i in t.search(q @ matrix, q, v, ids, own, k, stop, bound)]
        return pd.DataFrame(out, columns=["query_id", "q", "vec_id", "score"])

    found = "query_id bigint, q binary, vec_id bigint, score double"
    own = staged(own, "neighbours-own")
    home = staged(meeting(own), "neighbours-home")
    bounds = home.groupBy("query_id", "q").agg(F.max("score").alias("bound"), F.count("*").alias("n"))
    bounds = bounds.select(F.col("query_id").alias("id"), F.col("q").alias("v"), F.when(F.col("n") >= k, F.col("bound")).alias("known"))
    bounded = own.drop("bound").join(bounds, ["id", "v"], "left").withColumn("bound", F.coalesce("known", F.lit(float("inf")))).drop("known")
    low, high = boxes(tree)

    def others(batches):
        kinds = {"id": pa.int64(), "v": pa.binary(), "block": pa.int64(), "bound": pa.float64()}
        for batch in (part for b in batches for part in slices(b)):
            cols: dict[str, list] = {c: [] for c in kinds}
            for i, raw, home_block, bound in zip(*(batch.column(c).to_pylist() for c in cols)):
                q = np.frombuffer(raw, np.float64) @ matrix
                gap = np.maximum(0, np.maximum(low - q, q - high))
                near = np.flatnonzero((gap * gap).sum(axis=1) <= stop * bound * bound + 1e-12 * (1 + float(q @ q)))
                to = (near[:, None] * dealt + np.arange(dealt)).reshape(-1)
                for at in range(0, len(to), SENT):
                    to_now = to[at : at + SENT]
                    to_now = to_now[to_now != home_block].tolist()
                    for c, x in zip(cols, ([i] * len(to_now), [raw] * len(to_now), to_now, [bound] * len(to_now))):
                        cols[c] += x
                    if len(cols["id"]) >= SENT:
                        yield pa.record_batch({c: pa.array(x, kinds[c]) for c, x in cols.items()})
                        cols = {c: [] for c in kinds}
            if cols["id"]:
                yield pa.record_batch({c: pa.array(x, kinds[c]) for c, x in cols.items()})

    found_all = home
    if blocks > 1:
        more = staged(bounded.select("id", "v", "block", "bound").mapInArrow(others, "id bigint, v binary, block bigint, bound double"), "neighbours-more")
        found_all = home.unionByName(meeting(more))
    order = Window.partitionBy("query_id", "q").orderBy("score", "vec_id")
    top = found_all.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    top = staged(top.select("query_id", "q", "rank", "vec_id", "score"), "neighbours-found")
    answers = top.select("query_id", "rank", "vec_id", "score")
    if again.head(1):
        packed = arrow_map(again, lambda b: pa.record_batch({"query_id": b.column("id"), "q": pa.array([x.tobytes() for x in stacked(b.column("v"), dim)], pa.binary()), "times": b.column("times")}), "query_id bigint, q binary, times bigint")
        more_rows = top.join(packed, ["query_id", "q"]).withColumn("copy", F.explode(F.sequence(F.lit(2), F.col("times").cast("int"))))
        answers = staged(answers.unionByName(more_rows.select("query_id", "rank", "vec_id", "score")), "neighbours-answers")
    discard(vectors, asked, own, home, *([more] if blocks > 1 else []))
    return answers


def boxes(tree: list[tuple[int, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the blocks in projected space."""
    low, high = np.full((1, DIMENSIONS), -np.inf), np.full((1, DIMENSIONS), np.inf)
    at = 0
    while at < len(tree):
        n = len(low)
        lows, highs = np.repeat(low, 2, axis=0), np.repeat(high, 2, axis=0)
        for j, (d, cut) in enumerate(tree[at : at + n]):
            highs[2 * j, d] = min(highs[2 * j, d], cut)
            lows[2 * j + 1, d] = max(lows[2 * j + 1, d], cut)
        low, high, at = lows, highs, at + n
    return low, high


def usable(rows: DataFrame) -> DataFrame:
    """(id, v, dim): rows with an id and a vector that is not null, empty or zero and has only finite components."""
    v = F.transform("v", lambda x: x.cast("double"))
    rows = rows.select("id", v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return rows.where(fine).withColumn("dim", F.size("v"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the 10 nearest found of each row whose vec_id is divisible by 100.

    Rows without vec_id, and vectors that are null, empty, zero or hold null or non-finite components, take
    no part; vectors of another length than the query's are no candidates; rows with the query's vec_id are its own;
    a repeated row is a neighbour, and a query, of its own; ties go to the smaller vec_id.
    """
    rows = usable(table(spark, sf_dir, "embeddings", F.col("vec_id").cast("bigint").alias("id"), F.col("embedding").alias("v")))
    dims = [r[0] for r in rows.where("id % 100 = 0").select("dim").distinct().collect()]
    out = None
    for d in dims:
        own = rows.where(F.col("dim") == d).select("id", "v")
        part = nearest(own, own.where("id % 100 = 0"), d)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")


QUERIES = {"op8_nearest_neighbours": op8_nearest_neighbours}
ORACLES: dict[str, str] = {}
