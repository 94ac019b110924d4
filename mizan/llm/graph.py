"""Joins and components that bear hot keys."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ROWS_A_FILE, discard, kept, staged

#: A key with more than one in HOT of the rows is hot, so there are HOT hot keys at most.
HOT = 1000


def meet(rows: DataFrame, groups: DataFrame, key: str, total: int) -> DataFrame:
    """rows joined with groups (one row a key, whose column ``n`` counts the rows of its key; dropped) on ``key``.

    Hot groups are broadcast, HOT rows at most; other rows are shuffled. ``groups`` should be staged."""
    hot = F.col("n") * HOT > total
    few, rest = groups.where(hot).drop("n"), groups.where(~hot).drop("n")
    common = rows.join(F.broadcast(few), key)
    rare = rows.join(F.broadcast(few.select(key)), key, "left_anti").join(rest, key)
    return common.unionByName(rare)


def crowded(counts: DataFrame, key: str, total: int) -> DataFrame:
    """(key, parts) of the hot keys of counts (key, n): how many parts of 1/HOT of all rows their rows fill; HOT rows at most."""
    often = counts.where(F.col("n") * HOT > total).select(key, F.ceil(F.col("n") * HOT / max(1, total)).cast("int").alias("parts"))
    return staged(often, "hot", HOT)


def salted(rows: DataFrame, others: DataFrame, key: str, often: DataFrame, by: str) -> DataFrame:
    """The rows of the keys in ``often`` (from crowded()) joined with ``others`` on ``key``: rows are dealt to their
    key's parts by the column ``by``, and what ``others`` has for such a key is copied once for each part."""
    few = F.broadcast(often)
    dealt = rows.join(few, key).withColumn("salt", F.pmod(F.xxhash64(by), F.col("parts").cast("bigint")).cast("int")).drop("parts")
    copies = others.join(few, key).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    return dealt.join(copies, [key, "salt"]).drop("salt")


def meet_salted(rows: DataFrame, others: DataFrame, key: str, often: DataFrame, by: str) -> DataFrame:
    """rows joined with ``others`` on ``key``, the keys in ``often`` salted; how ``others`` is dealt is of use for the rest."""
    rare = rows.join(F.broadcast(often.select(key)), key, "left_anti").join(others, key)
    return salted(rows, others, key, often, by).unionByName(rare)


#: Parts to which a node's edges are dealt.
SALTS = 64


def smallest(edges: DataFrame) -> DataFrame:
    """(a, b, m): each edge with the smallest b of its a.

    Edges of a node are dealt to SALTS parts by their other end, and only what is smallest in a part meets the others', so no task sees all edges of a node."""
    salt = F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int").alias("salt")
    parts = edges.groupBy("a", salt).agg(F.min("b").alias("m")).withColumn("m", F.min("m").over(Window.partitionBy("a")))
    return edges.withColumn("salt", salt).join(parts, ["a", "salt"]).select("a", "b", "m")


def components(edges: DataFrame, size: int, rounds: int | None = None) -> DataFrame:
    """(node, root) for all nodes of edges (a, b): root is the smallest node reached.

    Alternating large and small stars (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014);
    each round is written to the shared folder, so lineage stays short, and the one before deleted.
    ``size``: about the number of edges.
    Rounds go on until one changes nothing; if that takes more than ``rounds``, it is an error."""
    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", size)
    before = None
    for k in itertools.count():
        if k == rounds:
            raise RuntimeError(f"components still change after {rounds} rounds")
        both = smallest(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
        large = both.where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).where("a <> b").distinct()
        large = kept(large.coalesce(1 + size // ROWS_A_FILE))
        # Each node and its smaller neighbours meet at the smallest of them.
        met = smallest(large).select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        last, edges = edges, staged(met.select("e.*").where("a <> b").distinct(), "edges", size)
        large.unpersist()
        discard(last)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return edges.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
