"""N-gram Jaccard join with adaptive multi-match prefixes.

Shingles are ordered by document frequency, rarest first.  Two sets that reach the similarity
share a shingle within their prefixes, and l of them when the prefixes are l - 1 longer; each
document takes the l with the smallest estimated cost of candidates (Wang et al., "Can We Beat
the Prefix Filtering?", 2012), and a pair is verified if it shares as many as the smaller l of both.

An entry of a prefix also knows how large a partner may be for which it counts.  Equal sets are
one node.  First each node is held against the most central node of its lists, and what is linked
then is one component; after that all pairs of nodes from different components that the prefixes
allow are verified.  So no link between components is lost, and large groups of near copies are
not expanded into all pairs.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BATCH_BYTES, BATCH_ROWS, LOWER, SPACED, arrow_map, bounded, carried, discard, gathered, kept, mix64, schema_with, slices, span_hashes, staged, table, text_bytes, tidy, word_spans
from .graph import HOT, components, crowded, meet, meet_salted, salted

WORDS = 5
#: Sets link when 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Text bytes for which there is one partition of shingles; partitions at least and at most; beyond, text bytes
#: for which there is one cell, what a task counts at once.
PARTITION_BYTES, LEAST_PARTITIONS, MOST_PARTITIONS, CELL_BYTES = 8 << 20, 128, 16_384, 256 << 20
#: Shingles are 40 bits of a hash within a cell (47 bits in all, and one more whenever cells double).
BITS = 40
#: Shingles that a batch has for each cell, about; sets of a batch at most; sets of a batch that make a shingle common.
FILL, MOST_SETS, COMMON = 32, 1 << 16, 32
#: The largest l, and what verifying a candidate costs, measured in entries of lists.
MOST_SHARED, VERIFY = 8, 8
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_LOWER = np.frombuffer(LOWER, np.uint8)


def least_shared(n: int) -> int:
    """Shingles that a set of n shares with any set it links to, at least."""
    return -(-PERCENT * n // 100)


def shingles(texts: list[str | None], bits: int = 64) -> list[np.ndarray]:
    """The sorted set of each text's shingle hashes, the leading ``bits`` bits of them."""
    parts = [text_bytes(t) + b"\n" for t in texts]
    data = _LOWER[np.frombuffer(b"".join(parts), np.uint8)]
    starts, ends = word_spans(data, SPACED)
    h = span_hashes(data, starts, ends) if len(starts) else np.empty(0, np.uint64)
    at = np.searchsorted(starts, np.cumsum([0, *map(len, parts)]))
    full = np.zeros(max(0, len(h) - WORDS + 1), np.uint64)
    for k in range(WORDS):
        full += h[k : k + len(full)] * _ODD[k]
    full = mix64(full)
    shift = np.uint64(64 - bits)
    out = []
    for a, b in zip(at, at[1:]):
        if b - a >= WORDS:
            out.append(np.unique(full[a : b - WORDS + 1] >> shift))
        elif b > a:
            x = np.array([b - a], np.uint64)
            for k in range(b - a):
                x = x * _ODD[4] + h[a + k : a + k + 1] * _ODD[k]
            out.append(mix64(x) >> shift)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def digest(tokens: np.ndarray) -> bytes | None:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None


def pack(tokens: np.ndarray) -> bytes:
    """The low 40 bits of each, five bytes apiece."""
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<u8").reshape(-1)


def dealt(docs: DataFrame, partitions: int, cells: int) -> DataFrame:
    """(p, cell, batch, ...): the different sets of each batch of texts, their shingles dealt to cells, ``cells`` / ``partitions`` of them a partition.

    A batch takes up texts until each cell gets FILL shingles of it, or MOST_SETS sets.  A row for a cell has the shingles
    and their owners; a shingle that COMMON sets of the batch have stands there once, with their number, so no shingle is
    sent more than COMMON times a batch.  One more row, dealt by the batch's name, has the sets' names and sizes and
    the owners of such shingles."""
    bits = BITS + (cells - 1).bit_length()

    def blobs(sets: dict[bytes, np.ndarray]) -> pa.RecordBatch:
        nodes = sorted(sets)
        tokens = np.concatenate([sets[x] for x in nodes])
        of = np.repeat(np.arange(len(nodes), dtype=np.uint16), [len(sets[x]) for x in nodes])
        common, times = np.unique(tokens, return_counts=True)
        common, times = common[times >= COMMON], times[times >= COMMON].astype(np.uint32)
        often = np.isin(tokens, common) if len(common) else np.zeros(len(tokens), bool)
        owners = of[often][np.argsort(tokens[often], kind="stable")]
        tokens, of = tokens[~often], of[~often]
        cell = (tokens >> np.uint64(BITS)).astype(np.uint16 if cells <= 1 << 16 else np.uint32)
        # By cell and then by owner, which is how they compress best.
        order = np.argsort(cell, kind="stable")
        tokens, of, cell = tokens[order], of[order], cell[order]
        cut, cut_common = (np.searchsorted(c, np.arange(cells + 1)) for c in (cell, common >> np.uint64(BITS)))
        name = hashlib.blake2b(b"".join(nodes), digest_size=16).digest()
        rows = [k for k in range(cells) if cut[k] < cut[k + 1] or cut_common[k] < cut_common[k + 1]]
        per = cells // partitions
        at = int.from_bytes(name[:4], "little") % partitions
        column = lambda f, head, kind: pa.array([*(f(k) for k in rows), head], kind)
        return pa.record_batch(
            {
                "p": column(lambda k: k // per, at, pa.int32()),
                "cell": column(lambda k: k, at * per, pa.int32()),
                "batch": column(lambda k: name, name, pa.binary()),
                "owners": column(lambda k: of[cut[k] : cut[k + 1]].tobytes(), owners.tobytes(), pa.binary()),
                "tokens": column(lambda k: pack(tokens[cut[k] : cut[k + 1]]), None, pa.binary()),
                "common": column(lambda k: pack(common[cut_common[k] : cut_common[k + 1]]), common.tobytes(), pa.binary()),
                "times": column(lambda k: times[cut_common[k] : cut_common[k + 1]].tobytes(), times.tobytes(), pa.binary()),
                "nodes": column(lambda k: None, b"".join(nodes), pa.binary()),
                "sizes": column(lambda k: None, np.array([len(sets[x]) for x in nodes], np.int32).tobytes(), pa.binary()),
            }
        )

    def deal(batches):
        sets: dict[bytes, np.ndarray] = {}
        held = 0
        for part in (x for b in batches for x in slices(b)):
            for s in shingles(part.column("text").to_pylist(), bits):
                if len(s) and (name := digest(s)) not in sets:
                    sets[name] = s
                    held += len(s)
            if held >= FILL * cells or len(sets) > MOST_SETS - BATCH_ROWS:
                yield blobs(sets)
                sets, held = {}, 0
        if sets:
            yield blobs(sets)
        tidy()

    bounded(docs.sparkSession)
    return docs.select("text").mapInArrow(deal, "p int, cell int, batch binary, owners binary, tokens binary, common binary, times binary, nodes binary, sizes binary")


_COUNTED = ("batch", "owners", "tokens", "df", "common", "times", "nodes", "sizes")


def counted(dealt_rows: DataFrame, partitions: int, cells: int) -> DataFrame:
    """The same batches with only shingles of two sets or more, and the document frequency of each (of common ones in ``times``).

    A task counts one cell at a time; where a partition has several, Spark sorts its rows by cell and spills."""

    def count(cell: int, rows: list[dict]):
        own = [unpack(r["tokens"]) for r in rows]
        common = [unpack(r["common"]) for r in rows]
        weights = np.concatenate([np.ones(sum(map(len, own)), np.int64), *(np.frombuffer(r["times"], np.uint32).astype(np.int64) for r in rows)])
        _, back = np.unique(np.concatenate(own + common), return_inverse=True)
        df = np.minimum(np.bincount(back, weights).astype(np.int64)[back], (1 << 32) - 1).astype(np.uint32)
        at, high = 0, np.uint64(cell << BITS)
        df_common = np.split(df[sum(map(len, own)) :], np.cumsum([len(c) for c in common])[:-1])
        for r, t, c, d in zip(rows, own, common, df_common):
            n = df[at : at + len(t)]
            at += len(t)
            keep = n > 1
            yield r["batch"], np.frombuffer(r["owners"], np.uint16)[keep].tobytes(), (t[keep] | high).tobytes(), n[keep].tobytes(), (c | high).tobytes(), d.tobytes(), None, None

    def results(batches):
        cell, held = None, {}
        for r in (r for b in batches for x in slices(b) for r in x.to_pylist()):
            if r["nodes"] is not None:
                yield r["batch"], r["owners"], None, None, r["common"], r["times"], r["nodes"], r["sizes"]
                continue
            if r["cell"] != cell:
                if held:
                    yield from count(cell, list(held.values()))
                cell, held = r["cell"], {}
            # Batches of the same sets have the same name and the same rows; one of them stands for all.
            held[r["batch"]] = r
        if held:
            yield from count(cell, list(held.values()))

    def run(batches):
        out: list[tuple] = []
        size = 0
        for row in results(batches):
            out.append(row)
            size += sum(len(x) for x in row if x is not None)
            if len(out) >= 256 or size > BATCH_BYTES:
                yield pa.record_batch([pa.array(c, pa.binary()) for c in zip(*out)], names=list(_COUNTED))
                out, size = [], 0
        if out:
            yield pa.record_batch([pa.array(c, pa.binary()) for c in zip(*out)], names=list(_COUNTED))
        tidy()

    rows = dealt_rows.repartitionById(partitions, "p")
    if cells > partitions:
        rows = rows.sortWithinPartitions("cell")
    return rows.mapInArrow(run, ", ".join(f"{c} binary" for c in _COUNTED))


def chosen(n: int, df: np.ndarray) -> tuple[int, int]:
    """(l, k) for a set of n shingles, of which those with frequencies df (rising) are in two sets or more: the l with
    the smallest estimated cost, and how many of those shingles its longest prefix has (0: nothing can link).

    The cost is that of partners of the same size, the usual ones: entries of lists that are read, and candidates."""
    single = n - len(df)
    one = n - least_shared(n) + 1
    if one <= single:
        return 1, 0
    sums = np.concatenate([[0], np.cumsum(df - 1.0)])
    same = n - -(-2 * PERCENT * n // (100 + PERCENT)) - single
    best = None
    for shared in range(1, min(MOST_SHARED, least_shared(n)) + 1):
        cost = sums[min(len(df), max(0, same + shared))] * (1 + VERIFY / shared)
        if best is None or cost < best[0]:
            best = (cost, shared)
    return best[1], min(len(df), one + best[1] - 1 - single)


def prefixes(counted_rows: DataFrame) -> DataFrame:
    """(node, n, l, k, tokens): sets that can link to others, with their shingles of frequency 2 or more, rarest first."""

    def order(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        head = next(r for r in rows if r["nodes"] is not None)
        rows = [r for r in rows if r["nodes"] is None]
        nodes, sizes = head["nodes"], np.frombuffer(head["sizes"], np.int32)
        column = lambda c, t: np.frombuffer(b"".join(r[c] for r in rows), t)
        owners, tokens, df = column("owners", np.uint16), column("tokens", np.uint64), column("df", np.uint32)
        common, times = np.frombuffer(head["common"], np.uint64), np.frombuffer(head["times"], np.uint32)
        if len(common):
            found, of_found = column("common", np.uint64), column("times", np.uint32)
            by = np.argsort(found)
            own = of_found[by][np.searchsorted(found[by], common)]
            owners = np.concatenate([owners, np.frombuffer(head["owners"], np.uint16)])
            tokens, df = np.concatenate([tokens, np.repeat(common, times)]), np.concatenate([df, np.repeat(own, times)])
        sort = np.lexsort((tokens, df, owners))
        owners, tokens, df = owners[sort], tokens[sort], df[sort]
        at = np.searchsorted(owners, np.arange(len(sizes) + 1))
        out: dict[str, list] = {"node": [], "n": [], "l": [], "k": [], "tokens": []}
        for i, (a, b) in enumerate(zip(at, at[1:])):
            shared, k = chosen(int(sizes[i]), df[a:b].astype(np.int64))
            if k:
                for c, x in zip(out, (nodes[16 * i : 16 * i + 16], int(sizes[i]), shared, k, tokens[a:b].tobytes())):
                    out[c].append(x)
        return pa.table({c: pa.array(x, t) for (c, x), t in zip(out.items(), (pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.binary()))})

    return counted_rows.groupBy("batch").applyInArrow(order, "node binary, n int, l int, k int, tokens binary")


def reach(n, shared, rank):
    """The largest set that a set of n can link to if the first shingle they share has this rank in its order (from 0)
    and l - 1 others follow: intersection >= PERCENT * (n + m) / (100 + PERCENT) and <= n - rank + l - 1."""
    return (100 + PERCENT) * (n - rank + shared - 1) // PERCENT - n


def postings(sets: DataFrame) -> DataFrame:
    """(token, node, n, l, reach, own): the prefixes of sets; an entry serves for partners of up to ``reach`` shingles,
    and ``own`` is the share (in millionths) of shingles that no other set has."""

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens, reaches, own = [], [], []
        for t, k, n, shared in zip(*(batch.column(c).to_pylist() for c in ("tokens", "k", "n", "l"))):
            tokens.append(np.frombuffer(t, np.int64)[:k])
            single = n - len(t) // 8
            reaches.append(reach(n, shared, single + np.arange(k)))
            own.append(np.full(k, single * 1_000_000 // n, np.int32))
        rows = pa.array(np.repeat(np.arange(len(tokens)), [len(t) for t in tokens]))
        return pa.record_batch({"token": pa.array(np.concatenate(tokens)), **{c: batch.column(c).take(rows) for c in ("node", "n", "l")}, "reach": pa.array(np.concatenate(reaches).astype(np.int32)), "own": pa.array(np.concatenate(own))})

    return arrow_map(sets, spread, "token bigint, node binary, n int, l int, reach int, own int")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of pairs (a, b) that link, staged. ``sets`` has all shingles that two sets can share; a set with many pairs is copied, not crowded."""
    own = sets.select("node", "n", "tokens")
    pairs = kept(pairs.select("a", "b"))
    n = pairs.count()
    often = {c: crowded(pairs.groupBy(c).agg(F.count("*").alias("n")), c, n) for c in "ab"}
    of_a, of_b, few = own.toDF("a", "na", "ta"), own.toDF("b", "nb", "tb"), F.broadcast(often["b"].select("b"))
    # Sets are dealt by node already, so only pairs move, and crowded sets' copies. Both ends are told apart before the first join.
    rare = meet_salted(pairs.join(few, "b", "left_anti"), of_a, "a", often["a"], "b").join(of_b, "b")
    common = salted(meet_salted(pairs.join(few, "b", "left_semi"), of_a, "a", often["a"], "b"), of_b, "b", often["b"], "a")
    both = rare.unionByName(common)

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for na, ta, nb, tb in zip(*(batch.column(c).to_pylist() for c in ("na", "ta", "nb", "tb"))):
            both = len(np.intersect1d(np.frombuffer(ta, np.uint64), np.frombuffer(tb, np.uint64), assume_unique=True))
            keep.append(100 * both >= PERCENT * (na + nb - both))
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    out = gathered(arrow_map(both, check, "a binary, b binary"), "jaccard-edges")
    pairs.unpersist()
    discard(*often.values())
    return out


def links(sets: DataFrame) -> DataFrame:
    """(node, root) of all nodes that link to others; root is the smallest node of the component."""
    size, cores = sets.count(), sets.sparkSession.sparkContext.defaultParallelism
    posts = postings(sets)
    # Of each list, the node with the fewest shingles of its own leads: of a group of near copies, the one most alike to all.
    lead = F.min(F.struct("own", "node", F.col("n").alias("m"), F.col("reach").alias("r")))
    counts = posts.groupBy("token").agg(F.count("*").alias("f")).where("f > 1")
    total = counts.agg(F.sum("f")).first()[0] or 0
    # The lists of hot shingles, HOT at most, stay where they are; all others are dealt by shingle once.
    few = staged(counts.where(F.col("f") * HOT > total).select("token"), "jaccard-hot", HOT)
    common = posts.join(F.broadcast(few), "token")
    common = common.join(F.broadcast(common.groupBy("token").agg(lead.alias("lead"))), "token")
    w = Window.partitionBy("token")
    rare = posts.join(F.broadcast(few), "token", "left_anti").withColumn("f", F.count("*").over(w)).withColumn("lead", lead.over(w)).where("f > 1").drop("f")
    posts = staged(common.unionByName(rare), "jaccard-lists", total, cores)
    met = posts.where((F.col("node") != F.col("lead.node")) & (F.col("n") <= F.col("lead.r")) & (F.col("lead.m") <= F.col("reach")))
    votes = met.groupBy(F.col("node").alias("a"), F.col("lead.node").alias("b")).agg(F.count("*").alias("v"))
    pairs = votes.groupBy("a").agg(F.max(F.struct("v", "b")).alias("x")).select("a", F.col("x.b").alias("b"))
    edges = verified(pairs, sets)
    comp = staged(components(edges, size), "jaccard-roots", size)
    labelled = with_roots(posts.drop("lead"), comp)
    parts = labelled.groupBy("token", "root").agg(F.count("*").alias("n"))
    major = parts.groupBy("token").agg(F.max(F.struct("n", "root")).alias("x"), F.count("*").alias("roots"), F.sum("n").alias("n")).where("roots > 1")
    major = staged(major.select("token", "n", F.col("x.root").alias("major")), "jaccard-major", total)
    left = staged(meet(labelled.withColumnRenamed("n", "size"), major, "token", total), "jaccard-left", total, cores)
    a = left.where("root <> major").select("token", F.col("node").alias("a"), F.col("root").alias("ra"), F.col("size").alias("na"), F.col("l").alias("la"), F.col("reach").alias("xa"))
    b = left.select("token", F.col("node").alias("b"), F.col("root").alias("rb"), F.col("size").alias("nb"), F.col("l").alias("lb"), F.col("reach").alias("xb"), (F.col("root") == F.col("major")).alias("is_major"))
    fits = (F.col("ra") != F.col("rb")) & (F.col("nb") <= F.col("xa")) & (F.col("na") <= F.col("xb")) & (F.col("is_major") | (F.col("a") < F.col("b")))
    often = crowded(major.select("token", "n"), "token", total)
    pairs = meet_salted(b, a, "token", often, "b").where(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.least("la", "lb").alias("l"))
    pairs = pairs.groupBy("a", "b", "l").agg(F.count("*").alias("v")).where(F.col("v") >= F.col("l"))
    last = verified(pairs, sets)
    discard(comp, often, left, major, posts, few)
    out = staged(components(edges.unionByName(last), size), "jaccard-roots", size)
    discard(edges, last)
    return out


def with_roots(posts: DataFrame, comp: DataFrame) -> DataFrame:
    return posts.join(comp, "node", "left").withColumn("root", F.coalesce("root", "node"))


def joined(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of docs (doc_id, text), n_shingles and component_id, the smallest doc_id of the component.

    Empty texts and rows without id link with nothing; their component is their own id. Shingles are compared by hashes
    of 47 bits or more: that two of a pair's different shingles count as one, the only error there can be, has odds of
    about 10**-14 for each two. A kept column named like a new one is an error."""
    docs = carried(docs, keep, ("n_shingles", "component_id"), "doc_id", "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions, cells = dealing(size)
    bits = BITS + (cells - 1).bit_length()

    def name(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = shingles(batch.column("text").to_pylist(), bits)
        return pa.record_batch([batch.column("row"), batch.column("doc_id"), pa.array([len(x) for x in s], pa.int64()), pa.array([digest(x) for x in s], pa.binary())], names=["row", "doc_id", "n_shingles", "node"])

    members = kept(arrow_map(docs, name, schema_with(docs, ("row", "doc_id"), "n_shingles bigint, node binary")))
    total = members.count()
    counts = counted(dealt(docs.where("doc_id is not null"), partitions, cells), partitions, cells)
    sets = kept(prefixes(counts).dropDuplicates(["node"]))
    roots = links(sets)
    sets.unpersist()
    classes = members.where("node is not null and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("low"), F.count("*").alias("n"))
    classes = kept(classes.join(roots, "node", "left").where("n > 1 or root is not null").withColumn("root", F.coalesce("root", "node")))
    n_classes = classes.count()
    lows = staged(classes.groupBy("root").agg(F.min("low").alias("component"), F.count("*").alias("n")), "jaccard-lows", n_classes)
    named = meet(classes.withColumnRenamed("n", "of"), lows, "root", n_classes).select("node", "component", F.col("of").alias("n"))
    named = staged(named, "jaccard-named", n_classes)
    classes.unpersist()
    discard(roots, lows)
    # Of the rows outside hot classes, which are labelled by broadcast, nothing meets in one task.
    hot = F.col("n") * HOT > total
    at_once = members.join(F.broadcast(named.where(hot).drop("n")), "node", "left")
    rest = at_once.where("component is null").drop("component").join(named.where(~hot).drop("n"), "node", "left")
    out = at_once.where("component is not null").unionByName(rest)
    return out.select("row.*", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def dealing(size: int) -> tuple[int, int]:
    """Partitions and cells of shingles for texts of ``size`` bytes; both powers of two."""
    partitions = 1 << (max(LEAST_PARTITIONS, min(MOST_PARTITIONS, size // PARTITION_BYTES)) - 1).bit_length()
    return partitions, partitions << max(0, -(-size // (partitions * CELL_BYTES)) - 1).bit_length()


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Null and empty texts, and texts without words, have no shingles and are components of their own;
    equal rows are in the same component; a row without id has no component.
    """
    return joined(table(spark, sf_dir, "documents", "doc_id", "text"))


_ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w
), n AS (SELECT doc_id, len(g) AS n FROM g),
s AS (SELECT doc_id, unnest(g) AS sh FROM g),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL
), e AS (
  SELECT a, b FROM l JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT a, b FROM u UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, coalesce(m.low, n.doc_id)) AS component_id
FROM n LEFT JOIN (SELECT a, min(b) AS low FROM r GROUP BY a) m ON m.a = n.doc_id
"""
QUERIES = {"op6_ngram_jaccard": op6_ngram_jaccard}
ORACLES = {"op6_ngram_jaccard": _ORACLE}
