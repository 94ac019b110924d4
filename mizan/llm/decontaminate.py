"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

Fixed masks ignore some of the words of a window; equal hashes of the words they keep are hits,
whatever stands at the ignored places.  Around each hit the texts are aligned and compared word
by word.  The two masks hit every window of 13 words with at most two substitutions (shown by
trying them all in the tests).  Items of 8 to 12 words are held against texts as a whole, with
one substitution at most: two masks without a common place see to that.  Shorter items must be
there as they are: a mask of their own length, which ignores nothing, finds them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import gathered, kept, table

#: 1: a word that counts; 0: a word that is ignored.
MASKS = ("11101011", "110100111")
#: Masks at the begin of items that are shorter than a window.
HALVES = ("10101010", "01010101")
#: Words of a window and how many must agree.
WINDOW, AGREE = 13, 11
#: Items of fewer words must agree in all; those of fewer than a window's in all but one.
SHORT = len(HALVES[0])
#: Bytes up to which a side is broadcast; beyond, both sides are shuffled. What a row of seeds or ids counts for.
BROADCAST_BYTES, ROW_BYTES = 64 << 20, 64


def words(text: Column) -> Column:
    """Runs of letters and digits in lower case; none for null and empty texts."""
    all_words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    start = F.when(F.get(all_words, F.lit(0)) == "", 2).otherwise(1)
    tail = F.when(F.element_at(all_words, -1) == "", 1).otherwise(0)
    return F.slice(all_words, start, F.greatest(F.lit(0), F.size(all_words) - (start - 1) - tail))


def seeds(rows: DataFrame, masks: dict[int, str], *keep: str) -> DataFrame:
    """(keep, at, seed): for each mask (by number) and place, the hash of the words that the mask keeps. ``rows`` has an array ``words``."""
    hashed = rows.select(*keep, F.transform("words", lambda w: F.xxhash64(w)).alias("h"))

    def masked(number: int, mask: str) -> Column:
        kept = [i for i, c in enumerate(mask) if c == "1"]
        places = F.when(F.size("h") >= len(mask), F.sequence(F.lit(0), F.size("h") - len(mask))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.xxhash64(F.lit(number), *[F.get("h", i + F.lit(o)) for o in kept]))

    by_mask = hashed.select(*keep, F.explode(F.array(*[masked(*m) for m in masks.items()])).alias("s"))
    return by_mask.select(*keep, F.posexplode("s").alias("at", "seed"))


#: Numbers of the masks; that of a short item is its length behind them.
LONG = dict(enumerate(MASKS))
MIDDLE = dict(enumerate(HALVES, len(LONG)))


def whole(n: int) -> dict[int, str]:
    """The mask of an item of n words, all of which count."""
    return {len(LONG) + len(MIDDLE) + n: "1" * n}


def sized(df: DataFrame, size: int) -> DataFrame:
    """df, to be broadcast if its ``size`` in bytes allows."""
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, doc_word, matched): pairs of a document and an item that share a window.

    ``docs`` has doc_id and text, ``items`` item_id and text.  doc_word is the document's word (from 0;
    below 0 if the item begins before the document) at which the item begins in the alignment with the most agreeing words (the first
    of several), ``matched`` their number.  Rows without id, and texts without words, match nothing; of rows
    with the same id any may match, and the pair is returned once.  The result is staged.
    """
    items = kept(items.where("item_id is not null").select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0))
    docs = docs.where("doc_id is not null").select("doc_id", "text")
    n, sides = F.size("words"), []
    lengths = {r[0] for r in items.where(n < WINDOW).select(n).distinct().collect()}  # twelve at most
    parts = [(items.where(n >= WINDOW), LONG)]
    if any(k >= SHORT for k in lengths):
        parts.append((items.where((n < WINDOW) & (n >= SHORT)), MIDDLE))
    parts += [(items.where(n == k), whole(k)) for k in sorted(lengths) if k < SHORT]
    masks: dict[int, str] = {}
    for own, m in parts:
        found = seeds(own, m, "item_id").withColumnRenamed("at", "item_at")
        sides.append(found if m is LONG else found.where("item_at = 0"))
        masks |= m
    tests = sides[0]
    for x in sides[1:]:
        tests = tests.unionByName(x)
    tests = kept(tests.distinct())
    found = seeds(docs.select("doc_id", words(F.col("text")).alias("words")), masks, "doc_id").join(sized(tests, tests.count() * ROW_BYTES), "seed")
    hits = kept(found.select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct())
    hit_docs = hits.groupBy("doc_id").agg(F.collect_set(F.struct("item_id", "shift")).alias("hits"))
    near = docs.join(sized(hit_docs, hits.count() * ROW_BYTES), "doc_id").select("doc_id", words(F.col("text")).alias("words"), "hits")
    pairs = near.select("doc_id", "words", F.explode("hits").alias("hit")).select("doc_id", "words", "hit.*")
    size = items.agg(F.sum(F.aggregate("words", F.lit(ROW_BYTES).cast("bigint"), lambda a, x: a + F.octet_length(x) + 16))).first()[0] or 0
    pairs = pairs.join(sized(items.withColumnRenamed("words", "item"), size), "item_id")
    same = F.transform(F.sequence(F.lit(0), F.size("item") - 1), lambda i: F.when((F.col("shift") + i >= 0) & (F.get("words", F.greatest(F.lit(0), F.col("shift") + i)) == F.get("item", i)), 1).otherwise(0))
    pairs = pairs.select("doc_id", "item_id", "shift", F.size("item").alias("n"), same.alias("same"))
    width = F.least(F.lit(WINDOW), F.col("n"))
    windows = F.transform(F.sequence(F.lit(1), F.col("n") - width + 1), lambda i: F.aggregate(F.slice("same", i, width), F.lit(0), lambda a, x: a + x))
    pairs = pairs.select("doc_id", "item_id", "shift", "n", F.array_max(windows).alias("best"), F.aggregate("same", F.lit(0), lambda a, x: a + x).alias("matched"))
    least = F.when(F.col("n") < SHORT, F.col("n")).when(F.col("n") < WINDOW, F.col("n") - 1).otherwise(AGREE)
    top = F.max(F.struct("matched", (-F.col("shift")).alias("before"))).alias("top")
    best = pairs.where(F.col("best") >= least).groupBy("doc_id", "item_id").agg(top)
    out = gathered(best.select("doc_id", "item_id", (-F.col("top.before")).cast("bigint").alias("doc_word"), F.col("top.matched").cast("bigint").alias("matched")), "contaminated")
    for df in (items, tests, hits):
        df.unpersist()
    return out


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs without those that share a window with an item; rows without id stay, and of rows with the same id all go."""
    found = contaminated(docs, items).select("doc_id").distinct()
    return docs.join(sized(found, found.count() * ROW_BYTES), "doc_id", "left_anti")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that share a window: doc_id, item_id, doc_word, matched.

    Null and empty texts, and rows without id, match nothing; of alignments with as many agreeing words the
    first counts; repeated rows give one pair.
    """
    return contaminated(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


_ORACLE = r"""
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents WHERE doc_id IS NOT NULL
), bw AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark WHERE item_id IS NOT NULL
), d AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS p FROM dw),
b AS (SELECT item_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS q, len(w) AS n FROM bw),
m AS (SELECT doc_id, item_id, p - q AS shift, q, n FROM d JOIN b USING (word)),
c AS (
  SELECT doc_id, item_id, shift, n,
         count(*) OVER (PARTITION BY doc_id, item_id, shift ORDER BY q RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) AS best,
         count(*) OVER (PARTITION BY doc_id, item_id, shift) AS matched
  FROM m
), k AS (SELECT DISTINCT doc_id, item_id, shift, matched FROM c WHERE best >= CASE WHEN n < 8 THEN n WHEN n < 13 THEN n - 1 ELSE 11 END)
SELECT doc_id, item_id, CAST(shift AS BIGINT) AS doc_word, CAST(matched AS BIGINT) AS matched
FROM k QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, shift) = 1
"""
QUERIES = {"op7_decontamination": op7_decontamination}
ORACLES = {"op7_decontamination": _ORACLE}
