"""The corpus pipeline: documents of quality, without toxic ones, near copies and benchmark passages, as token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mizan.llm import decontaminate, jaccard, pieces, quality, toxicity
from mizan.llm.common import gathered, staged, table


#: Parts that the last stage remembers in each worker, which has held other stages' models before.
REMEMBERED = 60_000


def _rows(docs: DataFrame) -> DataFrame:
    """Each document as one struct, so that no column's name can clash with an operator's, its id and its text."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "doc_id", "text")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold.

    Null and empty texts get the score of no n-grams; a score at the threshold stays; equal texts, and so repeated rows,
    stay or go together, with or without id. An empty table stays empty."""
    w = quality.fit(docs, quality.training_labels(spark, sf_dir))
    return quality.scored(_rows(docs), w, ("row",)).where(F.col("score") >= quality.THRESHOLD).select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold.

    Null and empty texts show nothing toxic and stay; a score at the threshold goes; equal texts, and so repeated rows,
    stay or go together, with or without id. An empty table stays empty."""
    model = toxicity.fit(docs, toxicity.training_labels(spark, sf_dir))
    return toxicity.scored(_rows(docs), model, ("row",)).where(F.col("score") < toxicity.THRESHOLD).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; of rows with the same id and text, one.

    Documents without words or without id are no copies of anything."""
    found = jaccard.joined(docs.select("doc_id", "text"))
    copies = gathered(found.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct(), "pipeline-copies")
    kept = docs.join(decontaminate.sized(copies, copies.count() * decontaminate.ROW_BYTES), "doc_id", "left_anti").select(*docs.columns)
    again = gathered(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "pipeline-again")
    n = again.count() * decontaminate.ROW_BYTES
    if not n:
        return kept
    repeated = kept.join(decontaminate.sized(again, n), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(decontaminate.sized(again, n), "doc_id", "left_anti").unionByName(repeated).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with a benchmark item.

    Null and empty texts, and rows without id, stay; of rows with the same id all go if one does. An empty table stays empty."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the text they decode to, and the ids.

    Null and empty texts have no ids; repeated rows and rows without id stay. An empty table stays empty."""
    return pieces.encoded(docs, public_tokenizers.path(pieces.MODEL), with_ids=True, remembered=REMEMBERED)


STAGES = [
    ("quality", keep_quality),
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]
#: No stage can be expressed in SQL as a whole; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
