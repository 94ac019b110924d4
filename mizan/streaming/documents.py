"""Texts that arrive as files: each is parsed when it comes; nothing spans files, so no state is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import legal


def texts(spark: SparkSession, path: str, files_at_once: int = 1000) -> DataFrame:
    """(doc_id, text): a stream of the text files under path, one row a file."""
    files = spark.readStream.format("text").option("wholetext", "true").option("maxFilesPerTrigger", files_at_once).load(path)
    return files.select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("text"))


def parse(docs: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Writes each batch's articles, as flat rows, to Parquet; a batch that runs again replaces what it wrote."""

    def write(batch: DataFrame, number: int) -> None:
        rows = legal.article_texts(legal.articles(legal.parse_documents(batch)))
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
