"""Both programs end to end over a folder of files, with engines given as adapters.

What an engine makes is staged: rendering and recognition run once, however many columns follow from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import legal, pages, recognised
from ..sources import engines, files
from ..sources.staging import staged

#: What the page generation says of itself.
VERSION, PAGE_ENGINE = "2.0.0", "Tesseract"


def page_images(found: DataFrame, renderer: Callable, steps: Callable | None = None) -> DataFrame:
    """(path, page_number, image, seconds) of files (path, content), staged."""
    images = engines.render(found, renderer)
    return staged(engines.improve(images, steps) if steps else images, "images")


def page_documents(spark: SparkSession, path: str, renderer: Callable, reader: Callable, steps: Callable | None = None, detector: Callable | None = None, language: str | None = None, images: DataFrame | None = None) -> DataFrame:
    """(doc_id, document) of the page generation: metadata, summary, pages and the legal structure.

    ``language`` goes before ``detector``; without both, pages are read in all languages. ``images``: page_images() made before."""
    if language not in (None, *engines.PAGE_LANGUAGES):
        raise ValueError(f"language must be one of {', '.join(engines.PAGE_LANGUAGES)}")
    found = files.supported(files.scan(spark, path))
    if images is None:
        images = page_images(files.supported(files.scan(spark, path, content=True)), renderer, steps)
    if language is None and detector is not None:
        images = engines.detect(images, detector).withColumn("language", files.engine_language("detected"))
    else:
        images = images.withColumn("language", F.lit(language or "ara+eng"))
    read = staged(engines.read_pages(images, reader), "pages").withColumnRenamed("path", "doc_id")
    kept = pages.keep_words(engines.words_of(read.withColumnRenamed("doc_id", "path")).withColumnRenamed("path", "doc_id"))
    stats = staged(pages.page_stats(read.select("doc_id", "page_number", F.col("full_text").alias("text"), "language_used", "seconds"), kept), "page-stats")
    each = stats.join(pages.block_trees(kept), ["doc_id", "page_number"], "left")
    none = lambda c: F.coalesce(c, F.array())
    page = F.struct("page_number", F.col("text").alias("full_text"), none("words").alias("words"), none("blocks").alias("blocks"), "language_used", "cleaned_text", "page_confidence", "word_count", "character_count", "contains_arabic", "contains_english")
    of_doc = each.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(F.col("page_number").alias("k"), page.alias("page")))).alias("p")).select("doc_id", F.transform("p", lambda x: x["page"]).alias("pages"))
    summary = pages.summary(stats).select("doc_id", "total_pages", F.struct("total_pages", "total_words", "total_characters", "average_confidence", F.split("detected_languages", ",").alias("detected_languages")).alias("summary"))
    spent = stats.groupBy("doc_id").agg(F.round(F.sum("seconds"), 2).alias("processing_time_seconds"))
    own = pages.structures(stats.select("doc_id", "page_number", "cleaned_text")).withColumnRenamed("structure", "legal_structure")
    meta = found.select(F.col("path").alias("doc_id"), "file_name", F.col("path").alias("file_path"), "file_size_bytes", "file_type")
    out = meta.join(spent, "doc_id", "left").join(summary, "doc_id", "left").join(of_doc, "doc_id", "left").join(own, "doc_id", "left")
    metadata = F.struct("file_name", "file_path", "file_size_bytes", "file_type", F.coalesce("total_pages", F.lit(0)).alias("total_pages"), F.lit(VERSION).alias("pipeline_version"), F.coalesce("processing_time_seconds", F.lit(0.0)).alias("processing_time_seconds"), F.lit(PAGE_ENGINE).alias("ocr_engine"))
    nothing = F.struct(F.lit(0).cast("bigint").alias("total_pages"), F.lit(0).cast("bigint").alias("total_words"), F.lit(0).cast("bigint").alias("total_characters"), F.lit(0.0).alias("average_confidence"), F.array(F.lit("Unknown")).alias("detected_languages"))
    return out.select("doc_id", F.struct(metadata.alias("metadata"), F.coalesce("summary", nothing).alias("summary"), none("pages").alias("pages"), none("legal_structure").alias("legal_structure")).alias("document"))


def legal_documents(spark: SparkSession, path: str, texts: dict[str, Callable], renderer: Callable, lines: Callable, mode: str = "auto", steps: Callable | None = None) -> DataFrame:
    """(doc_id, document) of the legal generation; ``texts`` has engines by source, in the order of preference.

    Only documents whose embedded text has no article are rendered and recognised."""
    engines.languages(mode)
    found = files.supported(files.scan(spark, path))
    contents = files.supported(files.scan(spark, path, content=True))
    candidates = None
    for k, (source, make) in enumerate(texts.items()):
        own = engines.embedded_texts(contents, make, source, k)
        candidates = own if candidates is None else candidates.unionByName(own)
    if candidates is None:
        candidates = found.select("path", F.lit(0).alias("priority"), F.lit("").alias("source"), F.lit(None).cast("string").alias("text"), F.lit(0.0).alias("seconds"))
    candidates = T.with_nfkc(candidates, "text", branch=False).withColumn("text", T.normalize_lines("text"))
    candidates = staged(candidates.withColumnRenamed("path", "doc_id"), "candidates")
    primary = legal.choose_text(candidates)
    good = legal.with_articles(legal.split_lines(primary)).select(F.col("doc_id").alias("path"))
    images = engines.render(contents.join(good, "path", "left_anti"), renderer)
    predicted = staged(engines.recognise_lines(engines.improve(images, steps) if steps else images, lines, mode), "predictions")
    seen = recognised.deduplicate(engines.lines_of(predicted).withColumnRenamed("path", "doc_id"))
    chosen = staged(legal.with_fallback(primary, recognised.to_text(seen)), "texts")
    docs = legal.documents(legal.split_lines(chosen))
    counts = seen.groupBy("doc_id").agg(F.count("*").alias("ocr_line_count"))
    sizes = predicted.groupBy(F.col("path").alias("doc_id")).agg(F.max("page_number").alias("seen_pages"), F.sum("seconds").alias("reading"))
    used = candidates.groupBy("doc_id").agg(F.sum("seconds").alias("texting"), *[F.coalesce(F.bool_or((F.col("source") == s) & (F.col("text") != "")), F.lit(False)).alias(f"{s}_used") for s in texts])
    meta = found.withColumnRenamed("path", "doc_id").join(chosen.select("doc_id", F.col("source").alias("text_source")), "doc_id").join(used, "doc_id").join(counts, "doc_id", "left").join(sizes, "doc_id", "left")
    spent = F.round(F.col("texting") + F.coalesce("reading", F.lit(0.0)), 2).alias("processing_time_seconds")
    meta = meta.select("doc_id", F.struct("file_name", F.col("doc_id").alias("file_path"), "file_size_bytes", "file_type", "ocr_engine", "layout_engine", F.coalesce("total_pages", "seen_pages").alias("total_pages"), spent, F.lit(mode).alias("language_mode"), *[f"{s}_used" for s in texts], F.coalesce("ocr_line_count", F.lit(0)).alias("ocr_line_count"), "text_source").alias("metadata"))
    return docs.join(meta, "doc_id").select("doc_id", F.struct("document.*", "metadata").alias("document"))
