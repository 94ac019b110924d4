"""All queries by name, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import legal, pages, recognised
from ..sources import files
from . import fixtures as X
from .oracles import ORACLES

FLAGSHIP = "b_articles"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The fixture's lines are NFKC as they stand.
    return legal.tagged(X.legal(spark, sf_dir))


@query
def b_articles(spark, sf_dir):
    return legal.articles(_tagged(spark, sf_dir))


@query
def b_article_texts(spark, sf_dir):
    return legal.article_texts(legal.articles(_tagged(spark, sf_dir)))


@query
def b_parts(spark, sf_dir):
    return legal.parts(_tagged(spark, sf_dir))


@query
def b_chapters(spark, sf_dir):
    return legal.chapters(_tagged(spark, sf_dir))


@query
def b_preamble(spark, sf_dir):
    return legal.preamble(_tagged(spark, sf_dir))


@query
def b_dropped_lines(spark, sf_dir):
    return legal.dropped_lines(_tagged(spark, sf_dir))


@query
def b_number_words(spark, sf_dir):
    found = X.number_phrases(spark, sf_dir).select("item_id", "k", T.leading_number("phrase").alias("x"))
    return found.select("item_id", "k", "x.number", "x.rest")


@query
def b_titles(spark, sf_dir):
    return legal.titles(legal.states(X.legal(spark, sf_dir))).drop("n_headings")


@query
def b_title_scores(spark, sf_dir):
    tag = _tagged(spark, sf_dir)
    return tag.select("doc_id", "pos", legal.title_score(F.col("line"), F.col("kind").isNotNull()).alias("score"))


@query
def b_noise(spark, sf_dir):
    return X.mixed(spark, sf_dir).select("doc_id", "pos", T.is_noise("padded").alias("noise"))


@query
def b_list_items(spark, sf_dir):
    return X.lines(spark, sf_dir).select("doc_id", "pos", T.is_list_item(F.expr(X.LIST_LINE)).alias("list_item"))


@query
def b_bilingual(spark, sf_dir):
    return T.with_scripts(X.mixed(spark, sf_dir), "padded", "text_en", "text_ar").select("doc_id", "pos", "text_en", "text_ar")


@query
def b_choose_text(spark, sf_dir):
    return legal.choose_text(X.candidates(spark, sf_dir)).select("doc_id", "source", F.length("text").alias("n_chars"))


@query
def b_fallback(spark, sf_dir):
    primary = legal.choose_text(X.candidates(spark, sf_dir))
    return legal.with_fallback(primary, X.recognised_texts(spark, sf_dir)).select("doc_id", "source", F.length("text").alias("n_chars"))


@query
def b_article_counts(spark, sf_dir):
    return legal.article_counts(X.legal(spark, sf_dir))


@query
def b_no_structure(spark, sf_dir):
    return legal.titles(legal.states(X.lines(spark, sf_dir)))


@query
def b_json(spark, sf_dir):
    """Nested documents as JSON text, nulls kept."""
    return legal.documents(X.legal(spark, sf_dir)).select("doc_id", F.to_json("document", {"ignoreNullFields": "false"}).alias("json"))


@query
def ocr_dedup(spark, sf_dir):
    return recognised.deduplicate(X.recognised(spark, sf_dir))


@query
def ocr_lines_to_text(spark, sf_dir):
    return recognised.to_text(recognised.deduplicate(X.recognised(spark, sf_dir)))


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.keep_words(X.words(spark, sf_dir))


@query
def a_word_filter(spark, sf_dir):
    return _words(spark, sf_dir).select("doc_id", "idx", "text", "confidence")


@query
def a_lines(spark, sf_dir):
    return pages.lines(_words(spark, sf_dir))


@query
def a_paragraphs(spark, sf_dir):
    return pages.paragraphs(a_lines(spark, sf_dir))


@query
def a_blocks(spark, sf_dir):
    return pages.blocks(a_paragraphs(spark, sf_dir))


@query
def a_page_stats(spark, sf_dir):
    words = _words(spark, sf_dir)
    texts = pages.page_texts(pages.blocks(pages.paragraphs(pages.lines(words))))
    return pages.page_stats(texts, words).select("doc_id", "page_number", F.col("character_count").cast("bigint").alias("character_count"), "contains_arabic", "contains_english", "word_count", "page_confidence")


@query
def a_summary(spark, sf_dir):
    return pages.summary(a_page_stats(spark, sf_dir))


@query
def a_clean_text(spark, sf_dir):
    return X.dirty(spark, sf_dir).select("doc_id", T.collapse(T.drop_control("text")).alias("cleaned_text"))


@query
def a_clean_nfkc(spark, sf_dir):
    return pages.clean_pages(X.dirty(spark, sf_dir)).select("doc_id", "cleaned_text", "character_count", "contains_arabic", "contains_english")


def _pages_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.tagged(X.legal_pages(spark, sf_dir))


@query
def a_chapters(spark, sf_dir):
    return pages.chapters(_pages_tagged(spark, sf_dir))


@query
def a_sections(spark, sf_dir):
    return pages.sections(_pages_tagged(spark, sf_dir))


@query
def a_articles(spark, sf_dir):
    return pages.articles(_pages_tagged(spark, sf_dir))


@query
def a_clauses(spark, sf_dir):
    return pages.clauses(_pages_tagged(spark, sf_dir))


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = X.read(spark, sf_dir, "conversations", F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_number"), "text")
    return pages.clean_pages(turns)


@query
def a_fallback(spark, sf_dir):
    turns = _turns(spark, sf_dir).select("doc_id", "page_number", "cleaned_text")
    lines = turns.select("doc_id", "page_number", F.posexplode(F.split("cleaned_text", "\n")).alias("pos", "line"))
    return pages.without_structure(turns, pages.tagged(lines))


@query
def a_json(spark, sf_dir):
    """Nested chapters as JSON text, for conversations as documents."""
    turns = _turns(spark, sf_dir).select("doc_id", "page_number", "cleaned_text")
    return pages.structures(turns).select("doc_id", F.to_json("structure", {"ignoreNullFields": "false"}).alias("json"))


@query
def a_structures(spark, sf_dir):
    """Nested chapters as JSON text, for documents with headings of the page generation."""
    lines = F.array_sort(F.collect_list(F.struct("pos", "line")))
    each = X.legal_pages(spark, sf_dir).groupBy("doc_id", "page_number").agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("cleaned_text"))
    return pages.structures(each).select("doc_id", F.to_json("structure", {"ignoreNullFields": "false"}).alias("json"))


@query
def a_lang_map(spark, sf_dir):
    docs = X.read(spark, sf_dir, "documents", "lang")
    return docs.groupBy("lang").agg(F.count("*").alias("n")).select("lang", files.engine_language("lang").alias("engine_language"), "n")


@query
def t_source_lines(spark, sf_dir):
    return legal.source_lines(X.html_lines(spark, sf_dir))


@query
def t_digits(spark, sf_dir):
    return X.mixed(spark, sf_dir).select("doc_id", "pos", T.ascii_digits("mixed").alias("text"))


@query
def t_normalize(spark, sf_dir):
    return X.mixed(spark, sf_dir).select("doc_id", "pos", T.normalize("padded").alias("text"))


@query
def meta_files(spark, sf_dir):
    path = F.regexp_replace("url", "[?#].*$", "")
    ending = F.expr("CASE page_id % 4 WHEN 0 THEN '.PDF' WHEN 1 THEN '.png' WHEN 2 THEN '.Tiff' ELSE '.txt' END")
    found = X.read(spark, sf_dir, "pages", "page_id", "url").select("page_id", F.concat(path, ending).alias("path"))
    return files.described(found).select("page_id", "file_name", "file_type", "supported", "ocr_engine", "layout_engine", "total_pages")


@query
def i_deskew_rule(spark, sf_dir):
    angles = X.read(spark, sf_dir, "events", F.col("user_id").alias("doc_id"), (F.col("value") % 60 - 15).alias("angle"))
    return recognised.skew_angle(angles).select("doc_id", F.round("angle", 6).alias("angle"), "applied")
