"""The page generation: words to lines, paragraphs, blocks and pages; pages to chapters, sections, articles and clauses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions import headings
from ..functions import text as T

#: Titles of what a document lacks.
VIRTUAL, GENERAL, FULL_TEXT = "Virtual Chapter", "General", "Full Text"


def keep_words(words: DataFrame) -> DataFrame:
    """Words with text and a confidence of 0 or more; text stripped, confidence whole."""
    conf = F.col("confidence").cast("int")
    return words.withColumns({"text": T.strip(F.coalesce("text", F.lit(""))), "confidence": conf}).where((F.col("text") != "") & (conf >= 0))


def mean(c: Column | str) -> Column:
    """To one decimal, half to even."""
    return F.bround(F.avg(c), 1)


_PAGE = ("doc_id", "page_number")


def _joined(order: str, separator: str) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "text"))), lambda x: x["text"]), separator)


def lines(words: DataFrame) -> DataFrame:
    """One row a line: text in input order, mean confidence, the union of the boxes, number of words.

    Words are dealt by page once; lines, paragraphs, blocks and pages are then grouped where they lie."""
    words = words.repartition(*_PAGE)
    x2, y2 = F.max(F.col("x") + F.col("width")), F.max(F.col("y") + F.col("height"))
    return words.groupBy(*_PAGE, "block_num", "par_num", "line_num").agg(
        _joined("idx", " ").alias("text"),
        mean("confidence").alias("average_confidence"),
        F.min("x").alias("x"),
        F.min("y").alias("y"),
        (x2 - F.min("x")).alias("width"),
        (y2 - F.min("y")).alias("height"),
        F.count("*").alias("n_words"),
    )


def paragraphs(lines_: DataFrame) -> DataFrame:
    return lines_.groupBy(*_PAGE, "block_num", "par_num").agg(_joined("line_num", " ").alias("text"), F.count("*").alias("n_lines"))


def blocks(paragraphs_: DataFrame) -> DataFrame:
    return paragraphs_.groupBy(*_PAGE, "block_num").agg(_joined("par_num", "\n").alias("text"), F.count("*").alias("n_paragraphs"))


def block_trees(words: DataFrame) -> DataFrame:
    """(doc_id, page_number, words, blocks): a page's kept words in input order, and nested as blocks, paragraphs and lines."""
    box = lambda *c: F.struct(*(F.col(x).alias(y) if isinstance(x, str) else x.alias(y) for x, y in zip(c, ("x", "y", "width", "height")))).alias("bounding_box")
    word = F.struct("text", "confidence", box("x", "y", "width", "height"), "block_num", "par_num", "line_num", "word_num")
    words = words.repartition(*_PAGE).withColumn("w", F.struct("idx", word.alias("v")))
    plain = lambda c: F.transform(F.array_sort(c), lambda x: x["v"])
    nested = lambda key, *c: F.collect_list(F.struct(key, F.struct(key, *c).alias("v")))
    x2, y2 = F.max(F.col("x") + F.col("width")), F.max(F.col("y") + F.col("height"))
    line = words.groupBy(*_PAGE, "block_num", "par_num", "line_num").agg(
        F.collect_list("w").alias("own"), _joined("idx", " ").alias("text"), mean("confidence").alias("average_confidence"),
        box(F.min("x"), F.min("y"), x2 - F.min("x"), y2 - F.min("y")),
    )
    line = line.withColumn("words", plain(F.col("own")))
    par = line.groupBy(*_PAGE, "block_num", F.col("par_num").alias("paragraph_num")).agg(F.flatten(F.collect_list("own")).alias("own"), _joined("line_num", " ").alias("text"), nested("line_num", "text", "average_confidence", "bounding_box", "words").alias("lines"))
    par = par.withColumn("lines", plain(F.col("lines")))
    block = par.groupBy(*_PAGE, "block_num").agg(F.flatten(F.collect_list("own")).alias("own"), _joined("paragraph_num", "\n").alias("text"), nested("paragraph_num", "text", "lines").alias("paragraphs"))
    block = block.withColumn("paragraphs", plain(F.col("paragraphs")))
    page = block.groupBy(*_PAGE).agg(F.flatten(F.collect_list("own")).alias("own"), nested("block_num", "text", "paragraphs").alias("blocks"))
    return page.select(*_PAGE, plain(F.col("own")).alias("words"), plain(F.col("blocks")).alias("blocks"))


def page_texts(blocks_: DataFrame) -> DataFrame:
    """(doc_id, page_number, text): a page's blocks."""
    return blocks_.groupBy(*_PAGE).agg(_joined("block_num", "\n").alias("text"))


def clean_pages(pages: DataFrame, text: str = "text") -> DataFrame:
    """pages with cleaned_text, character_count, contains_arabic, contains_english: control characters go, then NFKC, then white space."""
    pages = T.with_nfkc(pages.withColumn("cleaned_text", T.drop_control(F.coalesce(text, F.lit("")))), "cleaned_text", branch=False)
    pages = pages.withColumn("cleaned_text", T.collapse("cleaned_text"))
    return pages.withColumns({"character_count": F.length("cleaned_text"), "contains_arabic": T.has_arabic("cleaned_text"), "contains_english": T.has_latin("cleaned_text")})


def page_stats(pages: DataFrame, words: DataFrame) -> DataFrame:
    """clean_pages() of pages with word_count and page_confidence of their kept words; 0 and 0.0 without any."""
    stats = words.groupBy(*_PAGE).agg(F.count("*").alias("word_count"), mean("confidence").alias("page_confidence"))
    return clean_pages(pages).join(stats, list(_PAGE), "left").withColumns({"word_count": F.coalesce("word_count", F.lit(0)), "page_confidence": F.coalesce("page_confidence", F.lit(0.0))})


def summary(stats: DataFrame) -> DataFrame:
    """One row a document; the mean confidence is that of pages' rounded ones."""
    ar, en = F.bool_or("contains_arabic"), F.bool_or("contains_english")
    languages = F.when(ar & en, F.lit("Arabic,English")).when(ar, F.lit("Arabic")).when(en, F.lit("English")).otherwise(F.lit("Unknown"))
    return stats.groupBy("doc_id").agg(
        F.count("*").alias("total_pages"),
        F.sum("word_count").alias("total_words"),
        F.sum("character_count").cast("bigint").alias("total_characters"),
        # Tenths are summed as whole numbers, so that the order of pages cannot matter.
        F.bround(F.sum(F.round(F.col("page_confidence") * 10).cast("bigint")) / (F.lit(10.0) * F.count("*")), 1).alias("average_confidence"),
        languages.alias("detected_languages"),
    )


def tagged(page_lines: DataFrame) -> DataFrame:
    """Lines (doc_id, page_number, pos, line) with their heading and running state; state crosses pages; empty lines go.

    chapter_seq 0 is the virtual chapter; section_seq counts within a chapter, 0 is its general section."""
    return _running(page_lines.withColumn("line", T.strip("line")).where("line <> ''"))


def _running(lines_: DataFrame) -> DataFrame:
    """tagged() of stripped lines, with their other columns; those that are null are no headings."""
    lines_ = lines_.withColumn("h", headings.page_event(F.col("line")))
    w = Window.partitionBy("doc_id").orderBy("page_number", "pos").rowsBetween(Window.unboundedPreceding, 0)
    kind = F.col("h.kind")
    step = lines_.select(
        *(c for c in lines_.columns if c != "h"),
        kind.alias("kind"),
        "h.number",
        F.count(F.when(kind == "C", 1)).over(w).alias("chapter_seq"),
        F.count(F.when(kind == "S", 1)).over(w).alias("sections"),
        F.count(F.when(kind == "A", 1)).over(w).alias("article_seq"),
        F.last(kind, ignorenulls=True).over(w).alias("last_kind"),
    )
    # Sections before the open chapter: the running count at its heading.
    before = F.coalesce(F.max(F.when(F.col("kind") == "C", F.col("sections"))).over(w), F.lit(0))
    return step.withColumn("section_seq", F.col("sections") - before).drop("sections")


def chapters(tag: DataFrame) -> DataFrame:
    real = tag.where("kind = 'C'").select("doc_id", "chapter_seq", F.col("number").alias("chapter_number"), F.col("line").alias("title"))
    virtual = tag.where("chapter_seq = 0 and kind in ('S', 'A')").select("doc_id").distinct()
    return real.unionByName(virtual.select("doc_id", F.lit(0).cast("bigint").alias("chapter_seq"), F.lit("0").alias("chapter_number"), F.lit(VIRTUAL).alias("title")))


def sections(tag: DataFrame) -> DataFrame:
    real = tag.where("kind = 'S'").select("doc_id", "chapter_seq", "section_seq", F.col("number").alias("section_number"), F.col("line").alias("title"))
    general = tag.where("kind = 'A' and section_seq = 0").select("doc_id", "chapter_seq").distinct()
    return real.unionByName(general.select("doc_id", "chapter_seq", F.lit(0).cast("bigint").alias("section_seq"), F.lit("0").alias("section_number"), F.lit(GENERAL).alias("title")))


def articles(tag: DataFrame) -> DataFrame:
    return tag.where("kind = 'A'").select("doc_id", "article_seq", "chapter_seq", "section_seq", F.col("number").alias("article_number"), F.col("line").alias("title"))


def clauses(tag: DataFrame) -> DataFrame:
    """Lines of an open article; those between a chapter or section and the next article belong to nothing."""
    return tag.where("kind is null and last_kind = 'A'").select("doc_id", "article_seq", "page_number", "pos", F.col("line").alias("clause"))


def without_structure(pages: DataFrame, tag: DataFrame) -> DataFrame:
    """(doc_id, page_number, clause): the pages with text of documents without any heading, which become
    clauses of the article "0" (Full Text) of the general section of the virtual chapter."""
    any_heading = tag.where("kind is not null").select("doc_id").distinct()
    return pages.join(any_heading, "doc_id", "left_anti").where("cleaned_text <> ''").select("doc_id", "page_number", F.col("cleaned_text").alias("clause"))


def structures(pages: DataFrame) -> DataFrame:
    """(doc_id, structure): nested chapters of cleaned pages (doc_id, page_number, cleaned_text).

    One scan and one exchange: each line has the keys of the chapter, section and article it is in, and grouping by ever
    fewer of them, all within the document, folds lines to articles, sections, chapters and the document."""
    lines_ = pages.select("doc_id", "page_number", "cleaned_text", F.posexplode(F.split("cleaned_text", "\n")).alias("pos", "line"))
    lines_ = lines_.withColumn("page", F.when((F.col("pos") == 0) & (F.col("cleaned_text") != ""), F.struct("page_number", F.col("cleaned_text").alias("v")))).drop("cleaned_text")
    tag = _running(lines_.withColumn("line", F.nullif(T.strip("line"), F.lit(""))))
    none, last = F.count("kind").over(Window.partitionBy("doc_id")) == 0, F.col("last_kind")
    tag = tag.withColumns({"c": F.when(last.isNotNull(), F.col("chapter_seq")), "s": F.when(last.isin("S", "A"), F.col("section_seq")), "a": F.when(last == "A", F.col("article_seq")), "page": F.when(none, F.col("page"))})
    clause = F.when(F.col("a").isNotNull() & F.col("kind").isNull() & F.col("line").isNotNull(), F.struct("page_number", "pos", F.col("line").alias("v")))
    plain = lambda c: F.transform(F.sort_array(c), lambda x: x["v"])
    folded = lambda c: F.flatten(F.collect_list(c)).alias(c)
    # What a group's own heading says: the row without the next key has it.
    own = lambda key, c: F.max(F.when(F.col(key).isNull(), F.col(c))).alias(c)
    nested = lambda key, *c: plain(F.collect_list(F.when(F.col(key).isNotNull(), F.struct(F.col(key).alias("k"), F.struct(*c).alias("v")))))
    named = lambda number, title, key, no, name: (F.when(F.col(key) == 0, no).otherwise(F.col("number")).alias(number), F.when(F.col(key) == 0, name).otherwise(F.col("title")).alias(title))
    heading = lambda c: F.max(F.when(F.col("kind").isNotNull(), F.col(c)))
    arts = tag.groupBy("doc_id", "c", "s", "a").agg(heading("number").alias("number"), heading("line").alias("title"), plain(F.collect_list(clause)).alias("clauses"), F.collect_list("page").alias("page"))
    secs = arts.groupBy("doc_id", "c", "s").agg(own("a", "number"), own("a", "title"), nested("a", F.col("number").alias("article_number"), "title", "clauses").alias("articles"), folded("page"))
    chs = secs.groupBy("doc_id", "c").agg(own("s", "number"), own("s", "title"), nested("s", *named("section_number", "title", "s", "0", GENERAL), "articles").alias("sections"), folded("page"))
    docs = chs.groupBy("doc_id").agg(nested("c", *named("chapter_number", "title", "c", "0", VIRTUAL), "sections").alias("structure"), folded("page"))
    # A document without any heading has its pages as clauses of one article.
    lone = F.array(F.struct(F.lit("0").alias("article_number"), F.lit(FULL_TEXT).alias("title"), plain(F.col("page")).alias("clauses")))
    lone = F.array(F.struct(F.lit("0").alias("section_number"), F.lit(GENERAL).alias("title"), lone.alias("articles")))
    lone = F.array(F.struct(F.lit("0").alias("chapter_number"), F.lit(VIRTUAL).alias("title"), lone.alias("sections")))
    return docs.select("doc_id", F.when(F.size("structure") > 0, F.col("structure")).otherwise(lone).alias("structure"))
