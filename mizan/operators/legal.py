"""The legal parser: ordered lines to parts, chapters, articles, titles and nested documents.

All running state comes from one window per document, ordered by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions import headings
from ..functions import text as T

#: The marks by which a text shows structure.
MARKERS = ["article", "chapter", "part", "المادة", "الفصل", "الباب", "الجزء"]
#: Words of titles.
COMMERCE = ["chambers", "commerce", "regulation", "regulations", "rules"]
LAW_NOUNS = ["نظام", "قانون", "لائحة", "الأحكام"]
UNTITLED_EN, UNTITLED_AR = "Untitled Legal Document", "مستند قانوني بدون عنوان"
#: Lines from a document's start that may be its title.
TITLE_LINES = 80


def split_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, line): the raw lines of documents (doc_id, text); a document without text has one empty line."""
    lines = F.split(F.translate(F.coalesce("text", F.lit("")), "\r", "\n"), "\n")
    return docs.select("doc_id", F.posexplode(lines).alias("pos", "line"))


def _cleaned(c: Column | str) -> Column:
    """An array of the cleaned line, or of nothing: each step is evaluated once, however often the next one names it."""
    unmarked = lambda x: F.when(x.startswith("#"), F.regexp_replace(x, r"(?U)^#{1,6}\s*", "")).otherwise(x)
    comment = lambda x: x.startswith("<!--") & x.rlike(r"(?iU)^<!--\s*image\s*-->$")
    return F.filter(F.transform(F.array(T.normalize(c)), unmarked), lambda x: (x != "") & ~comment(x))


def clean_line(c: Column | str) -> Column:
    """Normalised, without one run of up to six number signs; null for image comments and empty lines."""
    return F.get(_cleaned(c), F.lit(0))


def source_lines(lines: DataFrame) -> DataFrame:
    """(doc_id, pos, line) without those that clean_line() drops."""
    return lines.select("doc_id", "pos", F.explode(_cleaned("line")).alias("line"))


def states(lines: DataFrame) -> DataFrame:
    """All lines with their heading (kind, number, title, body), the running state and the scripts of the raw line (ar, en);
    ``line`` is null for those that clean_line() drops.

    part_seq, chapter_seq, order_index: headings so far; last_kind: the last heading's kind;
    in_part and in_chapter: whether one is open; n: the line's number among source lines."""
    lines = lines.select("doc_id", "pos", clean_line("line").alias("line"), T.has_arabic("line").alias("ar"), T.has_latin("line").alias("en"))
    return _running(headings.with_headings(lines))


def tagged(lines: DataFrame) -> DataFrame:
    """states() of the source lines alone."""
    return _running(headings.with_headings(source_lines(lines)))


def _running(lines: DataFrame) -> DataFrame:
    w = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    kind = F.col("kind")
    count = lambda c: F.count(F.when(c, 1)).over(w)
    last = lambda *kinds: F.last(F.when(kind.isin(*kinds), kind), ignorenulls=True).over(w)
    return lines.select(
        *lines.columns,
        count(kind == "P").alias("part_seq"),
        count(kind.isin("C", "F")).alias("chapter_seq"),
        count(kind == "A").alias("order_index"),
        last("F", "P", "C", "A").alias("last_kind"),
        F.coalesce(last("F", "P") == "P", F.lit(False)).alias("in_part"),
        F.coalesce(last("F", "P", "C") != "P", F.lit(False)).alias("in_chapter"),
        F.count("line").over(w).alias("n"),
    )


def articles(tag: DataFrame) -> DataFrame:
    """(doc_id, order_index, article_number, part_seq, chapter_seq, text): parents are null where none is open."""
    own = tag.where("last_kind = 'A'")
    content = F.when(F.col("kind") == "A", F.nullif("body", F.lit(""))).otherwise(F.col("line"))
    lines = F.array_sort(F.collect_list(F.when(content.isNotNull(), F.struct("pos", content.alias("line")))))
    flat = own.groupBy("doc_id", "order_index").agg(
        F.max(F.when(F.col("kind") == "A", F.col("number"))).alias("article_number"),
        F.max(F.when(F.col("in_part"), F.col("part_seq"))).alias("part_seq"),
        F.max(F.when(F.col("in_chapter"), F.col("chapter_seq"))).alias("chapter_seq"),
        F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("text"),
    )
    return flat


def article_texts(flat: DataFrame) -> DataFrame:
    """articles() with text_en and text_ar in place of text."""
    return T.with_scripts(flat, "text", "text_en", "text_ar").drop("text")


def parts(tag: DataFrame) -> DataFrame:
    tag = T.with_scripts(tag.where("kind = 'P'"), "title", "title_en", "title_ar")
    return tag.select("doc_id", "part_seq", F.col("number").alias("part_number"), "title_en", "title_ar")


def chapters(tag: DataFrame) -> DataFrame:
    """Chapters and closing chapters; the latter have no number and belong to no part."""
    parent = F.when((F.col("kind") == "C") & F.col("in_part"), F.col("part_seq"))
    tag = T.with_scripts(tag.where("kind in ('C', 'F')"), "title", "title_en", "title_ar")
    return tag.select("doc_id", "chapter_seq", parent.alias("part_seq"), F.col("number").alias("chapter_number"), "title_en", "title_ar")


def preamble(tag: DataFrame) -> DataFrame:
    return tag.where("last_kind is null").select("doc_id", "pos", "line")


def dropped_lines(tag: DataFrame) -> DataFrame:
    """Lines after a part or chapter heading and before its first article: they belong to nothing."""
    return tag.where("kind is null and last_kind in ('F', 'P', 'C')").select("doc_id", "pos", "line")


def is_title_case(text: Column) -> Column:
    """Every word's first letter is upper case and no other is; a text without case qualifies."""
    return ~(text.rlike(r"^\p{Ll}") | text.rlike(r"[^\p{Ll}\p{Lu}\p{Lt}]\p{Ll}") | text.rlike(r"[\p{Ll}\p{Lu}\p{Lt}][\p{Lu}\p{Lt}]"))


def title_score(line: Column, structure: Column) -> Column:
    """How much a normalised line looks like a title; ``structure``: whether it is a heading."""
    low, words = T.fold_case(line), F.size(F.split(line, " "))
    points = lambda cond, n: F.when(cond, n).otherwise(0)
    total = (
        points(F.length(line).between(8, 90), 8)
        + points(words <= 10, 3)
        + points(~line.contains(":"), 2)
        + points(low.endswith("law") | low.contains(" law"), 20)
        + points(T.contains_any(low, COMMERCE), 6)
        + points(T.contains_any(line, LAW_NOUNS), 20)
        + points(is_title_case(line), 2)
        - points(line.endswith(":"), 5)
        - points(words > 18, 8)
    )
    return F.when(T.is_noise_line(line), -100).when(structure, -50).otherwise(total)


def _candidate() -> Column:
    """A line's place among the candidates for the title, null for other lines: the lines before the first heading and
    the first TITLE_LINES source lines; the greatest is the best, the first of several."""
    before = F.col("last_kind").isNull()
    score = F.when(F.col("line").isNotNull() & (before | (F.col("n") <= TITLE_LINES)), title_score(F.col("line"), F.col("kind").isNotNull()))
    first = F.transform(F.array(score), lambda s: F.when(s >= 0, F.struct(s.alias("score"), F.when(before, 1).otherwise(0).alias("preamble"), (-F.col("pos")).alias("before"), F.col("line").alias("line"))))
    return F.get(first, F.lit(0))


def _titled(docs: DataFrame, *keep: str) -> DataFrame:
    """docs (best, ar, en) with title_en and title_ar: the best candidate's sides, else the fallback title."""
    arabic_only = F.col("ar") & ~F.col("en")
    none = F.col("e").isNull() & F.col("a").isNull()
    sides = T.with_scripts(docs.withColumn("line", F.col("best.line")), "line", "e", "a")
    return sides.select(*keep, F.when(none & ~arabic_only, UNTITLED_EN).otherwise(F.col("e")).alias("title_en"), F.when(none & arabic_only, UNTITLED_AR).otherwise(F.col("a")).alias("title_ar"))


def titles(states_: DataFrame) -> DataFrame:
    """(doc_id, title_en, title_ar, n_headings) of documents as states()."""
    docs = states_.withColumn("candidate", _candidate()).groupBy("doc_id")
    docs = docs.agg(F.max("candidate").alias("best"), F.bool_or("ar").alias("ar"), F.bool_or("en").alias("en"), F.count("kind").alias("n_headings"))
    return _titled(docs, "doc_id", "n_headings").select("doc_id", "title_en", "title_ar", "n_headings")


def documents(lines: DataFrame) -> DataFrame:
    """(doc_id, document): nested structures; parts and chapters without articles stay, in their order.

    One scan and one exchange: each line has the keys of the part, chapter and article it is in, and grouping by
    ever fewer of them, all within the document, folds lines to articles, chapters, parts and the document."""
    tag = states(lines).withColumn("candidate", _candidate())
    p, c, a = F.when(F.col("in_part"), F.col("part_seq")), F.when(F.col("in_chapter"), F.col("chapter_seq")), F.when(F.col("last_kind") == "A", F.col("order_index"))
    tag = tag.withColumns({"p": p, "c": c, "a": a})
    group = F.col("kind").isin("P", "C", "F")
    content = F.when(F.col("a").isNull(), None).when(F.col("kind") == "A", F.nullif("body", F.lit(""))).otherwise(F.col("line"))
    text = F.array_sort(F.collect_list(F.when(content.isNotNull(), F.struct("pos", content.alias("line")))))
    whole = lambda *more: [F.max("best").alias("best"), F.bool_or("ar").alias("ar"), F.bool_or("en").alias("en"), *more]
    of_group = lambda c: F.max(F.when(F.col("a").isNull(), F.col(c))).alias(c)
    articles_ = tag.withColumn("best", F.col("candidate")).groupBy("doc_id", "p", "c", "a").agg(
        *whole(),
        F.max(F.when(F.col("kind") == "A", F.col("number"))).alias("article_number"),
        F.max(F.when(group, F.col("number"))).alias("number"),
        F.max(F.when(group, F.col("title"))).alias("title"),
        F.array_join(F.transform(text, lambda x: x["line"]), "\n").alias("text"),
    )
    # An article has a text, a heading a title: one of both is split by script.
    articles_ = T.with_scripts(articles_.withColumn("t", F.coalesce("title", "text")), "t", "text_en", "text_ar")
    article = F.struct("article_number", "text_en", "text_ar", F.col("a").cast("int").alias("order_index"))
    by = lambda key, c: F.sort_array(F.collect_list(F.when(F.col(key).isNotNull(), F.struct(F.col(key).alias("k"), c.alias("v")))))
    plain = lambda c: F.transform(c, lambda x: x["v"])
    title = [of_group("number"), F.max(F.when(F.col("a").isNull(), F.col("text_en"))).alias("title_en"), F.max(F.when(F.col("a").isNull(), F.col("text_ar"))).alias("title_ar")]
    chapters_ = articles_.groupBy("doc_id", "p", "c").agg(*whole(), *title, plain(by("a", article)).alias("articles"))
    chapter = F.struct("title_en", "title_ar", F.col("number").alias("chapter_number"), "articles")
    own = lambda c, key: F.max(F.when(F.col(key).isNull(), F.col(c))).alias(c)
    parts_ = chapters_.groupBy("doc_id", "p").agg(*whole(), own("number", "c"), own("title_en", "c"), own("title_ar", "c"), own("articles", "c"), plain(by("c", chapter)).alias("chapters"))
    parts_ = parts_.withColumn("articles", F.coalesce("articles", F.array().cast("array<struct<article_number:string,text_en:string,text_ar:string,order_index:int>>")))
    part = F.struct("title_en", "title_ar", F.col("number").alias("part_number"), "articles", "chapters")
    docs = parts_.groupBy("doc_id").agg(*whole(), own("articles", "p"), own("chapters", "p"), plain(by("p", part)).alias("parts"))
    out = _titled(docs, "doc_id", "articles", "chapters", "parts")
    empty = lambda c, of: F.coalesce(F.col(c), F.transform(F.filter("parts", lambda x: F.lit(False)), lambda x: x[of][0])).alias(c)
    return out.select("doc_id", F.struct("title_en", "title_ar", F.lit("law").alias("document_type"), empty("articles", "articles"), empty("chapters", "chapters"), "parts").alias("document"))


def article_counts(lines: DataFrame) -> DataFrame:
    """(doc_id, n_articles) of lines, 0 for documents without any."""
    found = headings.with_headings(lines.select("doc_id", clean_line("line").alias("line")))
    return found.groupBy("doc_id").agg(F.count(F.when(F.col("kind") == "A", 1)).alias("n_articles"))


def choose_text(candidates: DataFrame) -> DataFrame:
    """(doc_id, source, text) of candidates (doc_id, priority, source, text): the longest, with 200 for each kind of
    marker; ties go to the first priority. A document without any text gets the source "" and the text "none"."""
    low = T.fold_case("text")
    score = F.length("text")
    for marker in MARKERS:
        score = score + F.when(low.contains(marker), 200).otherwise(0)
    scored = candidates.withColumn("score", F.when(F.coalesce("text", F.lit("")) != "", score))
    best = scored.groupBy("doc_id").agg(F.max(F.when(F.col("score").isNotNull(), F.struct("score", (-F.col("priority")).alias("p"), "source", "text"))).alias("b"))
    return best.select("doc_id", F.coalesce("b.source", F.lit("")).alias("source"), F.coalesce("b.text", F.lit("none")).alias("text"))


def with_articles(lines: DataFrame) -> DataFrame:
    """(doc_id, has_article) of the documents that have an article."""
    found = headings.with_headings(source_lines(lines)).where("kind = 'A'")
    return found.select("doc_id").distinct().withColumn("has_article", F.lit(True))


def with_fallback(primary: DataFrame, recognised: DataFrame) -> DataFrame:
    """(doc_id, source, text) after the fallback: documents whose text has no article take the recognised one, ``none`` if there is none.

    ``recognised`` need only have those documents."""
    both = primary.join(with_articles(split_lines(primary)), "doc_id", "left").join(recognised.select("doc_id", F.col("text").alias("again")), "doc_id", "left")
    good, found = F.coalesce("has_article", F.lit(False)), F.coalesce(F.col("again") != "", F.lit(False))
    source = F.when(good, F.col("source")).when(found, "paddleocr").otherwise("")
    return both.select("doc_id", source.alias("source"), F.when(good, F.col("text")).when(found, F.col("again")).otherwise("none").alias("text"))


def parse_documents(docs: DataFrame) -> DataFrame:
    """Flat tables' common input from documents (doc_id, text): NFKC where a text can change, split, tagged."""
    return tagged(split_lines(T.with_nfkc(docs, "text")))
