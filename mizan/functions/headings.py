"""Heading detectors of both generations, over normalised lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import ascii_digits, begins_number, leading_number, normalize

#: Nouns of the headings.
PART, CHAPTER, ARTICLE = r"Part\b|الجزء|الباب", r"Chapter\b|الفصل", r"Article\b|المادة|مادة"
_PART_AR, _CHAPTER_AR, _ARTICLE_AR = ["الباب", "الجزء"], ["الفصل"], ["المادة", "مادة"]
#: Titles of closing chapters, whole lines.
FINAL = r"(?iU)^(?:(?:final|general|concluding)\s+provisions?|الأحكام\s+الختامية|احكام\s+ختامية)$"
#: What numbers of headings are made of.
_TOKEN, _NUMBER = "[A-Za-z0-9٠-٩]+", "[0-9٠-٩]+"
#: A line that begins otherwise is no heading: spares most lines the detectors.
_BEGINS = r"^(?:[PpCcAaFfGg]|[؀-ۿ])"
_NOUN = rf"(?iU)^({PART}|{CHAPTER}|{ARTICLE})"
#: Between the number and the rest of a heading that _numbered() has rewritten; no normalised line has it.
_CUT = "\n"


def _numbered(nouns: str, token: str, tail: str) -> str:
    return rf"(?iU)^(?:{nouns})\s*[(\[]?\s*({token})\s*[)\]]?\s*{tail}$"


#: Parts and chapters; articles with a body after a mark; articles alone.
_GROUP, _BODY, _ALONE = _numbered(f"{PART}|{CHAPTER}", _TOKEN, r"[:.\-–—]?\s*(.*)"), _numbered(ARTICLE, _NUMBER, r"[:\-–—]\s*(.*)"), _numbered(ARTICLE, _NUMBER, ":?()")


def titled(keyword: str, number: Column, rest: Column) -> Column:
    """``keyword number: rest``, or without rest."""
    head = F.concat(F.lit(f"{keyword} "), ascii_digits(number))
    return F.when(rest == "", head).otherwise(F.concat(head, F.lit(": "), rest))


def with_headings(lines: DataFrame) -> DataFrame:
    """lines with kind, number, title and body of the heading that ``line`` (normalised) is; null for other lines.

    F (closing chapter) goes before P (part), C (chapter) and A (article); an article's body may be empty.
    Each step is a projection of its own, so nothing is evaluated twice, and the noun decides which detector
    a line meets at all; a detector's one match gives number and rest."""
    line, columns = F.col("line"), lines.columns
    found = lines.withColumn("_begins", line.rlike(_BEGINS)).select(
        *columns,
        F.when(F.col("_begins"), line.rlike(FINAL)).otherwise(F.lit(False)).alias("_final"),
        F.when(F.col("_begins"), F.regexp_extract("line", _NOUN, 1)).otherwise("").alias("_noun"),
    )
    noun = F.col("_noun")
    of = F.when(noun.rlike(f"(?iU)^(?:{PART})$"), "P").when(noun.rlike(f"(?iU)^(?:{CHAPTER})$"), "C").otherwise("A")
    found = found.withColumn("_of", F.when(~F.col("_final") & (noun != ""), of))
    cut = lambda pattern: F.split(F.regexp_replace("line", pattern, f"$1{_CUT}$2"), _CUT)
    matched = lambda c: F.when(F.size(c) == 2, F.col(c))
    # The tail of _ALONE is empty, that of _BODY begins with a mark: no line matches both.
    found = found.withColumn("_cut", F.when(F.col("_of") == "A", cut(_BODY)).when(F.col("_of").isNotNull(), cut(_GROUP))).withColumn("_cut", matched("_cut"))
    found = found.withColumn("_alone", F.when((F.col("_of") == "A") & F.col("_cut").isNull(), cut(_ALONE))).withColumn("_alone", matched("_alone"))
    found = found.withColumn("_cut", F.coalesce("_cut", "_alone"))
    after = F.length("_noun")
    words = F.when(F.col("_of").isNotNull() & F.col("_cut").isNull() & F.col("_noun").isin(*_PART_AR, *_CHAPTER_AR, *_ARTICLE_AR) & (line.substr(after + 1, F.lit(1)) == " "), F.substr(line, after + 2))
    found = found.withColumn("_words", words)
    found = found.withColumn("_s", F.when(begins_number("_words"), leading_number("_words")))
    found = found.withColumn("kind", F.when(F.col("_final"), "F").when(F.col("_cut").isNotNull() | F.col("_s").isNotNull(), F.col("_of")))
    is_ = lambda *k: F.col("kind").isin(*k)
    number, rest = F.get("_cut", F.lit(0)), normalize(F.get("_cut", F.lit(1)))
    heading = F.when(is_("P"), titled("Part", number, rest)).otherwise(titled("Chapter", number, rest))
    title = F.when(is_("F"), line).when(is_("P", "C"), F.when(F.col("_cut").isNotNull(), heading).otherwise(line))
    body = F.when(is_("A"), F.when(F.col("_cut").isNotNull(), rest).otherwise(F.col("_s.rest")))
    own = F.when(is_("P", "C", "A"), F.coalesce(ascii_digits(number), F.col("_s.number")))
    return found.select(*columns, "kind", own.alias("number"), title.alias("title"), body.alias("body"))


#: The page generation finds its keywords anywhere in a line.
PAGE_CHAPTER = r"(?iU)(?:chapter|الفصل)\s+(\p{Nd}+)"
PAGE_SECTION = r"(?iU)(?:section|القسم)\s+(\p{Nd}+)"
PAGE_ARTICLE = r"(?iU)(?:article|المادة)\s*[(\-–—]?\s*(\p{Nd}+)"


def page_event(line: Column) -> Column:
    """struct(kind, number): C before S before A, null for other lines; digits keep their script."""
    found = [(k, F.regexp_extract(line, p, 1)) for k, p in (("C", PAGE_CHAPTER), ("S", PAGE_SECTION), ("A", PAGE_ARTICLE))]
    out = None
    for kind, number in found:
        value = F.struct(F.lit(kind).alias("kind"), number.alias("number"))
        out = F.when(number != "", value) if out is None else out.when(number != "", value)
    return out
