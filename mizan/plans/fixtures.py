"""Deterministic inputs made from the driver's tables: one formula each, read by Spark and by DuckDB alike.

The tables hold neither headings nor Arabic, so lines get both by their document and position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_AR_N = "translate(CAST(n AS STRING), '0123456789', '٠١٢٣٤٥٦٧٨٩')"
#: Number phrases, by (doc_id + pos * 3) % 9; two of them are none.
_W = """CASE (doc_id + pos * 3) % 9 WHEN 0 THEN 'الأول' WHEN 1 THEN 'الثانية' WHEN 2 THEN 'الخامسة عشرة' WHEN 3 THEN 'السابعة والثلاثون'
 WHEN 4 THEN 'الحادية والعشرون' WHEN 5 THEN 'العشرون' WHEN 6 THEN 'الثلائون' WHEN 7 THEN 'الثاني عشر' ELSE 'الثالثة:' END"""
_LEGAL = f"""CASE WHEN doc_id % 5 = 0 THEN line ELSE CASE m
 WHEN 0 THEN concat('Chapter (', n, ') - ', line)
 WHEN 1 THEN concat('Part ', n, ': ', line)
 WHEN 2 THEN CASE WHEN doc_id % 5 = 1 THEN line ELSE concat('Article ', n, ': ', line) END
 WHEN 3 THEN CASE WHEN doc_id % 5 = 1 THEN line ELSE concat('Article ', n) END
 WHEN 4 THEN concat('Article ', n, '. ', line)
 WHEN 5 THEN concat('المادة ', w, ' ', line)
 WHEN 6 THEN concat('الفصل ', w, ' ', line)
 WHEN 7 THEN concat('الباب ', {_AR_N}, ': ', line)
 WHEN 8 THEN 'Final Provisions'
 WHEN 9 THEN concat('## Chapter ', n, ' ', line)
 WHEN 10 THEN concat('مادة ٥ - نص ', line)
 WHEN 11 THEN '<!-- image -->'
 WHEN 12 THEN '12'
 ELSE line END END"""
_LEGAL_A = f"""CASE WHEN doc_id % 5 = 0 THEN line ELSE CASE m
 WHEN 0 THEN concat('Chapter (', n, ') - ', line)
 WHEN 1 THEN concat('Section ', n, ' ', line)
 WHEN 2 THEN concat('Article ', n, ': ', line)
 WHEN 3 THEN concat('Article ', n)
 WHEN 4 THEN concat('see article (', n, ') ', line)
 WHEN 5 THEN concat('المادة ', w, ' ', line)
 WHEN 6 THEN concat('الفصل ', n, ' ', line)
 WHEN 7 THEN concat('القسم ', {_AR_N})
 WHEN 8 THEN concat('Subsection ', n)
 WHEN 9 THEN concat('particle ', n, ' ', line)
 WHEN 10 THEN concat('مادة ٥ - نص ', line)
 WHEN 12 THEN 'chapter٣ x'
 ELSE line END END"""
_MIXED = """CASE (doc_id + pos) % 6
 WHEN 0 THEN line
 WHEN 1 THEN 'أحكام عامة للعقود'
 WHEN 2 THEN concat(line, ' أحكام عامة')
 WHEN 3 THEN concat('12 ) ', line, ' أحكام عامة 34')
 WHEN 4 THEN '12345'
 ELSE '١٢٣' END"""
_PADDED = """CASE pos % 4 WHEN 0 THEN concat(chr(8207), mixed, chr(8206)) WHEN 1 THEN concat(chr(160), mixed, chr(160), chr(160)) WHEN 2 THEN concat(chr(9), mixed, '  x') ELSE mixed END"""
_DIRTY = """CASE doc_id % 5
 WHEN 1 THEN concat(split_part(text, chr(10), 1), chr(10), chr(10), chr(10), chr(10), chr(10), text)
 WHEN 2 THEN replace(text, ' ', concat(chr(9), '  '))
 WHEN 3 THEN concat(chr(65279), replace(text, ' ', concat(chr(8204), ' ')), chr(12))
 WHEN 4 THEN concat(text, ' ', chr(65275), ' ', chr(64257))
 ELSE text END"""


def _spark(sql: str) -> str:
    """DuckDB's integer chr for Spark, whose own stops at 255."""
    import re

    return re.sub(r"chr\((\d+)\)", lambda m: f"decode(unhex('{chr(int(m[1])).encode().hex()}'), 'UTF-8')", sql)


def _duck(sql: str) -> str:
    return sql.replace("AS STRING", "AS VARCHAR")


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, pos, line) of the documents' texts."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


LINES = "lines AS (SELECT doc_id, unnest(w) AS line, generate_subscripts(w, 1) - 1 AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS w FROM documents))"


def _with_numbers(df: DataFrame) -> DataFrame:
    return df.selectExpr("doc_id", "pos", "line", "(doc_id + pos) % 17 AS m", "1 + (doc_id * 7 + pos) % 40 AS n", f"{_W} AS w")


_NUMBERS = f"numbered AS (SELECT doc_id, pos, line, (doc_id + pos) % 17 AS m, 1 + (doc_id * 7 + pos) % 40 AS n, {_W} AS w FROM lines)"


def legal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, pos, line) with headings of the legal generation."""
    return _with_numbers(lines(spark, sf_dir)).selectExpr("doc_id", "pos", f"{_LEGAL} AS line")


LEGAL = f"{LINES}, {_NUMBERS}, legal AS (SELECT doc_id, pos, {_duck(_LEGAL)} AS line FROM numbered)"


def legal_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_number, pos, line) with headings of the page generation; ten lines a page."""
    return _with_numbers(lines(spark, sf_dir)).selectExpr("doc_id", "CAST(1 + floor(pos / 10) AS INT) AS page_number", "pos", f"{_LEGAL_A} AS line")


LEGAL_PAGES = f"{LINES}, {_NUMBERS}, legal_pages AS (SELECT doc_id, CAST(1 + floor(pos / 10) AS INT) AS page_number, pos, {_duck(_LEGAL_A)} AS line FROM numbered)"


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, pos, mixed, padded): both scripts in a line, and the same with marks and white space around."""
    df = lines(spark, sf_dir).selectExpr("doc_id", "pos", f"{_MIXED} AS mixed")
    return df.selectExpr("doc_id", "pos", "mixed", f"{_spark(_PADDED)} AS padded")


MIXED = f"{LINES}, mixed0 AS (SELECT doc_id, pos, {_MIXED} AS mixed FROM lines), mixed AS (SELECT doc_id, pos, mixed, {_PADDED} AS padded FROM mixed0)"


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_number, text) with control characters, runs of white space and presentation forms."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return docs.selectExpr("doc_id", "1 AS page_number", f"{_spark(_DIRTY)} AS text")


DIRTY = f"dirty AS (SELECT doc_id, 1 AS page_number, {_DIRTY} AS text FROM documents)"

#: Candidate texts of a document by source.
_CANDIDATES = [
    (0, "pypdf", "CASE WHEN doc_id % 3 <> 0 THEN text END"),
    (1, "docling", "CASE WHEN doc_id % 10 = 1 THEN text WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 5 = 2 THEN concat(substr(text, 1, CAST(floor(length(text) / 2) AS INT)), chr(10), 'Article 1: الباب Chapter Part') ELSE substr(text, 1, CAST(floor(length(text) / 2) AS INT)) END"),
]


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, priority, source, text) of the embedded texts."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    each = [docs.selectExpr("doc_id", f"{p} AS priority", f"'{s}' AS source", f"{_spark(sql)} AS text") for p, s, sql in _CANDIDATES]
    return each[0].unionByName(each[1])


def recognised_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text): the legal lines of every seventh document as one text."""
    own = legal(spark, sf_dir).where("doc_id % 7 = 0")
    ordered = F.array_sort(F.collect_list(F.struct("pos", "line")))
    return own.groupBy("doc_id").agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("text"))


CANDIDATES = "candidates AS (" + " UNION ALL ".join(f"SELECT doc_id, {p} AS priority, '{s}' AS source, {sql} AS text FROM documents" for p, s, sql in _CANDIDATES) + ")"
RECOGNISED_TEXTS = "recognised AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM legal WHERE doc_id % 7 = 0 GROUP BY doc_id)"

_OCR = [
    "CAST(1 + floor(pos / 20) AS INT) AS page_number",
    "CASE WHEN engine_seq = 1 AND pos % 3 = 0 THEN upper(replace(line, 'ß', 'ss')) WHEN engine_seq = 1 AND pos % 3 = 1 THEN concat(line, ' x') WHEN pos % 50 = 7 THEN ' ' ELSE line END AS text",
    "CAST((doc_id * 13) % 50 + engine_seq AS INT) AS x",
    "CAST(CASE WHEN pos % 20 < 3 THEN 6 + 12 * (pos % 20) ELSE (pos % 20) * 20 + engine_seq * 3 END AS INT) AS y",
]


def recognised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, engine_seq, idx, page_number, text, x, y): what two engines find of each line."""
    both = lines(spark, sf_dir).crossJoin(spark.range(2).selectExpr("CAST(id AS INT) AS engine_seq"))  # two rows
    return both.selectExpr("doc_id", "engine_seq", "pos AS idx", *_OCR)


RECOGNISED = f"{LINES}, recognised_lines AS (SELECT doc_id, engine_seq, pos AS idx, {', '.join(_OCR)} FROM lines CROSS JOIN (SELECT unnest([0, 1]) AS engine_seq))"

_WORDS = [
    "CAST(1 + floor(idx / 200) AS INT) AS page_number",
    "CAST(1 + floor((idx % 200) / 100) AS INT) AS block_num",
    "CAST(1 + floor((idx % 100) / 50) AS INT) AS par_num",
    "CAST(1 + floor((idx % 50) / 8) AS INT) AS line_num",
    "CASE WHEN idx % 97 = 0 THEN '  ' ELSE word END AS text",
    "CAST((doc_id * 31 + idx * 17) % 106 - 5 AS INT) AS confidence",
    "CAST((idx % 8) * 60 AS INT) AS x",
    "CAST((1 + floor((idx % 50) / 8)) * 20 AS INT) AS y",
    "CAST(7 * length(word) AS INT) AS width",
    "CAST(14 + idx % 3 AS INT) AS height",
]


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_number, idx, block_num, par_num, line_num, text, confidence, x, y, width, height)."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    each = docs.select("doc_id", F.posexplode(F.split(F.translate("text", "\n", " "), " ")).alias("idx", "word"))
    return each.selectExpr("doc_id", "idx", *_WORDS)


WORDS = f"words0 AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS idx FROM (SELECT doc_id, string_split(replace(text, chr(10), ' '), ' ') AS w FROM documents)), words AS (SELECT doc_id, idx, {', '.join(_WORDS)} FROM words0)"

#: A line as an item of a list, in every way that counts and some that do not.
LIST_LINE = """CASE pos % 7 WHEN 0 THEN concat('12. ', line) WHEN 1 THEN concat('٣) ', line) WHEN 2 THEN concat('a) ', line) WHEN 3 THEN concat('ب ', line) WHEN 4 THEN concat('ج. ', line) WHEN 5 THEN concat('12.', line) ELSE line END"""

#: What follows a heading's noun in b_number_words, by item.
_PHRASES = ["الأول", "الثانية", "الخامسة عشرة", "السابعة والثلاثون", "الحادية والعشرون", "العشرون", "الثلائون", "الثاني عشر", "الثالثة:", "الاولى والثانية", "الستين", "مجهول"]


def number_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, k, phrase): each phrase, followed by the item's first words."""
    items = read(spark, sf_dir, "benchmark", "item_id", "text")
    phrases = F.array(*[F.lit(p) for p in _PHRASES])
    each = items.select("item_id", "text", F.posexplode(phrases).alias("k", "p"))
    return each.selectExpr("item_id", "k", "CASE WHEN (item_id + k) % 3 = 0 THEN p ELSE concat(p, ' ', split_part(text, ' ', 1), '  ', split_part(text, ' ', 2)) END AS phrase")


NUMBER_PHRASES = f"phrases AS (SELECT item_id, k, CASE WHEN (item_id + k) % 3 = 0 THEN p ELSE concat(p, ' ', split_part(text, ' ', 1), '  ', split_part(text, ' ', 2)) END AS phrase FROM (SELECT item_id, text, unnest({_PHRASES!r}) AS p, generate_subscripts({_PHRASES!r}, 1) - 1 AS k FROM benchmark))"


def html_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, pos, line): pages cut at tags, with number signs and image comments."""
    pages = read(spark, sf_dir, "pages", "page_id", "html")
    each = pages.select(F.col("page_id").alias("doc_id"), F.posexplode(F.split("html", "<")).alias("pos", "part"))
    return each.selectExpr("doc_id", "pos", f"{_HTML_LINE} AS line")


_HTML_LINE = "CASE pos % 7 WHEN 1 THEN concat('## ', part) WHEN 2 THEN '<!-- IMAGE  -->' WHEN 3 THEN concat('####### ', part) WHEN 4 THEN concat('  ', part, '  ') ELSE part END"
HTML_LINES = f"html_lines AS (SELECT doc_id, pos, {_HTML_LINE} AS line FROM (SELECT page_id AS doc_id, unnest(w) AS part, generate_subscripts(w, 1) - 1 AS pos FROM (SELECT page_id, string_split(html, '<') AS w FROM pages)))"
