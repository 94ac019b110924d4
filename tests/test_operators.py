"""State machines, layout, recognised lines: vectors derived by hand, and properties."""

import json
import random

from pyspark.sql import functions as F

from mizan.operators import legal, pages, recognised


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def tagged(spark, *texts):
    return legal.tagged(legal.split_lines(docs(spark, *texts)))


def test_parents_and_resets(spark):
    tag = tagged(spark, "Part 1\nArticle 1: a\nFinal Provisions\nArticle 2: b\nChapter 9\nArticle 3: c\nmore")
    arts = legal.articles(tag).orderBy("order_index").collect()
    assert [(a.order_index, a.article_number, a.part_seq, a.chapter_seq, a.text) for a in arts] == [(1, "1", 1, None, "a"), (2, "2", None, 1, "b"), (3, "3", None, 2, "c\nmore")]
    chapters = legal.chapters(tag).orderBy("chapter_seq").collect()
    assert [(c.chapter_number, c.part_seq) for c in chapters] == [(None, None), ("9", None)]


def test_loose_lines_are_dropped(spark):
    tag = tagged(spark, "intro\nChapter 1\nloose\nArticle 1\nbody")
    assert legal.articles(tag).first().text == "body"
    assert [r.line for r in legal.dropped_lines(tag).collect()] == ["loose"]
    assert [r.line for r in legal.preamble(tag).collect()] == ["intro"]


def test_every_line_is_somewhere(spark):
    rng = random.Random(5)
    kinds = ["Part 1", "Chapter 2", "Article 3", "Final Provisions", "text here", "more text", ""]
    tag = tagged(spark, *["\n".join(rng.choice(kinds) for _ in range(rng.randint(0, 25))) for _ in range(60)])
    n = tag.count()
    heads = tag.where("kind is not null").count()
    in_articles = tag.where("kind is null and last_kind = 'A'").count()
    assert heads + in_articles + legal.preamble(tag).count() + legal.dropped_lines(tag).count() == n


def test_source_lines(spark):
    rows = legal.source_lines(legal.split_lines(docs(spark, "####### x\r## y\n<!-- IMAGE -->\n \n<!-- image --> z"))).orderBy("pos").collect()
    assert [r.line for r in rows] == ["# x", "y", "<!-- image --> z"]


def test_titles(spark):
    texts = ["Commercial Law\nArticle 1: a", "12\n!!", "١٢\n٣", None, "x"]
    lines = legal.split_lines(docs(spark, *texts))
    got = {r.doc_id: (r.title_en, r.title_ar) for r in legal.titles(legal.states(lines)).collect()}
    assert got == {0: ("Commercial Law", None), 1: (legal.UNTITLED_EN, None), 2: (None, legal.UNTITLED_AR), 3: (legal.UNTITLED_EN, None), 4: (legal.UNTITLED_EN, None)}


def test_title_score(spark):
    df = spark.createDataFrame([("Commercial Law",), ("12",), ("commercial law:",)], "line string")
    assert [r[0] for r in df.select(legal.title_score(F.col("line"), F.lit(False))).collect()] == [35, -100, 8 + 3 + 20 - 5]


def test_choice_of_text(spark):
    rows = [(0, 0, "pypdf", "abc"), (0, 1, "docling", "abc"), (1, 0, "pypdf", "x" * 100), (1, 1, "docling", "article"), (2, 0, "pypdf", None), (2, 1, "docling", "")]
    got = {r.doc_id: (r.source, r.text) for r in legal.choose_text(spark.createDataFrame(rows, "doc_id int, priority int, source string, text string")).collect()}
    assert got == {0: ("pypdf", "abc"), 1: ("docling", "article"), 2: ("", "none")}


def test_nested_document(spark):
    text = "Law of things\nPart 1: One\nChapter 1: Two\nArticle 1: a\nArticle 2\nb\nPart 2\nFinal Provisions"
    doc = json.loads(legal.documents(legal.split_lines(docs(spark, text))).select(F.to_json("document", {"ignoreNullFields": "false"})).first()[0])
    assert doc["document_type"] == "law" and doc["articles"] == []
    assert [p["part_number"] for p in doc["parts"]] == ["1", "2"]
    assert [a["article_number"] for a in doc["parts"][0]["chapters"][0]["articles"]] == ["1", "2"]
    assert doc["parts"][1]["chapters"] == [] and doc["chapters"][0]["chapter_number"] is None
    assert doc["title_en"] == "Law of things"


def page_lines(spark, *page_texts):
    rows = [(0, n, k, line) for n, text in enumerate(page_texts, 1) for k, line in enumerate(text.split("\n"))]
    return spark.createDataFrame(rows, "doc_id int, page_number int, pos int, line string")


def test_virtual_parents(spark):
    tag = pages.tagged(page_lines(spark, "loose\nArticle 1\nx", "y\nSection 2\ngone\nArticle 3\nChapter 4\nArticle 5\nz"))
    assert [(c.chapter_seq, c.chapter_number) for c in pages.chapters(tag).orderBy("chapter_seq").collect()] == [(0, "0"), (1, "4")]
    assert [(s.chapter_seq, s.section_seq, s.section_number) for s in pages.sections(tag).orderBy("chapter_seq", "section_seq").collect()] == [(0, 0, "0"), (0, 1, "2"), (1, 0, "0")]
    assert [(c.article_seq, c.clause) for c in pages.clauses(tag).orderBy("page_number", "pos").collect()] == [(1, "x"), (1, "y"), (3, "z")]


def test_pages_without_structure(spark):
    rows = [(0, 1, "a"), (0, 2, ""), (0, 3, "b"), (1, 1, "Article 1\nx"), (2, 1, "")]
    got = {r.doc_id: r.structure for r in pages.structures(spark.createDataFrame(rows, "doc_id int, page_number int, cleaned_text string")).collect()}
    assert got[0][0].sections[0].articles[0].title == "Full Text" and got[0][0].sections[0].articles[0].clauses == ["a", "b"]
    assert got[1][0].title == "Virtual Chapter" and got[1][0].sections[0].articles[0].clauses == ["x"]
    assert got[2][0].sections[0].articles[0].clauses == []


def test_words_to_blocks(spark):
    cols = "doc_id int, page_number int, idx int, block_num int, par_num int, line_num int, text string, confidence int, x int, y int, width int, height int"
    rows = [(0, 1, 1, 1, 1, 1, "b", 91, 20, 5, 10, 10), (0, 1, 0, 1, 1, 1, " a ", 90, 5, 6, 10, 10), (0, 1, 2, 1, 1, 2, "c", 0, 5, 20, 10, 10), (0, 1, 3, 1, 2, 1, "d", -1, 0, 0, 1, 1), (0, 1, 4, 1, 2, 1, "e", 50, 0, 40, 1, 1), (0, 1, 5, 2, 1, 1, " ", 50, 0, 0, 1, 1)]
    words = pages.keep_words(spark.createDataFrame(rows, cols))
    line = pages.lines(words).where("line_num = 1 and par_num = 1").first()
    assert (line.text, line.average_confidence, line.x, line.y, line.width, line.height) == ("a b", 90.5, 5, 5, 25, 11)
    blocks = pages.blocks(pages.paragraphs(pages.lines(words))).collect()
    assert [b.text for b in blocks] == ["a b c\ne"]


def test_summary_uses_rounded_pages(spark):
    rows = [(0, 1, 0, 0, False, False, 0.0), (0, 2, 1, 3, True, False, 90.0)]
    stats = spark.createDataFrame(rows, "doc_id int, page_number int, word_count int, character_count int, contains_arabic boolean, contains_english boolean, page_confidence double")
    s = pages.summary(stats).first()
    assert (s.average_confidence, s.detected_languages, s.total_words) == (45.0, "Arabic", 1)


def test_recognised_lines(spark):
    rows = [(0, 0, k, 1, "Same", 0, y) for k, y in enumerate((6, 18, 30))] + [(0, 1, 0, 1, "SAME", 1, 18), (0, 0, 3, 1, "  ", 0, 90)]
    lines = spark.createDataFrame(rows, "doc_id int, engine_seq int, idx int, page_number int, text string, x int, y int")
    once = recognised.deduplicate(lines)
    assert sorted((r.y, r.idx) for r in once.where("trim(text) <> ''").collect()) == [(6, 0), (18, 1)]
    assert recognised.deduplicate(once).count() == once.count()
    assert recognised.to_text(once).first().text == "Same\nSame"


def test_geometry(spark):
    df = spark.sql("select array(struct(1.9 as x, 5.0 as y), struct(-3.7 as x, 9.2 as y)) p")
    assert tuple(df.select(recognised.box_of("p")).first()[0]) == (-3, 5, 4, 4)
    z = spark.sql("select array(1,2,3) p, array('a','b') t, array(0.5D,0.6D,0.7D) s").select(recognised.zip_predictions(F.col("p"), F.col("t"), F.col("s"))).first()[0]
    assert [tuple(x) for x in z] == [(1, "a", 0.5), (2, "b", 0.6)]
    # As long as the shortest: nothing where one is empty or null.
    for p, t in (("array()", "array('a')"), ("cast(null as array<int>)", "array('a')"), ("array(1)", "cast(null as array<string>)"), ("array(1)", "cast(array() as array<string>)")):
        row = spark.sql(f"select cast({p} as array<int>) p, {t} t, array(0.5D) s")
        assert row.select(recognised.zip_predictions(F.col("p"), F.col("t"), F.col("s")).alias("z")).first().z == []
    angles = spark.createDataFrame([(0, 1.0), (0, 2.0), (0, 80.0), (1, 0.1), (2, 20.0)], "doc_id int, angle double")
    assert {r.doc_id: (r.angle, r.applied) for r in recognised.skew_angle(angles).collect()} == {0: (1.5, True), 1: (0.1, False), 2: (20.0, False)}
