"""Vectors of the text functions and heading detectors, derived by hand."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from mizan.functions import headings
from mizan.functions import text as T


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column.alias("x")).first()[0]


@pytest.mark.parametrize("value, out", [("‏a  b\t", "a b"), (None, ""), ("a\x1cb  c", "a b c"), ("  ", "")])
def test_normalize(spark, value, out):
    assert one(spark, value, T.normalize("v")) == out


def test_digits(spark):
    assert one(spark, "٣۴", T.ascii_digits("v")) == "3۴"


@pytest.mark.parametrize("value, out", [("الثانية والعشرون", 22), ("الحادية والعشرون", None), ("الأولى والثانية", 3), ("الخامسة عشرة", 15), ("الثلائون", 30), ("الثالثة:", None), ("", None), ("السابعة والثلاثون والاول", None)])
def test_parse_number(spark, value, out):
    assert one(spark, value, T.parse_number("v")) == out


@pytest.mark.parametrize("value, out", [("الخامسة عشرة نص", ("15", "نص")), ("الثالثة: نص", None), ("السابعة والثلاثون", ("37", "")), ("الثاني عشر a b c d", ("12", "a b c d")), ("", None)])
def test_leading_number(spark, value, out):
    got = one(spark, value, T.leading_number("v"))
    assert (tuple(got) if got else None) == out


@pytest.mark.parametrize(
    "value, en, ar",
    [
        ("Hello مرحبا 123", "Hello 123", "مرحبا 123"),
        ("123 Hello مرحبا", "Hello", "مرحبا"),
        ("123", "123", None),
        ("٣", None, "٣"),
        ("", None, None),
        (None, None, None),
        ("abcمرحبا", "abcمرحبا", "abcمرحبا"),
        ("a\n\n b", "a\nb", None),
        ("Part 3: العقود", "Part 3:", "العقود"),
    ],
)
def test_scripts(spark, value, en, ar):
    row = T.with_scripts(spark.createDataFrame([(value,)], "v string"), "v", "e", "a").first()
    assert (row.e, row.a) == (en, ar)


HEADINGS = [
    ("Final Provisions", ("F", None, "Final Provisions", None)),
    ("Final Provisions:", None),
    ("Part of the agreement", ("P", "of", "Part of: the agreement", None)),
    ("Parties agree", None),
    ("Part", None),
    ("Part-time", None),
    ("الباب ٣: العقود", ("P", "3", "Part 3: العقود", None)),
    ("الباب الأول العقود", ("P", "1", "الباب الأول العقود", None)),
    ("الباب الأول: العقود", None),
    ("Chapter (2) - Membership", ("C", "2", "Chapter 2: Membership", None)),
    ("Chapter II Governance", ("C", "II", "Chapter II: Governance", None)),
    ("Article 12: Text", ("A", "12", None, "Text")),
    ("Article 12", ("A", "12", None, "")),
    ("Article (12):", ("A", "12", None, "")),
    ("Article 12. Text", None),
    ("Article 12 Text", None),
    ("مادة ٥ - نص", ("A", "5", None, "نص")),
    ("المادة السابعة والثلاثون", ("A", "37", None, "")),
    ("body", None),
]


def test_headings(spark):
    df = spark.createDataFrame([(k, line) for k, (line, _) in enumerate(HEADINGS)], "k int, line string")
    rows = headings.with_headings(df).orderBy("k").collect()
    assert [(r.kind, r.number, r.title, r.body) if r.kind else None for r in rows] == [out for _, out in HEADINGS]


@pytest.mark.parametrize("value, out", [("Subsection 4", ("S", "4")), ("particle 7", ("A", "7")), ("article5", ("A", "5")), ("chapter3", None), ("chapter 2 section 3", ("C", "2")), ("القسم ٤", ("S", "٤"))])
def test_page_headings(spark, value, out):
    got = one(spark, value, headings.page_event(F.col("v")))
    assert (tuple(got) if got else None) == out


def test_noise_and_lists(spark):
    for value, noise in (("12", True), ("", True), ("abc", False), ("a1234567", True), ("!!! ???", True)):
        assert one(spark, value, T.is_noise("v")) is noise, value
    for value, item in (("1. x", True), ("a) x", True), ("ب نص", True), ("ab) x", False), ("1.x", False), (None, False)):
        assert one(spark, value, T.is_list_item("v")) is item, value


def test_cleaning(spark):
    assert one(spark, "a‌b\t\tc\n\n\n\nd", T.collapse(T.drop_control("v"))) == "ab c\n\nd"


def test_nfkc_only_where_needed(spark):
    rows = [(k, v) for k, v in enumerate(["plain", "ﬁ", "ﻻ", None, "é", "é", "Ａ", "العقود", "½", "…"])]
    for branch in (True, False):
        got = {r.k: r.v for r in T.with_nfkc(spark.createDataFrame(rows, "k int, v string"), "v", branch).collect()}
        assert got == {k: v if v is None else unicodedata.normalize("NFKC", v) for k, v in rows}


def test_stable_characters_are_stable():
    import re

    pattern = re.compile(T.STABLE)
    for code in range(0x3000):
        c = chr(code)
        if unicodedata.category(c) != "Cs" and pattern.match(c):
            assert unicodedata.normalize("NFKC", c) == c, hex(code)
            assert unicodedata.normalize("NFKC", "a" + c) == "a" + c, hex(code)
