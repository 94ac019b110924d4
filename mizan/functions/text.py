"""Normalisation, scripts, digits and number words as columns."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"
DIGITS = "0123456789"
#: White space as Unicode has it, with the four separators that Java's class lacks.
SPACES = r"(?U)[\s\x1c-\x1f]+"
#: A text of these characters alone is the same in NFKC: ASCII, Latin letters, punctuation and Arabic without
#: what composes or has a compatibility form.
STABLE = r"^[\x00-\x7F¡-§©«-®°±¶·»¿-ıĴ-ľŁ-ňŊ-ž؀-ْ٠-ٴٹ-ڿ‌-‐–—‘-‟]*$"

#: Stems of the Arabic ordinals one to ten, masculine and feminine, after folding the alef.
UNITS = [
    ("الاول", "الاولى"),
    ("الثاني", "الثانية"),
    ("الثالث", "الثالثة"),
    ("الرابع", "الرابعة"),
    ("الخامس", "الخامسة"),
    ("السادس", "السادسة"),
    ("السابع", "السابعة"),
    ("الثامن", "الثامنة"),
    ("التاسع", "التاسعة"),
    ("العاشر", "العاشرة"),
]
#: The unit of eleven, which differs from one; the words for ten in the teens.
ELEVEN, TEN = ("الحادي", "الحادية"), ("عشر", "عشرة")
#: Tens, nominative and genitive, with two spellings of thirty that recognition produces.
TENS = {20: ["العشرون", "العشرين"], 30: ["الثلاثون", "الثلاثين", "الثلائون", "الثلائين"], 40: ["الاربعون", "الاربعين"], 50: ["الخمسون", "الخمسين"], 60: ["الستون", "الستين"]}


def number_words() -> dict[str, int]:
    """Words of one or two tokens and their numbers: units, teens made from them, and tens."""
    out = {w: n for n, pair in enumerate(UNITS, 1) for w in pair}
    for n, pair in enumerate([ELEVEN, *UNITS[1:9]], 11):
        out |= {f"{unit} {ten}": n for unit, ten in zip(pair, TEN)}
    return out | {w: n for n, forms in TENS.items() for w in forms}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None else unicodedata.normalize("NFKC", x))


def with_nfkc(df: DataFrame, column: str, branch: bool = True) -> DataFrame:
    """df with the column in NFKC; only texts that can change go through Python.

    They do on a branch of their own, so that what is above it stays free of Python; or, where df is dear to
    compute twice, on the one branch, all other texts as nulls."""
    stable = F.coalesce(F.col(column).rlike(STABLE), F.lit(True))
    if branch:
        return df.where(stable).unionByName(df.where(~stable).withColumn(column, nfkc(F.col(column))))
    return df.withColumn(column, F.coalesce(nfkc(F.when(~stable, F.col(column))), F.col(column)))


def normalize(c: Column | str) -> Column:
    """Direction marks and runs of white space to one space, trimmed; null to empty. NFKC is with_nfkc()'s."""
    marks = F.translate(F.coalesce(_col(c), F.lit("")), "‏‎", "  ")
    return F.trim(F.regexp_replace(marks, SPACES, " "))


def normalize_lines(c: Column | str) -> Column:
    """normalize() for each line; empty lines go."""
    lines = F.split(F.translate(F.coalesce(_col(c), F.lit("")), "\r", "\n"), "\n")
    return F.array_join(F.filter(F.transform(lines, normalize), lambda x: x != ""), "\n")


def ascii_digits(c: Column | str) -> Column:
    """Arabic-Indic digits to ASCII; Persian ones stay."""
    return F.translate(_col(c), ARABIC_DIGITS, DIGITS)


def fold_alef(c: Column | str) -> Column:
    return F.translate(normalize(c), "إأآ", "ااا")


def has_arabic(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit("")).rlike(r"[؀-ۿ]")


def has_latin(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit("")).rlike("[A-Za-z]")


def fold_case(c: Column | str) -> Column:
    """Lower case, with the one expansion that texts of our languages need."""
    return F.replace(F.lower(_col(c)), F.lit("ß"), F.lit("ss"))


def _number_map() -> Column:
    return F.create_map(*[F.lit(x) for item in number_words().items() for x in item])


def parse_number(c: Column | str) -> Column:
    """The number of an Arabic number phrase: a known word, or two known ones around ``and``; else null."""
    return _parse_folded(fold_alef(c))


def _parse_folded(text: Column) -> Column:
    known = _number_map()
    parts = F.filter(F.transform(F.split(text, " و"), F.trim), lambda x: x != "")
    # A missing word is null, and so is the sum.
    both = F.aggregate(F.transform(parts, lambda x: F.element_at(known, x)), F.lit(0), lambda a, x: a + x)
    return F.coalesce(F.element_at(known, text), F.when(F.size(parts) == 2, both))


def begins_number(c: Column | str) -> Column:
    """Whether the first word of a normalised text can begin a number phrase: spares other texts the search for one."""
    first = sorted({w.split(" ")[0] for w in number_words()})
    return F.translate(F.substring_index(_col(c), " ", 1), "إأآ", "ااا").isin(*first)


def leading_number(c: Column | str) -> Column:
    """struct(number, rest) of the longest number phrase in the first four words; null if there is none."""

    def attempt(words: Column, k: Column) -> Column:
        number = _parse_folded(F.translate(F.array_join(F.slice(words, F.lit(1), k), " "), "إأآ", "ااا"))
        return F.struct(number.cast("string").alias("number"), F.array_join(F.slice(words, k + 1, F.size(words)), " ").alias("rest"))

    # One lambda for the words and one for the lengths, so each is evaluated once and the code stays small.
    tries = F.transform(F.array(F.split(normalize(c), " ")), lambda words: F.filter(F.transform(F.sequence(F.lit(4), F.lit(1), F.lit(-1)), lambda k: attempt(words, k)), lambda x: x["number"].isNotNull()))
    return F.get(F.get(tries, F.lit(0)), F.lit(0))


def project_script(text: Column, arabic: bool) -> Column:
    """Of a normalised text, the words with the script and those with neither after the first; null if there are none."""
    own, other = (has_arabic, has_latin) if arabic else (has_latin, has_arabic)

    def chosen(words: Column) -> Column:
        first = F.array_position(F.transform(words, own), True)
        # Words before the first with the script are cut off once; of the rest, only the other script's go.
        rest = F.slice(words, F.greatest(first, F.lit(1)).cast("int"), F.size(words))
        return F.when(first > 0, F.array_join(F.filter(rest, lambda t: own(t) | ~other(t)), " "))

    return _let(F.split(text, " "), chosen)


def _let(value: Column, f) -> Column:
    """f(value) with the value evaluated once, however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def split_scripts(c: Column | str) -> Column:
    """struct(en, ar) of a text: one script takes the whole text, lines kept; two are told apart by word."""

    def split(text: Column) -> Column:
        ar, en = has_arabic(text), has_latin(text)
        none, one_line = F.lit(None).cast("string"), F.replace(text, F.lit("\n"), F.lit(" "))
        pair = lambda e, a: F.struct(e.alias("en"), a.alias("ar"))
        return F.when(text == "", pair(none, none)).when(~ar, pair(text, none)).when(~en, pair(none, text)).otherwise(pair(project_script(one_line, False), project_script(one_line, True)))

    return _let(normalize_lines(c), split)


def with_scripts(df: DataFrame, column: str, en: str, ar: str) -> DataFrame:
    """df with the sides of a column's text in columns of their own."""
    return df.withColumn("_sides", split_scripts(column)).withColumns({en: F.col("_sides.en"), ar: F.col("_sides.ar")}).drop("_sides")


#: The Arabic letters that can number an item of a list.
LIST_LETTERS = "اأإآبتثجحخدذرزسشصضطظعغفقكلمنهويى"


def is_list_item(c: Column | str) -> Column:
    """A number or letter with a mark, or an Arabic letter with or without one, and then white space."""
    return normalize(c).rlike(r"(?U)^(?:\p{Nd}+[.)]|[A-Za-z][.)]|[" + LIST_LETTERS + r"][.)]?)\s+")


def is_noise(c: Column | str) -> Column:
    """Empty, of two characters at most, without both scripts, or with few letters."""
    return _let(normalize(c), is_noise_line)


def is_noise_line(text: Column) -> Column:
    """is_noise() of a normalised text."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    solid = F.length(F.replace(text, F.lit(" "), F.lit("")))
    return (F.length(text) <= 2) | ~(has_latin(text) | has_arabic(text)) | (letters / F.nullif(solid, F.lit(0)) < 0.35)


def strip(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def drop_control(c: Column | str) -> Column:
    """Without control and format characters but line ends, tabs and spaces."""
    return F.regexp_replace(_col(c), r"[\p{C}&&[^\n\t ]]", "")


def collapse(c: Column | str) -> Column:
    """Runs of spaces and tabs to one space, three and more line ends to two, stripped."""
    return strip(F.regexp_replace(F.regexp_replace(_col(c), r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def contains_any(c: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])
