"""Licence scans: an Aho-Corasick automaton finds identifier tags and notice phrases in one
pass over the words of a text; a shunting-yard parser evaluates the and/or/with expressions
that follow tags."""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import ASCII_LOWER, arrow_map, carried, schema_with, table

GAPS = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Further notice phrases, as words, and their labels.
NOTICES = {
    "mit licence": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "gnu general public licence": "gpl",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "apache licence": "apache",
    "apache license version 2 0": "apache-2.0",
    "apache license 2 0": "apache-2.0",
    "bsd license": "bsd",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "mozilla public license version 2 0": "mpl-2.0",
    "eclipse public license": "epl",
    "isc license": "isc",
    "boost software license": "bsl-1.0",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons zero": "cc0",
    "cc0 1 0": "cc0",
    "the unlicense": "unlicense",
    "public domain": "public-domain",
    "all rights reserved": "proprietary",
}
#: Tags that an expression of identifiers follows.
TAGS = ("spdx license identifier", "license identifier")
#: Identifiers in expressions, as words, and their labels.
IDENTIFIERS = {
    "mit": "mit",
    "apache 2 0": "apache-2.0",
    "gpl 2 0": "gpl-2.0",
    "gpl 2 0 only": "gpl-2.0",
    "gpl 2 0 or later": "gpl-2.0",
    "gpl 3 0": "gpl-3.0",
    "gpl 3 0 only": "gpl-3.0",
    "gpl 3 0 or later": "gpl-3.0",
    "lgpl 2 1": "lgpl-2.1",
    "lgpl 2 1 only": "lgpl-2.1",
    "lgpl 2 1 or later": "lgpl-2.1",
    "lgpl 3 0": "lgpl-3.0",
    "agpl 3 0": "agpl-3.0",
    "agpl 3 0 only": "agpl-3.0",
    "agpl 3 0 or later": "agpl-3.0",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "mpl 2 0": "mpl-2.0",
    "epl 2 0": "epl-2.0",
    "isc": "isc",
    "zlib": "zlib",
    "bsl 1 0": "bsl-1.0",
    "cc0 1 0": "cc0",
    "cc by 4 0": "cc-by",
    "cc by sa 4 0": "cc-by-sa",
    "cc by nc 4 0": "cc-by-nc",
    "unlicense": "unlicense",
    "classpath exception 2 0": "classpath-exception-2.0",
    "llvm exception": "llvm-exception",
    "gcc exception 3 1": "gcc-exception-3.1",
}
#: How free a label leaves one, by its first part; what is missing here counts as UNSURE.
FREE = {"mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "zlib": 1.0, "bsl": 1.0, "cc0": 1.0, "unlicense": 1.0, "public": 1.0, "cc-by": 0.9, "mpl": 0.7, "epl": 0.7, "lgpl": 0.6, "cc-by-sa": 0.5, "gpl": 0.4, "agpl": 0.3, "cc-by-nd": 0.3, "cc-by-nc": 0.2, "cc-by-nc-sa": 0.2, "cc-by-nc-nd": 0.1, "proprietary": 0.0}
UNSURE = 0.5
_BINDS = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[()]|[^\s()]+")
#: What an identifier is made of; known ones without capitals, digits and marks.
_IDENTIFIER = re.compile(r"[A-Za-z0-9][A-Za-z0-9.+:-]*")
_NAMES = frozenset(k for k in IDENTIFIERS if k.isalpha())


def words_of(text: str | None) -> str:
    """The words of a text, each between spaces; " " if there is none."""
    words = GAPS.sub(" ", (text or "").translate(ASCII_LOWER)).strip(" ")
    return f" {words} " if words else " "


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """Finds " phrase " for every phrase; the value is (phrase, base label, label, is a tag)."""
    a = ahocorasick.Automaton()
    for p in dict.fromkeys((*BASE, *NOTICES, *TAGS)):
        a.add_word(f" {p} ", (p, BASE.get(p), NOTICES.get(p) or BASE.get(p), p in TAGS))
    a.make_automaton()
    return a


def freedom(label: str) -> float:
    for name in (label, *(label.rsplit("-", k)[0] for k in range(1, label.count("-") + 1))):
        if name in FREE:
            return FREE[name]
    return UNSURE


def operand(token: str) -> str:
    """The label of an identifier: the table's, else the identifier itself, so that what is unknown stays in the expression."""
    return IDENTIFIERS.get(" ".join(re.findall(r"[a-z0-9]+", token.removesuffix("+"))), token)


def postfix(tokens: list[str]) -> list[str] | None:
    """Shunting-yard: operands and operators in postfix order, None if the expression is not well formed."""
    out: list[str] = []
    stack: list[str] = []
    operand = True  # whether one is due
    for t in tokens:
        if t == "(" and operand:
            stack.append(t)
        elif t == ")" and not operand:
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif t in _BINDS and not operand:
            while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= _BINDS[t]:
                out.append(stack.pop())
            stack.append(t)
            operand = True
        elif t not in _BINDS and t not in "()" and operand:
            out.append(t)
            operand = False
        else:
            return None
    if operand or "(" in stack:
        return None
    return out + stack[::-1]


def evaluate(order: list[str]) -> tuple[set[str], float]:
    """Labels of an expression and how free it leaves one: the freer side of ``or``, the stricter of ``and``;
    an exception after ``with`` only loosens a licence."""
    stack: list[tuple[set[str], float]] = []
    for t in order:
        if t in _BINDS:
            (b, y), (a, x) = stack.pop(), stack.pop()
            stack.append((a | b, max(x, y) if t == "or" else min(x, y) if t == "and" else min(1.0, x + 0.2)))
        else:
            label = operand(t)
            stack.append(({label}, freedom(label)))
    return stack[0]


def expression(line: str) -> tuple[set[str], float] | None:
    """The expression with which a line begins: the longest well-formed run of identifiers, operators and brackets.

    An identifier need not be known. A word without capitals and digits after an operator without capitals
    is prose, and ends the expression before that operator."""
    tokens, prose = [], False
    for m in _TOKEN.finditer(line):
        t = m[0] if m[0] in "()" else m[0].rstrip(".,;:*/<>-\"'")
        low = t.translate(ASCII_LOWER)
        if low in _BINDS:
            prose = t == low
        elif t not in "()" and (not _IDENTIFIER.fullmatch(t) or prose and low == t and low.isalpha() and operand(low) == low and low not in _NAMES):
            break
        tokens.append(low)
    for n in range(len(tokens), 0, -1):
        # Where brackets do not match, the expression is read without them.
        for run in (tokens[:n], [t for t in tokens[:n] if t not in "()"]):
            if (order := postfix(run)) is not None:
                return evaluate(order)
    return None


def after_words(text: str, counts: list[int]) -> list[int]:
    """Where in the text the words with these (rising) numbers, from 1, end."""
    out, k = [], 0
    for n, m in enumerate(_WORD.finditer(text.translate(ASCII_LOWER)), 1):
        while k < len(counts) and counts[k] == n:
            out.append(m.end())
            k += 1
        if k == len(counts):
            break
    return out


def expressions(text: str, tags: list[int]) -> list[tuple[set[str], float]]:
    """The expressions of tags, which are given by the number of words up to their ends: what follows a colon or equals sign in the tag's line."""
    found = []
    for at in after_words(text, tags):
        end = text.find("\n", at)
        m = _MARK.match(text, at)
        if m and (x := expression(text[m.end() : end if end >= 0 else len(text)])):
            found.append(x)
    return found


_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MARK = re.compile(r"[ \t]*[:=][ \t]*")


def scan(text: str | None) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, freedom).

    The score is the strength of evidence for a licence: 1 with an evaluated identifier tag, else 0.6
    for one kind of notice and more for each further; 0 without any. ``freedom`` is the strictest found."""
    words = words_of(text)
    n_words = words.count(" ") - 1
    base, labels, n_base, tags = set(), set(), 0, []
    first = last = None
    free: list[float] = []
    at = counted = 0
    for end, (phrase, kind, label, is_tag) in automaton().iter(words):
        if is_tag:
            tags.append(words.count(" ", 0, end))
            continue
        labels.add(label)
        if kind:
            start = end - len(phrase) - 1
            # Starts need not rise with ends: count spaces from the last start, either way.
            counted += words.count(" ", at, start) if start >= at else -words.count(" ", start, at)
            at = start
            n_base += 1
            base.add(kind)
            first = counted if first is None else min(first, counted)
            last = counted if last is None else max(last, counted)
    free = [freedom(x) for x in labels]
    parsed = expressions(text, sorted(set(tags))) if tags else []
    for found, x in parsed:
        labels |= found
        free.append(x)
    score = 1.0 if parsed else 1 - 0.4 ** len(labels) if labels else 0.0
    return n_words, n_base, first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score, min(free) if free else None


_SCHEMA = {"n_words": ("bigint", pa.int64()), "n_base": ("bigint", pa.int64()), "first_word": ("bigint", pa.int64()), "last_word": ("bigint", pa.int64()), "base_labels": ("string", pa.string()), "labels": ("string", pa.string()), "score": ("double", pa.float64()), "freedom": ("double", pa.float64())}


def scanned(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of docs and what scan() finds in each text; a kept column named like a new one is an error."""
    docs = carried(docs, keep, tuple(_SCHEMA), "text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [scan(t) for t in batch.column("text").to_pylist()]
        new = [pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(_SCHEMA.values())]
        return pa.record_batch([batch.column("row"), *new], names=["row", *_SCHEMA])

    out = arrow_map(docs, run, schema_with(docs, ("row",), ", ".join(f"{k} {t}" for k, (t, _) in _SCHEMA.items())))
    return out.select("row.*", *_SCHEMA)


def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, freedom.

    Null and empty texts have no words, no places, empty labels and score 0; repeated rows and rows without
    doc_id stay. Places of different phrases that begin at the same word all count; labels have no order to break ties in but the alphabet's.
    """
    return scanned(table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {"op9_licence_scan": op9_licence_scan}
ORACLES: dict[str, str] = {}
