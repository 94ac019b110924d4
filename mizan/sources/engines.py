"""Text engines as adapters: rendering, image steps, language detection and recognition run where an engine is installed.

An adapter is made once for each Python worker, which serves many tasks, and sees one item at a time, so a worker
holds one page.  All that follows recognition is DataFrame operations.  What an adapter makes is dear: callers stage it.
"""

from __future__ import annotations

import hashlib
import importlib.util
import time
from collections.abc import Callable, Iterable, Iterator
from typing import Protocol

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import recognised

#: Render resolution of both generations.
PAGE_DPI, LEGAL_DPI = 400, 200
MODES = ("auto", "eng", "ara")
#: Languages that the page generation can be held to.
PAGE_LANGUAGES = ("ara", "eng", "ara+eng")
_WORD = "text string, confidence int, x int, y int, width int, height int, block_num int, par_num int, line_num int, word_num int"
PAGE_SCHEMA = f"path string, page_number int, language_used string, full_text string, words array<struct<{_WORD.replace(' ', ':').replace(',:', ',')}>>, seconds double"
PREDICTION_SCHEMA = "path string, page_number int, engine_seq int, polygons array<array<struct<x:double,y:double>>>, texts array<string>, scores array<double>, seconds double"


class Renderer(Protocol):
    def pages(self, path: str, content: bytes) -> Iterable[tuple[int, bytes]]:
        """(number from 1, image) of each page; pages that come out empty are left out."""


class ImageSteps(Protocol):
    def improved(self, image: bytes) -> bytes:
        """An image that is easier to read."""


class LanguageDetector(Protocol):
    def language(self, image: bytes) -> str | None:
        """The code of the language of what is written on an image; None if nothing is or it cannot be told."""


class PageEngine(Protocol):
    def read(self, image: bytes, language: str) -> tuple[str, Iterable[dict]]:
        """The engine's own full text, and its words with text, confidence, box and the numbers of block, paragraph, line and word."""


class LineEngine(Protocol):
    def predictions(self, image: bytes, language: str) -> Iterable:
        """What an engine predicts of an image, in one of the shapes that prediction() knows."""


class TextEngine(Protocol):
    def text(self, path: str, content: bytes) -> str | None:
        """A file's embedded text; None if there is none or it cannot be read."""


def require(module: str, hint: str) -> None:
    """Fails on the driver, before a job starts, where a library is missing."""
    if importlib.util.find_spec(module) is None:
        raise RuntimeError(f"{module} is not installed; {hint}")


#: Adapters of this worker, by what makes them.
_LIVE: dict[str, object] = {}


def _shared(make: Callable[[], object]) -> Callable[[], object]:
    """A function that makes an adapter the first time a worker calls it, and gives the same one afterwards."""
    key = hashlib.sha1(cloudpickle.dumps(make)).hexdigest()

    def get() -> object:
        if key not in _LIVE:
            _LIVE[key] = make()
        return _LIVE[key]

    return get


def _mapped(items: DataFrame, make: Callable[[], object], rows_of: Callable[[object, dict], Iterator[tuple]], schema: str, names: list[str]) -> DataFrame:
    get = _shared(make)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = get()
        for batch in batches:
            for item in batch.to_dict("records"):
                for row in rows_of(engine, item):
                    yield pd.DataFrame([row], columns=names)

    return items.mapInPandas(run, schema)


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def render(files: DataFrame, make: Callable[[], Renderer]) -> DataFrame:
    """(path, page_number, image, seconds) of files (path, content)."""
    schema = "path string, page_number int, image binary, seconds double"

    def rows(e, f):
        began = time.monotonic()
        for n, image in e.pages(f["path"], f["content"]):
            if image:
                yield f["path"], n, image, time.monotonic() - began
            began = time.monotonic()

    return _mapped(files.select("path", "content"), make, rows, schema, _names(schema))


def improve(pages: DataFrame, make: Callable[[], ImageSteps]) -> DataFrame:
    """pages (path, page_number, image, seconds) after an adapter's image steps."""
    schema = "path string, page_number int, image binary, seconds double"

    def rows(e, p):
        began = time.monotonic()
        image = e.improved(p["image"])
        yield p["path"], p["page_number"], image, p["seconds"] + time.monotonic() - began

    return _mapped(pages.select("path", "page_number", "image", "seconds"), make, rows, schema, _names(schema))


def detect(pages: DataFrame, make: Callable[[], LanguageDetector]) -> DataFrame:
    """pages with ``detected``, the code of a page's language; null where the adapter finds none or fails."""
    schema = "path string, page_number int, image binary, seconds double, detected string"

    def rows(e, p):
        began = time.monotonic()
        try:
            found = e.language(p["image"])
        except Exception:  # a page that cannot be told is read in all languages
            found = None
        yield p["path"], p["page_number"], p["image"], p["seconds"] + time.monotonic() - began, found or None

    return _mapped(pages.select("path", "page_number", "image", "seconds"), make, rows, schema, _names(schema))


def read_pages(pages: DataFrame, make: Callable[[], PageEngine]) -> DataFrame:
    """PAGE_SCHEMA rows of pages (path, page_number, image, language, seconds): one call of the engine a page."""
    fields = [f.split()[0] for f in _WORD.split(", ")]

    def rows(e, p):
        began = time.monotonic()
        text, words = e.read(p["image"], p["language"])
        words = [{k: str(w[k]) if k == "text" else int(float(w[k])) for k in fields} for w in words]
        yield p["path"], p["page_number"], p["language"], (text or "").strip(), words, p["seconds"] + time.monotonic() - began

    return _mapped(pages.select("path", "page_number", "image", "language", "seconds"), make, rows, PAGE_SCHEMA, ["path", "page_number", "language_used", "full_text", "words", "seconds"])


def words_of(pages: DataFrame) -> DataFrame:
    """One row a word of read_pages()'s rows, with its number on the page (idx)."""
    return pages.select("path", "page_number", F.posexplode("words").alias("idx", "w")).select("path", "page_number", "idx", "w.*")


def languages(mode: str) -> list[str]:
    """The engines of a mode, in the order in which they run on a page."""
    if mode not in MODES:
        raise ValueError(f"language mode must be one of {', '.join(MODES)}")
    return {"auto": ["en", "ar"], "eng": ["en"], "ara": ["ar"]}[mode]


def prediction(found) -> tuple[list, list, list]:
    """(polygons, texts, scores) of a prediction: a list of entries (polygon, (text, score)) or (polygon, text, score), maybe
    within a list; or a mapping or object with rec_polys (or dt_polys), rec_texts and rec_scores, which may differ in length.

    Entries of another form are left out."""
    if found is None:
        return [], [], []
    if not isinstance(found, list):

        def part(*names: str) -> list:
            for name in names:
                try:
                    value = found[name]
                except (KeyError, TypeError, IndexError, AttributeError):
                    value = getattr(found, name, None)
                if value is not None and len(value):
                    return list(value)
            return []

        return part("rec_polys", "dt_polys"), part("rec_texts"), part("rec_scores")
    entries = found[0] if len(found) == 1 and isinstance(found[0], list) else found
    good = []
    for entry in entries:
        if entry and len(entry) == 2 and isinstance(entry[1], (list, tuple)) and len(entry[1]) >= 2:
            good.append((entry[0], *entry[1][:2]))
        elif entry and len(entry) == 3:
            good.append(tuple(entry))
    return [g[0] for g in good], [g[1] for g in good], [g[2] for g in good]


def points(polygon) -> list[dict] | None:
    """A polygon's points as numbers; None for what is no polygon."""
    try:
        out = [{"x": float(p[0]), "y": float(p[1])} for p in polygon]
    except (TypeError, ValueError, IndexError, KeyError):
        return None
    return out or None


def recognise_lines(pages: DataFrame, make: Callable[[], LineEngine], mode: str = "auto") -> DataFrame:
    """PREDICTION_SCHEMA rows: what each engine of the mode predicts of each page (path, page_number, image, seconds), one call and one row each."""
    order = languages(mode)

    def rows(e, p):
        for seq, language in enumerate(order):
            began = time.monotonic()
            polygons, texts, scores = [], [], []
            for found in e.predictions(p["image"], language):
                # Each prediction's three lists are cut to the shortest before they are put together.
                for x, t, s in zip(*prediction(found)):
                    polygons.append(points(x))
                    texts.append(str(t))
                    scores.append(float(s or 0.0))
            yield p["path"], p["page_number"], seq, polygons, texts, scores, time.monotonic() - began + (p["seconds"] if seq == 0 else 0.0)

    return _mapped(pages.select("path", "page_number", "image", "seconds"), make, rows, PREDICTION_SCHEMA, _names(PREDICTION_SCHEMA.replace("array<array<struct<x:double,y:double>>>", "a")))


def lines_of(predictions: DataFrame) -> DataFrame:
    """(path, engine_seq, idx, page_number, text, confidence, x, y, width, height) of recognise_lines()'s rows: texts normalised;
    lines without text, or with a polygon that is none or whose numbers are no whole ones, are left out."""
    entries = recognised.zip_predictions(F.col("polygons"), F.col("texts"), F.col("scores"))
    each = predictions.select("path", "engine_seq", "page_number", F.posexplode(entries).alias("idx", "e"))
    each = T.with_nfkc(each.withColumn("text", F.col("e.text")), "text", branch=False).withColumn("text", T.normalize("text"))
    each = each.withColumn("box", F.when(F.col("e.polygon").isNotNull(), recognised.box_of(F.col("e.polygon"))))
    each = each.where((F.col("text") != "") & F.col("box.width").isNotNull() & F.col("box.height").isNotNull())
    return each.select("path", "engine_seq", "idx", "page_number", "text", F.col("e.score").alias("confidence"), "box.*")


def embedded_texts(files: DataFrame, make: Callable[[], TextEngine], source: str, priority: int) -> DataFrame:
    """(path, priority, source, text, seconds) of files (path, content): a candidate each; errors of the engine give null."""
    schema = "path string, priority int, source string, text string, seconds double"

    def rows(e, f):
        began = time.monotonic()
        try:
            text = e.text(f["path"], f["content"])
        except Exception:  # a file that one engine cannot read is left to the next
            text = None
        yield f["path"], priority, source, text or None, time.monotonic() - began

    return _mapped(files.select("path", "content"), make, rows, schema, _names(schema))
