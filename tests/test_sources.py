"""Files, engines with stand-ins, both programs end to end, the sink, the stream and the command line."""

import json
import os
import tempfile

import pytest

from mizan import cli
from mizan.plans import pipelines
from mizan.sources import adapters, engines, files, json_sink
from mizan.streaming import documents as stream


class Render:
    def pages(self, path, content):
        for n, text in enumerate(content.decode().split("\f"), 1):
            yield n, text.encode()


def counted(what):
    """One line in a file that all workers write to, for each call of an engine."""
    with open(os.path.join(tempfile.gettempdir(), "mizan-test-calls"), "a") as out:
        out.write(f"{what}\n")


def calls():
    path = os.path.join(tempfile.gettempdir(), "mizan-test-calls")
    lines = open(path).read().split() if os.path.exists(path) else []
    open(path, "w").close()
    return lines


class Words:
    def read(self, image, language):
        counted("read")
        words = [{"text": w, "confidence": f"{90 + k % 3}.0", "x": k * 10, "y": 0, "width": 8, "height": 8, "block_num": 1, "par_num": 1 + k // 3, "line_num": 1, "word_num": k} for k, w in enumerate(image.decode().split())]
        return f" {image.decode()}\n", [*words, words[0] | {"text": " ", "word_num": 99}, words[0] | {"confidence": -1}] if words else []


class Language:
    def language(self, image):
        counted("detect")
        if b"broken" in image:
            raise ValueError
        return {b"Ch": "ar", b"no": "en-GB"}.get(image[:2])


class Upper:
    def improved(self, image):
        counted("improve")
        return image.replace(b": c", b": C")


class Lines:
    def predictions(self, image, language):
        counted(language)
        box = lambda k: [(0, k * 20), (50, k * 20), ("50.7", k * 20 + 10), (0, k * 20 + 10)]
        lines = image.decode().split("\n")
        yield [[(box(k), (line, 0.9)) for k, line in enumerate(lines)]]
        yield {"rec_polys": [None, [(0, "x")]], "rec_texts": ["bad", "bad"], "rec_scores": [0.1, 0.1, 0.1]}


class Embedded:
    def text(self, path, content):
        if "broken" in path:
            raise ValueError
        return content.decode() if "text" in path else None


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "text.pdf").write_text("Trade Law\nArticle 1: a\nb")
    (tmp_path / "scan.PNG").write_text("Chapter 1\nArticle 2: c")
    (tmp_path / "broken.pdf").write_text("nothing here")
    (tmp_path / "notes.txt").write_text("not supported")
    return str(tmp_path)


def test_files(spark, folder):
    got = {r.file_name: (r.file_type, r.supported, r.total_pages) for r in files.scan(spark, folder).collect()}
    assert got == {"text.pdf": ("pdf", True, None), "scan.PNG": ("image", True, 1), "broken.pdf": ("pdf", True, None), "notes.txt": (None, False, None)}
    assert files.supported(files.scan(spark, folder)).count() == 3
    with pytest.raises(Exception, match="unsupported file type"):
        files.supported(files.scan(spark, folder), strict=True).collect()


def test_page_documents(spark, folder):
    calls()
    docs = {r.doc_id.rsplit("/", 1)[1]: r.document for r in pipelines.page_documents(spark, folder, Render, Words, Upper, Language).collect()}
    # The dear steps run once a page, however many columns follow from them.
    assert sorted(calls()) == ["detect"] * 3 + ["improve"] * 3 + ["read"] * 3
    doc = docs["scan.PNG"]
    assert len(docs) == 3 and doc.summary.total_words == 5 and doc.legal_structure[0].chapter_number == "1"
    assert doc.metadata.total_pages == 1 and doc.metadata.processing_time_seconds >= 0 and doc.metadata.pipeline_version == "2.0.0"
    page = doc.pages[0]
    assert (page.full_text, page.language_used, page.word_count) == ("Chapter 1\nArticle 2: C", "ara", 5)
    assert [w.text for w in page.words] == ["Chapter", "1", "Article", "2:", "C"] and page.words[1].bounding_box.x == 10
    block = page.blocks[0]
    assert block.text == "Chapter 1 Article\n2: C" and [p.paragraph_num for p in block.paragraphs] == [1, 2]
    line = block.paragraphs[0].lines[0]
    assert (line.line_num, line.text, line.average_confidence, line.bounding_box.width) == (1, "Chapter 1 Article", 91.0, 28) and [w.word_num for w in line.words] == [0, 1, 2]
    assert docs["broken.pdf"].pages[0].language_used == "eng" and docs["text.pdf"].pages[0].language_used == "ara+eng"
    forced = pipelines.page_documents(spark, folder, Render, Words, language="eng").collect()
    assert {p.language_used for r in forced for p in r.document.pages} == {"eng"} and "detect" not in calls()
    with pytest.raises(ValueError):
        pipelines.page_documents(spark, folder, Render, Words, language="fra")


def test_pages_without_words(spark, tmp_path):
    (tmp_path / "empty.png").write_text(" ")
    doc = pipelines.page_documents(spark, str(tmp_path), Render, Words).first().document
    assert doc.pages[0].words == [] and doc.pages[0].blocks == [] and doc.summary.detected_languages == ["Unknown"]


def test_legal_documents(spark, folder):
    calls()
    docs = {r.doc_id.rsplit("/", 1)[1]: r.document for r in pipelines.legal_documents(spark, folder, {"pypdf": Embedded}, Render, Lines).collect()}
    assert docs["text.pdf"].metadata.text_source == "pypdf" and docs["text.pdf"].articles[0].text_en == "a\nb" and docs["text.pdf"].metadata.ocr_line_count == 0
    assert docs["scan.PNG"].metadata.text_source == "paddleocr" and docs["scan.PNG"].chapters[0].articles[0].article_number == "2"
    # Both engines find the same two lines; each page is read once by either.
    assert docs["scan.PNG"].metadata.ocr_line_count == 2 and docs["broken.pdf"].metadata.ocr_line_count == 1
    assert sorted(calls()) == ["ar"] * 2 + ["en"] * 2
    assert docs["scan.PNG"].metadata.total_pages == 1 and docs["broken.pdf"].metadata.total_pages == 1 and docs["text.pdf"].metadata.total_pages is None
    assert docs["broken.pdf"].articles == [] and docs["broken.pdf"].metadata.text_source == "paddleocr"


def test_modes_and_sizes():
    assert engines.languages("auto") == ["en", "ar"]
    with pytest.raises(ValueError):
        engines.languages("fra")
    with pytest.raises(RuntimeError):
        engines.require("no_such_module", "install it")
    assert adapters.target_size(1000, 500, 1400, 1600) == (1400, 700) and adapters.target_size(3200, 100, 1400, 1600) == (1600, 50) and adapters.target_size(1500, 1500, 1400, 1600) == (1500, 1500)
    assert engines.points([("1.9", 2), (5, 7)]) == [{"x": 1.9, "y": 2.0}, {"x": 5.0, "y": 7.0}] and engines.points([1, 2]) is None and engines.points([]) is None
    with pytest.raises(RuntimeError):
        adapters.ready(adapters.PaddleLines)


class Found:
    rec_polys, dt_polys, rec_texts, rec_scores = [], [[(0, 0)]], ["a", "b"], [0.5]


@pytest.mark.parametrize(
    "found, lists",
    [
        (None, ([], [], [])),
        ([], ([], [], [])),
        ([["p", ("t", 0.5)], ["q", "no"], None, ("r", "u", 1)], (["p", "r"], ["t", "u"], [0.5, 1])),
        ([[["p", ("t", 0.5)]]], (["p"], ["t"], [0.5])),
        ({"dt_polys": ["p", "q"], "rec_texts": ["t"], "rec_scores": []}, (["p", "q"], ["t"], [])),
        (Found(), ([[(0, 0)]], ["a", "b"], [0.5])),
    ],
)
def test_prediction_shapes(found, lists):
    assert engines.prediction(found) == lists


class Pixels:
    """Says what is asked of it."""

    def __init__(self, width=1000, height=500, angles=(1.0, 2.0, 80.0)):
        self.log, self.at, self.found = [], (width, height), angles

    def decoded(self, image):
        return image.decode()

    def encoded(self, x):
        return x.encode()

    def size(self, x):
        return self.at

    def angles(self, x):
        return list(self.found)

    def __getattr__(self, name):
        def step(x, *numbers):
            self.log.append((name, *numbers))
            return f"{x} {name}"

        return step


def test_image_steps_in_their_order():
    pixels = Pixels()
    assert adapters.Steps(adapters.PAGE_STEPS, pixels).improved(b"x").decode().split() == ["x", "resized", "gray", "contrast", "background", "denoise", "binarise", "close", "turned"]
    assert pixels.log == [("resized", (2400, 1200)), ("gray",), ("contrast", 2.0, 8), ("background", 25), ("denoise", 15), ("binarise", 3), ("close", 2), ("turned", 1.5)]
    pixels = Pixels(1500, 1500)
    adapters.Steps(adapters.LEGAL_STEPS, pixels).improved(b"x")
    assert [s[0] for s in pixels.log] == ["gray", "contrast", "denoise", "binarise", "colour"]


def test_turns():
    assert adapters.turn([]) is None and adapters.turn([50.0]) is None and adapters.turn([0.2, 0.1]) is None and adapters.turn([20.0]) is None
    assert adapters.turn([1.0, 2.0, 60.0]) == 1.5 and adapters.turn([-0.3]) == -0.3 and adapters.turn([10.0]) == 10.0


def test_one_engine_a_worker():
    make = lambda: object()
    assert engines._shared(make)() is engines._shared(make)()


def test_sink(spark, tmp_path):
    df = spark.sql("select 'a/b.c.pdf' p, struct('é' as x, cast(null as string) as y) d")
    assert df.select(json_sink.output_name("p", json_sink.LEGAL_SUFFIX)).first()[0] == "b.c_structured.json"
    json_sink.write(df, "d", str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).first()[0] == '{"x":"é","y":null}'
    docs = spark.sql("select p doc_id, struct('é' as x, cast(null as string) as y) d from values ('a/b.c.pdf'), ('z/B.c.png'), ('q/d.pdf') t(p)")
    got = json_sink.write_files(docs, "d", f"file://{tmp_path}/files", json_sink.LEGAL_SUFFIX).collect()
    names = sorted(r.name for r in got)
    assert len({n.lower() for n in names}) == 3 and names[-1] == "d_structured.json" and sorted(os.listdir(tmp_path / "files")) == names
    assert (tmp_path / "files" / "d_structured.json").read_text() == '{\n  "x": "é",\n  "y": null\n}'
    pages = spark.sql("select '/a/x.pdf' path, n page_number, cast('png' as binary) image from values (1), (2) t(n)")
    assert json_sink.write_images(pages, f"file://{tmp_path}/images") == 2 and len(os.listdir(tmp_path / "images")) == 2


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("Article 1: x\ny")
    q = stream.parse(stream.texts(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination(120)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r.article_number, r.text_en) for r in rows] == [("1", "x\ny")]


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "a.txt").write_text("Article 1: x\n" + "long " * 3000)
    assert cli.main(["legal", str(tmp_path / "a.txt"), "-o", str(tmp_path / "out"), "--print-text"]) == 0
    assert json.loads((tmp_path / "out" / "a_structured.json").read_text())["articles"][0]["article_number"] == "1"
    said = capsys.readouterr().out
    assert "long " * 3000 in said and "Documents: 1" in said
    (tmp_path / "b.txt").write_text("Article 1\nx\fy")
    assert cli.main(["pages", str(tmp_path / "b.txt"), "-o", str(tmp_path / "one.json")]) == 0
    assert json.loads((tmp_path / "one.json").read_text())[0]["sections"][0]["articles"][0]["clauses"] == ["x", "y"]
    assert cli.main(["pages", str(tmp_path / "b.txt"), "-o", str(tmp_path / "lines"), "--lines"]) == 0
    assert spark.read.text(str(tmp_path / "lines")).count() == 1
    assert cli.main(["legal", str(tmp_path / "missing.txt")]) == 1
    # Without the engines' libraries a file that needs them ends the program before any job.
    (tmp_path / "c.pdf").write_text("x")
    for words in (["legal", "-l", "ara", "--no-docling"], ["pages", "-l", "ara+eng", "--save-preprocessed"]):
        assert cli.main([*words, str(tmp_path / "c.pdf")]) == 1
    with pytest.raises(SystemExit):
        cli.main(["legal", "-l", "fra", "x"])
