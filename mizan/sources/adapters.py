"""Adapters to the engines themselves, each of which needs a library that is checked before a job starts.

Every class names its libraries in ``NEEDS``; ready() checks them on the driver."""

from __future__ import annotations

import io
from collections.abc import Iterable

from .engines import PAGE_DPI, require

#: Steps of both generations in their order, with the numbers that the results depend on.
#: scale: least and most pixels of the long side; contrast: clip limit and tiles a side; background: side of the
#: opening whose residue is added; denoise: strength; binarise: side of the blur before the threshold; close: side.
PAGE_STEPS = [("scale", 2400, None), ("gray",), ("contrast", 2.0, 8), ("background", 25), ("denoise", 15), ("binarise", 3), ("close", 2), ("deskew",)]
LEGAL_STEPS = [("scale", 1400, 1600), ("gray",), ("contrast", 2.0, 8), ("denoise", 15), ("binarise", 3), ("colour",)]
#: Angles of lines that count, and of a page that is turned, in degrees.
LINE_ANGLE, LEAST_TURN, MOST_TURN = 45.0, 0.3, 10.0
#: How words and whole pages are read.
WORD_CONFIG, DETECT_CONFIG = "--psm 6 --oem 1 -c preserve_interword_spaces=1", "--psm 3"


def ready(*adapters: type) -> None:
    """Fails on the driver where a library of an adapter is missing."""
    for adapter in adapters:
        for module, hint in adapter.NEEDS.items():
            require(module, hint)


def target_size(width: int, height: int, least: int, most: int | None = None) -> tuple[int, int]:
    """The size to which a page is scaled so that its long side lies between ``least`` and ``most``; fractions of a pixel are cut."""
    side = max(width, height)
    goal = least if side < least else most if most and side > most else side
    return (width, height) if goal == side else (int(width * (goal / side)), int(height * (goal / side)))


def turn(angles: Iterable[float]) -> float | None:
    """The angle by which a page is turned back: the median of its lines' angles, where it is worth it."""
    flat = sorted(a for a in angles if abs(a) < LINE_ANGLE)
    if not flat:
        return None
    half = len(flat) // 2
    median = flat[half] if len(flat) % 2 else (flat[half - 1] + flat[half]) / 2
    return median if LEAST_TURN <= abs(median) <= MOST_TURN else None


class Steps:
    """Image steps by plan: each names a method of ``pixels``, whatever library that is, and its numbers."""

    NEEDS = {"cv2": "pip install opencv-python-headless"}

    def __init__(self, plan: list[tuple] = PAGE_STEPS, pixels=None):
        self.plan, self.pixels = plan, pixels or OpenCv()

    def improved(self, image: bytes) -> bytes:
        x = self.pixels.decoded(image)
        for step, *numbers in self.plan:
            x = getattr(self, f"_{step}", getattr(self.pixels, step, None))(x, *numbers)
        return self.pixels.encoded(x)

    def _scale(self, x, least: int, most: int | None):
        size = self.pixels.size(x)
        goal = target_size(*size, least, most)
        return x if goal == size else self.pixels.resized(x, goal)

    def _deskew(self, x):
        angle = turn(self.pixels.angles(x))
        return x if angle is None else self.pixels.turned(x, angle)


class OpenCv:
    """Pixels by OpenCV."""

    def __init__(self):
        import cv2
        import numpy

        self.cv, self.np = cv2, numpy

    def decoded(self, image: bytes):
        return self.cv.imdecode(self.np.frombuffer(image, self.np.uint8), self.cv.IMREAD_COLOR)

    def encoded(self, x) -> bytes:
        return self.cv.imencode(".png", x)[1].tobytes()

    def size(self, x) -> tuple[int, int]:
        return x.shape[1], x.shape[0]

    def resized(self, x, size: tuple[int, int]):
        smaller = size[0] < x.shape[1]
        return self.cv.resize(x, size, interpolation=self.cv.INTER_AREA if smaller else self.cv.INTER_CUBIC)

    def gray(self, x):
        return self.cv.cvtColor(x, self.cv.COLOR_BGR2GRAY)

    def colour(self, x):
        return self.cv.cvtColor(x, self.cv.COLOR_GRAY2BGR)

    def contrast(self, x, clip: float, tiles: int):
        return self.cv.createCLAHE(clipLimit=clip, tileGridSize=(tiles, tiles)).apply(x)

    def _square(self, side: int):
        return self.cv.getStructuringElement(self.cv.MORPH_RECT, (side, side))

    def background(self, x, side: int):
        return self.cv.add(x, self.cv.morphologyEx(x, self.cv.MORPH_TOPHAT, self._square(side)))

    def denoise(self, x, strength: int):
        return self.cv.fastNlMeansDenoising(x, h=strength)

    def binarise(self, x, side: int):
        smooth = self.cv.GaussianBlur(x, (side, side), 0)
        return self.cv.threshold(smooth, 0, 255, self.cv.THRESH_BINARY + self.cv.THRESH_OTSU)[1]

    def close(self, x, side: int):
        return self.cv.morphologyEx(x, self.cv.MORPH_CLOSE, self._square(side))

    def angles(self, x) -> list[float]:
        found = self.cv.HoughLinesP(self.cv.Canny(x, 50, 150, apertureSize=3), 1, self.np.pi / 180, threshold=100, minLineLength=100, maxLineGap=10)
        if found is None:
            return []
        ends = found.reshape(-1, 4).astype(float)
        ends = ends[ends[:, 0] != ends[:, 2]]
        return self.np.degrees(self.np.arctan2(ends[:, 3] - ends[:, 1], ends[:, 2] - ends[:, 0])).tolist()

    def turned(self, x, angle: float):
        w, h = self.size(x)
        matrix = self.cv.getRotationMatrix2D((w // 2, h // 2), angle, 1.0)
        return self.cv.warpAffine(x, matrix, (w, h), flags=self.cv.INTER_CUBIC, borderMode=self.cv.BORDER_REPLICATE)


class FilePages:
    """Pages of PDF files, one at a time, and the first frame of image files, as PNG."""

    NEEDS = {"pdf2image": "pip install pdf2image, and install poppler", "PIL": "pip install pillow"}

    def __init__(self, dpi: int = PAGE_DPI):
        self.dpi = dpi

    def pages(self, path: str, content: bytes):
        if path.lower().endswith(".pdf"):
            import pdf2image

            for n in range(1, int(pdf2image.pdfinfo_from_bytes(content)["Pages"]) + 1):
                for image in pdf2image.convert_from_bytes(content, dpi=self.dpi, first_page=n, last_page=n):
                    yield n, png(image)
            return
        from PIL import Image

        with Image.open(io.BytesIO(content)) as image:
            image.seek(0)
            yield 1, png(image.convert("RGB"))


def png(image) -> bytes:
    out = io.BytesIO()
    image.save(out, "PNG")
    return out.getvalue()


class TesseractLanguage:
    """The language of a page by a first reading in both languages."""

    NEEDS = {"pytesseract": "pip install pytesseract", "langdetect": "pip install langdetect", "PIL": "pip install pillow"}

    def language(self, image: bytes) -> str | None:
        import langdetect
        import pytesseract
        from PIL import Image

        text = pytesseract.image_to_string(Image.open(io.BytesIO(image)), lang="eng+ara", config=DETECT_CONFIG).strip()
        return langdetect.detect(text) if text else None


class TesseractPage:
    """Full text and words of a page."""

    NEEDS = {"pytesseract": "pip install pytesseract", "PIL": "pip install pillow"}
    #: Names of the engine's columns for those of a word.
    COLUMNS = {"text": "text", "confidence": "conf", "x": "left", "y": "top", "width": "width", "height": "height", "block_num": "block_num", "par_num": "par_num", "line_num": "line_num", "word_num": "word_num"}

    def read(self, image: bytes, language: str):
        import pytesseract
        from PIL import Image

        page = Image.open(io.BytesIO(image))
        how = {"lang": language, "config": WORD_CONFIG}
        table = pytesseract.image_to_data(page, output_type=pytesseract.Output.DICT, **how)
        columns = [table[c] for c in self.COLUMNS.values()]
        return pytesseract.image_to_string(page, **how), [dict(zip(self.COLUMNS, row)) for row in zip(*columns)]


class PaddleLines:
    """Lines of a page; an engine for each language, made when it is first asked for."""

    NEEDS = {"paddleocr": "pip install paddleocr", "cv2": "pip install opencv-python-headless"}
    #: How the engine is set up.
    SETTINGS = {"use_doc_orientation_classify": False, "use_doc_unwarping": False, "use_textline_orientation": False, "text_det_limit_side_len": 960, "text_recognition_batch_size": 1, "textline_orientation_batch_size": 1}

    def __init__(self):
        self.by_language: dict = {}

    def predictions(self, image: bytes, language: str):
        import paddleocr

        if language not in self.by_language:
            self.by_language[language] = paddleocr.PaddleOCR(lang=language, **self.SETTINGS)
        return list(self.by_language[language].predict(OpenCv().decoded(image)))


class PypdfText:
    """Embedded text of PDF files."""

    NEEDS = {"pypdf": "pip install pypdf"}

    def text(self, path: str, content: bytes) -> str | None:
        import pypdf

        if not path.lower().endswith(".pdf"):
            return None
        texts = [(page.extract_text() or "").strip() for page in pypdf.PdfReader(io.BytesIO(content)).pages]
        return "\n".join(t for t in texts if t) or None


class DoclingText:
    """Text of PDF files as a layout engine exports it; ``mode`` chooses the languages, ``tesseract`` names the program."""

    NEEDS = {"docling": "pip install docling"}

    def __init__(self, mode: str = "auto", tesseract: str = "tesseract"):
        self.languages, self.tesseract = {"eng": ["eng"], "ara": ["ara"]}.get(mode, ["eng", "ara"]), tesseract

    def text(self, path: str, content: bytes) -> str | None:
        from docling.datamodel.base_models import DocumentStream, InputFormat
        from docling.datamodel.pipeline_options import PdfPipelineOptions, TesseractCliOcrOptions
        from docling.document_converter import DocumentConverter, PdfFormatOption

        if not path.lower().endswith(".pdf"):
            return None
        reader = TesseractCliOcrOptions(lang=self.languages, tesseract_cmd=self.tesseract, psm=6)
        options = PdfFormatOption(pipeline_options=PdfPipelineOptions(do_ocr=True, do_table_structure=False, ocr_options=reader))
        converter = DocumentConverter(allowed_formats=[InputFormat.PDF], format_options={InputFormat.PDF: options})
        found = converter.convert(DocumentStream(name=path.rsplit("/", 1)[-1], stream=io.BytesIO(content)))
        return found.document.export_to_markdown() or None
