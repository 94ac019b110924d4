"""Input files as rows: metadata, supported kinds, language modes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Image files that are read besides PDF.
IMAGES = ["png", "jpg", "jpeg", "tiff", "tif", "bmp", "webp"]
OCR_ENGINE, LAYOUT_ENGINE = "PaddleOCR", "Docling"


def extension(path: Column | str) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def described(files: DataFrame) -> DataFrame:
    """files (path, ...) with file_name, file_type (null: not supported), supported, the engines' names and
    total_pages: 1 for images, null for PDF until it is rendered."""
    kind = F.when(extension("path") == "pdf", "pdf").when(extension("path").isin(IMAGES), "image")
    return files.withColumns(
        {
            "file_name": F.regexp_extract("path", "([^/]*)$", 1),
            "file_type": kind,
            "supported": kind.isNotNull(),
            "ocr_engine": F.lit(OCR_ENGINE),
            "layout_engine": F.lit(LAYOUT_ENGINE),
            "total_pages": F.when(kind == "image", 1),
        }
    )


def scan(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    """Files under path: (path, file_size_bytes, file_name, ...); contents are read only if asked for."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = files.select("path", F.col("length").alias("file_size_bytes"), *(["content"] if content else []))
    return described(files)


def supported(files: DataFrame, strict: bool = False) -> DataFrame:
    """Files of a supported kind; with ``strict``, one of another kind fails the job."""
    if not strict:
        return files.where("supported")
    ok = F.when(F.col("supported"), True).otherwise(F.raise_error(F.concat(F.lit("unsupported file type: "), F.col("path"))).cast("boolean"))
    return files.where(ok)


def engine_language(lang: Column | str) -> Column:
    """The engine's language for a detected one: Arabic, English, else both."""
    c = F.col(lang) if isinstance(lang, str) else lang
    return F.when(c == "ar", "ara").when(c.isin("en", "en-US", "en-GB"), "eng").otherwise("ara+eng")
