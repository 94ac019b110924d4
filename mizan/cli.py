"""Command line: ``python -m mizan.cli legal INPUT`` and ``pages INPUT`` for a file or a folder.

Text files (.txt, .md) are parsed as they are, form feeds between pages; PDF and image files go through the engines, which must be installed.
Each document becomes a JSON file with its default name in the output folder, or in the working folder."""

from __future__ import annotations

import argparse
import functools
import logging
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .operators import legal, pages
from .plans import pipelines
from .sources import adapters, engines, files, json_sink

TEXT_FILES = (".txt", ".md")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="mizan", description="Structure legal documents.")
    programs = p.add_subparsers(dest="program", required=True)
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("input", help="a file, or a folder of them")
    shared.add_argument("-o", "--output", help="folder for the JSON files, or the name of one file that ends in .json")
    shared.add_argument("--lines", action="store_true", help="one JSON text a line instead of a file a document")
    shared.add_argument("--print-text", action="store_true", help="print the texts of documents")
    one = programs.add_parser("legal", parents=[shared], help="parts, chapters and articles, in two languages")
    one.add_argument("-l", "--lang", choices=engines.MODES, default="auto", help="languages of recognition")
    one.add_argument("--no-docling", action="store_true", help="leave out the layout engine")
    two = programs.add_parser("pages", parents=[shared], help="words, blocks and pages; chapters, sections, articles and clauses")
    two.add_argument("-l", "--lang", choices=engines.PAGE_LANGUAGES, help="language of recognition; told by each page if it is left out")
    two.add_argument("--save-preprocessed", action="store_true", help="keep the images that are recognised")
    return p


def texts(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, text) of text files."""
    return spark.read.format("text").option("wholetext", "true").load(path).select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("text"))


def text_documents(spark: SparkSession, program: str, path: str) -> DataFrame:
    """(doc_id, document) of text files."""
    docs = texts(spark, path)
    if program == "legal":
        return legal.documents(legal.split_lines(T.with_nfkc(docs, "text")))
    each = docs.select("doc_id", F.posexplode(F.split("text", "\f")).alias("page_number", "text")).withColumn("page_number", F.col("page_number") + 1)
    return pages.structures(pages.clean_pages(each)).withColumnRenamed("structure", "document")


def engine_documents(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """(doc_id, document) of PDF and image files, by the engines; RuntimeError where one is not installed."""
    if args.program == "legal":
        own = {} if args.no_docling else {"docling": functools.partial(adapters.DoclingText, args.lang)}
        adapters.ready(adapters.FilePages, adapters.PaddleLines, adapters.PypdfText, *([] if args.no_docling else [adapters.DoclingText]))
        render, steps = functools.partial(adapters.FilePages, engines.LEGAL_DPI), functools.partial(adapters.Steps, adapters.LEGAL_STEPS)
        return pipelines.legal_documents(spark, args.input, {"pypdf": adapters.PypdfText} | own, render, adapters.PaddleLines, args.lang, steps)
    adapters.ready(adapters.FilePages, adapters.Steps, adapters.TesseractPage, *([] if args.lang else [adapters.TesseractLanguage]))
    found = files.supported(files.scan(spark, args.input, content=True), strict=True)
    images = pipelines.page_images(found, adapters.FilePages, adapters.Steps)
    if args.save_preprocessed:
        json_sink.write_images(images, uri(args.output or "."))
    return pipelines.page_documents(spark, args.input, adapters.FilePages, adapters.TesseractPage, detector=adapters.TesseractLanguage, language=args.lang, images=images)


def uri(path: str) -> str:
    return path if "://" in path else "file://" + os.path.abspath(path)


def is_text(path: str) -> bool:
    """Whether a file, or all files of a folder, are text files."""
    names = [n for _, _, found in os.walk(path) for n in found] if os.path.isdir(path) else [path]
    return bool(names) and all(n.lower().endswith(TEXT_FILES) for n in names)


def saved(docs: DataFrame, args: argparse.Namespace) -> int:
    """Writes the documents as the arguments say; returns their number."""
    if args.lines:
        json_sink.write(docs, "document", uri(args.output or "documents"))
        return docs.count()
    suffix = json_sink.LEGAL_SUFFIX if args.program == "legal" else json_sink.OCR_SUFFIX
    if args.output and args.output.endswith(".json"):
        rows = docs.select(F.to_json(F.struct("document"), {"ignoreNullFields": "false"}).alias("j")).take(2)
        if len(rows) != 1:
            raise ValueError("one output file is for one document")
        import json

        with open(args.output, "w", encoding="utf-8") as out:
            json.dump(json.loads(rows[0].j)["document"], out, ensure_ascii=False, indent=json_sink.INDENT)
        return 1
    return json_sink.write_files(docs, "document", uri(args.output or "."), suffix).count()


def print_texts(spark: SparkSession, docs: DataFrame, args: argparse.Namespace, plain: bool) -> None:
    """All texts, however long; documents come to the driver one after the other."""
    if plain:
        for row in texts(spark, args.input).toLocalIterator():
            print(f"--- {row.doc_id} ---\n{row.text}")
    elif args.program == "pages":
        each = docs.select("doc_id", F.explode("document.pages").alias("p")).select("doc_id", "p.page_number", "p.cleaned_text").orderBy("doc_id", "page_number")
        for row in each.toLocalIterator():
            print(f"--- {row.doc_id}, page {row.page_number} ---\n{row.cleaned_text}")


def print_summary(docs: DataFrame, plain: bool, n: int) -> None:
    print(f"Documents: {n}")
    if plain or "summary" not in docs.schema["document"].dataType.names:
        return
    s = docs.select("document.summary.*")
    total = s.agg(F.sum("total_pages"), F.sum("total_words"), F.sum("total_characters"), F.bround(F.avg("average_confidence"), 1), F.array_sort(F.array_distinct(F.flatten(F.collect_set("detected_languages"))))).first()
    for name, value in zip(("Pages", "Words", "Characters", "Average confidence", "Languages"), total):
        print(f"{name}: {', '.join(value) if isinstance(value, list) else value}")


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("mizan").getOrCreate()
    try:
        if "://" not in args.input and not os.path.exists(args.input):
            raise FileNotFoundError(f"there is no input {args.input}")
        plain = is_text(args.input)
        docs = text_documents(spark, args.program, args.input) if plain else engine_documents(spark, args)
        n = saved(docs, args)
        if args.print_text:
            print_texts(spark, docs, args, plain)
        print_summary(docs, plain, n)
    except Exception:
        logging.exception("the input could not be parsed")
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
