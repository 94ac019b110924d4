"""Documents as JSON: UTF-8, other scripts as they are, nulls kept; as lines, or a file a document."""

from __future__ import annotations

import json
import uuid

import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What names of output files end in, and their indentation.
OCR_SUFFIX, LEGAL_SUFFIX, INDENT = "_ocr_output.json", "_structured.json", 2


def to_json(column: Column | str, pretty: bool = False) -> Column:
    return F.to_json(column, {"ignoreNullFields": "false", "pretty": str(pretty).lower()})


def output_name(path: Column | str, suffix: str) -> Column:
    """The file name's stem and the suffix."""
    return F.concat(F.regexp_replace(F.regexp_extract(path, "([^/]*)$", 1), r"\.[^.]+$", ""), F.lit(suffix))


def write(documents: DataFrame, column: str, path: str) -> None:
    """One JSON text a line, in as many files as there are partitions."""
    documents.select(to_json(column).alias("value")).write.mode("overwrite").text(path)


def write_files(documents: DataFrame, column: str, folder: str, suffix: str) -> DataFrame:
    """A file for each document (doc_id, its path, and ``column``) in a folder that executors can write to; returns (doc_id, name, bytes).

    Names are default names; where several documents would have the same one, a hash of the path tells them apart.
    A file gets its name when it is whole, so a task that runs again, or twice, does no harm."""
    stem, same = output_name("doc_id", ""), Window.partitionBy(F.lower(output_name("doc_id", "")))
    rows = documents.select("doc_id", stem.alias("stem"), to_json(column).alias("json")).withColumn("n", F.count("*").over(same))
    rows = rows.select("doc_id", "json", F.concat("stem", F.when(F.col("n") > 1, F.concat(F.lit("-"), F.hex(F.xxhash64("doc_id")))).otherwise(""), F.lit(suffix)).alias("name"))

    def put(batches):
        files, root = pa.fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        for batch in batches:
            sizes = []
            for name, text in zip(batch.column("name").to_pylist(), batch.column("json").to_pylist()):
                data = json.dumps(json.loads(text), ensure_ascii=False, indent=INDENT).encode()
                new = f"{root}/_{uuid.uuid4().hex}"
                with files.open_output_stream(new) as out:
                    out.write(data)
                files.move(new, f"{root}/{name}")
                sizes.append(len(data))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "name": batch.column("name"), "bytes": pa.array(sizes, pa.int64())})

    return rows.mapInArrow(put, "doc_id string, name string, bytes bigint")


def write_images(images: DataFrame, folder: str) -> int:
    """A PNG for each page (path, page_number, image), for debugging; returns how many. Names have the file's, so pages of several files stay apart."""
    stem = F.concat(F.regexp_extract("path", "([^/]*)$", 1), F.lit("-"), F.hex(F.xxhash64("path")))
    rows = images.select(F.concat(F.lit("preprocessed_"), stem, F.lit("_page_"), F.col("page_number"), F.lit(".png")).alias("name"), "image")

    def put(batches):
        files, root = pa.fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        for batch in batches:
            for name, image in zip(batch.column("name").to_pylist(), batch.column("image").to_pylist()):
                with files.open_output_stream(f"{root}/{name}") as out:
                    out.write(image)
            yield pa.record_batch({"n": pa.array([batch.num_rows], pa.int64())})

    return rows.mapInArrow(put, "n bigint").agg(F.sum("n")).first()[0] or 0
