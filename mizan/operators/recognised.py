"""Recognised lines: order, removal of duplicates, text, and geometry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions import text as T

#: Pixels of a row in which the same text counts once.
ROW = 12
_ORDER = ("page_number", "y", "x", "engine_seq", "idx")


def deduplicate(lines: DataFrame) -> DataFrame:
    """The first line, in reading order, of those with the same page, row (half to even) and text regardless of case."""
    key = ("doc_id", "page_number", F.bround(F.col("y") / ROW, 0), T.fold_case(T.normalize("text")))
    w = Window.partitionBy(*key).orderBy("y", "x", "engine_seq", "idx")
    return lines.withColumn("nth", F.row_number().over(w)).where("nth = 1").drop("nth")


def to_text(lines: DataFrame) -> DataFrame:
    """(doc_id, text, n_lines): lines with text in reading order."""
    ordered = F.array_sort(F.collect_list(F.struct(*_ORDER, "text")))
    return lines.where(T.normalize("text") != "").groupBy("doc_id").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "\n").alias("text"), F.count("*").alias("n_lines"))


def box_of(polygon: Column | str) -> Column:
    """struct(x, y, width, height) around an array of struct(x, y); coordinates are cut to whole numbers."""
    p = F.col(polygon) if isinstance(polygon, str) else polygon
    xs, ys = F.transform(p, lambda q: q["x"].cast("int")), F.transform(p, lambda q: q["y"].cast("int"))
    return F.struct(F.array_min(xs).alias("x"), F.array_min(ys).alias("y"), (F.array_max(xs) - F.array_min(xs)).alias("width"), (F.array_max(ys) - F.array_min(ys)).alias("height"))


def zip_predictions(polygons: Column, texts: Column, scores: Column) -> Column:
    """array<struct(polygon, text, score)>, as long as the shortest of the three; empty if one is null."""
    # least() skips nulls, so a null array counts as one of no items.
    n = F.least(*(F.coalesce(F.size(F.when(x.isNotNull(), x)), F.lit(0)) for x in (polygons, texts, scores)))
    items = F.transform(F.slice(polygons, F.lit(1), n), lambda p, i: F.struct(p.alias("polygon"), F.get(texts, i).alias("text"), F.get(scores, i).alias("score")))
    return F.coalesce(F.when(n > 0, items), F.array())


def skew_angle(angles: DataFrame) -> DataFrame:
    """(doc_id, angle, applied): the median of a page's line angles below 45 degrees, and whether it is worth a rotation."""
    median = F.percentile("angle", 0.5)
    out = angles.where(F.abs("angle") < 45).groupBy("doc_id").agg(median.alias("angle"))
    return out.withColumn("applied", (F.abs("angle") >= 0.3) & (F.abs("angle") <= 10))
