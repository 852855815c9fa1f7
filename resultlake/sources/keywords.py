"""Keyword lists (SC1-SC3, PR8, AG4)."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from resultlake.functions import strip_text
from resultlake.functions.text import LINE_BREAK
from resultlake.operators.ranking import exploded
from resultlake.sinks.files import first_bytes


def keyword_lines(text: Column) -> Column:
    """Non-blank, stripped lines of a text, in order, as an array."""
    lines = F.transform(F.split(text, LINE_BREAK, -1), strip_text)
    return F.filter(lines, lambda line: line != "")


def resolve_path(path: str, base_dir: str | None = None) -> str:
    """A relative path belongs to the job's folder."""
    if base_dir is None or os.path.isabs(path) or "://" in path:
        return path
    return os.path.join(base_dir, path)


def read_keywords(spark: SparkSession, path: str, base_dir: str | None = None) -> DataFrame:
    """Keyword file to ``(kw_pos, keyword)`` with dense positions from 1.

    The file (or folder of ordered part files) is read in splits. A line is placed by
    its split and its place within the split; positions become dense by adding up the
    splits' line counts, so no task sees more than one split.
    """
    path = resolve_path(path, base_dir)
    try:
        file = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no keyword file: {path}") from error
        raise
    place = F.monotonically_increasing_id()
    split = F.struct("_metadata.file_path", "_metadata.file_block_start")
    raw = file.select("value", split.alias("block"), place.alias("line"))
    if first_bytes(spark, path, 3) == b"\xef\xbb\xbf":
        # The line reader drops a byte order mark; a plain UTF-8 reading keeps it.
        at_start = (F.col("block.file_block_start") == 0) & (F.col("line") == 0)
        marked = F.concat(F.lit("\ufeff"), F.col("value"))
        raw = raw.withColumn("value", F.when(at_start, marked).otherwise(F.col("value")))
    pieces = raw.select("block", "line", keyword_lines(F.col("value")).alias("pieces"))
    lines = exploded(pieces, "block", "line", array="pieces", name="keyword")

    totals = lines.groupBy("block").count()
    before = F.sum("count").over(
        Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per split of the file: small by construction.
    starts = totals.select("block", F.coalesce(before, F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("block").orderBy("line", "position"))
    keywords = lines.withColumn("within", within).join(starts, "block").select(
        (F.col("start") + F.col("within")).alias("kw_pos"), "keyword"
    )
    if keywords.isEmpty():
        raise ValueError(f"no keywords in {path}")
    return keywords
