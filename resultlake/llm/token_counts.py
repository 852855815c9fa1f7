"""Token counts: an exact histogram of encoded lengths (operator 2).

Documents are encoded once, whole; what leaves a task is one row per length met in
it. On the summed histogram, suffix sums answer what any context limit would keep.
The histogram has at most as many rows as there are distinct lengths.

Empty and null texts have length 0. Repeated rows count each. An empty table gives an
empty histogram.
"""

from __future__ import annotations

from collections import Counter
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from resultlake.llm.common import text_batches
from resultlake.llm.tokens import VOCABULARY, encoder
from resultlake.session import stage


def _lengths(batches, vocabulary: str):
    found: Counter = Counter()
    encode = encoder(vocabulary)
    for batch in batches:
        found.update(encode.lengths(batch.column(0)).tolist())
    items = sorted(found.items())
    yield pa.RecordBatch.from_arrays(
        [pa.array([n for n, _ in items], pa.int64()), pa.array([c for _, c in items], pa.int64())],
        names=["n_tokens", "docs"],
    )


def length_histogram(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs (text)`` to ``(n_tokens, docs)``, one row per encoded length."""
    text_batches(docs.sparkSession)
    each = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(
        partial(_lengths, vocabulary=vocabulary), "n_tokens long, docs long"
    )
    return each.groupBy("n_tokens").agg(F.sum("docs").alias("docs"))


# Lengths that share a block of the two-level suffix sums.
BLOCK = 4096


def context_limits(histogram: DataFrame) -> DataFrame:
    """For every length as a context limit: documents and tokens of that length, of it
    or more (suffix sums), tokens kept if longer documents are cut at it, and the
    share of documents that fit whole (their quantile). Sums run inside blocks of
    lengths and over the blocks' totals, so no task holds the whole histogram."""
    h = stage(
        histogram.select("n_tokens", "docs", (F.col("n_tokens") * F.col("docs")).alias("tokens"))
        .withColumn("block", F.floor(F.col("n_tokens") / BLOCK)),
        "lengths",
    )
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    totals = h.groupBy("block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    blocks = totals.select(
        "block",
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tokens_above"),
    )
    whole = h.agg(F.sum("docs").alias("all_docs"), F.sum("tokens").alias("all_tokens")).first()
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    n, all_docs, all_tokens = F.col("n_tokens"), F.lit(whole["all_docs"]), F.lit(whole["all_tokens"])
    summed = h.join(F.broadcast(blocks), "block").select(  # a row per 4,096 lengths
        n,
        "docs",
        "tokens",
        (F.sum("docs").over(inside) + F.col("docs_above")).cast("long").alias("docs_from"),
        (F.sum("tokens").over(inside) + F.col("tokens_above")).cast("long").alias("tokens_from"),
    )
    longer = F.col("docs_from") - F.col("docs")
    return summed.select(
        "*",
        (all_tokens - F.col("tokens_from") + F.col("tokens") + longer * n).cast("long").alias("tokens_kept"),
        (F.lit(1.0) - longer / all_docs).alias("fitting"),
    )


def quantile_length(limits: DataFrame, share: float) -> int | None:
    """Smallest length that at least ``share`` of the documents do not exceed."""
    return limits.where(F.col("fitting") >= share).agg(F.min("n_tokens")).first()[0]
