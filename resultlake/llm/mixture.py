"""Mixing sources to target weights by balanced sampling (operator 3).

A source's target says how often its documents are taken on average; the whole part of
that is certain, the fraction is drawn. Draws are balanced by the cube method: in
flight, inclusion probabilities move along the null space of two constraints (number
of documents, number of words), so both totals stay as they are until all but two
documents of a block are decided. What stays undecided flies again in blocks of such
leftovers until one block a source remains, of which a dozen documents are left to land:
the rounding of them that keeps both totals best. Blocks are hashed parts of a source of bounded size, so a source that
holds a third of all rows is just more blocks.

Null texts have size 0; a null source is a source of its own, the last one. Repeated
rows are drawn one by one. A source without words has target 0. Draws depend on the
rows alone, not on how they are stored. An empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resultlake.llm.common import WORD, small
from resultlake.session import stage

WEIGHTS = (3, 1, 2)  # of the sources in order, repeating
SHARE, MOST = 1.5, 2.0
BLOCK = 2048
# Documents of a source that are rounded together at the end.
LANDING = 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def _source_key(source: Column) -> Column:
    """Never null, and in the sources' order: code points first, no source last."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("c"), source.cast("string")))


def _ranked(sources: DataFrame) -> DataFrame:
    """``place`` of each source in order, from 0: counted inside ranges of sources and
    over the ranges' totals, so no task sees all sources."""
    ranged = stage(
        sources.repartitionByRange(F.col("key")).withColumn("range", F.spark_partition_id()), "sources"
    )
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("range").count().select(  # a row per range
        "range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")
    )
    inside = F.row_number().over(Window.partitionBy("range").orderBy("key"))
    return ranged.join(F.broadcast(starts), "range").withColumn("place", F.col("start") + inside - 1)


def targets(
    rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """``rows (key, size)`` to one row per source: ``key, n, source_size, target``.
    Sources share ``share`` of all sizes by weight; none gets more than ``most`` times
    its own, and what it leaves is shared again. Only sums reach the driver."""
    sums = rows.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    ranked = _ranked(sums).withColumn(
        "weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int"))
    )
    sources = stage(ranked.select("key", "n", "source_size", "weight"), "sources")
    goal = share * float(sources.agg(F.sum("source_size")).first()[0] or 0)
    cap, level = F.col("source_size") * F.lit(most), 0.0
    while True:
        capped = cap <= F.col("weight") * F.lit(level)
        held, free = sources.agg(
            F.sum(F.when(capped, cap).otherwise(F.lit(0.0))), F.sum(F.when(capped, F.lit(0.0)).otherwise(F.col("weight")))
        ).first()
        now = (goal - held) / free if free else level
        if now <= level:
            break
        level = now
    target = F.least(cap, F.col("weight") * F.lit(level)).cast("double")
    return sources.select("key", "n", "source_size", target.alias("target"))


def _landed(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The rounding that keeps the words, then the documents, closest to expected."""
    options = (np.arange(1 << len(p))[:, None] >> np.arange(len(p)) & 1).astype(float)
    words, documents = np.abs(options @ size - p @ size), np.abs(options.sum(1) - p.sum())
    return options[np.argmin(words + 0.05 * size.mean() * documents)]


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator, land: bool) -> np.ndarray:
    """Decide all but two of the probabilities in the order given, while their sum and
    their sum weighted by size stay as they are. To ``land``, a few documents of all
    sizes are left out of the flight and rounded together with what it leaves."""
    p, eps = p.astype(float).copy(), 1e-9
    p[p <= eps], p[p >= 1 - eps] = 0.0, 1.0
    open_ones = np.flatnonzero((p > 0) & (p < 1))
    by_size = open_ones[np.argsort(size[open_ones], kind="stable")]
    kept = by_size[np.linspace(0, len(by_size) - 1, min(LANDING, len(by_size))).astype(int)] if land else by_size[:0]
    live: list[int] = []
    for i in np.setdiff1d(open_ones, kept, assume_unique=True).tolist():
        live.append(i)
        if len(live) < 3:
            continue
        a, b, c = live
        # Orthogonal to (1, 1, 1) and to the sizes.
        u = np.array([size[b] - size[c], size[c] - size[a], size[a] - size[b]], float)
        if not u.any():
            u = np.array([1.0, -1.0, 0.0])
        now = p[live]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(u > 0, (1 - now) / u, np.where(u < 0, -now / u, np.inf)).min()
            down = np.where(u > 0, now / u, np.where(u < 0, (now - 1) / u, np.inf)).min()
        step = up if rng.random() < down / (up + down) else -down
        now = now + step * u
        for k, j in enumerate(live):
            p[j] = round(now[k]) if not eps < now[k] < 1 - eps else now[k]
        live = [j for j in live if eps < p[j] < 1 - eps]
    if land and (live or len(kept)):
        last = np.array(sorted({*live, *kept.tolist()}))
        p[last] = _landed(p[last], size[last])
    return p


def _fly(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values(["order", "doc_id", "uid"], ignore_index=True)
    rng = np.random.default_rng(zlib.crc32(f"{key[0]}/{key[1]}/{block['blocks'][0]}".encode()))
    p = flight(block["p"].to_numpy(), block["size"].to_numpy(float), rng, block["blocks"][0] == 1)
    return block.assign(p=p)


_FLOWN = "key string, block long, blocks long, uid long, doc_id long, size long, `order` long, p double"


def _decided(rows: DataFrame, block: int) -> DataFrame:
    """``(uid, extra)`` for rows ``(key, uid, doc_id, size, p)`` with a fraction to draw."""
    order = F.xxhash64("doc_id", "size")
    counts = rows.groupBy("key").agg(F.ceil(F.count("*") / block).cast("long").alias("blocks"))
    # Rows repeated beyond a block's size are told apart by their own number too.
    many = rows.groupBy("key", "doc_id", "size").count().where(F.col("count") > block).select(
        "key", F.col("doc_id").alias("many_id"), F.col("size").alias("many_size"), F.lit(True).alias("many")
    )
    open_rows = (
        rows.join(small(counts), "key")
        .join(
            small(stage(many, "repeated")).withColumnRenamed("key", "many_key"),
            (F.col("key") == F.col("many_key"))
            & F.col("doc_id").eqNullSafe(F.col("many_id"))
            & (F.col("size") == F.col("many_size")),
            "left",
        )
        .withColumn("order", F.when(F.col("many"), F.xxhash64("doc_id", "size", "uid")).otherwise(order))
        .withColumn("block", F.pmod(F.xxhash64("order", F.lit(1)), "blocks"))
    )
    done = []
    while True:
        open_rows = open_rows.select("key", "block", "blocks", "uid", "doc_id", "size", "order", "p")
        flown = stage(open_rows.groupBy("key", "block").applyInPandas(_fly, _FLOWN), "flown")
        whole = F.col("p").isin(0.0, 1.0)
        done.append(flown.where(whole).select("uid", F.col("p").cast("long").alias("extra")))
        left = flown.where(~whole)  # at most two a block, none where a source had one block
        if left.isEmpty():
            return reduce(DataFrame.unionByName, done)
        fewer = F.ceil(F.col("blocks") * 2 / block).cast("long")
        open_rows = left.withColumn("blocks", fewer).withColumn(
            "block", F.pmod(F.xxhash64("block", F.lit(2)), "blocks")
        )


def mix(docs: DataFrame, block: int = BLOCK, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``docs (doc_id, source, size)``, and a ``uid`` if rows are to be recognised, to
    ``uid, doc_id, size, source_size, target, copies, taken``; ``most`` bounds the
    copies of a document."""
    rows = docs if "uid" in docs.columns else docs.withColumn("uid", F.monotonically_increasing_id())
    rows = stage(
        rows.select("uid", F.col("doc_id").cast("long"), _source_key(F.col("source")).alias("key"), "size"),
        "sizes",
    )
    goals = stage(targets(rows, weights, share, most), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    with_rate = stage(rows.join(small(goals), "key").withColumn("rate", rate), "rated")
    fraction = F.col("rate") - F.floor("rate")
    drawn = with_rate.where((fraction > 1e-9) & (fraction < 1 - 1e-9))
    extra = _decided(drawn.select("key", "uid", "doc_id", "size", fraction.alias("p")), block)
    certain = F.when(fraction >= 1 - 1e-9, F.ceil("rate")).otherwise(F.floor("rate"))
    copies = (certain + F.coalesce("extra", F.lit(0))).cast("long")
    return with_rate.join(extra, "uid", "left").select(
        "uid", "doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )
