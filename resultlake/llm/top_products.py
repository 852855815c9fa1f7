"""Exact top-k inner products by MaxScore (operator 5).

Every component of a vector is a term, and a shard of vectors holds the postings of all
terms: as rows of a matrix where most vectors have the term, as lists of vectors and
values where few do. A query orders the terms by the most they can add to a score in
the shard. The terms whose bounds together stay below the query's current k-th score
are non-essential: a vector that only they speak for cannot enter. Essential postings
are traversed for all vectors; the others are probed, largest bound first, only for
vectors that can still reach the k-th score. A task takes a block of queries through a
run of shards, so the k-th score carries over; the runs' results are merged by rank.

Components are floor(64 x), x as double, and scores are exact integers; both end at 62
bits. Vectors that are null or
hold null or non-finite components, and rows without an id, take no part. Missing
components of shorter vectors count as 0. A repeated row is a candidate of its own, and
of the others with its id. Ties go to the smaller id. Empty tables give no rows.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from resultlake.llm.near_vectors import _padded
from resultlake.llm.vectors import as_doubles, valid
from resultlake.session import stage

TOP, EVERY, SCALE = 20, 20, 64
# Vectors of a shard, queries of a block, shards of a run.
SHARD, QUERIES, RUN = 8192, 2048, 8
# A posting list as a matrix row from this share of the shard; terms probed at a time.
DENSE, PROBED = 0.25, 4
# Where scores end.
MOST = 1 << 62
_PACKED = "shard long, uids binary, ids binary, terms int, matrix binary"


def _packed(batches):
    """Shards of a task's vectors: ids and values of up to ``SHARD`` rows in one row."""
    seen, held, count = TaskContext.get().partitionId() << 40, [], 0

    def shard():
        ids, width = np.concatenate([h[0] for h in held]), max(h[1].shape[1] for h in held)
        values = np.concatenate([np.pad(h[1], ((0, 0), (0, width - h[1].shape[1]))) for h in held])
        uids = np.arange(seen, seen + len(ids), dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([seen]), pa.array([uids.tobytes()]), pa.array([ids.tobytes()]), pa.array([width], pa.int32()), pa.array([values.tobytes()])],
            names=["shard", "uids", "ids", "terms", "matrix"],
        )

    for batch in batches:
        ids = batch.column(0).to_numpy()
        limit = float(MOST)
        values = np.clip(np.floor(SCALE * _padded(batch.column(1))), -limit, limit).astype(np.int64)
        for at in range(0, len(ids), SHARD):
            held.append((ids[at : at + SHARD], values[at : at + SHARD]))
            count += len(held[-1][0])
            if count >= SHARD:
                yield shard()
                seen, held, count = seen + count, [], 0
    if held:
        yield shard()


def _queries(batches, every: int):
    for batch in batches:
        for r in batch.to_pylist():
            uids, ids, values = _unpacked(r["uids"], r["ids"], r["matrix"])
            at = np.flatnonzero(ids % every == 0)
            terms = pa.array([values[i].tobytes() for i in at.tolist()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(uids[at]), pa.array(ids[at]), terms], names=["quid", "query_id", "terms"])


def _unpacked(uids: bytes, ids: bytes, matrix: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return np.frombuffer(uids, np.int64), ids, np.frombuffer(matrix, np.int64).reshape(len(ids), -1)


class Shard:
    """Postings of all terms over a few thousand vectors."""

    def __init__(self, uids: np.ndarray, ids: np.ndarray, values: np.ndarray, kind):
        self.uids, self.ids = uids, ids
        by_term = np.ascontiguousarray(values.T).astype(kind)
        self.high, self.low = by_term.max(1, initial=0), by_term.min(1, initial=0)
        filled = np.count_nonzero(by_term, axis=1)
        dense = filled >= DENSE * len(ids)
        self.row = np.where(dense, np.cumsum(dense) - 1, -1)
        self.rows = by_term[dense]
        self.lists = {}
        for t in np.flatnonzero(~dense).tolist():
            held = np.flatnonzero(by_term[t])
            self.lists[t] = held, by_term[t, held]

    def search(self, query: np.ndarray, quid: int, top: list[tuple[int, int, int]], k: int) -> list[tuple[int, int, int]]:
        """``top`` (-score, id, uid), best first, merged with what the shard has."""
        width = min(len(query), len(self.row))
        w = query[:width]
        bound = np.maximum(np.maximum(w * self.high[:width], w * self.low[:width]), 0)
        least = -top[-1][0] if len(top) == k else None
        order = np.argsort(bound, kind="stable")
        sums = np.cumsum(bound[order])
        weak = 0 if least is None else int(np.searchsorted(sums, least, "left"))
        score = self._traversed(w, order[weak:])
        if least is None:
            live = np.arange(len(self.ids))
        else:
            rest = sums[weak - 1] if weak else 0
            live = np.flatnonzero(score + rest >= least)
            for at in range(weak, 0, -PROBED):
                if not len(live):
                    break
                part = order[max(0, at - PROBED) : at]
                score[live] += self._probed(w, part, live)
                rest = sums[max(0, at - PROBED) - 1] if at > PROBED else 0
                live = live[score[live] + rest >= least]
        live = live[self.uids[live] != quid]
        score = np.clip(score[live], -MOST, MOST)
        if len(live) > k:
            best = np.lexsort((self.uids[live], self.ids[live], -score))[:k]
            live, score = live[best], score[best]
        new = zip((-score).tolist(), self.ids[live].tolist(), self.uids[live].tolist(), strict=True)
        return sorted([*top, *((int(s), i, u) for s, i, u in new)])[:k]

    def _traversed(self, w: np.ndarray, terms: np.ndarray) -> np.ndarray:
        terms = terms[w[terms] != 0]
        rows = self.row[terms]
        full = rows >= 0
        score = w[terms[full]] @ self.rows[rows[full]] if full.any() else np.zeros(len(self.ids), w.dtype)
        for t in terms[~full].tolist():
            held, values = self.lists[t]
            score[held] += w[t] * values
        return score

    def _probed(self, w: np.ndarray, terms: np.ndarray, live: np.ndarray) -> np.ndarray:
        found = np.zeros(len(live), self.rows.dtype)
        for t in terms.tolist():
            if self.row[t] >= 0:
                found += w[t] * self.rows[self.row[t], live]
            else:
                held, values = self.lists[t]
                at = np.minimum(np.searchsorted(held, live), max(0, len(held) - 1))
                if len(held):
                    found += np.where(held[at] == live, w[t] * values[at], 0)
        return found


def _exact_kind(queries: np.ndarray, values: np.ndarray):
    """Doubles as long as they hold every sum exactly, else 64-bit integers, else
    integers of any size."""
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(values).max(initial=0)) * max(1, queries.shape[1])
    return np.float64 if largest < 2**53 else np.int64 if largest < 2**62 else object


_FOUND = "quid long, query_id long, vec_id long, uid long, score long"


def _searched(batches, k: int):
    """Rows of a run come together, sorted: one block of queries, one shard after another."""
    now, queries, best = None, None, []

    def results():
        quids, ids, _ = queries
        flat = [(q, i, vec, uid, -s) for q, i, top in zip(quids, ids, best, strict=True) for s, vec, uid in top]
        columns = zip(*flat, strict=True) if flat else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["quid", "query_id", "vec_id", "uid", "score"])

    for batch in batches:
        for r in batch.to_pylist():
            key = (r["block"], r["run"])
            if key != now:
                if now is not None:
                    yield results()
                rows = [np.frombuffer(q["terms"], np.int64) for q in r["queries"]]
                width = max(map(len, rows))
                matrix = np.array([np.pad(x, (0, width - len(x))) for x in rows])
                queries = [q["quid"] for q in r["queries"]], [q["query_id"] for q in r["queries"]], matrix
                now, best = key, [[] for _ in rows]
            uids, ids, values = _unpacked(r["uids"], r["ids"], r["matrix"])
            kind = _exact_kind(queries[2], values)
            shard, weights = Shard(uids, ids, values, kind), queries[2].astype(kind)
            for i, quid in enumerate(queries[0]):
                best[i] = shard.search(weights[i], quid, best[i], k)
    if now is not None:
        yield results()


def top_products(vectors: DataFrame, k: int = TOP, every: int = EVERY) -> DataFrame:
    """``vectors (vec_id, embedding)`` to ``query_id, rank, vec_id, score``; queries are
    the rows whose vec_id is divisible by ``every``."""
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), as_doubles(vectors).alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & valid(F.col("vector")))
    shards = stage(rows.mapInArrow(_packed, _PACKED), "shards")
    queries = stage(shards.mapInArrow(partial(_queries, every=every), "quid long, query_id long, terms binary"), "queries")
    n_shards, n_queries = shards.count(), queries.count()
    blocks, runs = max(1, -(-n_queries // QUERIES)), max(1, -(-n_shards // RUN))
    # Few blocks still give every core a run.
    cores = spark.sparkContext.defaultParallelism
    runs = max(runs, min(n_shards, -(-cores // blocks)))
    number = F.row_number().over(Window.orderBy("shard"))  # a number per shard
    run_of = shards.select("shard").withColumn("run", number % runs)
    dealt = shards.join(run_of, "shard")
    packed = (
        queries.groupBy(F.pmod(F.xxhash64("quid"), F.lit(blocks)).alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("quid", "query_id", "terms"))).alias("queries"))  # a block's
        .select("block", "queries", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run"))
    )
    parts = min(blocks * runs, 20_000)
    together = packed.join(dealt, "run").repartition(parts, "block", "run").sortWithinPartitions("block", "run", "shard")
    found = together.mapInArrow(partial(_searched, k=k), _FOUND)
    order = Window.partitionBy("quid").orderBy(F.desc("score"), "vec_id", "uid")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
