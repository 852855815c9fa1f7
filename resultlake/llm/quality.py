"""Quality by a factorisation machine (operator 10).

A text becomes a sparse vector: its lower-cased words hashed into buckets with damped,
normalised counts, and statistics of its structure and size. A factorisation machine
scores it in time linear in the entries, since all pairwise interactions sum to
``((V'x)^2 - (V^2)'x^2) / 2``. It is fitted on a bounded sample of labelled rows; every
text is scored whole, where it lies, by a model of fixed size.

Null and empty texts have a vector of their own (no words, all statistics 0) and a
score like any other. A document with several labels counts once, with the largest.
With nothing to learn from every score is 0.5.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resultlake.llm.common import col, fresh, learnable, text_batches

BUCKETS, STATISTICS, FACTORS = 1 << 14, 24, 8
#: Labelled rows the machine is fitted on, at most; those with the smallest hashed ids.
SAMPLE_ROWS = 12_000
EPOCHS, BATCH, RATE, SHRINK = 6, 128, 0.05, 1e-5

SCORE = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def _statistics(raw: bytes, words: list[bytes], codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    n, w = len(raw), len(words)
    out = np.zeros(STATISTICS)
    if not w:
        return out
    byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    digits, upper, lower = byte[48:58].sum(), byte[65:91].sum(), byte[97:123].sum()
    beyond = byte[128:].sum()
    space = byte[32] + byte[9:14].sum()
    marks = n - digits - upper - lower - beyond - space
    lines = [x for x in raw.split(b"\n") if x]
    pairs = codes[:-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + codes[1:].astype(np.uint64)
    inner = max(1, n - space)
    sentences = byte[46] + byte[33] + byte[63]
    out[:22] = (
        1.0,
        np.log1p(n) / 10,
        np.log1p(w) / 8,
        digits / inner * 4,
        upper / inner * 4,
        lower / inner,
        beyond / inner * 2,
        marks / inner * 4,
        byte[33] / w * 2,
        (byte[35] + byte[36] + byte[37] + byte[38] + byte[42]) / w,
        byte[124] / w * 2,
        byte[60] / w + byte[62] / w,
        space / n * 4,
        inner / w / 10,
        len(counts) / w,
        counts.max() / w * 4,
        np.count_nonzero(codes[1:] == codes[:-1]) / w * 2,
        len(np.unique(pairs)) / max(1, len(pairs)),
        len(set(lines)) / max(1, len(lines)),
        np.log1p(w / max(1, len(lines))) / 5,
        np.log1p(w / max(1, sentences)) / 5,
        byte[44] / w * 4,
    )
    return out


def vector(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text's entries."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    codes = np.fromiter(map(zlib.crc32, raw.lower().split()), np.uint32, len(words))
    buckets, counts = np.unique(codes % BUCKETS, return_counts=True)
    values = np.log1p(counts)
    if len(values):
        values = values / np.sqrt((values**2).sum())
    stats = _statistics(raw, words, codes, counts)
    return (
        np.concatenate([buckets.astype(np.int32), np.arange(BUCKETS, BUCKETS + STATISTICS, dtype=np.int32)]),
        np.concatenate([values, stats]).astype(np.float32),
    )


@dataclass
class FactorisationMachine:
    bias: float = 0.0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS + STATISTICS, np.float32))
    factors: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS + STATISTICS, FACTORS), np.float32))

    def margin(self, index: np.ndarray, value: np.ndarray) -> float:
        v = self.factors[index] * value[:, None]
        total = v.sum(0)
        return float(self.bias + self.weights[index] @ value + 0.5 * ((total**2).sum() - (v**2).sum()))

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(*vector(text)), -30, 30))))


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 7) -> FactorisationMachine:
    """Logistic loss by adaptive gradient steps over small batches."""
    machine, rng = FactorisationMachine(), np.random.default_rng(seed)
    if not rows:
        return machine
    size = BUCKETS + STATISTICS
    w, v = machine.weights, rng.normal(0, 0.02, (size, FACTORS)).astype(np.float32)
    w_seen, v_seen, b_seen = np.full(size, 1e-6, np.float32), np.full((size, FACTORS), 1e-6, np.float32), 1e-6
    labels = np.array([r[0] for r in rows], np.float32)
    machine.bias = float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1)))
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            part = [rows[i] for i in order[at : at + BATCH]]
            index, value = np.concatenate([r[1] for r in part]), np.concatenate([r[2] for r in part])
            sizes = np.array([len(r[1]) for r in part])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            row = np.repeat(np.arange(len(part)), sizes)
            x = v[index] * value[:, None]
            total = np.add.reduceat(x, starts)
            margin = (
                machine.bias
                + np.add.reduceat(w[index] * value, starts)
                + 0.5 * ((total**2).sum(1) - np.add.reduceat((x**2).sum(1), starts))
            )
            slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[order[at : at + BATCH]]) / len(part)
            sort = np.argsort(index, kind="stable")
            used, first = np.unique(index[sort], return_index=True)
            by_entry = slope[row] * value
            gw = np.add.reduceat(by_entry[sort], first) + SHRINK * w[used]
            gv = np.add.reduceat((by_entry[:, None] * (total[row] - x))[sort], first) + SHRINK * v[used]
            w_seen[used] += gw**2
            v_seen[used] += gv**2
            w[used] -= RATE * gw / np.sqrt(w_seen[used])
            v[used] -= RATE * gv / np.sqrt(v_seen[used])
            b_seen += float(slope.sum()) ** 2
            machine.bias -= RATE * float(slope.sum()) / np.sqrt(b_seen)
    machine.factors = v
    return machine


def _vectors(batches):
    for batch in batches:
        rows = batch.to_pydict()
        found = [vector(t) for t in rows["text"]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows["quality"], pa.int32()),
                pa.array([f[0] for f in found], pa.list_(pa.int32())),
                pa.array([f[1] for f in found], pa.list_(pa.float32())),
            ],
            names=["quality", "index", "value"],
        )


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> FactorisationMachine:
    """A machine from ``docs (doc_id, text)`` and ``labels (doc_id, quality)``."""
    text_batches(docs.sparkSession)
    marked = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .where(learnable(F.col("doc_id")) & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
    )
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # A row per document, however often it is repeated.
    found = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    rows = found.select("quality", "text").mapInArrow(_vectors, "quality int, index array<int>, value array<float>").toArrow()
    parts = zip(rows["quality"].to_pylist(), rows["index"], rows["value"], strict=True)
    kept = [(q, np.asarray(i.values, np.int32), np.asarray(x.values, np.float32)) for q, i, x in parts]
    # The order in which tasks end must not matter.
    kept.sort(key=lambda r: (len(r[1]), r[0], zlib.crc32(r[1].tobytes()), zlib.crc32(r[2].tobytes())))
    return fit(kept)


def scores(docs: DataFrame, machine: FactorisationMachine, name: str = "quality_score") -> DataFrame:
    """All columns of ``docs`` and ``struct(score, predicted)`` named ``name``."""
    text_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(machine)

    @F.arrow_udf(SCORE)
    def scored(texts: pa.Array) -> pa.Array:
        found = [model.value.score(t) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array(found, pa.float64()), pa.array([int(s >= 0.5) for s in found], pa.int32())],
            names=["score", "predicted"],
        )

    mark: Column = scored(F.col("text").cast("string")).alias(fresh(docs, name))
    return docs.select(*(col(c) for c in docs.columns), mark)
