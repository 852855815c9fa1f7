"""Embedding near-duplicates by iterative quantisation (operator 4).

A rotation learned on a bounded sample makes balanced binary codes of the vectors: the
sample's principal axes, turned until they are as close to a corner of the cube as
they get. Codes are cut into substrings, each the key of a hash table; a vector is
looked up in every table under its own substring and all those one bit away
(multi-index Hamming search). A pair is taken from the first table that has it, and
only if its codes are close; the original vectors decide. Substrings get longer and
tables more numerous with the logarithm of the corpus, so buckets stay small.

Codes are those of the vectors less their mean, from which a pair at the threshold looks
wider apart than from the origin, the more so the nearer the vectors are to the mean.
Tables are as many as the angle asks for at a radius that the nearest two percent of the
sample are within. Pairs with a vector within it have tables of their own, over the
vectors near enough to be its partners, turned at random about the origin, where the
angle is the threshold's own. Where even the first would be too many, since nearly all
vectors are close to one, all are turned so.

Copies (equal vectors) are one class and are compared once. Vectors that are null, zero
or hold null or non-finite components are linked with nothing; vectors of different
lengths are not compared. Repeated rows are vectors of their own. Ties do not matter:
everything at the threshold is linked. Extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import partial, reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resultlake.llm.common import small
from resultlake.llm.components import components
from resultlake.llm.vectors import as_doubles, valid
from resultlake.session import stage

THRESHOLD = 0.95
#: Numbers of the sample the rotation is learned on, at most, and its rows.
SAMPLE_NUMBERS, SAMPLE_ROWS = 1 << 21, 8192
TURNS, RECALL = 30, 0.94
#: Share of the sample that is nearer to the mean than what the tables about it are sized
#: for; tables beyond which the mean is not taken off.
NEAREST, MOST_TABLES = 0.02, 64
VECTORS_PER_BATCH = 4096


@dataclass
class Quantiser:
    """Codes of ``tables`` substrings of ``bits`` bits."""

    mean: np.ndarray
    axes: np.ndarray  # dimensions x (tables * bits)
    bits: int
    tables: int
    off: float  # share of bits in which a pair at the threshold differs
    #: Distance from the mean that both vectors of a pair must have for this to hold.
    radius: float = 0.0

    def codes(self, x: np.ndarray) -> np.ndarray:
        on = ((x - self.mean) @ self.axes > 0).reshape(len(x), self.tables, self.bits)
        return on.astype(np.int64) @ (1 << np.arange(self.bits, dtype=np.int64))


def share_off(threshold: float, radius: float = 1.0) -> float:
    """Share of bits in which two unit vectors at the threshold differ, seen from a point
    at the distance ``radius`` of both."""
    return math.acos(max(-1.0, 1 - (1 - threshold) / max(radius**2, 1e-300))) / math.pi


def plan(count: int, off: float) -> tuple[int, float]:
    """Bits of a substring and number of tables: buckets of a few vectors, and the share
    of pairs at the threshold itself that some table finds."""
    bits = min(32, max(12, math.ceil(math.log2(max(2, count)))))
    hit = (1 - off) ** bits + bits * off * (1 - off) ** (bits - 1)
    return bits, max(4, math.ceil(math.log(1 - RECALL) / math.log1p(-hit))) if hit > 1e-9 else math.inf


def learn(sample: np.ndarray, count: int, threshold: float, seed: int = 11) -> Quantiser:
    """Iterative quantisation for ``count`` vectors; as many rotations as the code has bits."""
    mean, turns = sample.mean(0), TURNS
    radius = float(np.quantile(np.sqrt(((sample - mean) ** 2).sum(1)), NEAREST))
    off = share_off(threshold, radius)
    bits, tables = plan(count, off)
    if tables > MOST_TABLES:
        return learn_about_origin(sample, count, threshold, seed)
    return _rotations(sample, mean, turns, seed, bits, tables, off, radius)


def learn_about_origin(sample: np.ndarray, count: int, threshold: float, seed: int = 11) -> Quantiser:
    """Codes by random rotations about the origin, where the angle of a pair is its own."""
    off = share_off(threshold)
    return _rotations(sample, np.zeros(sample.shape[1]), 0, seed, *plan(count, off), off, 0.0)


def _rotations(sample, mean, turns: int, seed: int, bits: int, tables: int, off: float, radius: float) -> Quantiser:
    x = sample - mean
    _, axes = np.linalg.eigh(x.T @ x)
    y, rng, found = x @ axes, np.random.default_rng(seed), []
    while sum(a.shape[1] for a in found) < bits * tables:
        turn = np.linalg.qr(rng.normal(size=(y.shape[1], y.shape[1])))[0]
        for _ in range(turns):
            corner = np.where(y @ turn > 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(corner.T @ y)
            turn = (u @ v).T
        found.append(axes @ turn)
    return Quantiser(mean, np.concatenate(found, 1)[:, : bits * tables], bits, tables, off, radius)


def _padded(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of a list column, shorter ones filled with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    width = max(width or 0, int(lengths.max(initial=0)))
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(1, initial=0), 1e-300)[:, None]
    return x / np.maximum(np.sqrt((x**2).sum(1)), 1e-300)[:, None]


def _prepared(batches):
    for batch in batches:
        x = _padded(batch.column(1)) + 0.0  # no negative zero
        lengths = batch.column(1).value_lengths().to_pylist()
        digests = [blake2b(r[:n].tobytes(), digest_size=16).digest() for r, n in zip(x, lengths, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.binary())], names=["vec_id", "vector", "digest"])


def _coded(batches, model, centre: np.ndarray):
    """Codes, and the distance from the centre."""
    for batch in batches:
        width = len(centre)
        x = _unit(_padded(batch.column(1), width))[:, :width]
        codes = model.value.codes(x)
        away = np.sqrt(((x - centre) ** 2).sum(1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(list(codes), pa.list_(pa.int64())), batch.column(1).value_lengths().cast(pa.int32()), pa.array(away)],
            names=["cls", "code", "dim", "away"],
        )


def _similar(batches, threshold: float):
    for batch in batches:
        one, other = _padded(batch.column(2)), _padded(batch.column(3))
        width = max(one.shape[1], other.shape[1])
        one, other = (_unit(np.pad(x, ((0, 0), (0, width - x.shape[1])))) for x in (one, other))
        keep = pa.array(np.einsum("ij,ij->i", one, other) >= threshold)
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in (0, 1)], names=["a", "b"])


def candidate_pairs(codes: DataFrame, model: Quantiser, within: float | None = None) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of ``codes (cls, code, dim, away)`` that a table has, once
    each; with ``within`` those of which one vector at least is nearer to the mean."""
    at, code = F.posexplode("code"), F.col("code")
    near_b = F.lit(True) if within is None else F.col("away") < within
    listed = codes.select(F.col("cls").alias("b"), code.alias("cb"), F.col("dim").alias("db"), near_b.alias("nb"), at.alias("t", "key"))
    asking = codes if within is None else codes.where(F.col("away") < within)
    own = asking.select(F.col("cls").alias("a"), code.alias("ca"), F.col("dim").alias("da"), at.alias("t", "own"))
    near = F.array(F.col("own"), *(F.col("own").bitwiseXOR(F.lit(1 << i).cast("long")) for i in range(model.bits)))
    asked = own.select("a", "ca", "da", "t", F.explode(near).alias("key"))
    apart = [F.bit_count(F.col("ca")[t].bitwiseXOR(F.col("cb")[t])) for t in range(model.tables)]
    earlier = reduce(lambda x, y: x | y, ((F.col("t") > t) & (apart[t] <= 1) for t in range(model.tables)))
    # Twice the bits that pairs at the threshold differ in, and a margin.
    most = int(2 * model.bits * model.tables * model.off + 6)
    # Where both vectors ask, the smaller one's question counts.
    together = asked.join(listed, ["t", "key"]).where(
        (F.col("a") != F.col("b")) & ((F.col("a") < F.col("b")) | ~F.col("nb"))
        & (F.col("da") == F.col("db")) & ~earlier & (reduce(lambda x, y: x + y, apart) <= most)
    )
    return together.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vectors (vec_id, embedding)`` to ``vec_id, n_links, component_id, kept``."""
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(VECTORS_PER_BATCH))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), as_doubles(vectors).alias("vector"))
    usable = valid(F.col("vector")) & F.exists("vector", lambda x: x != 0)
    usable = F.coalesce(usable, F.lit(False))
    alone = rows.where(~usable).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    prepared = stage(
        rows.where(usable)
        .mapInArrow(_prepared, "vec_id long, vector array<double>, digest binary")
        .withColumn("uid", F.monotonically_increasing_id()),
        "vectors",
    )
    classes = prepared.groupBy("digest").agg(
        F.min("uid").alias("cls"), F.count("*").alias("copies"), F.min("vec_id").alias("least")
    )
    classes = stage(classes, "classes")
    chosen = stage(
        prepared.join(classes.select(F.col("cls").alias("uid")), "uid", "left_semi").select(F.col("uid").alias("cls"), "vector"),
        "class-vectors",
    )
    widest = chosen.agg(F.max(F.size("vector")), F.count("*")).first()
    if not widest[1]:
        return alone
    limit = max(64, min(SAMPLE_ROWS, SAMPLE_NUMBERS // widest[0]))
    sample = chosen.orderBy(F.xxhash64("vector"), "cls").limit(limit).select("vector").toArrow()
    sample = _unit(_padded(sample["vector"].combine_chunks(), widest[0]))
    learned = learn(sample, widest[1], threshold)
    schema = "cls long, code array<long>, dim int, away double"

    def coded(quantiser: Quantiser) -> DataFrame:
        model = spark.sparkContext.broadcast(quantiser)
        return chosen.mapInArrow(partial(_coded, model=model, centre=learned.mean), schema)

    codes = stage(coded(learned).where(F.col("away") >= learned.radius), "codes")
    pairs = stage(candidate_pairs(codes, learned), "vector-pairs")
    if learned.radius > 0:
        # Linked vectors are no further apart than this, so one of them within the radius
        # has its partners within both distances; there the angle is taken at the origin.
        reach = math.sqrt(2 * (1 - threshold)) + 1e-6
        inner = learn_about_origin(sample, widest[1], threshold)
        codes = stage(coded(inner).where(F.col("away") < learned.radius + reach), "inner-codes")
        pairs = stage(pairs.unionByName(candidate_pairs(codes, inner, learned.radius)), "all-vector-pairs")
    one = chosen.select(F.col("cls").alias("a"), F.col("vector").alias("va"))
    other = chosen.select(F.col("cls").alias("b"), F.col("vector").alias("vb"))
    compared = pairs.join(one, "a").join(other, "b").select("a", "b", "va", "vb")
    links = stage(compared.mapInArrow(partial(_similar, threshold=threshold), "a long, b long"), "vector-links")

    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    weight = classes.select(F.col("cls").alias("b"), F.col("copies").alias("w"))
    degrees = both.join(weight, "b").groupBy(F.col("a").alias("cls")).agg(F.sum("w").alias("near"))
    labels = components(links).withColumnRenamed("id", "cls")
    known = classes.join(degrees, "cls", "left").join(labels, "cls", "left").withColumn(
        "label", F.coalesce("component_id", "cls")
    )
    known = stage(known.select("digest", "least", "label", (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "known")
    named = known.groupBy("label").agg(F.min("least").alias("component_id"))
    final = stage(known.join(named, "label").select("digest", "n_links", "component_id"), "final")
    linked = prepared.select("vec_id", "digest").join(small(final), "digest").select(
        "vec_id",
        F.col("n_links").cast("long").alias("n_links"),
        "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
    return linked.unionByName(alone)
