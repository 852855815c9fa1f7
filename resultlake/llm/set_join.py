"""N-gram Jaccard join by partitions of the universe (operator 7).

A document is the set of its distinct word shingles. Sizes fall into bands so narrow
that a partner lies in the same band or the next; every band and its successor make a
space, in which two linked sets differ in at most ``H`` shingles. Hashing deals the
universe of shingles into ``H + 1`` segments. By the pigeonhole principle the subsets
of two linked sets then agree in at least one segment, so one hashed key per segment
finds every link.

A key costs as much as the sets that share it. The costly one is the empty subset,
which a fixed share of all sets have in any segment, related or not. Allocation by cost
gives an empty segment no key (0 differences) and its neighbour a tolerance of one
instead (1 difference: the subset and its one-deletion neighbourhood, under the mark
of the empty segment); all others get their subset (one unit each). If both sets are
empty there, the units add up to ``H + 1`` again; if one is not, the segment holds a
difference itself; and of two empty neighbours the second is found by its own subset.
So no link is lost, and no key is shared by sets for being empty alone.

Copies (equal word sequences) are one vertex. Sets with a key in common are compared
with the smallest of them first: by their sizes, then by parity sketches, and what these
leave possible exactly, on their shingles; only where that leaves the
holders of a key in several components are the members of different components
compared with each other, and of these only pairs whose parity sketches allow it: one
differing shingle changes one bit of a sketch, so sketches never differ in more bits
than the sets in shingles. So a group of near copies costs a comparison per member.

A document without words is linked with nothing and has size 0. Rows that share a
doc_id are one document; a row without one gets its size and no component. Extra
columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from functools import partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from resultlake.llm.common import frugal, small, text_batches
from resultlake.llm.components import components
from resultlake.session import stage

WORDS, PERCENT = 3, 90
# 64-bit words of a parity sketch.
SKETCH = 32
# Holders of a key that are compared with each other in one go.
HOLDERS = 1024
# Documents whose keys a task holds at a time.
TOGETHER = 512
# Bytes of texts handed to Python at a time.
BATCH_BYTES = 4 * 1024 * 1024


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case; bytes know no other letters and no other spaces."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(words: list[bytes], n: int) -> set:
    """The shingles themselves, for exact comparison."""
    if len(words) < n:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(n)), strict=False))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_codes(words: list[bytes], n: int) -> np.ndarray:
    """Sorted distinct 64-bit codes of the shingles."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(n, len(words))
    count = len(h) - n + 1
    codes = h[:count].copy()
    for i in range(1, n):
        codes = _mix(codes + np.uint64(0x9E3779B97F4A7C15)) ^ h[i : i + count]
    return np.unique(_mix(codes))


class Bands:
    """Where the bands of sizes begin and how many segments their spaces have."""

    def __init__(self, percent: int):
        self.percent, self.starts, self.segments = percent, [1], []

    def of(self, size: int) -> int:
        while self.starts[-1] <= size:
            start = self.starts[-1]
            following = 100 * start // self.percent + 1
            largest = following - 1
            both = largest + 100 * largest // self.percent
            self.segments.append(both * (100 - self.percent) // (100 + self.percent) + 1)
            self.starts.append(following)
        return int(np.searchsorted(self.starts, size, "right")) - 1


def keys_of(codes: np.ndarray, bands: Bands) -> np.ndarray:
    """The keys of a non-empty set, in the two spaces its band belongs to."""
    band, out = bands.of(len(codes)), []
    mixed = _mix(codes)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mixed, out=sums[1:])
    high = codes >> np.uint64(32)
    for space in (band - 1, band):
        if space < 0:
            continue
        m = bands.segments[space]
        segment = (high * np.uint64(m)) >> np.uint64(32)  # grows with the sorted codes
        edges = np.searchsorted(segment, np.arange(m + 1, dtype=np.uint64))
        subset = sums[edges[1:]] - sums[edges[:-1]]
        place = np.arange(m, dtype=np.uint64) + np.uint64((space + 1) << 32)
        sizes = np.diff(edges)
        mark = _mix(place)
        out.append(_mix(subset + mark)[sizes > 0])
        for empty in np.flatnonzero(sizes == 0).tolist():
            after = (empty + 1) % m
            near = np.append(subset[after], subset[after] - mixed[edges[after] : edges[after + 1]])
            out.append(_mix(_mix(near + mark[after]) + mark[empty]))
    return np.unique(np.concatenate(out))


# -- copies -----------------------------------------------------------------
def _digests(batches):
    for batch in batches:
        words = map(words_of, batch.column(1).to_pylist())
        digests = [blake2b(b" ".join(w), digest_size=16).digest() if w else None for w in words]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary())], names=["doc_id", "digest"])


def sketch(codes: np.ndarray, words: int = SKETCH) -> np.ndarray:
    """Parity of the number of codes in each of ``64 * words`` hashed classes, ``words``
    being a power of two; the two halves of a sketch make that of half as many classes."""
    odd = np.bincount((codes & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def wide_sketch(codes: np.ndarray) -> np.ndarray | None:
    """A sketch with a class or more per code, for sets that fill the narrow one."""
    return sketch(codes, 1 << (-(-len(codes) // 64) - 1).bit_length()) if len(codes) > 64 * SKETCH else None


# -- candidates -------------------------------------------------------------
# Most rows are a key and a holder; all else is one struct, null in these.
_KEYED = "part long, vertex long, more struct<key: long, rep: long, n: long, sketch: array<long>, wide: array<long>>"


def _keyed(batches, words: int, percent: int):
    """Per document a row with its size, and a row per key. Where several documents of
    a slice share a key, the smallest stands for them in the shuffle; the others are
    dealt out one by one, already compared with it, so no key makes a hot partition."""
    bands = Bands(percent)
    for batch in (b.slice(at, TOGETHER) for b in batches for at in range(0, b.num_rows, TOGETHER)):
        keys, sizes, sketches, wides = [], [], [], []
        doc_ids = batch.column(0).to_pylist()
        for text in batch.column(1).to_pylist():
            codes = shingle_codes(words_of(text), words)
            sizes.append(len(codes))
            sketches.append(sketch(codes))
            wides.append(wide_sketch(codes))
            keys.append(keys_of(codes, bands) if len(codes) else codes)
        ids = np.array(doc_ids, np.int64)
        vertex = np.repeat(ids, [len(k) for k in keys])
        key = np.concatenate([*keys, np.empty(0, np.uint64)])
        order = np.lexsort((vertex, key))
        key, vertex = key[order], vertex[order]
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        rep = vertex[first][np.cumsum(first) - 1] if len(key) else vertex
        same = vertex == rep
        spread = _mix(key ^ _mix(vertex.view(np.uint64)))
        part = np.where(same, key, spread).view(np.int64)
        n_keys, n_docs = len(key), len(ids)
        plain = np.concatenate([same, np.zeros(n_docs, bool)])
        about = np.concatenate([np.zeros(n_keys, bool), np.ones(n_docs, bool)])
        more = pa.StructArray.from_arrays(
            [
                pa.array(np.concatenate([key.view(np.int64), ids]), mask=about),
                pa.array(np.concatenate([rep, ids]), mask=about),
                pa.array(np.concatenate([vertex, np.array(sizes, np.int64)]), mask=~about),
                pa.array([None] * n_keys + sketches, pa.list_(pa.int64())),
                pa.array([None] * n_keys + wides, pa.list_(pa.int64())),
            ],
            names=["key", "rep", "n", "sketch", "wide"],
            mask=pa.array(plain),
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([part, _mix(ids.view(np.uint64)).view(np.int64)])),
                pa.array(np.concatenate([vertex, ids])),
                more,
            ],
            names=["part", "vertex", "more"],
        )


def _packed(batches):
    """Texts as their words alone, compressed: what pairs carry through a shuffle."""
    for batch in batches:
        words = (zlib.compress(b" ".join(words_of(t.as_py())), 1) for t in batch.column(1))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary())], names=["doc_id", "words"])


def _unpacked(words: bytes) -> list[bytes]:
    return zlib.decompress(words).split()


def _compared(batches, words: int, percent: int):
    for batch in batches:
        linked, last, left = [], None, set()
        for s, t in zip(batch.column(2), batch.column(3), strict=True):
            if (s := s.as_py()) != last:
                last, left = s, shingle_set(_unpacked(s), words)
            right = shingle_set(_unpacked(t.as_py()), words)
            common = len(left & right)
            linked.append(100 * common >= percent * (len(left) + len(right) - common) and common > 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).filter(pa.array(linked, pa.bool_())), batch.column(1).filter(pa.array(linked, pa.bool_()))],
            names=["a", "b"],
        )


def _plausible(batches, percent: int):
    """Pairs of a key's holders, block by block, that are in different components and
    whose sizes and sketches leave a link possible. Rows come sorted by block pair."""
    held, now = [], None

    def pairs():
        block, vertex, label, n = (np.array(c, np.int64) for c in list(zip(*held, strict=True))[1:5])
        parity = np.array([h[5] for h in held], np.int64).view(np.uint64)
        one, other = [], []
        for i in range(len(held) - 1):
            rest = slice(i + 1, None)
            fits = (label[rest] != label[i]) & (100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i]))
            if now[1] != now[2]:
                fits &= block[rest] != block[i]
            at = np.flatnonzero(fits) + i + 1
            if len(at):
                apart = np.bitwise_count(parity[at] ^ parity[i]).sum(1, dtype=np.int64)
                at = at[apart * (100 + percent) <= (n[at] + n[i]) * (100 - percent)]
                one += [int(vertex[i])] * len(at)
                other += vertex[at].tolist()
        return one, other

    for batch in batches:
        out: tuple[list, list] = ([], [])
        for row in zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns)), strict=True):
            if row[:3] != now:
                if len(held) > 1:
                    for found, new in zip(out, pairs(), strict=True):
                        found += new
                held, now = [], row[:3]
            held.append(row[2:])
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["a", "b"])
    if len(held) > 1:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in pairs()], names=["a", "b"])


def _possible(pairs: DataFrame, about: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that sizes, then parity sketches leave a link possible for:
    none that is linked is lost, and texts are fetched for few others. Sets that fill
    their narrow sketches are held against each other by the wide ones too."""

    def of(side: str, *columns: str) -> DataFrame:
        return about.select(F.col("vertex").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns))

    def near_enough(x, y):
        bits = F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q)))
        apart = F.aggregate(bits, F.lit(0), lambda total, n: total + n)
        return apart * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)

    sized = pairs.join(small(of("a", "n")), "a").join(small(of("b", "n")), "b")
    fits = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    near = sized.where(fits).join(small(of("a", "sketch")), "a").join(small(of("b", "sketch")), "b")
    near = stage(near.where(near_enough("sketch_a", "sketch_b")).select("a", "b", "n_a", "n_b").distinct(), "near-pairs")

    filled = F.least("n_a", "n_b") > 64 * SKETCH
    large = near.where(filled).join(small(of("a", "wide").where("wide_a is not null")), "a")
    large = large.join(small(of("b", "wide").where("wide_b is not null")), "b")
    one, other = F.size("wide_a"), F.size("wide_b")

    def halved(name: str):
        half = (F.size(name) / 2).cast("int")
        return F.zip_with(F.slice(name, 1, half), F.slice(name, half + 1, half), lambda x, y: x.bitwiseXOR(y))

    same = F.when(one == other, near_enough("wide_a", "wide_b"))
    same = same.when(one == 2 * other, near_enough(halved("wide_a"), F.col("wide_b")))
    same = same.when(other == 2 * one, near_enough(F.col("wide_a"), halved("wide_b"))).otherwise(F.lit(True))
    return near.where(~filled).select("a", "b").unionByName(large.where(same).select("a", "b")).distinct()


def _links(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sets are similar enough, staged."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    chosen = docs.join(small(stage(ids, "candidate-ids")), "doc_id", "left_semi")
    texts = stage(chosen.mapInArrow(frugal(_packed), "doc_id long, words binary"), "candidate-texts")
    one = texts.select(F.col("doc_id").alias("a"), F.col("words").alias("one"))
    other = texts.select(F.col("doc_id").alias("b"), F.col("words").alias("other"))
    joined = pairs.join(other, "b").join(one, "a").select("a", "b", "one", "other")
    return stage(joined.mapInArrow(frugal(partial(_compared, words=words, percent=percent)), "a long, b long"), "links")


def groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs (doc_id, text)`` to ``doc_id, n_shingles, component_id``, a row each."""
    spark = docs.sparkSession
    text_batches(spark, BATCH_BYTES)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stage(docs.mapInArrow(frugal(_digests), "doc_id long, digest binary"), "digests")
    full = rows.where("digest is not null")
    least = stage(full.groupBy("digest").agg(F.min("doc_id").alias("vertex")), "classes")
    empty = rows.where("digest is null").select("doc_id", F.col("doc_id").alias("vertex"))
    rows = stage(full.join(least, "digest").select("doc_id", "vertex").unionByName(empty), "copies")

    # One text per class goes on: its smallest document.
    chosen = F.col("doc_id") == F.col("vertex")
    others = rows.where(~chosen).join(rows.where(chosen).select("doc_id").distinct(), "doc_id", "left_anti")
    skipped = stage(others.select("doc_id").distinct(), "skipped")
    named = docs.where("doc_id is not null")
    first = named.join(small(skipped), "doc_id", "left_anti")
    keyed = first.mapInArrow(frugal(partial(_keyed, words=words, percent=percent)), _KEYED)
    running = Window.partitionBy("part").orderBy("vertex").rowsBetween(Window.unboundedPreceding, 0)
    found = stage(
        keyed.withColumn("first", F.first("vertex").over(running))
        .select(
            F.coalesce("more.key", "part").alias("key"), "vertex", F.coalesce("more.rep", "first").alias("rep"),
            F.col("more.n").alias("n"), F.col("more.sketch").alias("sketch"), F.col("more.wide").alias("wide"),
        )
        .where("n is not null or vertex <> rep"),
        "candidates",
    )
    shared = found.where("n is null").select("key", "vertex", "rep")
    pairs = stage(shared.select(F.col("rep").alias("a"), F.col("vertex").alias("b")).distinct(), "pairs")
    # A row per text: a document with two texts has two, and either may link it.
    about = stage(found.where("n is not null").select("vertex", "n", "sketch", "wide").distinct(), "sizes-and-sketches")
    links = _links(stage(_possible(pairs, about, percent), "possible-pairs"), named, words, percent)
    again = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("vertex").alias("a"), F.max("vertex").alias("b"))
    links = links.unionByName(again.where("a <> b").select("a", "b"))  # one document, two texts
    labels = components(links)

    # Keys whose holders are still apart, and were not all compared with each other.
    holders = shared.select("key", "vertex").union(shared.select("key", "rep")).distinct()
    placed = stage(
        holders.join(labels.withColumnRenamed("id", "vertex"), "vertex", "left").select(
            "key", "vertex", F.coalesce("component_id", "vertex").alias("label")
        ),
        "holders",
    )
    apart = placed.groupBy("key").agg(
        F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")
    ).where("n > 2 and low <> high")
    apart = stage(apart.select("key", F.ceil(F.col("n") / HOLDERS).cast("long").alias("blocks")), "apart")
    rest = placed.join(apart, "key").join(about.drop("wide"), "vertex")
    block = F.pmod(F.xxhash64("vertex"), "blocks")
    dealt = rest.withColumn("block", block).withColumn(
        "beside", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    )
    dealt = dealt.select(
        "key", F.least("block", "beside").alias("low"), F.greatest("block", "beside").alias("high"),
        "block", "vertex", "label", "n", "sketch",
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    together = dealt.repartition(parts, "key", "low", "high").sortWithinPartitions("key", "low", "high", "vertex")
    more = together.mapInArrow(frugal(partial(_plausible, percent=percent)), "a long, b long").distinct()
    more = stage(more.join(pairs, ["a", "b"], "left_anti"), "more-pairs")
    more = stage(_possible(more, about, percent), "possible-more-pairs")
    if not more.isEmpty():
        labels = components(links.unionByName(_links(more, named, words, percent)))

    sizes = about.groupBy("vertex").agg(F.max("n").alias("n_shingles"))
    sized = rows.join(sizes, "vertex", "left").join(labels.withColumnRenamed("id", "vertex"), "vertex", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "vertex"))
    return sized.select("doc_id", F.coalesce("n_shingles", F.lit(0)).alias("n_shingles"), component.alias("component_id"))


def survivors(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of linked documents, the smallest id's; rows
    without an id all stay."""
    found = stage(groups(docs, words, percent), "groups")
    gone = stage(found.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    twice = stage(found.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id"), "twice")
    kept = docs.join(small(gone), docs["doc_id"] == gone["doc_id"], "left_anti")
    if twice.isEmpty():
        return kept
    once = kept.join(small(twice), kept["doc_id"] == twice["doc_id"], "left_semi").dropDuplicates(["doc_id"])
    return kept.join(small(twice), kept["doc_id"] == twice["doc_id"], "left_anti").unionByName(once)
