"""Phrase collocation mining with Rabin-Karp fingerprints (operator 13).

Every n-gram of one to four words is hashed where its text lies: a word's code is a
polynomial of its bytes, an n-gram's fingerprint the difference of two prefix
polynomials of the codes, so numpy gives all of them at once and no phrase is ever made
a string. Language and length are mixed in; "no words at all" is the n-gram of length
zero, found once for each word, whose count is the language's size.

A task sums up equal fingerprints and hands on sorted blocks of them, dealt by range of
fingerprint: fingerprint, a second hash, count, and the document of one occurrence.
Whoever has a range adds up its blocks; what reaches the least count keeps two
documents as pointers. Only those documents are read again: the phrase is found in the
text by its fingerprint and taken from there. Fingerprints that agree while the second
hash does not are different phrases; where the two documents show different texts all
the same, the run is repeated with other polynomials.

Counts, scores and containment are then joins of the frequent phrases alone, in exact
integers. A range holds a bounded share of the corpus and a task gives a phrase to it
at most once a block, so no phrase, however common, makes a group of its occurrences.

A null text is an empty one; a null language is ``und``. Repeated rows count as often
as they are there. Texts of any length are taken whole. Extra columns are ignored and
an empty table gives an empty one. Bytes that are no UTF-8 cannot occur in a string.
"""

from __future__ import annotations

from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from resultlake.llm.common import small, text_batches
from resultlake.session import stage

LEAST, LONGEST, TOP = 30, 4, 2000
#: A candidate goes if a longer one around it has this percentage of its count.
COVERED = 80
# Occurrences a task holds before it sums them up; ranges for every split of the input.
HELD, RANGES_PER_SPLIT = 3_000_000, 4
# Bytes whose words are coded at a time.
CHUNK = 1 << 20
UNKNOWN = "und"
# Slices of a language that are ranked by themselves first.
RANK_SLICES = 64

# What a byte is: 0 of a word, 1 between words, 2 between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Polynomials:
    """Bases, their powers and the values of bytes, all drawn from one seed."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.byte = rng.integers(0, 2**63, 256, np.uint64)
        self.byte[65:91] = self.byte[97:123]  # A-Z are a-z
        odd = (rng.integers(0, 2**62, 3, np.uint64) * np.uint64(2) + np.uint64(1)).tolist()
        self.bases = [(b, pow(b, -1, 2**64)) for b in odd]
        self.seed = seed
        self.tables: dict[tuple[int, int], np.ndarray] = {}

    def powers(self, which: int, inverse: int, count: int) -> np.ndarray:
        known = self.tables.get((which, inverse))
        if known is None or len(known) < count:
            size = max(1024, 1 << (count - 1).bit_length()) if count else 1024
            steps = np.full(size, self.bases[which][inverse], np.uint64)
            steps[0] = 1
            known = self.tables[which, inverse] = np.cumprod(steps, dtype=np.uint64)
        return known[:count]

    def language(self, lang: str) -> int:
        return xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"), self.seed)

    def word_codes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        codes = np.empty(len(starts), np.uint64)
        sizes = ends - starts
        at, total = 0, np.cumsum(sizes)
        while at < len(starts):
            done = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, done + CHUNK, "right")))
            size = sizes[at:to]
            first = np.cumsum(size) - size
            place = np.arange(int(size.sum())) - np.repeat(first, size)
            values = self.byte[data[place + np.repeat(starts[at:to], size)]]
            values *= self.powers(0, 0, int(size.max()))[place]
            codes[at:to] = np.add.reduceat(values, first)
            at = to
        return _mix(codes + sizes.astype(np.uint64))

    def windows(self, codes: np.ndarray, which: int) -> list[np.ndarray]:
        """Fingerprints of 1 to LONGEST words from every word on, by prefix sums."""
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * self.powers(which, 0, len(codes)), out=sums[1:])
        back = self.powers(which, 1, len(codes))
        return [
            (sums[n:] - sums[: len(sums) - n]) * back[: len(codes) - n + 1] for n in range(1, min(LONGEST, len(codes)) + 1)
        ]


@lru_cache(maxsize=2)
def polynomials(seed: int) -> Polynomials:
    return Polynomials(seed)


class Ngrams:
    """All n-grams of a column of texts: ``fp``, ``check``, ``doc`` (the row), ``word``
    (of the batch, where it begins) and ``n``, in arrays per n."""

    def __init__(self, langs: list[str], texts: pa.Array, poly: Polynomials):
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        held = texts.buffers()[2]
        self.data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
        low, high = int(offsets[0]), int(offsets[-1])
        self.data, offsets = self.data[low:high], offsets - low
        kind = _KIND[self.data]
        inside = np.zeros(len(kind) + 2, bool)
        inside[1:-1] = kind == 0
        edge = np.zeros(len(kind) + 1, bool)
        edge[offsets] = True  # a text ends where the next one begins
        self.starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
        self.ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
        self.doc = np.searchsorted(offsets, self.starts, "right") - 1
        piece = np.cumsum(kind == 2, dtype=np.int64)[self.starts] if len(self.starts) else np.zeros(0, np.int64)
        piece += self.doc * (len(kind) + 1)
        codes = poly.word_codes(self.data, self.starts, self.ends)
        named = {lang: poly.language(lang) for lang in set(langs)}
        self.langs, self.poly = langs, poly
        key = np.array([named[lang] for lang in langs], np.uint64)
        self.found = []
        if len(codes):
            both = zip(poly.windows(codes, 1), poly.windows(codes, 2), strict=True)
            for n, (one, other) in enumerate(both, 1):
                whole = piece[n - 1 :] == piece[: len(piece) - n + 1]
                word = np.flatnonzero(whole)
                salt = key[self.doc[word]] + np.uint64(n)
                check = (_mix(other[word] + salt) >> np.uint64(48)).astype(np.uint16)
                self.found.append((n, _mix(one[word] ^ _mix(salt)), check, self.doc[word], word))
        # Length zero: once for every word of the text.
        words = np.bincount(self.doc, minlength=len(langs))
        has = np.flatnonzero(words)
        self.sizes = (_mix(key[has]), np.zeros(len(has), np.uint16), has, words[has])

    def phrase(self, word: int, n: int) -> str:
        """Words in lower case; bytes know no other letters than A-Z."""
        parts = [self.data[self.starts[i] : self.ends[i]].tobytes().lower() for i in range(word, word + n)]
        return b" ".join(parts).decode("utf-8")


# -- counting ---------------------------------------------------------------
_BLOCK = "slot int, entries long, packed binary"


# The columns of a block, each laid out by rank of bytes, so that like stands beside like.
_COLUMNS = [np.uint64, np.uint16, np.uint32, np.uint32]


def _packed(columns: list[np.ndarray], keys: np.ndarray) -> bytes:
    raw = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T).tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join([*raw, keys.tobytes()]))


def _unpacked(entries: int, packed: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    columns, at = [], 0
    for kind in _COLUMNS:
        size = np.dtype(kind).itemsize
        planes = raw[at : at + size * entries].reshape(size, entries)
        columns.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += size * entries
    return columns, raw[at:].view(np.int64) if at < len(raw) else np.zeros(0, np.int64)


def _slices(batches, column: int):
    """Batches cut into stretches of about CHUNK bytes of text, a text at least."""
    for batch in batches:
        total = np.cumsum(pa.compute.binary_length(batch.column(column).fill_null("")).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, done + CHUNK, "right")))
            yield batch.slice(at, to - at)
            at = to


def _summed(fp: np.ndarray, check: np.ndarray, count: np.ndarray | None):
    """Order, first rows of the groups of equal ``(fp, check)`` in it, and their sums."""
    order = np.argsort(fp, kind="stable")
    sorted_fp, sorted_check = fp[order], check[order]
    same = sorted_fp[1:] == sorted_fp[:-1]
    if (same & (sorted_check[1:] != sorted_check[:-1])).any():
        order = np.lexsort((check, fp))
        sorted_fp, sorted_check = fp[order], check[order]
        same = (sorted_fp[1:] == sorted_fp[:-1]) & (sorted_check[1:] == sorted_check[:-1])
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(fp)), bool), ~same]))
    if count is None:
        sums = np.diff(np.append(first, len(fp)))
    else:
        sums = np.add.reduceat(count[order], first) if len(first) else np.zeros(0, np.int64)
    return order, first, sums


def _blocks(batches, ranges: int, seed: int, hold: int):
    poly = polynomials(seed)
    held: list[tuple] = []
    sizes: dict[int, list[int]] = {}
    keys: list[np.ndarray] = []
    waiting = documents = 0

    def summed():
        nonlocal waiting, documents
        fp, check, doc = (np.concatenate([h[i] for h in held]) for i in range(3))
        order, first, count = _summed(fp, check, None)
        pick = order[first]
        fp, check, doc = fp[pick], check[pick], doc[pick]
        if sizes:
            extra = np.array(list(sizes), np.uint64)
            fp = np.concatenate([fp, extra])
            check = np.concatenate([check, np.zeros(len(extra), np.uint16)])
            count = np.concatenate([count, [v[0] for v in sizes.values()]])
            doc = np.concatenate([doc, np.array([v[1] for v in sizes.values()], doc.dtype)])
            order = np.argsort(fp, kind="stable")
            fp, check, count, doc = fp[order], check[order], count[order], doc[order]
        known = np.concatenate(keys)
        slot = ((fp >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
        edges = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1], [True]]))
        rows = []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            used, place = np.unique(doc[a:b], return_inverse=True)
            steps = np.diff(fp[a:b], prepend=np.uint64(0))
            columns = [steps, check[a:b], count[a:b].astype(np.uint32), place.astype(np.uint32)]
            rows.append((int(slot[a]), b - a, _packed(columns, known[used])))
        held.clear(), sizes.clear(), keys.clear()
        waiting = documents = 0
        kinds = [pa.int32(), pa.int64(), pa.binary()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["slot", "entries", "packed"])

    for batch in _slices(batches, 2):
        grams = Ngrams(batch.column(1).to_pylist(), batch.column(2), poly)
        keys.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
        for _, fp, check, doc, _ in grams.found:
            held.append((fp, check, (doc + documents).astype(np.uint32)))
            waiting += len(fp)
        fp, _, doc, words = grams.sizes
        for f, d, w in zip(fp.tolist(), doc.tolist(), words.tolist(), strict=True):
            known = sizes.setdefault(f, [0, d + documents])
            known[0] += w
        documents += batch.num_rows
        if waiting >= hold:
            yield summed()
    if waiting:
        yield summed()


_FREQUENT = "fp long, check int, f long, first long, last long"


def _frequent(batches, least: int):
    """Blocks sorted by slot; one slot is added up at a time."""
    held: list[tuple] = []
    now = None

    def added():
        fp, check, count, key = (np.concatenate([h[i] for h in held]) for i in range(4))
        order, first, sums = _summed(fp, check, count)
        often = sums >= least
        lowest = np.minimum.reduceat(key[order], first)[often]
        highest = np.maximum.reduceat(key[order], first)[often]
        pick = order[first][often]
        columns = [fp[pick].view(np.int64), check[pick].astype(np.int32), sums[often], lowest, highest]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["fp", "check", "f", "first", "last"])

    for batch in batches:
        for slot, entries, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if slot != now and held:
                yield added()
                held.clear()
            now = slot
            (steps, check, count, place), keys = _unpacked(entries, packed)
            held.append((np.cumsum(steps, dtype=np.uint64), check, count.astype(np.int64), keys[place]))
    if held:
        yield added()


# -- phrases ----------------------------------------------------------------
def _materialised(batches, seed: int):
    poly = polynomials(seed)
    for batch in _slices(batches, 1):
        grams = Ngrams(batch.column(0).to_pylist(), batch.column(1), poly)
        out: list[tuple] = []
        wanted = [np.unique(np.array(w, np.int64)) for w in batch.column(2).to_pylist()]
        parts = [(n, fp, check, doc, word) for n, fp, check, doc, word in grams.found]
        fp, check, doc, words = grams.sizes
        parts.append((0, fp, check, doc, np.zeros(len(fp), np.int64)))
        for n, fp, check, doc, word in parts:
            edges = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            for row in range(batch.num_rows):
                here = slice(edges[row], edges[row + 1])
                mine = fp[here].view(np.int64)
                at = np.flatnonzero(np.isin(mine, wanted[row]))
                if len(at):
                    _, first = np.unique(np.stack([mine[at], check[here][at]]), axis=1, return_index=True)
                    for i in at[first].tolist():
                        out.append((int(mine[i]), int(check[here][i]), grams.langs[row], n, grams.phrase(int(word[here][i]), n)))
        kinds = [pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.string()]
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["fp", "check", "lang", "n", "phrase"]
        )


def frequent_phrases(docs: DataFrame, least: int = LEAST, seed: int = 1, hold: int = HELD) -> DataFrame:
    """``docs (doc_id, text, lang)`` to ``lang, n, phrase, f``: all phrases of up to
    LONGEST words found so often, and for each language the empty phrase of no words,
    whose ``f`` is the number of its words."""
    spark = docs.sparkSession
    text_batches(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.xxhash64(F.col("doc_id").cast("long"), text).alias("key"),
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        text.alias("text"),
    )
    ranges = RANGES_PER_SPLIT * max(1, rows.rdd.getNumPartitions())
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ranges // 2)
    blocks = rows.mapInArrow(partial(_blocks, ranges=ranges, seed=seed, hold=hold), _BLOCK)
    dealt = blocks.repartition(parts, "slot").sortWithinPartitions("slot")
    often = stage(dealt.mapInArrow(partial(_frequent, least=least), _FREQUENT), "frequent-fingerprints")

    pointers = often.select("fp", F.explode(F.array_distinct(F.array("first", "last"))).alias("key"))
    wanted = stage(pointers.groupBy("key").agg(F.collect_list("fp").alias("fps")), "pointers")
    # A document is found by its key; repeated rows give the same phrases.
    shown = rows.join(small(wanted), "key").select("lang", "text", "fps")
    told = shown.mapInArrow(
        partial(_materialised, seed=seed), "fp long, check int, lang string, n int, phrase string"
    )
    seen = told.groupBy("fp", "check").agg(
        F.min(F.struct("lang", "n", "phrase")).alias("one"), F.max(F.struct("lang", "n", "phrase")).alias("other")
    )
    seen = stage(often.join(seen, ["fp", "check"]).select("one", "other", "f"), "frequent-phrases")
    if not seen.where("one <> other").isEmpty():
        return frequent_phrases(docs, least, seed + 1, hold)
    return seen.select("one.lang", "one.n", "one.phrase", "f")


# -- scores -----------------------------------------------------------------
def _part(words, start, length):
    return F.array_join(F.slice(words, start, length), " ")


def scored(phrases: DataFrame, covered: int = COVERED) -> DataFrame:
    """Frequent phrases to ``lang, phrase, a, l, r, n, score``, one row per candidate
    that no longer candidate covers. All arithmetic is in exact integers."""
    words = F.split("phrase", " ")
    candidates = phrases.where("n > 1").select("lang", "phrase", "n", F.col("f").alias("a"), words.alias("words"))
    cuts = candidates.select(
        "lang", "phrase", "a", "n", "words", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k")
    ).select(
        "lang", "phrase", "a", "k",
        _part("words", F.lit(1), F.col("k")).alias("left"),
        _part("words", F.col("k") + 1, F.col("n") - F.col("k")).alias("right"),
    )
    counts = phrases.where("n > 0")
    left = small(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")))
    right = small(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")))
    cut = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    wide = "decimal(38,0)"
    score = F.expr(f"(2000000BD * cast(a as {wide})) div (cast(l as {wide}) + cast(r as {wide}))")
    best = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("n") - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.col("n") - size + 1), lambda start: _part(F.col("words"), start, size)
            ),
        )
    )
    inside = candidates.where("n > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "a")
    around = inside.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    exceeds = F.expr(f"100BD * cast(around as {wide}) >= {int(covered)}BD * cast(a as {wide})")
    alone = best.join(small(around), ["lang", "phrase"], "left").where(~F.coalesce(exceeds, F.lit(False)))
    sizes = small(phrases.where("n = 0").select("lang", F.col("f").alias("n")))
    return alone.join(sizes, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, covered: int = COVERED, **options) -> DataFrame:
    """The best-scoring phrases of every language: ``lang, rank, phrase, a, l, r, n,
    score``."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # What leads a language leads its slice of it, so no task ranks a whole language.
    sliced = scored(frequent_phrases(docs, least, **options), covered).withColumn(
        "slice", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SLICES))
    )
    within = F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))
    leading = sliced.withColumn("within", within).where(F.col("within") <= top)
    ranked = leading.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    ranked = ranked.where(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("long"))
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
