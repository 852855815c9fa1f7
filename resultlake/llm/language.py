"""Language identification by bit-sliced n-gram filters (operator 9).

Three-letter grams, word ends included, are counted per language over the rows to
learn from. A gram belongs to every language that uses it often enough compared with
the language that uses it most. All languages share one Bloom filter whose slots hold
a mask of languages instead of a bit: the AND of a gram's slots is the set of all
languages that contain it. A text is decided by the languages' popcounts over its
grams, corrected for the share of false positives that each language's fill implies.

Null texts and texts without a letter are ``und`` with score 0; ties go to the
language first by code point; a text whose grams no language has goes to the most
common language with score 0; with nothing to learn from all texts are ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resultlake.llm.common import col, fresh, frugal, give_back, learnable, text_batches
from resultlake.session import stage

UNKNOWN = "und"
PREDICTION = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
# Slots of the filter (a power of two, which bounds the model), and probes of a gram.
SLOT_BITS, PROBES = 20, 3
# A gram is rare below this count; a language has it from this share of the largest.
LEAST_COUNT, LEAST_SHARE = 3, 0.4
# Languages of one mask; more languages take more masks.
MASK_BITS = 62
# Grams a task holds while it counts (16 bytes each), and bytes of texts in one batch.
HELD, BATCH_BYTES = 2**20, 4 * 1024 * 1024


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> np.ndarray:
    """64-bit mixed codes of a text's three-letter grams; a run of other characters
    counts as one word end. Different grams have different codes."""
    raw = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = np.where(_letters()[raw], raw, 0)
    if not letters.any():
        return np.empty(0, np.uint64)
    c = np.zeros(len(letters) + 2, np.uint64)
    c[1:-1] = letters
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 0) | (c[:-1] != 0)
    c = c[keep]
    if c[-1] != 0:
        c = np.append(c, np.uint64(0))
    x = c[:-2] | (c[1:-1] << np.uint64(21)) | (c[2:] << np.uint64(42))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(place, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)


def _counts(batches):
    """Gram counts per language; a task gives out what it holds, one count per distinct
    gram, whenever that is more than ``HELD`` grams."""
    found: dict[str, list] = {}
    waiting = 0

    def summed():
        for lang, parts in found.items():
            codes, counts = _merged(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes), pa.string()), pa.array(codes.view(np.int64)), pa.array(counts)],
                names=["lang", "gram", "n"],
            )

    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            g = grams(text.as_py())
            if not len(g):
                continue
            parts = found.setdefault(lang, [])
            parts.append(np.unique(g, return_counts=True))
            waiting += len(parts[-1][0])
            if waiting > HELD:
                found = {x: [_merged(held)] for x, held in found.items()}
                waiting = sum(len(held[0][0]) for held in found.values())
                if waiting > HELD // 2:
                    yield from summed()
                    found, waiting = {}, 0
    yield from summed()


@dataclass
class LanguageFilters:
    languages: list[str]  # by code point
    common: int  # index of the most common one
    masks: np.ndarray  # slots x words of languages
    false_positives: np.ndarray  # per language
    slot_bits: int = SLOT_BITS

    def hits(self, g: np.ndarray) -> np.ndarray:
        """For every language the number of grams whose slots all name it."""
        low = np.uint64(len(self.masks) - 1)
        found = self.masks[(g & low).astype(np.int64)]
        for probe in range(1, PROBES):
            found = found & self.masks[((g >> np.uint64(probe * self.slot_bits)) & low).astype(np.int64)]
        return np.array(
            [
                np.count_nonzero(found[:, i // MASK_BITS] & np.uint64(1 << (i % MASK_BITS)))
                for i in range(len(self.languages))
            ]
        )

    def predict(self, text: str | None) -> tuple[str, float]:
        g = grams(text)
        if not len(g) or not self.languages:
            return UNKNOWN, 0.0
        fp = self.false_positives
        rate = np.maximum(0.0, (self.hits(g) / len(g) - fp) / np.maximum(1e-9, 1 - fp))
        total, best = rate.sum(), int(rate.argmax())
        return (self.languages[best], float(rate[best] / total)) if total > 0 else (self.languages[self.common], 0.0)


def learn(docs: DataFrame, slot_bits: int = SLOT_BITS) -> LanguageFilters:
    """Filters from ``docs (doc_id, text, lang)``. The driver receives the filter: at
    most ``2 ** slot_bits`` slots, whatever the corpus."""
    text_batches(docs.sparkSession, BATCH_BYTES)
    rows = docs.where(learnable(F.col("doc_id"))).where("text is not null and lang is not null")
    counted = rows.select(F.col("text").cast("string"), F.col("lang").cast("string")).mapInArrow(
        frugal(_counts), "lang string, gram long, n long"
    )
    counts = stage(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    words = -(-len(languages) // MASK_BITS) or 1
    masks = np.zeros((2**slot_bits, words), np.uint64)
    if not languages:
        return LanguageFilters([], 0, masks, np.zeros(0), slot_bits)
    spark = docs.sparkSession
    known = spark.createDataFrame(
        [(x, i // MASK_BITS, 1 << (i % MASK_BITS), float(totals[x])) for i, x in enumerate(languages)],
        "lang string, word int, mask long, total double",
    )
    shares = counts.join(F.broadcast(known), "lang").withColumn("share", F.col("n") / F.col("total"))
    most = F.max("share").over(Window.partitionBy("gram"))  # a row per language at most
    members = shares.withColumn("most", most).where(
        (F.col("n") >= LEAST_COUNT) & (F.col("share") >= LEAST_SHARE * F.col("most"))
    )
    slots = F.array(
        *(F.shiftrightunsigned("gram", slot_bits * p).bitwiseAND(2**slot_bits - 1) for p in range(PROBES))
    )
    filled = (
        members.select(F.explode(slots).alias("slot"), "word", "mask")
        .groupBy("slot", "word")
        .agg(F.bit_or("mask").alias("mask"))
        .toArrow()
    )
    masks[filled["slot"].to_numpy(), filled["word"].to_numpy()] = filled["mask"].to_numpy().astype(np.uint64)
    fill = [
        np.count_nonzero(masks[:, i // MASK_BITS] & np.uint64(1 << (i % MASK_BITS))) / len(masks)
        for i in range(len(languages))
    ]
    common = max(range(len(languages)), key=lambda i: (totals[languages[i]], -i))
    return LanguageFilters(languages, common, masks, np.array(fill) ** PROBES, slot_bits)


def predictor(docs: DataFrame, filters: LanguageFilters):
    """``Column -> Column``: ``struct(lang_pred, score)`` of whole texts."""
    model = docs.sparkSession.sparkContext.broadcast(filters)

    @F.arrow_udf(PREDICTION)
    def predicted(texts: pa.Array) -> pa.Array:
        found = [model.value.predict(t.as_py()) for t in texts]
        give_back()
        return pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
            names=["lang_pred", "score"],
        )

    return predicted


def identify(docs: DataFrame, filters: LanguageFilters | None = None, name: str = "language") -> DataFrame:
    """All columns of ``docs`` and the prediction in a struct named ``name`` (with
    leading underscores if that name is taken). Filters are learned from ``docs``
    themselves if none are given."""
    text_batches(docs.sparkSession, BATCH_BYTES)
    filters = filters or learn(docs)
    found = predictor(docs, filters)(F.col("text").cast("string"))
    return docs.select(*(col(c) for c in docs.columns), found.alias(fresh(docs, name)))


def accepted(prediction: Column, least_score: float = 0.0) -> Column:
    """Texts with a language whose score is above ``least_score``; by default all that
    hold any gram of some language."""
    return (prediction["lang_pred"] != UNKNOWN) & (prediction["score"] > least_score)
