"""Best-fit packing by a grouping genetic algorithm on islands (operator 6).

Texts are encoded whole where they lie; only documents longer than a sequence are cut,
and full pieces are sequences by themselves. All other pieces are dealt into regions of
bounded size. On every region several islands evolve packings of their own: crossover
injects whole well-filled bins of one parent into the other, removes the bins that now
hold a document twice, and best-fits the displaced documents. Between rounds each
island sends its best packing to the next. The few worst bins of each region's best
packing are packed again together with those of other regions.

A null text is an empty one: a piece of the end mark alone. Repeated rows are packed
each. Results do not depend on which executor did what: islands are seeded by number.
"""

from __future__ import annotations

import math
import zlib
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resultlake.llm.common import frugal, numbered_rows, text_batches
from resultlake.llm.tokens import VOCABULARY, encoder
from resultlake.session import stage

LENGTH, END = 2048, 0
# Pieces of a region, islands on each, rounds between migrations, children a round.
REGION, ISLANDS, ROUNDS, CHILDREN, POPULATION = 2048, 2, 2, 6, 4
# Bins at least this full are passed on whole; the worst of a region are packed again.
WELL_FILLED, WORST, POOLED = 0.985, 16, 64
# Bytes of texts handed to Python at a time, beside the encoder's own words.
BATCH_BYTES = 4 * 1024 * 1024


def _pieces(batches, vocabulary: str, length: int):
    encode, end = encoder(vocabulary), np.array([END], "<u4").tobytes()
    step = 4 * length
    for batch in batches:
        out: dict[str, list] = {n: [] for n in ("doc_id", "piece", "start", "length", "ids_crc32")}
        encoded = encode.ids(batch.column(1))
        for doc_id, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
            ids += end
            for piece, at in enumerate(range(0, len(ids), step)):
                part = ids[at : at + step]
                for name, value in zip(out, (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                    out[name].append(value)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH) -> DataFrame:
    """``docs (doc_id, text)`` to ``doc_id, piece, start, length, ids_crc32``."""
    text_batches(docs.sparkSession, BATCH_BYTES)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        frugal(partial(_pieces, vocabulary=vocabulary, length=length)),
        "doc_id long, piece int, start long, length long, ids_crc32 long",
    )


class Packing:
    """Bins as lists of items, with the open bins kept by what is left in them."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.bins: list[list[int]] = []
        self.left: list[int] = []
        self.by_left: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = 0  # bit r: some bin has r left

    def add_bin(self, items: list[int], left: int) -> None:
        self.bins.append(items)
        self.left.append(left)
        self._file(len(self.bins) - 1, left)

    def _file(self, at: int, left: int) -> None:
        self.by_left[left].append(at)
        self.open |= 1 << left

    def best_fit(self, item: int) -> None:
        """Into the bin that it leaves the least room in, else into a new one."""
        need = self.lengths[item]
        fitting = self.open >> need
        if not fitting:
            self.add_bin([item], self.capacity - need)
            return
        left = need + (fitting & -fitting).bit_length() - 1
        stack = self.by_left[left]
        at = stack.pop()
        if not stack:
            self.open ^= 1 << left
        self.bins[at].append(item)
        self.left[at] = left - need
        self._file(at, left - need)

    def fitness(self) -> tuple[int, float]:
        """Fewer bins first, then fuller ones beside emptier ones."""
        return -len(self.bins), sum((self.capacity - r) ** 2 for r in self.left)


def _decreasing(lengths: list[int], capacity: int, noise: np.ndarray | None = None) -> Packing:
    keys = np.array(lengths, float) if noise is None else np.array(lengths) * noise
    packing = Packing(lengths, capacity)
    for item in np.argsort(-keys, kind="stable").tolist():
        packing.best_fit(item)
    return packing


def _cross(one: Packing, other: Packing, rng: np.random.Generator) -> Packing:
    """``one`` with well-filled bins of ``other`` in place of what they duplicate."""
    lengths, capacity = one.lengths, one.capacity
    child = Packing(lengths, capacity)
    room = (1 - WELL_FILLED) * capacity
    well = [at for at, r in enumerate(other.left) if r <= room] or [int(np.argmin(other.left))]
    chosen = rng.random(len(well)) < 0.5
    if not chosen.any():
        chosen[rng.integers(len(well))] = True
    taken = np.zeros(len(lengths), bool)
    for at, use in zip(well, chosen.tolist(), strict=True):
        if use:
            child.add_bin(list(other.bins[at]), other.left[at])
            taken[other.bins[at]] = True
    taken = taken.tolist()
    displaced = []
    for items, left in zip(one.bins, one.left, strict=True):
        free = [i for i in items if not taken[i]]
        # Bins that lost a document go, and so do some that are poorly filled.
        if len(free) == len(items) and (left <= room or rng.random() < 0.5):
            child.add_bin(list(items), left)
        else:
            displaced += free
    displaced.sort(key=lambda i: -lengths[i])
    for item in displaced:
        child.best_fit(item)
    return child


def _evolve(lengths: list[int], capacity: int, population: list[list[list[int]]], seed: int) -> list[list[list[int]]]:
    """Packings, best first. The population given is added to what is made here."""
    rng = np.random.default_rng(seed)
    floor = -(-sum(lengths) // capacity)
    people = [_decreasing(lengths, capacity)]
    for bins in population:
        packing = Packing(lengths, capacity)
        for items in bins:
            packing.add_bin(list(items), capacity - sum(lengths[i] for i in items))
        people.append(packing)
    while len(people) < POPULATION and len(people[0].bins) > floor:
        people.append(_decreasing(lengths, capacity, rng.uniform(0.9, 1.1, len(lengths))))
    people.sort(key=Packing.fitness, reverse=True)
    for _ in range(CHILDREN):
        if len(people[0].bins) <= floor or len(people) < 2:
            break
        one, other = rng.choice(len(people), 2, replace=False)
        people.append(_cross(people[one], people[other], rng))
        people.sort(key=Packing.fitness, reverse=True)
        people = people[:POPULATION]
    return [p.bins for p in people[:POPULATION]]


_STATE = "region long, island int, uids array<long>, lengths array<int>, people array<array<array<int>>>, bins int, squares long"


def _state(region: int, island: int, uids, lengths: list[int], people, capacity: int) -> dict:
    sums = [sum(lengths[i] for i in b) for b in people[0]]
    return dict(
        region=region, island=island, uids=uids, lengths=lengths, people=people, bins=len(people[0]),
        squares=sum(s * s for s in sums),
    )


def _settle(key: tuple, rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    rows = rows.sort_values(["length", "uid"], ascending=[False, True])
    lengths = rows["length"].astype(int).tolist()
    seed = zlib.crc32(f"{key[0]}/{key[1]}".encode())
    people = _evolve(lengths, capacity, [], seed)
    return pd.DataFrame([_state(key[0], key[1], rows["uid"].tolist(), lengths, people, capacity)])


def _next_round(batches, capacity: int, turn: int):
    for rows in batches:
        out = []
        for r in rows.itertuples():
            lengths, bins = [int(x) for x in r.lengths], lambda p: [[int(i) for i in b] for b in p]
            people = [bins(p) for p in r.people] + [bins(r.elite)]
            seed = zlib.crc32(f"{r.region}/{r.island}/{turn}".encode())
            people = _evolve(lengths, capacity, people, seed)
            out.append(_state(r.region, r.island, [int(u) for u in r.uids], lengths, people, capacity))
        yield pd.DataFrame(out, columns=_STATE_NAMES)


_STATE_NAMES = [part.strip().split(" ")[0] for part in _STATE.split(", ")]


def _islands(items: DataFrame, capacity: int, islands: int, rounds: int) -> DataFrame:
    """``items (region, uid, length)`` to the best packing of every region: one row of
    ``region, uids, lengths, packing``."""
    dealt = items.withColumn("island", F.explode(F.array(*(F.lit(i) for i in range(islands)))))
    state = stage(dealt.groupBy("region", "island").applyInPandas(partial(_settle, capacity=capacity), _STATE), "islands")
    for turn in range(1, rounds):
        elites = state.select(
            "region", ((F.col("island") + 1) % islands).alias("island"), F.col("people")[0].alias("elite")
        )
        state = stage(
            state.join(elites, ["region", "island"]).mapInPandas(
                partial(_next_round, capacity=capacity, turn=turn), _STATE
            ),
            "islands",
        )
    best = F.struct(-F.col("bins"), F.col("squares"), -F.col("island"))
    return state.groupBy("region").agg(
        F.max_by(F.struct("uids", "lengths", F.col("people")[0].alias("packing")), best).alias("s")
    ).select("region", "s.*")


_PLACED = "uid long, length long, region long, bin int, place long, pooled boolean"


def _placed(batches, capacity: int, pool: bool):
    """One row per item with its bin and place; the worst bins are marked for pooling."""
    for rows in batches:
        out = []
        for r in rows.itertuples():
            fill = [sum(int(r.lengths[i]) for i in b) for b in r.packing]
            worst = set(np.argsort(fill, kind="stable")[:WORST].tolist()) if pool else set()
            for at, items in enumerate(r.packing):
                place = 0
                poor = at in worst and fill[at] < WELL_FILLED * capacity
                for i in items:
                    out.append((int(r.uids[i]), int(r.lengths[i]), r.region, at, place, poor))
                    place += int(r.lengths[i])
        yield pd.DataFrame(out, columns=["uid", "length", "region", "bin", "place", "pooled"])


def pack(
    lengths: DataFrame, capacity: int = LENGTH, region: int = REGION, islands: int = ISLANDS, rounds: int = ROUNDS
) -> DataFrame:
    """``lengths (uid, length)``, uid unique and 1 <= length <= capacity, to ``uid,
    sequence_id, offset``."""
    full = lengths.where(F.col("length") >= capacity).select(
        "uid", (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    short = lengths.where(F.col("length") < capacity)
    regions = max(1, math.ceil(short.count() / region))
    items = short.select(F.pmod(F.xxhash64("uid"), F.lit(regions)).alias("region"), "uid", "length")
    first = stage(
        _islands(items, capacity, islands, rounds).mapInPandas(partial(_placed, capacity=capacity, pool=True), _PLACED),
        "placed",
    )
    again = first.where("pooled").select(F.floor(F.col("region") / POOLED).cast("long").alias("region"), "uid", "length")
    second = _islands(again, capacity, islands, rounds).mapInPandas(
        partial(_placed, capacity=capacity, pool=False), _PLACED
    )

    def named(rows: DataFrame, turn: int) -> DataFrame:
        sequence = ((F.col("region") * 2 + turn) * (1 << 20) + F.col("bin")).alias("sequence_id")
        return rows.select("uid", sequence, F.col("place").alias("offset"))

    return full.unionByName(named(first.where(~F.col("pooled")), 0)).unionByName(named(second, 1))


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH, **options) -> DataFrame:
    """Every piece of every document with its place."""
    rows = numbered_rows(pieces(docs, vocabulary, length), "uid", "pieces")
    return rows.join(pack(rows.select("uid", "length"), length, **options), "uid").drop("uid")
