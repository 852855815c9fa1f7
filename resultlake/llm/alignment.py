"""Cross-tokenizer alignment over a minimal perfect hash of id pairs (operator 12).

Two vocabularies encode the same bytes. A token of one and a token of the other are
linked where their byte ranges overlap; byte offsets at which tokens of both end cut
the tokens into groups. Cutting the bytes at all ends of either side gives one segment
for every link, so both come from two sorted arrays of ends. Neither vocabulary has a
token that goes on past a word into the next space, so a word is encoded and aligned
alike wherever it stands: new words are aligned as they come, known ones are remembered.

The first pass aligns all documents and hands on, a task at a time, the distinct id
pairs with their numbers of links, dealt by a hash of the pair into parts. Each part
gets a minimal perfect hash: keys take their place in a bit array, those that collide
go on to the next, and a key's slot is the number of bits set before its own. Counts
are then dense vectors over slots, summed up as a tree: tasks into branches, branches
into one vector a part, beside a vector of the keys that verifies every lookup. The
second pass aligns the documents again and looks the counts up.

Pairs are at most the product of the two vocabularies and in practice far fewer; hash,
keys and counts are broadcast if they fit, else documents' pairs are dealt to the
parts, looked up there, and summed up per document. Either way gives the same rows.

Texts that are null or empty, or that one vocabulary does not give back byte for byte,
have no tokens: zeros and an empty text of groups. Repeated rows count as often as they
are there and each gets its result. Texts of any length are taken whole; memory grows
with the longest. Extra columns are ignored; an empty table gives an empty one. Strings
of special tokens inside a text are plain text.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from functools import lru_cache, partial
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resultlake.llm.common import text_batches
from resultlake.session import BROADCAST_BYTES, stage

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Parts that pairs are dealt to, and branches of the tree that sums up a part.
PARTS, BRANCHES = 64, 16
# Pairs a task holds before it hands them on; texts encoded together.
HELD, TOGETHER = 2_000_000, 256
# Words a worker remembers, and bytes of them and of their groups.
WORDS, WORD_BYTES = 900_000, 180_000_000
# Bits of a level of the hash for every key left.
ROOM = 2


# -- tokens -----------------------------------------------------------------
def _place(vocabulary: str) -> str:
    import public_tokenizers

    return vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)


def _byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones
    for themselves, all others, in order, for the characters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteVocabulary:
    """A byte-level vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.model.no_truncation()
        self.model.no_padding()
        alphabet = _byte_alphabet()
        known = self.model.get_vocab()
        self.tokens = [b""] * (max(known.values()) + 1)
        for token, i in known.items():
            self.tokens[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        encoded = self.model.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [e.ids for e in encoded]

    def words_apart(self) -> bool:
        """True if the file's own splitter, which no token crosses, cuts before a space."""
        parts = self.model.pre_tokenizer.pre_tokenize_str(" a b. 1 2 é' c")
        return [len(p.lstrip("Ġ")) < len(p) for p, _ in parts].count(True) == 6


class PieceVocabulary:
    """A model file of the sentencepiece library; it puts a space before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokens = []
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            byte = self.model.is_byte(i)
            self.tokens.append(bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def words_apart(self) -> bool:
        """True if no token goes on past the end of a word into a space."""
        return not any(b" " in token.lstrip(b" ") for token in self.tokens)


@lru_cache(maxsize=4)
def vocabulary(name: str):
    """One per worker and file."""
    return (PieceVocabulary if name.endswith(".model") else ByteVocabulary)(_place(name))


# -- alignment --------------------------------------------------------------
class Aligner:
    def __init__(self, first: str, second: str):
        self.sides = [vocabulary(first), vocabulary(second)]
        self.sizes = [np.array([len(t) for t in v.tokens], np.int64) for v in self.sides]
        self.base = len(self.sides[1].tokens)
        # A token's id followed by each mark that may come after it.
        self.marked = [
            np.array([f"{i}{mark}" for mark in (",", last) for i in range(len(v.tokens))], object)
            for v, last in zip(self.sides, ("|", ";"), strict=True)
        ]

    def aligned(self, text: str):
        """None if a side does not give the text back, else the ids of both sides, for
        each link the positions of its two tokens and its last byte, and for each group
        the positions behind its last tokens and its last byte."""
        whole = b" " + text.encode("utf-8", "surrogatepass")
        ids, ends = [np.array(side.encode([text])[0], np.int64) for side in self.sides], []
        for side, sizes, i in zip(self.sides, self.sizes, ids, strict=True):
            ends.append(np.cumsum(sizes[i]))
            if not len(i) or ends[-1][-1] != len(whole) or b"".join([side.tokens[t] for t in i.tolist()]) != whole:
                return None
        marks = np.zeros((2, len(whole) + 1), bool)
        for mark, end in zip(marks, ends, strict=True):
            mark[end] = True
        cuts, both = np.flatnonzero(marks[0] | marks[1]), np.flatnonzero(marks[0] & marks[1])
        # A byte belongs to the token that has as many ends before it as its position.
        before = [np.cumsum(mark, dtype=np.int32) for mark in marks]
        links, edges = [n[cuts - 1] for n in before], [n[both].astype(np.int64) for n in before]
        return ids, ends, (links, cuts), (edges, both)

    def pairs(self, ids, links) -> np.ndarray:
        return ids[0][links[0]] * self.base + ids[1][links[1]]

    def marked_ids(self, ids, edges) -> tuple[list[str], np.ndarray]:
        """Ids with the mark that follows each in ``a1,a2|b1;a3|b2``, in that order, and
        the number of ids up to each group's end."""
        parts, order = [], []
        for side, (i, edge) in enumerate(zip(ids, edges, strict=True)):
            mark = np.zeros(len(i), np.int64)
            mark[edge - 1] = 1
            parts.append(self.marked[side][mark * len(self.sides[side].tokens) + i])
            order.append(2 * np.searchsorted(edge, np.arange(len(i)), "right") + side)
        order = np.argsort(np.concatenate(order), kind="stable")
        return np.concatenate(parts)[order].tolist(), edges[0] + edges[1]


# -- words --------------------------------------------------------------------
_SPACES = "[\\x{9}-\\x{d}\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
# White space beside white space, or at an end of the text.
_UNEVEN = f"{_SPACES}{_SPACES}|\\A{_SPACES}|{_SPACES}\\z"
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


def split_words(text: str) -> list[str]:
    """Cut a text at each single space between two characters that are no white space;
    what is cut there is encoded alike alone and in the text."""
    return _BETWEEN.split(text)


class Words:
    """What is known of the words met so far: both vocabularies end a token at the end
    of a word, so tokens, groups and links of a text are those of its words in order,
    and a word met before is not aligned again. New words are aligned many at a time,
    as one text. Without room for more, all are forgotten."""

    def __init__(self, align: Aligner, shown: bool):
        self.align, self.shown, self.table, self.highest, self.run = align, shown, None, None, None
        self.apart = all(side.words_apart() for side in align.sides)
        self.forget()

    def look_up(self, run: str, rows: list[dict], best: list[tuple[int, int]]) -> None:
        """Count by this run's table from now on."""
        if self.run == run:
            return
        self.forget()
        self.run, self.table = run, PairTable(rows)
        self.highest = np.zeros(self.align.base, np.int64)
        for i, count in best:
            self.highest[i] = count

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.texts: list[str] = []
        self.bytes = 0
        # Per word: tokens of both sides, groups, links, best links, sum of counts (the
        # first is -1 where a side does not give the word back).
        self.stats = np.zeros((1024, 6), np.int64)
        self.pair_ends = np.zeros(1024, np.int64)
        self.pairs: list[np.ndarray] = []
        self.times = np.zeros(1024, np.int64)

    @property
    def full(self) -> bool:
        return len(self.index) > WORDS or self.bytes > WORD_BYTES

    def of(self, texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
        """The numbers of each text's words, and the sums of their ``stats``; none and
        zeros for texts without tokens."""
        texts = texts.fill_null("")
        uneven = pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False)
        numbers: list[np.ndarray] = [np.zeros(0, np.int64)] * len(texts)
        sums = np.zeros((len(texts), 6), np.int64)
        for chosen in (np.flatnonzero(~uneven), np.flatnonzero(uneven)):
            if not len(chosen):
                continue
            some = texts.take(pa.array(chosen))
            if not self.apart:
                split = pa.array([[t] for t in some.to_pylist()], pa.list_(pa.string()))
            elif uneven[chosen[0]]:
                split = pa.array([split_words(t) for t in some.to_pylist()], pa.list_(pa.string()))
            else:
                split = pc.split_pattern(some, " ")
            coded = split.flatten().dictionary_encode()
            known = self._numbers(coded.dictionary.to_pylist(), self.apart and not uneven[chosen[0]])
            known = known[coded.indices.to_numpy()]
            edges = split.offsets.to_numpy() - split.offsets[0].as_py()
            stats = self.stats[known]
            total = np.add.reduceat(stats, edges[:-1], axis=0)
            good = np.minimum.reduceat(stats[:, 0], edges[:-1]) > 0
            sums[chosen[good]] = total[good]
            for row, a, b, fine in zip(chosen.tolist(), edges[:-1].tolist(), edges[1:].tolist(), good.tolist(), strict=True):
                if fine:
                    numbers[row] = known[a:b]
        return numbers, sums

    def _numbers(self, words: list[str], even: bool) -> np.ndarray:
        numbers = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(numbers < 0)
        new = [words[i] for i in missing.tolist()]
        # Words with white space at an end are none that a text was cut at.
        apart = [] if even and "" not in new else [w for w in new if not w or w[0].isspace() or w[-1].isspace()]
        first = len(self.index)
        if not apart:
            self._learn(new)  # numbered as they come
            numbers[missing] = np.arange(first, first + len(new))
            return numbers
        self._learn([w for w in new if w and not (w[0].isspace() or w[-1].isspace())])
        for word in apart:
            self._learn([word])
        numbers[missing] = [self.index[w] for w in new]
        return numbers

    def _learn(self, words: list[str]) -> None:
        if not words:
            return
        # No word at all is a text without tokens, though a space stands for it.
        found = self.align.aligned(" ".join(words)) if words != [""] else None
        if found is None and len(words) > 1:
            self._learn(words[: len(words) // 2])
            self._learn(words[len(words) // 2 :])
            return
        first, count = len(self.index), len(words)
        while first + count > len(self.stats):
            self.stats = np.concatenate([self.stats, np.zeros_like(self.stats)])
            self.pair_ends = np.concatenate([self.pair_ends, np.zeros_like(self.pair_ends)])
            self.times = np.concatenate([self.times, np.zeros_like(self.times)])
        mine = slice(first, first + count)
        self.index.update(zip(words, range(first, first + count), strict=True))
        sizes = np.array([len(w.encode("utf-8", "surrogatepass")) + 1 for w in words])
        self.bytes += int(sizes.sum())
        before = self.pair_ends[first - 1] if first else 0
        if found is None:
            self.stats[first, 0], self.pair_ends[first] = -1, before
            self.texts.append("")
            return
        ids, ends, (links, cuts), (edges, both) = found
        word_ends = np.cumsum(sizes)
        for column, at in enumerate([*ends, both, cuts]):
            self.stats[mine, column] = np.diff(np.searchsorted(at, word_ends, "right"), prepend=0)
        pairs = self.align.pairs(ids, links)
        self.pairs.append(pairs)
        self.pair_ends[mine] = before + np.cumsum(self.stats[mine, 3])
        if self.table is not None:
            self._count(mine, pairs)
        if self.shown:
            marked, upto = self.align.marked_ids(ids, edges)
            stops = upto[np.cumsum(self.stats[mine, 2]) - 1].tolist()
            self.bytes += 4 * len(marked)
            self.texts += ["".join(marked[a:b]) for a, b in zip([0, *stops[:-1]], stops, strict=True)]

    def _count(self, words: slice, pairs: np.ndarray) -> None:
        counts = self.table.counts[self.table.verified(pairs)]
        best = counts == self.highest[pairs % self.align.base]
        ends = np.cumsum(np.maximum(self.stats[words, 3], 0))
        for column, values in ((4, best), (5, counts)):
            sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[ends]
            self.stats[words, column] = np.diff(sums, prepend=0)

    def groups_text(self, numbers: np.ndarray) -> str:
        return "".join(map(self.texts.__getitem__, numbers.tolist()))[:-1]

    def pairs_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs of some words and their numbers of links."""
        flat = self.pairs[0] if len(self.pairs) == 1 else np.concatenate([*self.pairs, np.zeros(0, np.int64)])
        self.pairs = [flat]
        words, times = np.unique(numbers, return_counts=True)
        size = self.stats[words, 3]
        place = np.repeat(self.pair_ends[words] - np.cumsum(size), size) + np.arange(int(size.sum()))
        return _added(flat[place], np.repeat(times, size))

    def count(self, numbers: list[np.ndarray]) -> None:
        if numbers:
            seen = np.bincount(np.concatenate(numbers))
            self.times[: len(seen)] += seen

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs of all words counted, with their numbers of links; the words'
        own counts begin anew."""
        known = len(self.index)
        flat = np.concatenate([*self.pairs, np.zeros(0, np.int64)])
        times = np.repeat(self.times[:known], self.stats[:known, 3])
        self.times[:] = 0
        return _added(flat[times > 0], times[times > 0])


def _added(pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs and the sums of their numbers, exactly."""
    order = np.argsort(pairs, kind="stable")
    pairs = pairs[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(pairs)), bool), pairs[1:] != pairs[:-1]]))
    return pairs[first], np.add.reduceat(times[order], first) if len(first) else times[:0]


@lru_cache(maxsize=2)
def aligner(first: str, second: str) -> Aligner:
    return Aligner(first, second)


# -- minimal perfect hash ---------------------------------------------------
def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashed(keys: np.ndarray, level: int) -> np.ndarray:
    return _mix(keys.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64))


def part_of(keys: np.ndarray) -> np.ndarray:
    return (_hashed(keys, -1) % np.uint64(PARTS)).astype(np.int64)


def build_hash(keys: np.ndarray) -> list[np.ndarray]:
    """Levels of bits for distinct keys: a key's bit is set on the first level where no
    other key that came so far has the same place."""
    levels = []
    while len(keys):
        size = -(-ROOM * len(keys) // 64) * 64
        place = (_hashed(keys, len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size) == 1
        levels.append(alone)
        keys = keys[~alone[place]]
    return levels


class PairTable:
    """Hashes of all parts, one behind the other: levels by part, so that the number of
    bits before a key's own is its slot among all keys, and the vectors over slots."""

    def __init__(self, rows: list[dict]):
        rows = sorted(rows, key=lambda r: r["part"])
        deepest = max([len(r["levels"]) for r in rows], default=0)
        self.sizes = np.zeros((deepest, PARTS), np.uint64)
        self.starts = np.zeros((deepest, PARTS), np.int64)
        bits, at = [], 0
        for r in rows:
            for level, size in enumerate(r["levels"]):
                self.sizes[level, r["part"]], self.starts[level, r["part"]] = size, at
                at += size
            bits.append(np.frombuffer(r["bits"], np.uint64))
        self.words = np.concatenate([*bits, np.zeros(0, np.uint64)])
        self.before = np.cumsum(np.bitwise_count(self.words), dtype=np.int64) - np.bitwise_count(self.words)
        self.keys = np.concatenate([np.frombuffer(r["keys"], np.int64) for r in rows] or [np.zeros(0, np.int64)])
        self.counts = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in rows] or [np.zeros(0, np.int64)])

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        left, part = np.arange(len(keys)), part_of(keys)
        for level in range(len(self.sizes)):
            if not len(left):
                break
            size = self.sizes[level, part[left]]
            left, size = left[size > 0], size[size > 0]
            place = (_hashed(keys[left], level) % size).astype(np.int64) + self.starts[level, part[left]]
            word, bit = self.words[place >> 6], (place & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) > 0
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[hit]] = (self.before[place >> 6] + below)[hit]
            left = left[~hit]
        return out

    def verified(self, keys: np.ndarray) -> np.ndarray:
        """Slots; every key must be the one that its slot was made for."""
        slots = self.slots(keys)
        if len(keys) and ((slots < 0).any() or (self.keys[slots] != keys).any()):
            raise KeyError("a pair is not in the table that its own documents made")
        return slots


# -- first pass -------------------------------------------------------------
_PARTIAL = "part int, branch int, kind int, pairs binary, counts binary"


def _dealt_pairs(batches, first: str, second: str):
    """Distinct pairs of a task with their numbers of links, a row per part."""
    words = known_words(first, second, shown=False)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    waiting, branch = 0, TaskContext.get().partitionId() % BRANCHES

    def summed():
        pairs, counts = _merged(held)
        part = part_of(pairs)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(PARTS + 1))
        rows = [
            (p, branch, 1, pairs[order[a:b]].tobytes(), counts[order[a:b]].tobytes())
            for p, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))
            if b > a
        ]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["part", "branch", "kind", "pairs", "counts"])

    words.times[:] = 0  # a worker keeps what it knows of words, each task its own counts
    for texts in _together(batches, 0):
        words.count(words.of(texts)[0])
        if words.full:
            held.append(words.counted())
            words.forget()
            waiting += len(held[-1][0])
        if waiting >= HELD:
            yield summed()
            held.clear()
            waiting = 0
    held.append(words.counted())
    if any(len(pairs) for pairs, _ in held):
        yield summed()


def _together(batches, column: int):
    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            yield batch.column(column).slice(at, TOGETHER)


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return _added(*(np.concatenate([h[i] for h in held]) for i in range(2)))


def _groups(batches):
    """Rows that come sorted by their first two columns, a row at a time, with a mark
    at the first of each group."""
    now = None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield row[:2] != now, row
            now = row[:2]


def _united(batches, last: bool):
    """Distinct pairs of every group; at the last step a hash of them, and the keys in
    the order of their slots."""
    keys, now, out = np.zeros(0, np.int64), None, []

    def done():
        if last:
            levels = build_hash(keys)
            bits = np.packbits(np.concatenate([*levels, np.zeros(0, bool)]), bitorder="little").tobytes()
            row = dict(part=now[0], levels=[len(b) for b in levels], bits=bits, keys=keys.tobytes(), counts=keys.tobytes())
            slots = PairTable([row]).slots(keys)
            ordered = np.empty_like(keys)
            ordered[slots] = keys
            return now[0], row["levels"], bits, ordered.tobytes()
        return now[0], now[1], keys.tobytes()

    names = ["part", "levels", "bits", "keys"] if last else ["part", "branch", "pairs"]
    kinds = [pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary()] if last else [pa.int32(), pa.int32(), pa.binary()]

    def made():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    for new, row in _groups(batches):
        if new:
            if now is not None:
                out = [done()]
                yield made()
            keys, now = np.zeros(0, np.int64), row[:2]
        keys = np.union1d(keys, np.frombuffer(row[2], np.int64))
    if now is not None:
        out = [done()]
        yield made()


def _dense(batches):
    """Per part and branch the table's row, then the counts to be summed up by slot."""
    table, sums, now = None, None, None

    def made():
        return pa.RecordBatch.from_arrays(
            [pa.array([now[0]], pa.int32()), pa.array([sums.tobytes()], pa.binary())], names=["part", "vector"]
        )

    for new, (part, branch, kind, pairs, counts, levels, bits) in _groups(batches):
        if new:
            if now is not None:
                yield made()
            now = part, branch
        if kind == 0:
            table = PairTable([dict(part=part, levels=levels, bits=bits, keys=pairs, counts=pairs)])
            sums = np.zeros(len(table.keys), np.int64)
        else:
            slots = table.verified(np.frombuffer(pairs, np.int64))
            sums[slots] += np.frombuffer(counts, np.int64)
    if now is not None:
        yield made()


def _totals(batches):
    now, sums = None, None

    def made():
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([sums.tobytes()], pa.binary())], names=["part", "counts"])

    for batch in batches:
        for part, vector in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if part != now:
                if now is not None:
                    yield made()
                now, sums = part, 0
            sums = sums + np.frombuffer(vector, np.int64)
    if now is not None:
        yield made()


def _best(batches, base: int):
    """The highest count of every id of the second side in each part."""
    for batch in batches:
        for keys, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ids, count = np.frombuffer(keys, np.int64) % base, np.frombuffer(counts, np.int64)
            highest = np.zeros(base, np.int64)
            np.maximum.at(highest, ids, count)
            has = np.flatnonzero(highest)
            yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(highest[has])], names=["id", "highest"])


def pair_counts(texts: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """``texts (text)`` to one row per part, staged: the hash of its pairs (``levels``,
    ``bits``) and, by slot, the pairs (``keys``, id of the first side times the size of
    the second vocabulary plus id of the second) and their numbers of links."""
    spark = texts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = stage(texts.mapInArrow(partial(_dealt_pairs, first=first, second=second), _PARTIAL), "pair-counts")
    by_branch = found.select("part", "branch", "pairs").repartition(parts, "part", "branch")
    united = by_branch.sortWithinPartitions("part", "branch").mapInArrow(
        partial(_united, last=False), "part int, branch int, pairs binary"
    )
    by_part = united.select("part", F.lit(0).alias("branch"), "pairs").repartition(parts, "part")
    hashes = stage(
        by_part.sortWithinPartitions("part").mapInArrow(
            partial(_united, last=True), "part int, levels array<long>, bits binary, keys binary"
        ),
        "pair-hashes",
    )
    empty = F.lit(None)
    table = hashes.select(
        "part", F.explode(F.sequence(F.lit(0), F.lit(BRANCHES - 1))).alias("branch"), F.lit(0).alias("kind"),
        F.col("keys").alias("pairs"), empty.cast("binary").alias("counts"), "levels", "bits",
    )
    rows = found.withColumn("levels", empty.cast("array<long>")).withColumn("bits", empty.cast("binary"))
    summed = table.unionByName(rows).repartition(parts, "part", "branch").sortWithinPartitions("part", "branch", "kind")
    vectors = summed.mapInArrow(_dense, "part int, vector binary").repartition(parts, "part")
    totals = vectors.sortWithinPartitions("part").mapInArrow(_totals, "part int, counts binary")
    return stage(hashes.join(totals, "part").select("part", "levels", "bits", "keys", "counts"), "pair-table")


# -- second pass ------------------------------------------------------------
_RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
)


@lru_cache(maxsize=1)
def known_words(first: str, second: str, shown: bool) -> Words:
    """One per worker and pass, for all its tasks."""
    return Words(aligner(first, second), shown)


def _shown(words: Words, numbers: np.ndarray, whole: bool) -> str:
    text = words.groups_text(numbers)
    return text if whole else hashlib.sha256(text.encode()).hexdigest()


def _looked_up(batches, first: str, second: str, told, run: str, whole: bool):
    words = known_words(first, second, shown=True)
    words.look_up(run, *told.value)
    names = [part.split(" ")[0] for part in _RESULT.split(", ")]
    for batch in batches:
        found, shown = [], []
        for texts in _together([batch], 1):
            if words.full:
                words.forget()
            numbers, sums = words.of(texts)
            found.append(sums)
            shown += [_shown(words, n, whole) if len(n) else "" for n in numbers]
        columns = [pa.array(c) for c in np.concatenate([*found, np.zeros((0, 6), np.int64)]).T]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(shown, pa.string())], names=names)


def _own_pairs(batches, first: str, second: str, whole: bool):
    """Rows of results without counts, each with its distinct pairs and their links."""
    words = known_words(first, second, shown=True)
    for batch in batches:
        out = []
        for texts in _together([batch], 2):
            if words.full:
                words.forget()
            for numbers, sums in zip(*words.of(texts), strict=True):
                pairs, times = words.pairs_of(numbers)
                each = [{"pair": p, "times": t} for p, t in zip(pairs.tolist(), times.tolist(), strict=True)]
                out.append((*sums[:4].tolist(), _shown(words, numbers, whole) if len(numbers) else "", each))
        kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))]
        names = ["uid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs"]
        made = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=names)


def _unpacked(batches):
    for batch in batches:
        for keys, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(keys, np.int64)), pa.array(np.frombuffer(counts, np.int64))], names=["pair", "count"]
            )


def alignments(
    docs: DataFrame, first: str = FIRST, second: str = SECOND, whole: bool = True, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``docs (doc_id, text)`` to a row each: ``doc_id, n_a, n_b, n_groups, n_links,
    n_best, count_sum, groups``. ``groups`` is the alignment itself as text, or with
    ``whole=False`` its SHA-256, which spares writing it."""
    spark = docs.sparkSession
    text_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = pair_counts(rows.select("text"), first, second)
    base = len(vocabulary(second).tokens)
    best = table.select("keys", "counts").mapInArrow(partial(_best, base=base), "id long, highest long")
    best = best.groupBy("id").agg(F.max("highest").alias("highest"))  # at most one row per id of the vocabulary
    size = F.octet_length("keys") + F.octet_length("counts") + 3 * F.octet_length("bits")
    held = table.agg(F.sum(size).alias("bytes")).first()["bytes"] or 0
    if held <= broadcast_bytes:
        told = spark.sparkContext.broadcast(
            ([r.asDict() for r in table.collect()], [(r["id"], r["highest"]) for r in best.collect()])
        )
        look = partial(_looked_up, first=first, second=second, told=told, run=uuid.uuid4().hex, whole=whole)
        return rows.mapInArrow(look, _RESULT)
    numbered = rows.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")
    own = stage(
        numbered.mapInArrow(
            partial(_own_pairs, first=first, second=second, whole=whole),
            "uid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
            "pairs array<struct<pair:long,times:long>>",
        ),
        "own-pairs",
    )
    counts = table.select("keys", "counts").mapInArrow(_unpacked, "pair long, count long")
    counts = counts.withColumn("id", F.col("pair") % base).join(F.broadcast(best), "id")
    each = own.select("uid", F.explode("pairs").alias("p")).select("uid", "p.pair", "p.times")
    summed = each.join(counts, "pair").groupBy("uid").agg(
        F.sum(F.when(F.col("count") == F.col("highest"), F.col("times"))).alias("n_best"),
        F.sum(F.col("count") * F.col("times")).alias("count_sum"),
    )
    zero = F.lit(0).cast("long")
    return own.drop("pairs").join(summed, "uid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups",
    )
