"""Token ids of whole texts by a public vocabulary file.

The file lower-cases, drops white space and never lets a token cross it, so a text's
ids are those of its space-separated chunks in order, and a chunk met before is not
encoded again. Most chunks are a word, maybe with marks at its end, which the file
keeps apart too; new words are encoded many at a time.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "word_bpe_49k.json"
# Chunks of each of the two generations a worker remembers: what the older one still
# gives moves to the newer, the rest is forgotten. This bounds its memory.
CHUNKS = 350_000
# Texts whose new chunks are looked up together.
TOGETHER = 256
MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{|}~"  # no apostrophe, which may begin a token with letters
WORD_END = "</w>"
# Marks between a letter and a space: the file parts them from the letters as a space would.
_CLOSING = r"(\p{L})([.,;:!?]+) "


class ChunkEncoder:
    def __init__(self, vocabulary: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
        self.tokenizer = Tokenizer.from_file(path)
        known = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(known.values()) + 1, bool)
        self.closing[[i for token, i in known.items() if token.endswith(WORD_END)]] = True
        self.older: tuple[dict[str, int], np.ndarray, np.ndarray] = ({}, np.zeros(0, np.uint32), np.zeros(0, np.int64))
        self._begin()

    def _begin(self) -> None:
        """Chunks have numbers; all their ids stand in one array, one behind the other."""
        self.index: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 16, np.int64)

    def _known(self, chunk: str) -> bytes | None:
        """The ids of a chunk of either generation."""
        for index, flat, ends in ((self.index, self.flat, self.ends), self.older):
            at = index.get(chunk)
            if at is not None:
                return flat[ends[at - 1] if at else 0 : ends[at]].astype("<u4").tobytes()
        return None

    def one(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _numbered(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The chunks of some texts by number, and where each text's end."""
        if len(self.index) > CHUNKS:
            self.older = self.index, self.flat, self.ends
            self._begin()
        # A-Z here, as the file does with all letters: fewer chunks to be known.
        spaced = pc.replace_substring(pc.ascii_lower(texts.fill_null("")), "\n", " ")
        split = pc.split_pattern(pc.replace_substring_regex(spaced, _CLOSING, "\\1 \\2 "), " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        numbers = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            numbers[missing] = self._add([words[i] for i in missing.tolist()])
        edges = split.offsets.to_numpy() - split.offsets[0].as_py()
        return numbers[coded.indices.to_numpy()], edges

    def _add(self, new: list[str]) -> np.ndarray:
        count = len(new)
        learned = self._learn(new)
        new = [*new, *learned.keys() - set(new)]
        found = [learned[chunk] for chunk in new]
        first, ids = len(self.index), np.frombuffer(b"".join(found), "<u4")
        used = int(self.ends[first - 1]) if first else 0
        while first + len(new) > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        while used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[used : used + len(ids)] = ids
        self.ends[first : first + len(new)] = used + np.cumsum([len(f) // 4 for f in found])
        numbers = np.arange(first, first + len(new))
        self.index.update(zip(new, numbers.tolist(), strict=True))
        return numbers[:count]

    def _sizes(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = self.ends[numbers]
        starts = np.where(numbers > 0, self.ends[numbers - 1], 0)
        return starts, ends - starts

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """Every text's number of ids, without them."""
        out = []
        for at in range(0, len(texts), TOGETHER):
            numbers, edges = self._numbered(texts.slice(at, TOGETHER))
            out.append(np.add.reduceat(self._sizes(numbers)[1], edges[:-1]))
        return np.concatenate([*out, np.zeros(0, np.int64)])

    def ids(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """Every text's ids as little-endian unsigned 32-bit numbers."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        out: list[bytes] = []
        for at in range(0, len(texts), TOGETHER):
            numbers, edges = self._numbered(texts.slice(at, TOGETHER))
            starts, sizes = self._sizes(numbers)
            upto = np.cumsum(sizes)
            place = np.repeat(starts - upto + sizes, sizes) + np.arange(int(sizes.sum()))
            raw = self.flat[place].astype("<u4").tobytes()
            stops = (4 * upto[edges[1:] - 1]).tolist()
            out += [raw[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]
        return out

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """The ids of chunks that the younger generation does not have, and of the words
        and marks that make them up."""
        old, learned, parts, words = self.older[0], {"": b""}, {}, set()
        for chunk in new:
            if chunk in old:
                learned[chunk] = self._known(chunk)
            elif chunk.isascii() and chunk.isalpha() and chunk.islower():
                words.add(chunk)
            else:
                low = chunk.lower()
                word = low.rstrip(MARKS)
                # Latin letters and nothing else: lower-casing is the file's own there.
                if (not word or word.isalpha()) and _latin(chunk):
                    parts[chunk] = word, low[len(word) :]
                else:
                    learned[chunk] = self.one(chunk)
        made: dict[str, bytes] = {}
        for word, marks in parts.values():
            for part in (word, marks):
                if part and part not in learned and part not in words and part not in made:
                    found = self._known(part)
                    if found is not None:
                        made[part] = found
                    elif part is word:
                        words.add(word)
                    else:
                        made[marks] = self.one(marks)
        self._learn_words(sorted(words), learned)
        ids = {**made, **learned}
        for chunk, (word, marks) in parts.items():
            learned[chunk] = ids[word] + ids[marks]
        learned.update((part, found) for part, found in made.items() if part not in self.index)
        if "" not in new:
            del learned[""]
        return learned

    def _learn_words(self, words: list[str], learned: dict[str, bytes]) -> None:
        if not words:
            return
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.closing[ids]) + 1
        if len(ends) != len(words):
            learned.update((w, self.one(w)) for w in words)
            return
        raw = ids.tobytes()
        starts = np.concatenate([[0], ends[:-1]])
        spans = zip(words, (4 * starts).tolist(), (4 * ends).tolist(), strict=True)
        learned.update((w, raw[a:b]) for w, a, b in spans)


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> ChunkEncoder:
    """One encoder per worker and vocabulary."""
    return ChunkEncoder(vocabulary)
