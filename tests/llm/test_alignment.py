"""Alignment of two vocabularies against a plain one, token by token."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from resultlake.llm import alignment
from resultlake.llm.queries import LLM_QUERIES

SCHEMA = "doc_id long, text string, uid long, pairs string, `count` int"


def byte_level():
    """GPT-2's table of bytes, from its published definition."""
    kept = list(range(ord("!"), ord("~") + 1)) + list(range(ord("¡"), ord("¬") + 1)) + list(range(ord("®"), ord("ÿ") + 1))
    table, n = {chr(b): b for b in kept}, 0
    for b in range(256):
        if b not in kept:
            table[chr(256 + n)] = b
            n += 1
    return table


def spans(tokens):
    out, at = [], 0
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def plain(rows):
    one = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    table = byte_level()
    docs, counts = [], Counter()
    for doc_id, text in rows:
        if not text:
            docs.append((doc_id, None))
            continue
        a = one.encode(" " + text, add_special_tokens=False)
        b = two.encode(text)
        a_bytes = [bytes(table[c] for c in t) for t in a.tokens]
        b_bytes = [
            bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, two.id_to_piece(i)) for i in b)
        ]
        if b"".join(a_bytes) != b"".join(b_bytes) or b"".join(a_bytes) != (" " + text).encode():
            docs.append((doc_id, None))
            continue
        links, groups = [], []
        sa, sb = spans(a_bytes), spans(b_bytes)
        j = 0
        for i, (s, e) in enumerate(sa):
            while sb[j][1] <= s:
                j += 1
            k = j
            while k < len(sb) and sb[k][0] < e:
                links.append((a.ids[i], b[k]))
                k += 1
        ends = sorted({e for _, e in sa} & {e for _, e in sb})
        start = 0
        for end in ends:
            groups.append(
                ",".join(str(x) for x, (s, e) in zip(a.ids, sa) if s >= start and e <= end)
                + "|"
                + ",".join(str(x) for x, (s, e) in zip(b, sb) if s >= start and e <= end)
            )
            start = end
        counts.update(links)
        docs.append((doc_id, (len(a.ids), len(b), len(ends), links, ";".join(groups))))
    best = {}
    for (_, y), c in counts.items():
        best[y] = max(best.get(y, 0), c)
    for doc_id, found in docs:
        if found is None:
            yield doc_id, 0, 0, 0, 0, 0, 0, ""
        else:
            na, nb, ng, links, text = found
            yield doc_id, na, nb, ng, len(links), sum(counts[l] == best[l[1]] for l in links), sum(counts[l] for l in links), text


def made_rows():
    rng = random.Random(12)
    words = ["the", "river", "über", "naïve", "漢字", "😀😀", "  ", "\t", "\n", "<|endoftext|>", "<s>", "0x0A", "tokenization", "don't", "\x00", "é", "…"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 30)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " "), (203, "▁under"), (204, "ﬁ ligature"), (205, "a" * 3000), (206, "x  y"), (207, "<unk>")]
    return rows + [(208, "".join(rng.choice("abc ") for _ in range(30_000))), rows[0], rows[0], (None, "no id"), (None, None)]


@pytest.mark.parametrize("limit", [alignment.BROADCAST_BYTES, -1])
def test_against_plain(spark, limit):
    rows = made_rows()
    df = spark.createDataFrame([(*r, 1, "p", 2) for r in rows], SCHEMA).repartition(6)
    got = Counter(tuple(r) for r in alignment.alignments(df, broadcast_bytes=limit).collect())
    wanted = Counter(plain(rows))
    assert got == wanted
    assert sum(1 for r in wanted if r[1]) > 60 and sum(1 for r in wanted if not r[1]) >= 4  # null, empty, a marker inside


def test_query_on_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in LLM_QUERIES["op12_tokenizer_alignment"](spark, sf_dir).collect()}
    digest = {(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[1] else "") for r in plain([tuple(d) for d in docs])}
    assert got == digest


def test_hash_is_minimal_and_perfect():
    keys = np.unique(np.random.default_rng(3).integers(0, 50257 * 32000, 200_000))
    rows, at = [], 0
    for part in range(alignment.PARTS):
        mine = keys[alignment.part_of(keys) == part]
        levels = alignment.build_hash(mine)
        bits = np.packbits(np.concatenate(levels), bitorder="little").tobytes()
        rows.append(dict(part=part, levels=[len(b) for b in levels], bits=bits, keys=mine.tobytes(), counts=mine.tobytes()))
        at += len(mine)
    slots = alignment.PairTable(rows[::-1]).slots(keys)
    assert np.array_equal(np.sort(slots), np.arange(at))
    with pytest.raises(KeyError):
        alignment.PairTable(rows).verified(keys[:1] + 1)


def test_words_are_encoded_alike_alone_and_in_the_text():
    align = alignment.aligner(alignment.FIRST, alignment.SECOND)
    for _, text in made_rows()[:120]:
        words = alignment.split_words(text)
        assert " ".join(words) == text
        for side in align.sides:
            assert side.words_apart()
            assert side.encode([text])[0] == [i for ids in side.encode(words) for i in ids]


def test_forgotten_words_change_nothing(monkeypatch):
    align = alignment.aligner(alignment.FIRST, alignment.SECOND)
    texts = pa.array([t for _, t in made_rows()], pa.string())
    once = alignment.Words(align, True)
    numbers, wanted = once.of(texts)
    shown = [once.groups_text(n) for n in numbers]
    again = alignment.Words(align, True)
    monkeypatch.setattr(alignment, "WORDS", 5)
    for i in range(len(texts)):
        if again.full:
            again.forget()
        (n,), sums = again.of(texts.slice(i, 1))
        assert sums[0].tolist() == wanted[i].tolist() and again.groups_text(n) == shown[i]
