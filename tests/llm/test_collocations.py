"""Phrase mining against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from resultlake.llm import collocations

SCHEMA = "doc_id long, text string, lang string, fp int, n string, phrase string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(rows, top, least, covered):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text or "")):
            ws = re.findall("[^ \t]+", piece)
            n[lang] += len(ws)
            f.update((lang, tuple(ws[i : i + k])) for k in range(1, 5) for i in range(len(ws) - k + 1))
    found = []
    for (lang, ws), a in f.items():
        if len(ws) < 2 or a < least:
            continue
        cuts = [(2000000 * a // (f[lang, ws[:k]] + f[lang, ws[k:]]), k) for k in range(1, len(ws))]
        score, k = min(cuts)
        found.append((lang, ws, a, f[lang, ws[:k]], f[lang, ws[k:]], n[lang], score))
    around = Counter()
    for lang, ws, a, *_ in found:
        for size in range(2, len(ws)):
            for i in range(len(ws) - size + 1):
                around[lang, ws[i : i + size]] = max(around[lang, ws[i : i + size]], a)
    found = [r for r in found if 100 * around[r[0], r[1]] < covered * r[2]]
    found.sort(key=lambda r: (r[0], -r[6], -r[2], " ".join(r[1]).encode()))
    out, rank = set(), Counter()
    for lang, ws, *rest in found:
        rank[lang] += 1
        if rank[lang] <= top:
            out.add((lang, rank[lang], " ".join(ws), *rest))
    return out


def made_rows():
    rng = random.Random(13)
    words = ["the", "The", "of", "New", "York", "élan", "É", "ß", "\xa0x", "a-b", "😀", "\x1c", "new york"]
    marks = [" ", "  ", "\t", ", ", ". ", "\n", "\r\n", " ", " ", " ", ":"]

    def text(k):
        return "".join(rng.choice(words) + rng.choice(marks) for _ in range(k))

    rows = [(i, text(rng.randint(0, 60)), rng.choice(["en", "fr", None, "und", ""])) for i in range(150)]
    rows += [(200, None, "en"), (201, "", None), (202, " \t.,", "xx"), (203, text(40_000), "en"), (204, "y" * 3_000_000 + " z", "en")]
    rows += [(205, "new york " * 500, "de")] + [rows[3], rows[3], (None, "new york", "en"), (None, None, None)]
    return rows


@pytest.mark.parametrize("held", [collocations.HELD, 500])
def test_against_plain(spark, held):
    rows = made_rows()
    df = spark.createDataFrame([(*r, 1, "n", "p") for r in rows], SCHEMA).repartition(5)
    found = collocations.collocations(df, top=25, least=4, covered=80, hold=held)
    assert {tuple(r) for r in found.collect()} == plain(rows, 25, 4, 80)


def test_colliding_fingerprints_are_told_apart(spark, monkeypatch):
    """With fingerprints of 12 bits most phrases share one; the second hash parts them."""
    grams = collocations.Ngrams(["en"], pa.array(["a b c d e f g h a b"]), collocations.polynomials(1))
    fp = np.concatenate([g[1] for g in grams.found]) & np.uint64(7)
    check = np.concatenate([g[2] for g in grams.found])
    order, first, sums = collocations._summed(fp, check, None)
    wanted = Counter(zip(fp.tolist(), check.tolist(), strict=True))
    pick = order[first]
    assert dict(zip(zip(fp[pick].tolist(), check[pick].tolist(), strict=True), sums.tolist(), strict=True)) == wanted


def test_phrases_are_read_from_the_text(spark):
    texts = pa.array(["x. The End of Éa", None, "the end"])
    grams = collocations.Ngrams(["en", "en", "en"], texts, collocations.polynomials(1))
    by_fp = {}
    for n, fp, _, doc, word in grams.found:
        for f, d, w in zip(fp.tolist(), doc.tolist(), word.tolist(), strict=True):
            by_fp.setdefault(f, set()).add((grams.phrase(w, n), n))
    phrases = {p for v in by_fp.values() for p, _ in v}
    assert all(len(v) == 1 for v in by_fp.values())
    assert "the end of Éa" in phrases and "x the" not in phrases and len(by_fp) == 11
    assert grams.sizes[3].tolist() == [5, 2]


def test_scores_beyond_64_bits(spark):
    big = 9 * 10**18
    rows = [("en", 0, "", big), ("en", 1, "x", big), ("en", 1, "y", big - 7), ("en", 2, "x y", big - 9), ("en", 3, "x y z", big // 2),
            ("en", 1, "z", big), ("en", 2, "y z", big // 2 + 5)]
    df = spark.createDataFrame(rows, "lang string, n int, phrase string, f long")
    got = {r.phrase: (r.l, r.r, r.score) for r in collocations.scored(df).collect()}
    a = big // 2
    cuts = [(2000000 * a // (big + big // 2 + 5), big, big // 2 + 5), (2000000 * a // (big - 9 + big), big - 9, big)]
    assert got["x y"] == (big, big - 7, 2000000 * (big - 9) // (big + big - 7))
    assert got["x y z"] == (min(cuts)[1], min(cuts)[2], min(cuts)[0]) and "y z" not in got
