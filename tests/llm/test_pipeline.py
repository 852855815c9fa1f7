"""Stages of the corpus pipeline against plain computations."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
from test_methods import plain_groups, plain_spans, plain_targets

from resultlake.llm import pii
from resultlake.llm.tokens import VOCABULARY, ChunkEncoder

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def jaccard(one, other, n):
    a, b = ({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} for w in (one.split(), other.split()))
    return len(a & b) / len(a | b)


def changed(words, *places):
    return " ".join(f"x{i}" if i in places else w for i, w in enumerate(words))


def test_near_copies_of_five_words_and_eighty_percent_go(spark):
    words = [f"w{i}" for i in range(100)]
    texts = [changed(words), changed(words, 30, 70), changed(words, 20, 50, 70)]
    near, far = ([jaccard(texts[0], t, n) for n in (5, 3)] for t in texts[1:])
    assert near[0] >= 0.8 and near[1] < 0.9 and far[0] < 0.8
    docs = spark.createDataFrame([(i, t, "en", "s1", len(t)) for i, t in enumerate(texts)], DOCS)
    kept = corpus_pipeline.join_ngrams(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == [0, 2]


def made():
    """Prose with planted copies, near copies, junk, a script of its own and a name."""
    rng = random.Random(12)
    filler = ["".join(rng.choice("aeioulmnrst") for _ in range(6)) for _ in range(300)]
    texts = [" ".join(rng.choice(filler) for _ in range(rng.randint(20, 90))) for _ in range(220)]
    for i in range(8):
        texts.append(" ".join([*rng.sample(filler, 14), "Lee ann@x.org 10.0.0.1", *rng.sample(filler, 14)]))
    words = [rng.choice(filler) for _ in range(100)]
    texts += [changed(words), changed(words, 30, 70), changed(words, 20, 50, 70), changed(words).upper(), texts[3], texts[3]]
    texts += ["123 456", "", None, "so lee said +1 736 555 2678"] + ["жзи"] + ["йкл"] * 9
    return [(i, t, "en", rng.choice(["a", "b", "c", None]), len(t or "")) for i, t in enumerate(texts)]


def plain_languages(rows):
    def grams(text):
        t = re.sub(r"[\W\d_]+", " ", f" {(text or '').lower()} ")
        return [t[i : i + 3] for i in range(len(t) - 2)] if t.strip() else []

    learned = Counter(g for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1 for g in grams(r[1]))
    return [r for r in rows if any(learned[g] >= 3 for g in grams(r[1]))]


def plain_survivors(rows):
    found = plain_groups([r[:2] for r in rows], 5, 80)
    return [r for r in rows if found[r[0]][1] == r[0]]


def spans_of(text):
    return [(int(a), pii.KINDS.index(k), int(b)) for k, a, b in (s.split(":") for s in plain_spans(text))]


def words_in(text):
    return set(re.findall(r"[^\W_]+", text.lower()))


def plain_sanitised(rows):
    texts = {r[1] for r in rows}
    near, told = defaultdict(list), Counter()
    for t in texts:
        for a, kind, b in spans_of(t):
            before, after = t[max(0, a - 100) : a], t[b : b + 100]
            before = re.sub(r"^\S+", "", before) if a > 100 else before
            after = re.sub(r"\S+$", "", after) if len(after) == 100 else after
            value = t[a:b].lower() if kind < 2 else re.sub("[^0-9]", "", t[a:b])
            near[kind, value].append((t, frozenset(words_in(f"{before} | {after}"))))
    for contexts in near.values():
        prior = len({t for t, _ in contexts}) / len(texts)
        for word in set().union(*(c for _, c in contexts)):
            if len({c for _, c in contexts if word in c}) >= 3:
                given = len({t for t, c in contexts if word in c}) / sum(word in words_in(t) for t in texts)
                told[word] = max(told[word], math.log(given / prior) / math.log(1 / prior))
    out = []
    for r in rows:
        text, base, at, pieces = r[1], spans_of(r[1]), 0, []
        spans = [(a, b, f"<{pii.KINDS[k].upper()}>") for a, k, b in base]
        for m in re.finditer(r"[^\W_]+", text):
            if told[m[0].lower()] >= 0.8 and not any(a < m.end() and m.start() < b for a, _, b in base):
                spans.append((m.start(), m.end(), "" if told[m[0].lower()] >= 0.95 else "<WORD>"))
        for a, b, tag in sorted(spans):
            if a >= at:
                pieces += [text[at:a], tag]
            at = max(at, b)
        text = "".join(pieces) + text[at:]
        out.append((r[0], text, *r[2:4], len(text)))
    return out


def plain_pieces(rows):
    encoder, out = ChunkEncoder(VOCABULARY), []
    for r in rows:
        ids = encoder.one(r[1]) + b"\0\0\0\0"
        for n, at in enumerate(range(0, len(ids), 8192)):
            piece = ids[at : at + 8192]
            out.append((r[0], n, at // 4, len(piece) // 4, zlib.crc32(piece)))
    return Counter(out)


def check_mixture(rows, mixed):
    sizes, taken = Counter(), Counter()
    copies = Counter(mixed)
    for r in rows:
        sizes[r[3]] += len(r[1].split())
    goals = plain_targets(sizes)
    for r in rows:
        rate = goals[r[3]] / sizes[r[3]]
        assert math.floor(rate + 1e-9) <= copies[r] <= math.ceil(rate - 1e-9), r
        taken[r[3]] += copies[r] * len(r[1].split())
    assert not set(copies) - set(rows)
    for source, goal in goals.items():
        assert abs(taken[source] - goal) <= max(200, 0.01 * goal), source


def test_every_stage_against_a_plain_one(spark, tmp_path):
    rows = made()
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    plain = {"language ID": plain_languages, "n-gram Jaccard join": plain_survivors, "PII": plain_sanitised}
    dropped = []
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = sorted((tuple(r) for r in function(spark, docs, str(tmp_path)).collect()), key=lambda r: r[0])
        if name in plain:
            wanted = plain[name](rows)
            assert out == wanted, name
            dropped.append(len(rows) - len(wanted))
        else:
            check_mixture(rows, out)
        rows, docs = out, spark.createDataFrame(out, DOCS)
    assert dropped[0] >= 3 and dropped[1] >= 4
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == plain_pieces(rows)
    ends = Counter()
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 2048
