"""The operators' methods against plain computations."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from resultlake.llm import language, mixture, near_vectors, packing, pii, quality, set_join, token_counts, top_products, warc
from resultlake.llm.components import components
from resultlake.llm.tokens import VOCABULARY, ChunkEncoder


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").cache()


# -- 1 ----------------------------------------------------------------------
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    def holds(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            return 12 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in twice) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    spans = [
        (m.start(), k, m.end())
        for k, (kind, p) in enumerate(PLAIN.items())
        for m in re.finditer(p, text)
        if holds(kind, m[0])
    ]
    return [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans)]


def made_texts():
    rng = random.Random(1)
    parts = ["a@b.c", "x.y+z@q-r.st.uv", "@a.b", "a@b", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "0001.002.3.04", "😀", "é",
             "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111", "411111111111111111111", "1 2 3 4 5 6 7 8 9 0 1 2 8",
             "+1 (736) 555-2678", "+12", "+1 2 3 4 5 6 7 8 9", "+", "12", "3", " ", "-", ".", "  ", "\n", "word"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", "-", ". "]) for _ in range(rng.randint(1, 25))) for _ in range(400)]
    return [*texts, "", "a@b" + ".c" * 5000, "1." * 5000, "1 " * 5000, "+1" + " " * 5000, "a" * 20000 + "@b.c"]


def test_base_spans(spark):
    texts = made_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = df.select("doc_id", pii.spans_text(pii.base_spans(F.col("text"))).alias("s")).collect()
    for r in found:
        assert r.s == ",".join(plain_spans(texts[r.doc_id])), texts[r.doc_id][:200]


def test_long_runs_take_linear_time(spark):
    """Runs that an address could begin in, before an address further on."""
    texts = ["a" * 1_000_000 + " x@y.zz", "1" * 1_000_000 + " 1.2.3.4", "x%" * 300_000 + " a@b.c%d@e.f", "1.2." * 200_000 + "x +1 (736) 555-2678"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    started = time.monotonic()
    found = {r.doc_id: r.s for r in df.select("doc_id", pii.spans_text(pii.base_spans(F.substr("text", F.greatest(F.lit(1), F.length("text") - 40)))).alias("s")).collect()}
    assert {i: s for i, s in found.items()} == {i: ",".join(plain_spans(t[max(0, len(t) - 41) :])) for i, t in enumerate(texts)}
    whole = {r.doc_id: r.n for r in df.select("doc_id", F.size(pii.base_spans(F.col("text"))).alias("n")).where("doc_id < 3").collect()}
    assert whole == {0: 1, 1: 1, 2: 2} and time.monotonic() - started < 60


def test_disclosing_terms(spark):
    rng = random.Random(2)
    filler = ["".join(rng.choice("aeioulmnrst") for _ in range(6)) for _ in range(300)]

    def noise(n):
        return " ".join(rng.choice(filler) for _ in range(n))

    rows = [(i, f"{noise(12)} Falconer writes to ann@x.org {noise(12)}") for i in range(8)]
    rows += [(100 + i, f"{noise(40)} writes") for i in range(300)]
    rows += [(500, f"{noise(20)} FALCONER {noise(20)}"), (501, "falconers"), (502, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    terms = {r.term: r.removed for r in pii.disclosing_terms(df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))).collect()}
    assert "falconer" in terms and "writes" not in terms and not set(terms) & set(filler)
    out = {r.doc_id: r.pii for r in pii.sanitise(df).collect()}
    assert "ann@x.org" not in out[0].text and "alconer" not in out[0].text and "<EMAIL>" in out[0].text
    assert len(out[500].spans) == 1 and "FALCONER" not in out[500].text
    assert out[501].text == "falconers" and out[502].text == ""
    clean = [i for i, _ in rows if 100 <= i < 500]
    assert all(not out[i].spans for i in clean)


def passages(spark, told, others):
    """Distinct filler around each of ``told``, ``others`` texts of filler alone."""
    rng = random.Random(3)
    filler = ["".join(rng.choice("aeioulmnrst") for _ in range(6)) for _ in range(300)]
    texts = [" ".join([*rng.sample(filler, 12), t, *rng.sample(filler, 12)]) for t in told]
    return texts + [" ".join(rng.sample(filler, 40)) for _ in range(others)], filler


def terms_of(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return {r.term: r.removed for r in pii.disclosing_terms(df).collect()}


def test_name_beside_three_entities(spark):
    beside = "Falconer ann@x.org +1 736 555 2678 10.0.0.1"
    texts, filler = passages(spark, [beside] * 8, 302)
    terms = terms_of(spark, [*texts, "a falconer elsewhere"])
    assert terms.get("falconer") is True and not set(terms) & set(filler)


def test_copies_of_a_text_count_once(spark):
    texts, filler = passages(spark, ["Falconer writes to ann@x.org"] * 3, 300)
    once = terms_of(spark, texts)
    copied = terms_of(spark, [*texts, *texts[:1] * 400])
    assert once.get("falconer") is True and copied == once and not set(once) & set(filler)


@pytest.mark.parametrize("name", ["Lee", "Wu", "王伟", "K4711", "90210", "नाम"])
def test_short_names_and_codes(spark, name):
    texts, filler = passages(spark, [f"{name}, ann@x.org"] * 8, 300)
    texts += [f"so {name} said", f"x{name}9 is another"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert pii.disclosing_terms(df).where(F.lower(F.lit(name)) == F.col("term")).first().removed
    out = {r.doc_id: r.pii for r in pii.sanitise(df).where("doc_id < 8 or doc_id >= 308").collect()}
    assert all(name not in out[i].text for i in range(8))
    assert out[308].text == "so  said" and out[309].text == texts[309]


# -- 2 ----------------------------------------------------------------------
def test_token_counts(spark, docs):
    encode = ChunkEncoder(VOCABULARY).tokenizer.encode
    lengths = [len(encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()]
    limits = token_counts.context_limits(token_counts.length_histogram(docs))
    rows = {r.n_tokens: r for r in limits.collect()}
    assert {n: r.docs for n, r in rows.items()} == Counter(lengths)
    for n, r in rows.items():
        assert r.docs_from == sum(x >= n for x in lengths) and r.tokens_from == sum(x for x in lengths if x >= n)
        assert r.tokens_kept == sum(min(x, n) for x in lengths)
        assert r.fitting == pytest.approx(sum(x <= n for x in lengths) / len(lengths))
    assert token_counts.quantile_length(limits, 0.5) == sorted(lengths)[(len(lengths) - 1) // 2]


def test_chunks_are_encoded_alike():
    encoder = ChunkEncoder(VOCABULARY)
    odd = ["don't WON'T it's 'tis", "Σίσυφος ΣΑΣ", "école É İstanbul", "<|endoftext|> a<|startoftext|>b", "x y\x1cz\x85q", "½ 12 ²",
           "a.b,c!!! ...", "ﬁ ǅ ß ẞ", "", " ", "日本語 テキスト", "a\tb\r\nc", "naïve—dash “q”", "ªº µm", "Ⅷ ٣", None, "THE!! Word$$$ |x|"]
    for text, ids in zip(odd, encoder.ids(odd), strict=True):
        assert ids == encoder.one(text or ""), text


# -- 3 ----------------------------------------------------------------------
def test_flight_keeps_totals():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 50, 500):
        size, p = rng.integers(1, 900, n).astype(float), rng.uniform(0.05, 0.95, n)
        done = mixture.flight(p, size, rng, land=False)
        undecided = (done > 0) & (done < 1)
        assert undecided.sum() <= 2
        assert done.sum() == pytest.approx(p.sum()) and done @ size == pytest.approx(p @ size)
        landed = mixture.flight(p, size, rng, land=True)
        assert set(landed) <= {0.0, 1.0}
        if n >= 50:
            assert abs(landed @ size - p @ size) <= 0.01 * (p @ size)


def test_flight_is_unbiased():
    rng, size = np.random.default_rng(1), np.array([1.0, 5, 9, 30, 2, 7])
    p = np.array([0.2, 0.5, 0.7, 0.4, 0.9, 0.3])
    mean = np.mean([mixture.flight(p, size, rng, land=False) for _ in range(4000)], axis=0)
    assert np.abs(mean - p).max() < 0.03


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    rest, open_ones, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_ones:
        level = rest / sum(weights[s] for s in open_ones)
        over = [s for s in open_ones if weights[s] * level > 2 * sizes[s]]
        if not over:
            out.update({s: weights[s] * level for s in open_ones})
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
            rest -= out[s]
            open_ones.discard(s)
    return out


def test_mixture(spark):
    rng = random.Random(4)
    rows = []
    for i in range(6000):
        source = "hot" if i % 3 == 0 else rng.choice(["a", "b", "é", "Z", None, "tiny"] if i < 50 else ["a", "b", "é", "Z", None])
        rows.append((i, source, rng.choice([0, 3, 40, 400, 5000])))
    rows += [(9, "hot", 40)] * 200
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    first = mixture.mix(df, block=256).collect()
    sizes = defaultdict(int)
    for _, source, size in rows:
        sizes[source] += size
    goal = plain_targets(sizes)
    by_id = {r[0]: r[1] for r in rows}
    taken = defaultdict(int)
    for r in first:
        source = by_id[r.doc_id]
        assert r.source_size == sizes[source] and r.target == pytest.approx(goal[source])
        assert r.taken in (0, r.size, 2 * r.size) and r.taken == r.copies * r.size
        taken[source] += r.taken
    assert len(first) == len(rows)
    for source, target in goal.items():
        assert abs(taken[source] - target) <= max(50, 0.01 * target), source
    again = mixture.mix(df.repartition(7), block=256).collect()
    assert Counter((r.doc_id, r.taken) for r in first) == Counter((r.doc_id, r.taken) for r in again)


def test_mixture_of_one_row_repeated(spark):
    """More repeats of a row than a block holds are dealt over blocks."""
    df = spark.createDataFrame([(1, "s", 7)] * 900 + [(2, "t", 5)] * 30, "doc_id long, source string, size long")
    rows = mixture.mix(df, block=64).collect()
    assert sorted(rows) == sorted(mixture.mix(df, block=64).collect()) and len(rows) == 930
    assert sum(r.taken for r in rows if r.doc_id == 1) == pytest.approx(1.5 * (6300 + 150) - 300, abs=8)


def test_word_count(spark):
    texts = ["", None, "a", " a\tb\x0bc\x0cd\re\nf ", "a\x1cb c", "a b", "é ü"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(mixture.word_count(F.col("t"))).collect()] == [len((t or "").encode().split()) for t in texts]


# -- 4 ----------------------------------------------------------------------
def test_near_vectors_recall(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(700, 48))
    noisy = base[:300] + rng.normal(size=(300, 48)) * rng.uniform(0.05, 0.35, (300, 1))
    group = base[0] + rng.normal(size=(60, 48)) * 0.02
    x = np.concatenate([base, noisy, group, base[5:10], 3 * base[5:10]]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    rows = sorted(near_vectors.near_duplicates(df).collect(), key=lambda r: r.vec_id)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    found, true = np.array([r.n_links for r in rows]), linked.sum(1)
    assert (found <= true).all() and found.sum() >= 0.9 * true.sum() and true.sum() > 3000
    assert rows[700 + 300 + 60].n_links == true[5] and rows[700 + 300 + 60].component_id == 5


def links_found(spark, x):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in near_vectors.near_duplicates(df).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    true = linked.sum(1)
    assert all(found[i] <= true[i] for i in found)
    return sum(found.values()), true.sum()


@pytest.mark.parametrize("common", [0.8, 0.86, 0.92])
def test_near_vectors_with_a_common_component(spark, common):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(900, 64))
    x[:, 0] = 0
    x *= np.sqrt(1 - common) / np.linalg.norm(x, axis=1)[:, None]
    x[:, 0] = np.sqrt(common)
    apart = rng.normal(size=(400, 64))
    apart[:, 0] = 0
    other = x[:400] + 0.3 * apart / np.linalg.norm(apart, axis=1)[:, None]
    found, true = links_found(spark, np.concatenate([x, other]))
    assert found >= 0.9 * true and true > 400


@pytest.mark.parametrize("count", [2, 3, 40])
def test_near_vectors_of_one_tight_group(spark, count):
    rng = np.random.default_rng(8)
    found, true = links_found(spark, 1 + rng.normal(size=(count, 32)) * 0.05)
    assert found >= 0.9 * true and true == count * (count - 1)


# -- 5 ----------------------------------------------------------------------
@pytest.mark.parametrize("density", [0.05, 1.0])
def test_top_products(spark, density, monkeypatch):
    monkeypatch.setattr(top_products, "QUERIES", 16)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 20)) * (rng.random((900, 20)) < density)
    x[100:140] = x[100]  # ties
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    q = np.floor(64 * x).astype(int)
    found = defaultdict(list)
    for r in top_products.top_products(df.repartition(5)).collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(found) == set(range(0, 900, 20))
    for query, rows in found.items():
        score = q @ q[query]
        best = sorted((-int(s), i) for i, s in enumerate(score) if i != query)[:20]
        assert sorted(rows) == [(n, i, -s) for n, (s, i) in enumerate(best, 1)]


def test_shard_prunes_and_stays_exact():
    rng = np.random.default_rng(9)
    values = np.floor(rng.normal(size=(3000, 30)) * 20 * (rng.random((3000, 30)) < rng.uniform(0.02, 1, 30))).astype(np.int64)
    uids = np.arange(3000)
    parts = [top_products.Shard(uids[a : a + 1000], uids[a : a + 1000], values[a : a + 1000], np.float64) for a in (0, 1000, 2000)]
    for q in range(0, 3000, 150):
        top = []
        for shard in parts:
            top = shard.search(values[q].astype(float), q, top, 10)
        score = values @ values[q]
        assert [(-s, i) for s, i, _ in top] == [(-s, i) for s, i in sorted((-int(s), i) for i, s in enumerate(score) if i != q)[:10]]


# -- 6 ----------------------------------------------------------------------
def test_packing(spark, docs):
    rows = packing.pack_documents(docs, length=512, region=64, islands=2, rounds=2).collect()
    encoder = ChunkEncoder(VOCABULARY)
    wanted = []
    for r in docs.collect():
        ids = encoder.one(r.text or "") + b"\0\0\0\0"
        wanted += [(r.doc_id, n, at // 4, len(ids[at : at + 2048]) // 4, zlib.crc32(ids[at : at + 2048])) for n, at in enumerate(range(0, len(ids), 2048))]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(wanted)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 512
    assert len(sequences) <= 1.03 * sum(r.length for r in rows) / 512 + 1


def test_crossover_keeps_every_item():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 100, 300).tolist()
    one = packing._decreasing(lengths, 100)
    other = packing._decreasing(lengths, 100, rng.uniform(0.7, 1.3, 300))
    for _ in range(20):
        child = packing._cross(one, other, rng)
        assert sorted(i for b in child.bins for i in b) == list(range(300))
        assert all(sum(lengths[i] for i in b) == 100 - r for b, r in zip(child.bins, child.left, strict=True))
        one, other = other, child
    people = packing._evolve(lengths, 100, [], 5)
    assert len(people[0]) <= len(packing._decreasing(lengths, 100).bins)


# -- 7 ----------------------------------------------------------------------
def variants():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for size in [1, 2, 3, 4, 5, 8, 11, 12, 13, 20, 21, 22, 30, 45, 60, 100, 200, 600]:
        for _ in range(6):
            text = [rng.choice(words) for _ in range(size)]
            rows.append((n, " ".join(text)))
            n += 1
            for _ in range(6):
                copy = list(text)
                for _ in range(rng.randint(0, max(1, size // 25))):
                    at = rng.randrange(len(copy))
                    change = rng.random()
                    if change < 0.4:
                        copy[at] = rng.choice(words)
                    elif change < 0.7 and len(copy) > 1:
                        del copy[at]
                    else:
                        copy.insert(at, rng.choice(words))
                rows.append((n, " ".join(copy).upper() if rng.random() < 0.2 else "  ".join(copy)))
                n += 1
    return rows


def plain_groups(rows, words, percent):
    sets = {i: set_join.shingle_set((t or "").encode().lower().split(), words) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80), (1, 95), (2, 70)])
def test_jaccard_join(spark, words, percent):
    rows = [*variants(), (9000, None), (9001, ""), (9002, " \n"), (9003, "W1 w2"), (9004, "w1  w2"), (9005, "w2 w1")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in set_join.groups(df, words, percent).collect()}
    assert found == plain_groups(rows, words, percent)


def test_keys_meet_whenever_sets_are_close():
    """The promise of the segments: any two sets within the band's difference share a key."""
    rng = np.random.default_rng(2)
    for percent in (90, 80, 60):
        bands = set_join.Bands(percent)
        for size in [*range(1, 60), 100, 333]:
            for _ in range(20):
                one = rng.integers(0, 2**63, size).astype(np.uint64)
                common = rng.integers(0, size + 1)
                extra = rng.integers(0, max(1, size // 4) + 1)
                other = np.concatenate([one[:common], rng.integers(0, 2**63, extra).astype(np.uint64)])
                one, other = np.unique(one), np.unique(other)
                both = len(np.intersect1d(one, other))
                if both and 100 * both >= percent * (len(one) + len(other) - both):
                    shared = np.intersect1d(set_join.keys_of(one, bands), set_join.keys_of(other, bands))
                    assert len(shared), (percent, len(one), len(other), both)


def test_survivors(spark):
    rows = [(i, f"{i % 3} a b c d e f g h", "x") for i in range(9)] + [(1, "1 a b c d e f g h", "y"), (None, "0 a b c d e f g h", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = set_join.survivors(df).collect()
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in kept) == [-1, 0, 1, 2]
    assert set_join.survivors(df).columns == df.columns


def test_components(spark):
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 80)] + [(500, 400), (400, 450), (7, 7)]
    links += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    found = {r.id: r.component_id for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    assert found == {i: root(i) for i in {x for a, b in links if a != b for x in (a, b)}}


# -- 8 ----------------------------------------------------------------------
@pytest.mark.parametrize("compress", [False, True])
def test_archives_read_back(spark, sf_dir, tmp_path, compress):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    index = warc.write_archives(pages, str(tmp_path / "a"), compress=compress, roll=20_000)
    assert index.select("file").distinct().count() > 1
    want = {r.page_id: r for r in pages.collect()}
    rows = warc.read_records(index.where("page_id % 3 = 0")).collect()
    assert {r.page_id for r in rows} == {i for i in want if i % 3 == 0}
    for r in rows:
        payload = want[r.page_id].html.encode()
        assert bytes(r.payload) == payload and r.payload_digest == hashlib.sha256(payload).hexdigest() and r.url == want[r.page_id].url
    files = {}
    for r in index.collect():
        raw = files.setdefault(r.file, open(r.file, "rb").read())
        assert len(raw[r.offset : r.offset + r.length]) == r.length
    assert all(sum(r.length for r in index.collect() if r.file == f) == len(raw) for f, raw in files.items())


def test_ranges_are_coalesced():
    import pyarrow as pa

    index = [("a", 0, 10), ("a", 10, 5), ("a", 15 + warc.GAP, 5), ("a", 30 + 3 * warc.GAP, 5), ("b", 40, 5)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*index, strict=True)], names=["file", "offset", "length"])
    assert [(f, len(p)) for f, p in warc._ranges([batch])] == [("a", 3), ("a", 1), ("b", 1)]


# -- 9, 10 ------------------------------------------------------------------
def test_language(spark, sf_dir, docs):
    filters = language.learn(docs)
    assert filters.languages == sorted({r.lang for r in docs.collect()})
    rows = language.identify(docs, filters).where((F.crc32(F.col("doc_id").cast("string")) % 3) == 1).collect()
    assert np.mean([r.language.lang_pred == r.lang for r in rows]) >= 0.98
    assert filters.predict(None) == filters.predict("12 !?") == ("und", 0.0)
    assert language.grams("a").tolist() == language.grams(" A? ").tolist() != language.grams("b").tolist()


def test_filters_hold_every_language_of_a_gram():
    filters = language.LanguageFilters(["x", "y"], 0, np.zeros((2**12, 1), np.uint64), np.zeros(2), 12)
    for bit, text in ((1, "alpha beta"), (2, "beta gamma")):
        for probe in range(language.PROBES):
            slots = (language.grams(text) >> np.uint64(12 * probe)) & np.uint64(2**12 - 1)
            filters.masks[slots.astype(int), 0] |= np.uint64(bit)
    n = len(language.grams("beta"))
    assert filters.hits(language.grams("beta")).tolist() == [n, n]
    assert filters.hits(language.grams("alpha"))[0] == len(language.grams("alpha")) > filters.hits(language.grams("alpha"))[1]


def test_factorisation_machine_sum_of_squares():
    rng = np.random.default_rng(0)
    machine = quality.FactorisationMachine(0.3)
    machine.weights = rng.normal(size=machine.weights.shape).astype(np.float32)
    machine.factors = rng.normal(size=machine.factors.shape).astype(np.float32)
    index, value = quality.vector("One two two three! 4 five")
    pairs = sum(
        machine.factors[i] @ machine.factors[j] * x * y
        for a, (i, x) in enumerate(zip(index, value, strict=True))
        for j, y in list(zip(index, value, strict=True))[a + 1 :]
    )
    assert machine.margin(index, value) == pytest.approx(0.3 + machine.weights[index] @ value + pairs, rel=1e-3)


def test_quality(spark):
    folder = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    machine = quality.learn(documents, labels)
    held = labels.where((F.crc32(F.col("doc_id").cast("string")) % 3) == 1)
    rows = quality.scores(documents, machine).join(held, "doc_id").collect()
    assert np.mean([r.quality_score.predicted == r.quality for r in rows]) >= 0.95
    assert 0 <= machine.score(None) == machine.score("") <= 1


def test_links_of_vectors_near_the_mean(spark):
    """A common component, and a small cluster about the mean's own direction."""
    rng = np.random.default_rng(44)
    dims, common = 64, np.zeros(64)
    common[0] = 1.0

    def unit(x):
        return x / np.sqrt((x**2).sum(1))[:, None]

    rest = unit(rng.normal(size=(4000, dims)) * (np.arange(dims) > 0))
    far = np.sqrt(0.7) * common + np.sqrt(0.3) * rest
    near = unit(common + 0.12 * unit(rng.normal(size=(100, dims))))
    planted = unit(far[:300] + 0.3 * unit(rng.normal(size=(300, dims))))
    x = np.concatenate([far, near, planted])
    cosine = unit(x) @ unit(x).T >= 0.95
    np.fill_diagonal(cosine, False)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in near_vectors.near_duplicates(df).collect()}
    wanted = cosine.sum(1)
    assert all(found[i] <= wanted[i] for i in found)
    inside = range(4000, 4100)
    outside = [i for i in range(len(x)) if i not in inside]
    for rows in (inside, outside):  # each shell by itself
        assert sum(found[i] for i in rows) >= 0.9 * sum(wanted[i] for i in rows) > 0
