"""Operator 7 on sets that fill a narrow sketch."""

import random

import numpy as np

from resultlake.llm import set_join


def plain_groups(texts, words, percent):
    sets = {k: set_join.shingle_set(set_join.words_of(t), words) for k, t in texts.items()}
    parent = {k: k for k in texts}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in sorted(texts):
        for b in sorted(texts):
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                one, other = sorted((root(a), root(b)))
                parent[other] = one
    return {k: (len(sets[k]), root(k)) for k in texts}


def test_long_sets(spark):
    """Long near copies of many degrees, across the border between two widths of sketch."""
    rng = random.Random(3)
    texts, at = {}, 0
    for size in (2060, 4090, 4100, 9000):
        base = [f"w{rng.randrange(3000)}" for _ in range(size)]
        for share in (0, 0.005, 0.01, 0.02, 0.03, 0.04, 0.05, 0.08):
            changed = [f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in base]
            texts[at] = " ".join(changed[: int(size * rng.uniform(0.9, 1))])
            at += 1
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in set_join.groups(docs, 5, 80).collect()}
    assert found == plain_groups(texts, 5, 80)
    assert 1 < len({c for _, c in found.values()}) < len(texts)


def test_wide_sketches_bound_the_difference():
    rng = np.random.default_rng(5)
    for n in (2049, 4096, 4097, 20000):
        codes = rng.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64)
        fewer = np.unique(codes)[n // 5 :]
        one, other = set_join.wide_sketch(codes), set_join.wide_sketch(fewer)
        assert 64 * len(one) >= n
        if other is None:
            continue
        while len(one) > len(other):
            one = one[: len(one) // 2] ^ one[len(one) // 2 :]
        apart = int(np.bitwise_count((one ^ other).view(np.uint64)).sum())
        assert apart <= len(codes) - len(fewer)
    assert set_join.wide_sketch(codes[:2048]) is None


def test_a_document_with_two_texts_is_linked_by_either(spark):
    rng = random.Random(4)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(3000))
    short = " ".join(f"v{i}" for i in range(100))
    rows = [(1, long), (1, short), (2, long + " end"), (3, short + " end"), (4, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r["doc_id"], r["component_id"]) for r in set_join.groups(docs, 5, 80).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (4, 4)}
