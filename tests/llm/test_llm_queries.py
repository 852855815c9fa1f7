"""Corpus queries against DuckDB, and on tables with odd rows."""

import random

import pytest
from oracle import compare, connect
from pyspark.sql import Row

from resultlake.llm.queries import LLM_ORACLES, LLM_QUERIES


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_matches_oracle(spark, sf_dir, name):
    found = LLM_QUERIES[name](spark, sf_dir)
    assert compare(found, connect(sf_dir), LLM_ORACLES[name]) == ""


DOCS = "doc_id long, text string, lang string, source string, n_chars long, uid long, size long, key string, language string, pii string, pii_base int, hit_id int, taken_uid int"
LABELS = "doc_id long, quality int, toxic int"
VECTORS = "vec_id long, embedding array<float>, label int, uid long, digest string"
PAGES = "page_id long, url string, html string, digest string, payload string"


def odd_documents():
    rng = random.Random(3)
    words = ["the", "river", "über", "élan", "ox", "stone,", "and", "with", "+1", "a@b.cd", "10.0.0.1", "4111-1111-1111-1111"]
    long_text = " ".join(rng.choice(words) for _ in range(30_000))
    texts = [None, "", " \t\r\n\v\f ", "123 456", "x", "a b", "A B", long_text, long_text, "ß" * 5000, " \x1c\x85 z", "a.b\x00c", "😀 😀"]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(30)]
    rows = []
    for i, t in enumerate(texts):
        rows.append((i, t, rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", None, "\U0001f600"]), None, 7, None, "k", "x", "y", 1, 2, 3))
    rows += [rows[3], rows[20], rows[20]]  # repeated rows
    rows += [(None, "no id here at all", "en", "s1", 1, 1, 1, None, None, None, 1, 2, 3), (None,) * 13]
    return rows


def odd_vectors():
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(60)]
    rows += [(60 + i, rows[i % 3][1]) for i in range(12)]
    rows += [(80, None), (81, []), (82, [0.0] * 6), (83, [1.0, None] + [0.0] * 4), (84, [float("nan")] * 6),
             (85, [float("inf")] + [0.0] * 5), (86, [1.0, 2.0]), (87, [1e30] * 6), (88, [1e-30] * 6), (None, rows[0][1]), rows[0]]
    return [(i, v, 1, 2, "d") for i, v in rows]


def odd_pages():
    big = "<p>" + "x" * 200 + "</p>"
    rows = [(1, "u", big), (2, None, big), (3, "u\r\nX: y", big + "é"), (4, "u", None), (5, "u", ""), (6, "", "s"), (7, "u", "s")]
    rows += [(8, "u", big), (8, "u", big), (None, None, big), (None, "n", None), (9, "u", "\r\n\r\nWARC/1.1\r\n" * 40)]
    return [(*r, "d", "p") for r in rows]


@pytest.fixture(scope="module", params=["odd", "empty"])
def folder(spark, request, tmp_path_factory):
    path = str(tmp_path_factory.mktemp(request.param))
    full = request.param == "odd"
    docs = odd_documents() if full else []
    labels = [(i, i % 2, 0) for i in range(40)] + [(3, None, None), (None, 1, 1), (5, 1, 1)] if full else []
    for name, rows, schema in [
        ("documents", docs, DOCS), ("labels", labels, LABELS),
        ("embeddings", odd_vectors() if full else [], VECTORS), ("pages", odd_pages() if full else [], PAGES),
    ]:
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return path, len(docs)


PER_DOCUMENT = ["op12_tokenizer_alignment", "op11_line_dedup", "op1_pii_sanitisation", "op3_source_mixture", "op7_ngram_jaccard_join", "op9_language_id", "op10_quality_classifier"]


@pytest.mark.parametrize("name", sorted(LLM_QUERIES))
def test_odd_and_empty_tables(spark, folder, name):
    path, n = folder
    rows = LLM_QUERIES[name](spark, path).collect()
    if name in PER_DOCUMENT:
        assert len(rows) == n
    if name == "op6_best_fit_packing":
        assert len({(r.doc_id, r.sequence_id, r.offset) for r in rows}) == len(rows) >= n
    if name == "op4_embedding_near_dedup":
        assert len(rows) == (len(odd_vectors()) if n else 0)
    if name == "op8_warc_archive":
        assert len(rows) == (len(odd_pages()) if n else 0)


def test_pipeline_on_odd_and_empty_tables(spark, folder):
    import corpus_pipeline

    path, n = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, path)
        assert out.columns == columns, name
        rows = out.collect()
        docs = spark.createDataFrame(rows, docs.schema)
    assert corpus_pipeline.run(spark, path).count() >= (1 if n else 0)


def test_odd_vectors(spark, folder):
    path, n = folder
    if not n:
        return
    near = {r.vec_id: r for r in LLM_QUERIES["op4_embedding_near_dedup"](spark, path).collect()}
    for i in (80, 81, 82, 83, 84, 85):
        assert near[i] == Row(vec_id=i, n_links=0, component_id=i, kept=True)
    # Rows 60, 63, 66, 69 repeat vector 0, as do a repeated row and one without an id.
    assert near[60].n_links == 6 and near[60].component_id == 0 and not near[60].kept
    top = [r for r in LLM_QUERIES["op5_exact_top_k"](spark, path).collect() if r.query_id == 60]
    large = 1 if sum(odd_vectors()[0][1]) > 0 else None
    top.sort(key=lambda r: r["rank"])
    assert [r["rank"] for r in top] == list(range(1, 21)) and (top[0].vec_id == 87) == (large == 1)
    assert {r.vec_id for r in top}.isdisjoint({80, 83, 84, 85})


def test_odd_pages(spark, folder):
    path, n = folder
    if not n:
        return
    rows = LLM_QUERIES["op8_warc_archive"](spark, path).collect()
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in rows)
    assert kinds == [
        (0, "response", None), (0, "revisit", 1), (1, "response", None), (2, "revisit", 1), (3, "response", None),
        (4, "response", None), (5, "response", None), (6, "response", None), (7, "response", None),
        (8, "revisit", 1), (8, "revisit", 1), (9, "response", None),
    ]
