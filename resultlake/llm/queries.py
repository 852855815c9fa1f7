"""Driver queries of the corpus operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resultlake.llm import (
    alignment,
    collocations,
    language,
    lines,
    mixture,
    near_vectors,
    packing,
    pii,
    quality,
    set_join,
    token_counts,
    top_products,
    warc,
)
from resultlake.llm.common import held_out, ship, table
from resultlake.session import stage_path

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return run(spark, sf_dir)

    LLM_QUERIES[run.__name__] = shipped
    return shipped


@query
def op1_pii_sanitisation(spark, sf_dir):
    found = pii.sanitise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *(pii.count_of(F.col("pii.base"), kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(pii.spans_text(F.col("pii.base")), 256).alias("base_sha256"),
        pii.spans_text(F.col("pii.spans")).alias("spans"),
    )


@query
def op2_token_counts(spark, sf_dir):
    histogram = token_counts.length_histogram(table(spark, sf_dir, "documents").select("text"))
    return token_counts.context_limits(histogram)


@query
def op3_source_mixture(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", mixture.word_count(F.col("text")).alias("size"))
    return mixture.mix(sized).select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op4_embedding_near_dedup(spark, sf_dir):
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op5_exact_top_k(spark, sf_dir):
    return top_products.top_products(table(spark, sf_dir, "embeddings"))


@query
def op6_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op7_ngram_jaccard_join(spark, sf_dir):
    return set_join.groups(table(spark, sf_dir, "documents"))


@query
def op8_warc_archive(spark, sf_dir):
    index = warc.write_archives(table(spark, sf_dir, "pages"), stage_path(spark, "warc"))
    return warc.read_records(index, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs)
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("language.lang_pred").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )


@query
def op10_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = quality.learn(docs, table(spark, sf_dir, "labels"))
    found = quality.scores(docs, machine)
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("quality_score.score").alias("score"),
        F.col("quality_score.predicted").alias("predicted"),
    )


@query
def op11_line_dedup(spark, sf_dir):
    found = lines.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "lines.n_lines", "lines.n_dropped", F.sha2(F.col("lines.text"), 256).alias("kept_sha256")
    )


@query
def op12_tokenizer_alignment(spark, sf_dir):
    found = alignment.alignments(table(spark, sf_dir, "documents").select("doc_id", "text"), whole=False)
    return found.withColumnRenamed("groups", "groups_sha256")


@query
def op13_phrase_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


# -- counterparts in DuckDB, where SQL can say it ----------------------------
_REACHED = """
reach AS (
  SELECT id, id AS other FROM nodes
  UNION
  SELECT r.id, l.b FROM reach r JOIN both_ways l ON r.other = l.a
),
parts AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
"""

_VALID = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

LLM_ORACLES["op4_embedding_near_dedup"] = f"""
WITH RECURSIVE v AS (
  SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE {_VALID} AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT p.id AS a, q.id AS b FROM v p JOIN v q ON p.id < q.id
  WHERE list_cosine_similarity(p.e, q.e) >= 0.95
),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
nodes AS (SELECT vec_id AS id FROM embeddings),
{_REACHED},
degrees AS (SELECT a AS id, count(*) AS n FROM both_ways GROUP BY a)
SELECT p.id AS vec_id, coalesce(d.n, 0) AS n_links, p.component_id, p.id = p.component_id AS kept
FROM parts p LEFT JOIN degrees d ON d.id = p.id
"""

LLM_ORACLES["op5_exact_top_k"] = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE {_VALID}
),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

LLM_ORACLES["op7_ngram_jaccard_join"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
  END) AS sh FROM w
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS o
  FROM s p JOIN s q ON p.sh = q.sh AND p.doc_id < q.doc_id GROUP BY p.doc_id, q.doc_id
),
links AS (
  SELECT c.a, c.b FROM common c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b
  WHERE 100 * c.o >= 90 * (x.n + y.n - c.o)
),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
nodes AS (SELECT doc_id AS id FROM documents),
{_REACHED}
SELECT p.id AS doc_id, coalesce(n.n, 0) AS n_shingles, p.component_id
FROM parts p LEFT JOIN n ON n.doc_id = p.id
"""

LLM_ORACLES["op8_warc_archive"] = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest
  FROM pages
),
f AS (SELECT payload_digest, min(page_id) AS first FROM p GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM p JOIN f USING (payload_digest)
"""

LLM_ORACLES["op11_line_dedup"] = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM d
),
k AS (
  SELECT doc_id, line, pos,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM l
),
often AS (SELECT line_key FROM k WHERE line_key <> '' GROUP BY line_key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(o.line_key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (o.line_key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN often o ON o.line_key = k.line_key
GROUP BY doc_id
"""

LLM_ORACLES["op13_phrase_collocations"] = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
sizes AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest(range(1, 5)) AS k) WHERE len(ws) >= k
),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k AS n, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
    CAST(2000000::HUGEINT * c.a // (x.f::HUGEINT + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, n)) AS k FROM c) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.k + 1:], ' ')
),
best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
inside AS (
  SELECT lang, array_to_string(ws[s:s + m - 1], ' ') AS phrase, max(a) AS a
  FROM c, (SELECT unnest(range(1, 4)) AS s), (SELECT unnest(range(2, 4)) AS m)
  WHERE m < n AND s + m - 1 <= n GROUP BY ALL
),
alone AS (
  SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE i.a IS NULL OR 100::HUGEINT * i.a < 80::HUGEINT * b.a
)
SELECT a.lang, row_number() OVER (PARTITION BY a.lang ORDER BY score DESC, a.a DESC, phrase) AS rank, phrase, a.a, l, r, n, score
FROM alone a JOIN sizes USING (lang) QUALIFY rank <= 2000
"""
