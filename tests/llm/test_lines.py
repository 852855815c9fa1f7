"""Line dedup against plain counting."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from resultlake.llm import lines
from resultlake.llm.queries import LLM_QUERIES

SCHEMA = "doc_id long, text string, doc int, pos string, `line_doc` int, lines string"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(lines.SPACE))


def plain(rows, least, keep_first=False):
    """(id, text) to (lines, dropped, kept text); a document is its id and text."""
    documents, first = defaultdict(set), {}
    ordered = sorted({(r[0] is not None, r[0] or 0, r[1] or "") for r in rows})
    for known, doc, text in ordered:
        for pos, line in enumerate(text.split("\n")):
            documents[key_of(line)].add((known, doc, text))
            first.setdefault(key_of(line), (known, doc, text, pos))
    out = {}
    for known, doc, text in ordered:
        split = text.split("\n")
        kept = [
            line
            for pos, line in enumerate(split)
            if not key_of(line)
            or len(documents[key_of(line)]) < least
            or (keep_first and first[key_of(line)] == (known, doc, text, pos))
        ]
        out[known, doc, text] = len(split), len(split) - len(kept), "\n".join(kept)
    return out


def made_rows():
    rng = random.Random(11)
    common = ["All rights reserved.", "  ALL RIGHTS RESERVED.\t", "Élan", "élan", "a", "\x1c", "x\r", "\x0bx", "", " ", "ß😀"]
    rows = [
        (i, "\n".join(rng.choice(common) if rng.random() < 0.3 else f"line {rng.randint(0, 200)}" for _ in range(rng.randint(0, 12))))
        for i in range(200)
    ]
    rows += [(300 + i, "the hot line\nown line " + str(i)) for i in range(150)]
    rows += [(600, None), (601, ""), (602, "\n\n"), (603, "the hot line"), (604, "the hot line\n" * 3), (None, "the hot line\nno id"), (None, None)]
    rows += [(605, "\n".join(f"long {i % 7000}" if i % 3 else "the hot line" for i in range(50_000)))]
    rows += [(606, "a" * 400_000), (607, "y The Hot Line\x85"), rows[0], rows[0], (0, "the hot line\nother text")]
    return rows


@pytest.mark.parametrize("keep_first", [False, True])
def test_against_plain(spark, keep_first):
    rows = made_rows()
    # Ids are unique within a text order that the plain version and the operator share only then.
    if keep_first:
        rows = [r for r in rows if r[0] is not None and r != (0, "the hot line\nother text")]
    df = spark.createDataFrame([(*r, 1, "p", 2, "l") for r in rows], SCHEMA).repartition(7)
    found = lines.drop_repeated_lines(df, name="result", min_documents=5, keep_first=keep_first)
    assert found.columns == [*df.columns, "result"]
    wanted = plain(rows, 5, keep_first)
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r.result) == wanted[r.doc_id is not None, r.doc_id or 0, r.text or ""], r.doc_id


def test_bitmaps_are_runs_of_kept_lines(spark):
    text = "drop\nkeep one\nkeep two\ndrop\ndrop\nkeep three"
    df = spark.createDataFrame([(i, text.replace("keep", f"keep {i}") if i else text) for i in range(3)], "doc_id long, text string")
    found = lines.keep_bitmaps(df, min_documents=3).where("doc = 0").first()
    runs = [(r.start, min(r.length, 99)) for r in found.kept]
    assert found.dropped == 3 and runs[0] == (1, 2) and runs[1][0] == 5


def test_repeats_within_a_document_count_once(spark):
    df = spark.createDataFrame([(1, "x\n" * 50), (2, "y")], "doc_id long, text string")
    assert lines.keep_bitmaps(df, min_documents=2).count() == 0


def test_plan_is_native_and_streams_ranges(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = lines._streamed(lines._occurrences(docs, "doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "hashpartitioning" not in plan
    whole = LLM_QUERIES["op11_line_dedup"](spark, sf_dir)
    assert "Python" not in whole._jdf.queryExecution().executedPlan().toString()


def test_digest_of_the_kept_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = lines.drop_repeated_lines(docs.select("doc_id", "text")).select("doc_id", F.col("lines.text").alias("t")).collect()
    digests = {r.doc_id: r.kept_sha256 for r in LLM_QUERIES["op11_line_dedup"](spark, sf_dir).collect()}
    assert {r.doc_id: hashlib.sha256(r.t.encode()).hexdigest() for r in texts} == digests
