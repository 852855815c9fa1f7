"""Scheduled runs over newly landed captures (RS1), as an available-now stream.

What is known is a state per platform, kind and keyword: the best capture of that page so
far, by the rule a whole run follows, so increments over any batches give what one run
over all captures gives. A batch adds the pages it holds; pages captured again meet when
the state is read, or when batches are merged into one.

A batch becomes visible by one file, a manifest that names all folders of the state. It
is written last and read first: whoever reads sees the state before a batch or after it,
and a writer that ends half-way leaves the former state as it was.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resultlake.operators.ranking import numbered
from resultlake.plans.extraction import one_capture, rejected_of, rows_of, stated_surfaces
from resultlake.schema import CAPTURES, ROWS
from resultlake.session import configure
from resultlake.sinks.files import children, read_text, remove, write_text
from resultlake.sources.articles import read_articles
from resultlake.sources.captures import surface_pages
from resultlake.sources.registry import PLATFORMS, Platforms

#: Batches the state is kept in before they are merged into one.
MERGE_AFTER = 16
_REJECTED = "platform string, surface string, keyword string, page_url string, reason string"


# -- manifests --------------------------------------------------------------
def _manifests(spark: SparkSession, output: str) -> list[str]:
    return [n for n in children(spark, f"{output}/manifests") if n.endswith(".json")]


def _manifest(spark: SparkSession, output: str) -> dict:
    """The last state committed: its number, folders, and the last batch of each stream."""
    names = _manifests(spark, output)
    if not names:
        return {"number": 0, "folders": [], "streams": {}}
    return json.loads(read_text(spark, f"{output}/manifests/{names[-1]}"))


def _commit(spark: SparkSession, output: str, manifest: dict) -> None:
    write_text(spark, f"{output}/manifests/{manifest['number']:012d}.json", json.dumps(manifest))


def _clear(spark: SparkSession, output: str) -> None:
    """Drop folders that neither of the last two states names; a reader that has just
    begun may still read the one before."""
    names = _manifests(spark, output)[-2:]
    used = {f for n in names for f in json.loads(read_text(spark, f"{output}/manifests/{n}"))["folders"]}
    for folder in set(children(spark, f"{output}/batches")) - used:
        remove(spark, f"{output}/batches/{folder}")


# -- state ------------------------------------------------------------------
def _page_schema(kind: str) -> T.StructType:
    rows = T.ArrayType(T.StructType([f for f in ROWS[kind].fields if f.name not in ("keyword", "order")]))
    return T.StructType().add("platform", "string").add("keyword", "string").add("rows", rows)


def _pages(spark: SparkSession, output: str, folders: list[str], kind: str) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], _page_schema(kind))
    return spark.read.schema(_page_schema(kind)).parquet(*(f"{output}/batches/{f}/{kind}" for f in folders))


def _rejects(spark: SparkSession, output: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], _REJECTED)
    return spark.read.schema(_REJECTED).parquet(*(f"{output}/batches/{f}/rejected" for f in folders))


def _write(spark: SparkSession, output: str, folder: str, tables: dict[str, DataFrame | None]) -> None:
    for name, table in tables.items():
        empty = _REJECTED if name == "rejected" else _page_schema(name)
        found = spark.createDataFrame([], empty) if table is None else table
        found.write.mode("overwrite").parquet(f"{output}/batches/{folder}/{name}")


def run_increment(
    spark: SparkSession,
    landing: str,
    output: str,
    progress: str,
    articles_path: str | None = None,
    max_rows: int | None = None,
    files_per_batch: int = 10_000,
    known: Platforms = PLATFORMS,
    on_bad_card: str = "page",
) -> None:
    """Take up all capture files not seen before into the state under ``output``.

    A surface filters the batch for its own pages; HTML is read where it landed and not
    copied. A batch run again after a failure replaces what it had not committed, and
    does nothing if it had. A stream begun anew, its progress lost, meets the pages that
    are known and changes nothing.
    """
    configure(spark)
    stream = (
        spark.readStream.schema(CAPTURES)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
    )
    articles = read_articles(spark, articles_path) if articles_path else None

    def take_up(batch: DataFrame, number: int) -> None:
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        state = _manifest(spark, output)
        if number <= state["streams"].get(stream_id, -1):
            return
        stated = stated_surfaces(
            lambda sharing, kind: surface_pages(batch, sharing, kind), list(known.known), articles, max_rows, on_bad_card, known
        )
        folder = f"{stream_id}-{number}"
        tables = {kind: rows_of(stated, kind, max_rows) for kind in ROWS}
        _write(spark, output, folder, {**tables, "rejected": rejected_of(stated, max_rows)})
        folders = [*state["folders"], folder]
        if len(folders) > MERGE_AFTER:
            merged = f"merged-{state['number'] + 1}"
            whole = {kind: one_capture(_pages(spark, output, folders, kind)) for kind in ROWS}
            _write(spark, output, merged, {**whole, "rejected": _rejects(spark, output, folders)})
            folders = [merged]
        streams = {**state["streams"], stream_id: number}
        _commit(spark, output, {"number": state["number"] + 1, "folders": folders, "streams": streams})
        _clear(spark, output)

    query = (
        stream.writeStream.foreachBatch(take_up)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_increments(spark: SparkSession, output: str, kind: str) -> DataFrame:
    """All rows of one kind known so far, with their platform: of a page captured in
    several batches the capture that a run over all of them would take."""
    pages = one_capture(_pages(spark, output, _manifest(spark, output)["folders"], kind))
    return numbered(pages, "platform", "keyword").select(*ROWS[kind].fieldNames(), "platform")


def read_rejected(spark: SparkSession, output: str) -> DataFrame:
    """Pages of all batches that failed as a whole: ``(platform, surface, keyword,
    page_url, reason)``."""
    return _rejects(spark, output, _manifest(spark, output)["folders"])
