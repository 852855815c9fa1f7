"""The whole job (SC11): keyword file and captured pages in, three files out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resultlake.errors import CollectionError, ExportError
from resultlake.operators.ranking import isolation
from resultlake.plans.extraction import collect
from resultlake.plans.summary import counted_platforms, run_summary
from resultlake.session import configure, stage_counted
from resultlake.sinks.csv import export
from resultlake.sources.articles import read_articles
from resultlake.sources.captures import missing_captures, read_captures, request_list
from resultlake.sources.keywords import read_keywords
from resultlake.sources.registry import PLATFORMS, Platforms

OUTPUT_SETTING = "spark.resultlake.output.dir"


@dataclass(frozen=True)
class Run:
    """What a run left behind. ``rejected`` are pages that failed as a whole,
    ``requests`` all searches of the run and ``missing`` those no page answers.
    ``summary`` and ``platform_counts`` were counted while the tables were staged."""

    tables: dict[str, DataFrame]
    output_files: dict[str, str]
    summary: DataFrame
    rejected: DataFrame
    requests: DataFrame
    missing: DataFrame
    platform_counts: DataFrame


def output_folder(spark: SparkSession, output_dir: str | None) -> str:
    """Named folder, else the session's; a run never writes to a folder made up here."""
    folder = output_dir or spark.conf.get(OUTPUT_SETTING, None)
    if not folder:
        raise ExportError(f"name an output folder or set {OUTPUT_SETTING}")
    return folder


def run_job(
    spark: SparkSession,
    keywords_path: str,
    captures_path: str,
    articles_path: str | None = None,
    platforms: Sequence[str] | None = None,
    output_dir: str | None = None,
    max_rows: int | None = None,
    on_bad_card: str = "page",
    base_dir: str | None = None,
    known: Platforms = PLATFORMS,
    single_file: bool = False,
    sort_order: str | None = None,
) -> Run:
    """Extract, export and sum up. Bad arguments fail before any work starts."""
    configure(spark)
    names = known.chosen(platforms)
    isolation(on_bad_card)
    folder = output_folder(spark, output_dir)
    listed = read_keywords(spark, keywords_path, base_dir)
    keywords, lines = stage_counted(listed, "keywords", F.count(F.lit(1)).alias("n"))
    try:
        captures = read_captures(spark, captures_path)
        tables, rejected, counts = collect(
            keywords,
            captures,
            read_articles(spark, articles_path) if articles_path else None,
            platforms,
            max_rows,
            on_bad_card,
            known,
        )
    except Exception as error:
        raise CollectionError("result pages could not be extracted") from error
    files = export(tables, folder, single_file)
    requests = request_list(keywords, platforms, sort_order, known)
    totals = {"keyword": lines["n"], **{kind: sum(found.values()) for kind, found in counts.items()}}
    summary = run_summary(keywords, tables, folder, files, totals)
    by_platform = counted_platforms(spark, counts, names)
    return Run(tables, files, summary, rejected, requests, missing_captures(requests, captures), by_platform)
