"""Captured search-result pages to clean, ranked tables, on Spark."""

from resultlake.errors import CollectionError, ExportError, ResultLakeError
from resultlake.plans.extraction import (
    collect,
    extract_tables,
    public_table,
    rejected_pages,
    surface_table,
    union_tables,
)
from resultlake.plans.job import Run, run_job
from resultlake.plans.summary import platform_counts, run_summary, surface_counts
from resultlake.session import clear_stage, configure
from resultlake.sinks.csv import export, from_json_rows, load_tables, read_csv, save_tables, to_json_rows
from resultlake.sources.articles import read_articles, write_article_store
from resultlake.sources.captures import missing_captures, read_captures, request_list, write_captures
from resultlake.sources.keywords import keyword_lines, read_keywords
from resultlake.sources.registry import PLATFORMS, SURFACES, Platforms, Surface

__all__ = [
    "PLATFORMS",
    "SURFACES",
    "CollectionError",
    "ExportError",
    "Platforms",
    "ResultLakeError",
    "Run",
    "Surface",
    "clear_stage",
    "collect",
    "configure",
    "export",
    "extract_tables",
    "from_json_rows",
    "keyword_lines",
    "load_tables",
    "missing_captures",
    "platform_counts",
    "public_table",
    "read_articles",
    "read_captures",
    "read_csv",
    "read_keywords",
    "rejected_pages",
    "request_list",
    "run_job",
    "run_summary",
    "save_tables",
    "surface_counts",
    "surface_table",
    "to_json_rows",
    "union_tables",
    "write_article_store",
    "write_captures",
]
