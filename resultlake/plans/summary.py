"""Counts over result tables (AG1-AG4)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resultlake.plans.extraction import Counts
from resultlake.schema import ROWS, RUN_SUMMARY


def surface_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(surface, row_count)``, zero counts included, and their total as ``all``."""
    counts = [
        table.agg(F.count("*").alias("row_count")).select(F.lit(kind).alias("surface"), "row_count")
        for kind, table in tables.items()
    ]
    each = reduce(DataFrame.unionByName, counts)
    return each.rollup("surface").agg(F.sum("row_count").alias("row_count")).select(
        F.coalesce("surface", F.lit("all")).alias("surface"), "row_count"
    )


def platform_counts(tables: dict[str, DataFrame], platforms: Sequence[str]) -> DataFrame:
    """``(platform_pos, platform, surface, row_count)`` of every chosen platform, in
    order, repeats counted each and zero counts included."""
    spark = next(iter(tables.values())).sparkSession
    every = spark.createDataFrame(
        [(at, name, kind) for at, name in enumerate(platforms, start=1) for kind in tables],
        "platform_pos int, platform string, surface string",
    )
    counts = reduce(
        DataFrame.unionByName,
        (
            table.groupBy("platform_pos").agg(F.count("*").alias("row_count")).withColumn("surface", F.lit(kind))
            for kind, table in tables.items()
        ),
    )
    known = every.join(counts, ["platform_pos", "surface"], "left")
    return known.select("platform_pos", "platform", "surface", F.coalesce("row_count", F.lit(0)).alias("row_count"))


def counted_platforms(spark: SparkSession, counts: Counts, platforms: Sequence[str]) -> DataFrame:
    """What ``platform_counts`` gives, from counts taken while the tables were staged."""
    rows = [(at, name, kind, counts[kind][at]) for at, name in enumerate(platforms, start=1) for kind in counts]
    return spark.createDataFrame(rows, "platform_pos int, platform string, surface string, row_count long")


def run_summary(
    keywords: DataFrame,
    tables: dict[str, DataFrame],
    output_dir: str | None = None,
    output_files: dict[str, str] | None = None,
    counts: dict[str, int] | None = None,
) -> DataFrame:
    """One row about a run: keyword count, row count per kind, where the files are.
    ``counts`` by kind, ``keyword`` among them, if they are known: nothing is read then."""
    if counts is not None:
        return _summary(
            _known(keywords.sparkSession, {f"{kind}_count": counts.get(kind, 0) for kind in ["keyword", *ROWS]}),
            output_dir,
            output_files,
        )
    tagged = [keywords.select(F.lit("keyword").alias("kind"))] + [
        table.select(F.lit(kind).alias("kind")) for kind, table in tables.items()
    ]
    found = reduce(DataFrame.union, tagged).agg(
        *(F.count_if(F.col("kind") == kind).alias(f"{kind}_count") for kind in ["keyword", *ROWS])
    )
    return _summary(found, output_dir, output_files)


def _known(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} long" for name in counts))


def _summary(counts: DataFrame, output_dir: str | None, output_files: dict[str, str] | None) -> DataFrame:
    pairs = [F.lit(x) for pair in (output_files or {}).items() for x in pair]
    files = F.create_map(*pairs) if pairs else F.lit(None)
    return counts.select(
        "*",
        F.lit(output_dir).cast("string").alias("output_dir"),
        files.cast(RUN_SUMMARY["output_files"].dataType).alias("output_files"),
    )
