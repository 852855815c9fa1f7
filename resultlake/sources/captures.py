"""Captured pages and the requests they answer (SC4-SC6, JN1)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resultlake.operators.lookup import bucket_of, likely, likely_in_buckets, lookup_join
from resultlake.schema import CAPTURES
from resultlake.sources.articles import FOLDER, buckets_of
from resultlake.sources.registry import PLATFORMS, Platforms

PAGE_KEY = ["platform", "surface", "keyword"]


@dataclass(frozen=True)
class CaptureStore:
    """Captured pages under ``path``, partitioned by platform, surface and a bucket of
    the keyword, so that a key filter of any number of keywords can go by buckets."""

    spark: SparkSession
    path: str
    buckets: int

    def pages(self) -> DataFrame:
        root = f"{self.path}/{FOLDER}{self.buckets}"
        return self.spark.read.schema(T.StructType([*CAPTURES.fields, T.StructField("bucket", T.IntegerType())])).parquet(root)


def write_captures(captures: DataFrame, path: str, buckets: int) -> CaptureStore:
    """Add pages to a store of so many buckets; pages of no keyword are left out."""
    spark = captures.sparkSession
    found = buckets_of(spark, path)
    if found and found != buckets:
        raise ValueError(f"{path} has {found} buckets, not {buckets}")
    rows = captures.where("keyword is not null").select(*CAPTURES.fieldNames())
    rows = rows.withColumn("bucket", bucket_of(F.col("keyword"), buckets))
    dealt = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "platform", "surface", "bucket")
    dealt.write.mode("append").partitionBy("platform", "surface", "bucket").parquet(f"{path}/{FOLDER}{buckets}")
    return CaptureStore(spark, path, buckets)


def read_captures(spark: SparkSession, path: str) -> DataFrame | CaptureStore:
    """Result pages, one row per platform, surface and keyword, from a store or a plain
    table; this is best partitioned by platform and surface, so one surface's job reads
    one surface's files."""
    buckets = buckets_of(spark, path)
    return CaptureStore(spark, path, buckets) if buckets else spark.read.schema(CAPTURES).parquet(path)


def surface_pages(
    captures: DataFrame | CaptureStore, platforms: Sequence[str], surface: str, wanted: DataFrame | None = None
) -> DataFrame:
    """Pages of one surface. Filters sit below the page reader: partitions by platform
    and surface, and a key filter of the ``wanted (keyword)``; from a store it goes by
    buckets and prunes alike for any number of keywords. Pages are never shuffled; the
    later join is exact."""
    chosen = F.col("platform").isin(*dict.fromkeys(platforms)) & (F.col("surface") == surface)
    columns = ["platform", "keyword", "page_url", "html"]
    if isinstance(captures, CaptureStore):
        pages = captures.pages().where(chosen)
        if wanted is not None:
            pages = likely_in_buckets(pages, wanted, "keyword", captures.buckets)
        return pages.select(*columns)
    pages = captures.where(chosen).select(*columns)
    return pages if wanted is None else likely(pages, wanted, "keyword")


def platform_positions(platforms: Sequence[str] | None, known: Platforms = PLATFORMS):
    """``(platform_pos, platform)`` as a literal array; a repeated platform repeats."""
    return F.array(
        *(
            F.struct(F.lit(i).alias("platform_pos"), F.lit(name).alias("platform"))
            for i, name in enumerate(known.chosen(platforms), start=1)
        )
    )


def request_list(
    keywords: DataFrame,
    platforms: Sequence[str] | None = None,
    sort_order: str | None = None,
    known: Platforms = PLATFORMS,
) -> DataFrame:
    """Every keyword on every surface of every chosen platform, with its search URL."""
    requests = F.array(
        *(
            F.struct(
                F.lit(i).alias("platform_pos"),
                F.lit(name).alias("platform"),
                F.lit(surface.name).alias("surface"),
                F.lit(surface.order_of(sort_order)).cast("string").alias("sort_order"),
                surface.search_url(F.col("keyword"), sort_order).alias("search_url"),
            )
            for i, name in enumerate(known.chosen(platforms), start=1)
            for surface in known.known[name].values()
        )
    )
    return keywords.select("kw_pos", "keyword", F.explode(requests).alias("r")).select(
        "kw_pos", "keyword", "r.*"
    )


def missing_captures(requests: DataFrame, captures: DataFrame | CaptureStore) -> DataFrame:
    """Requests no captured page answers."""
    captures = captures.pages() if isinstance(captures, CaptureStore) else captures
    return lookup_join(requests, captures.select(*PAGE_KEY), PAGE_KEY, "left_anti")
