"""Article pages (SC7, SC8): a plain table, or a store whose reads grow with what is asked.

A store holds its pages in buckets by a hash of their url, one partition each, sorted by
url. Whoever asks for urls reads the buckets these fall in and no other file: the
buckets, at most as many numbers as the store has partitions, are a filter on the
partition column, which Spark applies before it opens a file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resultlake.operators.lookup import bucket_of, likely, likely_in_buckets
from resultlake.schema import ARTICLES
from resultlake.sinks.files import children

#: Partitions of a store unless named otherwise. More buckets mean less read for few
#: urls and smaller files; their number is the bound of the filter.
BUCKETS = 1024
FOLDER = "buckets="


@dataclass(frozen=True)
class ArticleStore:
    """Bucketed article pages under ``path``."""

    spark: SparkSession
    path: str
    buckets: int

    def pages(self) -> DataFrame:
        """All pages as ``(url, html, bucket)``."""
        schema = f"{ARTICLES.simpleString()[7:-1].replace(':', ' ').replace(',', ', ')}, bucket int"
        root = f"{self.path}/{FOLDER}{self.buckets}"
        return self.spark.read.schema(schema).option("basePath", root).parquet(root)

    def asked(self, urls: DataFrame) -> DataFrame:
        """Pages ``(url, html)`` that may be among ``urls (url)``; none of these is
        lost. Only buckets with an asked url are read."""
        hit = urls.where("url is not null").select(bucket_of(F.col("url"), self.buckets).alias("bucket")).distinct()
        numbers = sorted(r["bucket"] for r in hit.collect())  # at most self.buckets
        pages = self.pages().where(F.col("bucket").isin(numbers))
        if not numbers:
            return pages.select("url", "html")
        return likely_in_buckets(pages, urls, "url", self.buckets).select("url", "html")


def write_article_store(articles: DataFrame, path: str, buckets: int = BUCKETS, files: int = 1) -> ArticleStore:
    """Store pages ``(url, html)`` by bucket, ``files`` files in each; adds to the pages
    a store of as many buckets holds already. Pages without a url are left out, as
    nobody can ask for them."""
    spark = articles.sparkSession
    found = buckets_of(spark, path)
    if found and found != buckets:
        raise ValueError(f"{path} has {found} buckets, not {buckets}")
    bucket = bucket_of(F.col("url"), buckets)
    part = F.pmod(F.xxhash64("url", F.lit(1)), F.lit(files)).cast("int")
    dealt = articles.where("url is not null").select("url", "html", bucket.alias("bucket"), part.alias("_file"))
    # Hot buckets do not exist but for a url captured again and again.
    tasks = min(buckets * files, max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) * 4))
    together = dealt.repartition(tasks, "bucket", "_file").sortWithinPartitions("bucket", "_file", "url")
    together.drop("_file").write.mode("append").partitionBy("bucket").parquet(f"{path}/{FOLDER}{buckets}")
    return ArticleStore(spark, path, buckets)


def buckets_of(spark: SparkSession, path: str) -> int | None:
    """The number of buckets of a store; None for any other folder."""
    names = [n for n in children(spark, path) if n.startswith(FOLDER)]
    return int(names[0].removeprefix(FOLDER)) if names else None


def read_articles(spark: SparkSession, path: str) -> DataFrame | ArticleStore:
    """Article pages, outer and framed ones alike, from a store or a plain table. A url
    may have several rows; what any of them can tell counts."""
    buckets = buckets_of(spark, path)
    return ArticleStore(spark, path, buckets) if buckets else spark.read.schema(ARTICLES).parquet(path)


def asked_articles(articles: DataFrame | ArticleStore, urls: DataFrame) -> DataFrame:
    """Pages that may be among ``urls (url)``: from a store's buckets, or by a key filter
    below the page reader where all pages of a plain table have to be opened."""
    return articles.asked(urls) if isinstance(articles, ArticleStore) else likely(articles, urls, "url")
