"""Dates named by article pages (PX11, PX12, URL8, DT3): two hops, page to frame.

All surfaces of a run ask together: the urls their cards link to are the first frontier,
the frames those articles show the next, less what was visited before. So a run passes
over the articles once a hop, whatever the number of surfaces.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resultlake.functions import (
    is_malformed_url,
    is_unfetchable_url,
    normalize_text,
    parse_post_date,
    resolve_url,
    strip_text,
)
from resultlake.operators.cards import ARTICLE, extract, read_article
from resultlake.operators.lookup import lookup_join
from resultlake.operators.rules import BROKEN, READY
from resultlake.session import stage
from resultlake.sources.articles import ArticleStore, asked_articles

# Fixed value: the address blog frames are relative to.
BLOG_HOST = "https://blog.naver.com"
# An article and the frame it shows.
HOPS = 2
SHOWN = ("blog", "cafe")


def _read(articles: DataFrame) -> DataFrame:
    """What each article page ``(url, html)`` says, per surface, a row per page: the
    frame it shows and the post date it names. HTML is not shuffled."""
    found = extract(articles.select("url", "html"), read_article, ARTICLE, "found").select(
        "url", F.col("found")[0].alias("a")
    )
    frame = normalize_text(F.col("a.blog_frame"))
    dates = F.filter(
        F.transform("a.blog_dates", parse_post_date), lambda date: date.isNotNull()
    )
    read = found.select(
        "url",
        F.when(F.col("a.blog_frame").isNotNull(), resolve_url(BLOG_HOST, frame)).alias("blog_frame"),
        is_malformed_url(F.col("a.blog_frame")).alias("malformed"),
        F.try_element_at(dates, F.lit(1)).alias("blog_date"),
        resolve_url(F.col("url"), strip_text(F.col("a.cafe_frame"))).alias("cafe_frame"),
        parse_post_date(F.col("a.cafe_date")).alias("cafe_date"),
    )
    refused = F.col("malformed") | F.coalesce(is_unfetchable_url(F.col("blog_frame")), F.lit(False))
    return read.withColumn("blog_refused", refused).withColumn("cafe_refused", F.lit(False))


def _facts(articles: DataFrame) -> DataFrame:
    """A row per url: what it shows and says on each surface. Of several pages of a url
    a failed one hides nothing: the smallest usable frame and date count."""
    each = []
    for name in SHOWN:
        frame, refused = F.col(f"{name}_frame"), F.col(f"{name}_refused")
        shown = F.when(frame.isNotNull(), F.struct(refused.alias("refused"), frame.alias("frame")))
        each += [F.min(shown).alias(f"{name}_shown"), F.min(f"{name}_date").alias(f"{name}_date")]
    return _read(articles).groupBy("url").agg(*each)


def article_facts(
    articles: DataFrame | ArticleStore, urls: DataFrame, surfaces: Sequence[str], hops: int = HOPS
) -> DataFrame:
    """``url, <surface>_shown, <surface>_date`` for ``urls (url)`` and, hop by hop, for
    the frames shown there: one pass over the articles asked for a hop, and no url is
    read twice. Staged, so every surface looks up the same few rows."""
    frontier = stage(urls.select("url").where("url is not null").distinct(), "asked-urls")
    seen = frontier
    found: list[DataFrame] = []
    for hop in range(hops):
        read = _facts(asked_articles(articles, frontier))
        # The key filter lets a few others through, which a later hop may ask for.
        found.append(stage(lookup_join(read, frontier, ["url"], "left_semi"), "article-facts"))
        if hop + 1 == hops:
            break
        frames = [
            found[-1].where(f"not {name}_shown.refused").select(F.col(f"{name}_shown.frame").alias("url"))
            for name in surfaces
        ]
        new = reduce(DataFrame.unionByName, frames).distinct().join(seen, "url", "left_anti")
        frontier = stage(new, "asked-urls")
        seen = seen.unionByName(frontier)
    return reduce(DataFrame.unionByName, found)


def article_dates(facts: DataFrame, surface: str, urls: DataFrame) -> DataFrame:
    """``(url, post_date, refused)`` for those of ``urls (url)`` whose article names a
    date through its frame, or whose frame address an HTTP client refuses (blog only)."""
    outer = lookup_join(facts.where(f"{surface}_shown is not null"), urls.distinct(), ["url"], "left_semi").select(
        "url", f"{surface}_shown.*"
    )
    inner = facts.where(f"{surface}_date is not null").select(
        F.col("url").alias("frame"), F.col(f"{surface}_date").alias("post_date")
    )
    named = lookup_join(outer.where("not refused"), inner, ["frame"]).select("url", "post_date", "refused")
    if surface != "blog":
        return named
    return named.unionByName(
        outer.where("refused").select("url", F.lit(None).cast("date").alias("post_date"), "refused")
    )


def answer_cards(asked: DataFrame, dates: DataFrame) -> DataFrame:
    """Give every card waiting for its article a final state: ready with the article's
    date, broken if the frame's address was refused, or gone on a miss (JN2, JN3)."""
    waiting = asked.withColumn("url", F.col("card.url"))
    found = lookup_join(waiting, dates, ["url"])
    state = F.when(F.col("refused"), BROKEN).otherwise(READY)
    card = F.col("card").withField("state", state).withField("date", F.col("post_date"))
    return found.withColumn("card", card).drop("url", "post_date", "refused")
