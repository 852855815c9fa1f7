"""Reach, failure, limit and order against a reader that goes card by card."""

import random

import pytest
from pyspark.sql import functions as F
from test_surfaces import articles_of, blog_card, blog_frame, blog_page, pages_of, rows_of

from resultlake.operators import lookup
from resultlake.operators.ranking import accepted, numbered, reached
from resultlake.plans.extraction import surface_table
from resultlake.sources.registry import BLOG

# What a card turns out to be: known at once, or only once its article was asked.
OUTCOMES = {"ready": "ready", "broken": "broken", "found": "fetch", "missed": "fetch", "refused": "fetch"}


def read_in_order(cards, limit):
    rows = []
    for number, outcome in enumerate(cards):
        if outcome in ("broken", "refused"):
            return []
        if outcome in ("ready", "found"):
            rows.append(number)
        if len(rows) == limit:
            break
    return rows


@pytest.mark.parametrize("limit", [1, 2, 4, 10])
def test_pages_read_in_order(spark, limit):
    rng = random.Random(limit)
    weights = [8, 1, 4, 3, 1]
    pages = [rng.choices(list(OUTCOMES), weights, k=rng.randint(0, 14)) for _ in range(800)]
    rows = [(p, [(OUTCOMES[o], o, n) for n, o in enumerate(page)]) for p, page in enumerate(pages)]
    df = spark.createDataFrame(rows, "page int, cards array<struct<state:string, outcome:string, number:int>>")

    cut = df.withColumn("cards", reached(F.col("cards"), limit))
    for row in cut.collect():
        # Dropping what cannot be reached must not change the outcome.
        kept = [c.outcome for c in row.cards]
        assert read_in_order(kept, limit) == read_in_order(pages[row.page], limit)

    final = F.transform(
        "cards",
        lambda c: c.withField(
            "state",
            F.when(c["state"] != "fetch", c["state"])
            .when(c["outcome"] == "found", "ready")
            .when(c["outcome"] == "refused", "broken")
            .otherwise("missed"),
        ),
    )
    done = accepted(cut.withColumn("cards", final), limit)
    found = {p: [] for p in range(len(pages))}
    for row in numbered(done, "page", rows="cards").orderBy("page", "order").collect():
        assert row.order == len(found[row.page]) + 1
        found[row.page].append(row.number)
    assert found == {p: read_in_order(page, limit) for p, page in enumerate(pages)}


def test_hot_articles_and_frames(spark, monkeypatch):
    """One article linked from everywhere, one frame shown by most articles."""
    urls = [f"https://search.naver.com/p{i}" for i in range(30)]
    articles = articles_of(
        spark,
        **{u: f"<iframe id='mainFrame' src='{'/shared' if i % 3 else f'/own{i}'}'></iframe>" for i, u in enumerate(urls)},
        **{"https://blog.naver.com/shared": blog_frame("2021-01-01"), "https://blog.naver.com/own0": blog_frame("2022-02-02")},
    )
    posts = [0] * 20 + list(range(30)) + [1] * 20
    pages = pages_of(spark, *[blog_page(blog_card(date="어제", post=f"<a href='/p{i}'>{i}</a>"), blog_card()) for i in posts])

    def rows():
        return rows_of(surface_table(pages, BLOG, articles), "keyword", "order", "date", "subject")

    usual = rows()
    monkeypatch.setattr(lookup.likely, "__defaults__", (1,))
    assert rows() == usual and len(usual) == 70 + 20 + 20 + 1 + 20
