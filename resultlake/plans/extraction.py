"""Captured pages to result tables (PX1, PX3, PX5, JN1-JN3, ST1-ST3, SR1).

One surface is one chain: scan -> page reader -> card rules inside the page's row ->
article dates for the few undated cards -> final rows, still one row per page. Only
then are pages joined to the requests and taken apart into rows, so a keyword asked
for many times costs nothing but its result rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resultlake.operators.articles import answer_cards, article_dates, article_facts
from resultlake.operators.cards import extract
from resultlake.operators.lookup import lookup_join
from resultlake.operators.ranking import accepted, exploded, isolation, limit_of, numbered, reached
from resultlake.operators.ruled import RULED, STATED
from resultlake.operators.rules import BROKEN, FETCH, READY
from resultlake.schema import POSITIONS, ROWS, with_positions
from resultlake.session import stage, stage_counted
from resultlake.sources.articles import ArticleStore
from resultlake.sources.captures import CaptureStore, platform_positions, surface_pages
from resultlake.sources.registry import PLATFORMS, Platforms, Surface

PAGE = ["platform", "keyword"]


def _result_rows(cards, surface: Surface):
    """Accepted cards as structs of the result table's own columns."""
    return F.transform(
        cards, lambda c: F.struct(*(c[source].alias(name) for source, name in surface.columns.items()))
    )


def _limit(surface: Surface, max_rows: int | None) -> int:
    return limit_of(surface.max_rows if max_rows is None else max_rows)


def _read_pages(pages: DataFrame, surface: Surface, max_rows: int | None, on_bad_card: str) -> DataFrame:
    """Pages ``(platform, keyword, page_url, html)`` of one surface to ``(platform,
    keyword, page_url, error, cards)``; cards that wait for their article still do."""
    isolate, limit = isolation(on_bad_card), _limit(surface, max_rows)
    card, ruled = RULED.get(surface.rule, (None, None))
    plain = surface.has_articles and card == surface.card
    read = extract(pages, surface.read, surface.card, error="error", ruled=(ruled, STATED) if plain else None)
    raw, page_url = F.col("cards"), F.col("page_url")
    whole = [*PAGE, "page_url", "error"]
    if not surface.has_articles:
        stated = read.select(*whole, surface.rule(raw, page_url, limit).alias("cards"))
        return stated.withColumn("cards", isolate(raw))
    # Pages of plain cards are ruled where they are read, all others by the expression.
    said = surface.rule(raw, page_url)
    stated = read.select(*whole, (F.coalesce("ruled", said) if plain else said).alias("cards"))
    return stated.withColumn("cards", isolate(raw)).withColumn("cards", reached(raw, limit))


def _staged_pages(near: DataFrame, surface: Surface) -> DataFrame:
    """Read pages once and for all, each with whether it waits for articles."""
    waits = F.coalesce(F.exists("cards", lambda c: c["state"] == FETCH), F.lit(False))
    numbered_pages = near.withColumn("page_id", F.monotonically_increasing_id()).withColumn("waits", waits)
    return stage(numbered_pages, f"{surface.name}-pages")


def _asked_urls(staged: DataFrame) -> DataFrame:
    """Urls of the articles that staged pages wait for."""
    asked = F.filter("cards", lambda c: c["state"] == FETCH)
    return staged.where("waits").select(F.explode(F.transform(asked, lambda c: c["url"])).alias("url"))


def _settled(staged: DataFrame, surface: Surface, facts: DataFrame, on_bad_card: str, keep: bool) -> DataFrame:
    """Staged pages with final states; ``keep`` stages what articles had to answer, for
    a result that is read more than once."""
    answered = _answered(staged, surface, facts, isolation(on_bad_card))
    if keep:
        answered = stage(answered, f"{surface.name}-answered")
    return staged.where(~F.col("waits")).select(*PAGE, "page_url", "error", "cards").unionByName(answered)


def stated_pages(
    pages: DataFrame,
    surface: Surface,
    articles: DataFrame | ArticleStore | None = None,
    max_rows: int | None = None,
    on_bad_card: str = "page",
) -> DataFrame:
    """Pages ``(platform, keyword, page_url, html)`` of one surface to ``(platform,
    keyword, page_url, error, cards)``: their cards with final states, or what kept a
    page from being read. Without articles to ask nothing runs before an action does.
    """
    near = _read_pages(pages, surface, max_rows, on_bad_card)
    if not surface.has_articles or articles is None:  # every lookup is a miss
        return near
    staged = _staged_pages(near, surface)
    facts = article_facts(articles, _asked_urls(staged), [surface.name])
    return _settled(staged, surface, facts, on_bad_card, keep=False)


def _answered(staged: DataFrame, surface: Surface, facts: DataFrame, isolate) -> DataFrame:
    """Pages with undated cards, put together again once their articles were asked.
    Only these pages are shuffled, and a group is one page."""
    key = ["page_id", *PAGE, "page_url"]
    cards = exploded(staged.where("waits"), *key, array="cards", name="card")
    asked = cards.where(F.col("card.state") == FETCH)
    known = cards.where(F.col("card.state") != FETCH)
    answered = answer_cards(asked, article_dates(facts, surface.name, _asked_urls(staged)))
    together = known.unionByName(answered).groupBy(*key).agg(
        F.sort_array(F.collect_list(F.struct("position", "card"))).alias("placed")
    )
    cards = F.transform("placed", lambda p: p["card"])
    error = F.lit(None).cast("string").alias("error")
    return together.select(*PAGE, "page_url", error, isolate(cards).alias("cards"))


#: Pages of each kind with final states, by the surface definition they were read with.
Stated = dict[str, list[tuple[Surface, DataFrame]]]


def stated_surfaces(
    pages_of: Callable[[Sequence[str], str], DataFrame],
    names: Sequence[str],
    articles: DataFrame | ArticleStore | None = None,
    max_rows: int | None = None,
    on_bad_card: str = "page",
    known: Platforms = PLATFORMS,
) -> Stated:
    """All kinds of pages of the named platforms, staged with final states; ``pages_of``
    gives the pages of some platforms and one kind. The kinds do not wait for each other
    but to ask for articles together: a hop is one pass over them for the whole run."""
    run = inheritable_thread_target(SparkSession.active())

    def read(kind: str) -> list[tuple[Surface, bool, DataFrame]]:
        found = []
        for surface, sharing in definitions(names, kind, known):
            near = _read_pages(pages_of(sharing, kind), surface, max_rows, on_bad_card)
            asks = surface.has_articles and articles is not None
            found.append((surface, asks, _staged_pages(near, surface) if asks else stage(near, f"{kind}-stated")))
        return found

    with ThreadPoolExecutor(len(ROWS)) as pool:
        read_kinds = dict(zip(ROWS, pool.map(run(read), ROWS)))
        asking = [(surface, staged) for found in read_kinds.values() for surface, asks, staged in found if asks]
        facts = None
        if asking:
            urls = reduce(DataFrame.unionByName, (_asked_urls(staged) for _, staged in asking))
            facts = article_facts(articles, urls, sorted({surface.name for surface, _ in asking}))

        def settle(kind: str) -> list[tuple[Surface, DataFrame]]:
            return [
                (surface, _settled(staged, surface, facts, on_bad_card, keep=True) if asks else staged)
                for surface, asks, staged in read_kinds[kind]
            ]

        return dict(zip(ROWS, pool.map(run(settle), ROWS)))


def _rows_of(stated: DataFrame, surface: Surface, limit: int) -> DataFrame:
    return accepted(stated, limit).select(*PAGE, _result_rows(F.col("cards"), surface).alias("rows"))


def page_rows(
    pages: DataFrame,
    surface: Surface,
    articles: DataFrame | ArticleStore | None = None,
    max_rows: int | None = None,
    on_bad_card: str = "page",
) -> DataFrame:
    """Pages of one surface to ``(platform, keyword, rows)``, the rows in order and at
    most ``max_rows`` (the surface's own number if not given, and never less than one).

    ``on_bad_card`` says what a card that cannot be read takes with it once reached:
    the whole ``page`` or the ``card`` alone.
    """
    stated = stated_pages(pages, surface, articles, max_rows, on_bad_card)
    return _rows_of(stated, surface, _limit(surface, max_rows))


def _rejected(stated: DataFrame, surface: Surface, limit: int) -> DataFrame:
    """Pages of ``stated`` that gave no rows since they, or a card reached, cannot be
    read: ``(platform, surface, keyword, page_url, reason)``."""
    # Only states are read, and few pages have what is looked for.
    states = F.filter("cards.state", lambda state: state.isin(READY, BROKEN))
    decided = F.transform(states, lambda state: F.struct(state.alias("state")))
    some = stated.where(F.col("error").isNotNull() | F.array_contains("cards.state", BROKEN))
    within = some.withColumn("cards", decided).withColumn("cards", reached(F.col("cards"), limit))
    broken = F.exists("cards", lambda c: c["state"] == BROKEN)
    rows = (F.size("cards") - 1).cast("string")
    reason = F.coalesce("error", F.when(broken, F.concat(F.lit("broken card after rows: "), rows)))
    return within.select(
        "platform", F.lit(surface.name).alias("surface"), "keyword", "page_url", reason.alias("reason")
    ).where("reason is not null")


def rejected_pages(
    pages: DataFrame, surface: Surface, articles: DataFrame | ArticleStore | None = None, max_rows: int | None = None
) -> DataFrame:
    """Pages of one surface that failed as a whole, with the reason (PR9)."""
    stated = stated_pages(pages, surface, articles, max_rows)
    return _rejected(stated, surface, _limit(surface, max_rows))


def surface_table(
    pages: DataFrame,
    surface: Surface,
    articles: DataFrame | ArticleStore | None = None,
    max_rows: int | None = None,
    on_bad_card: str = "page",
) -> DataFrame:
    """Result table of one surface for pages taken as they come, without a keyword
    list: ``(keyword, order, ...)``."""
    rows = page_rows(pages, surface, articles, max_rows, on_bad_card)
    return numbered(rows, "keyword").select(*ROWS[surface.name].fieldNames())


def one_capture(rows: DataFrame) -> DataFrame:
    """One row per platform and keyword: of several captures of a page the one with
    the most rows, so a failed capture hides none."""
    best = F.max(F.struct(F.coalesce(F.size("rows"), F.lit(-1)).alias("n"), "rows"))
    return rows.groupBy(*PAGE).agg(best.alias("best")).select(*PAGE, "best.rows")


def extract_tables(
    keywords: DataFrame,
    captures: DataFrame | CaptureStore,
    articles: DataFrame | ArticleStore | None = None,
    platforms: Sequence[str] | None = None,
    max_rows: int | None = None,
    on_bad_card: str = "page",
    known: Platforms = PLATFORMS,
) -> dict[str, DataFrame]:
    """Results for a stored table ``(kw_pos, keyword)`` as three staged tables with
    their positions.

    Repeated keywords and repeated platforms repeat their rows.
    """
    return collect(keywords, captures, articles, platforms, max_rows, on_bad_card, known)[0]


#: Rows per kind and platform position, from 1; repeats of a platform have one each.
Counts = dict[str, dict[int, int]]


def collect(
    keywords: DataFrame,
    captures: DataFrame | CaptureStore,
    articles: DataFrame | ArticleStore | None = None,
    platforms: Sequence[str] | None = None,
    max_rows: int | None = None,
    on_bad_card: str = "page",
    known: Platforms = PLATFORMS,
) -> tuple[dict[str, DataFrame], DataFrame, Counts]:
    """The three tables, the pages that failed and the tables' row counts; each page is
    read once for all, and rows are counted while their table is staged."""
    names = known.chosen(platforms)
    isolation(on_bad_card)  # refuse a bad choice before any work starts
    keywords = keywords.select(F.col("kw_pos").cast("long").alias("kw_pos"), "keyword")
    requests = keywords.select(
        F.explode(platform_positions(names, known)).alias("p"), "kw_pos", "keyword"
    ).select("p.*", "kw_pos", "keyword")
    wanted = keywords.select("keyword")

    stated = stated_surfaces(
        lambda sharing, kind: surface_pages(captures, sharing, kind, wanted), names, articles, max_rows, on_bad_card, known
    )

    positions = range(1, len(names) + 1)
    each = [F.count_if(F.col("platform_pos") == at).alias(str(at)) for at in positions]

    def table_of(kind: str) -> tuple[DataFrame, dict[int, int]]:
        rows = rows_of(stated, kind, max_rows)
        if rows is None:
            return keywords.sparkSession.createDataFrame([], with_positions(kind)), dict.fromkeys(positions, 0)
        joined = lookup_join(requests, rows, PAGE)
        table = numbered(joined, *POSITIONS, "keyword").select(*POSITIONS, *ROWS[kind].fieldNames())
        staged, found = stage_counted(table, kind, *each)
        return staged, {at: found[str(at)] for at in positions}

    with ThreadPoolExecutor(len(ROWS)) as pool:
        run = inheritable_thread_target(keywords.sparkSession)(table_of)
        made = dict(zip(ROWS, pool.map(run, ROWS)))
    # The key filter may let a few pages through that nobody asked for.
    failed = lookup_join(rejected_of(stated, max_rows), wanted.distinct(), ["keyword"], "left_semi")
    return {kind: table for kind, (table, _) in made.items()}, failed, {kind: n for kind, (_, n) in made.items()}


def rejected_of(stated: Stated, max_rows: int | None = None) -> DataFrame:
    """Pages of any kind that failed as a whole, with the reason."""
    return reduce(
        DataFrame.unionByName,
        (_rejected(pages, surface, _limit(surface, max_rows)) for found in stated.values() for surface, pages in found),
    )


def rows_of(stated: Stated, kind: str, max_rows: int | None = None) -> DataFrame | None:
    """``(platform, keyword, rows)`` of one kind, one row per page key; None if no
    platform has such pages."""
    parts = [_rows_of(pages, surface, _limit(surface, max_rows)) for surface, pages in stated[kind]]
    return one_capture(reduce(DataFrame.unionByName, parts)) if parts else None


def definitions(names: Sequence[str], kind: str, known: Platforms) -> list[tuple[Surface, list[str]]]:
    """Surface definitions of one kind with the platforms sharing them, so that these
    share one pass over their pages."""
    found: dict[int, tuple[Surface, list[str]]] = {}
    for name in dict.fromkeys(names):
        surface = known.known[name].get(kind)
        if surface is not None:
            found.setdefault(id(surface), (surface, []))[1].append(name)
    return list(found.values())


def final_order(table: DataFrame) -> list[str]:
    """The columns a result table is sorted by; without them it has no final order."""
    order = [*POSITIONS, "order"]
    missing = [c for c in order if c not in table.columns]
    if missing:
        raise ValueError(f"a result table without {missing} has no final order")
    return order


def public_table(table: DataFrame, kind: str) -> DataFrame:
    """A result table in final order, without its positions."""
    return table.orderBy(*final_order(table)).select(*ROWS[kind].fieldNames())


def union_tables(*bundles: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Bag union, kind by kind; a kind missing everywhere stays missing (ST1)."""
    kinds = [kind for kind in ROWS if any(kind in b for b in bundles)]
    return {
        kind: reduce(DataFrame.unionByName, (b[kind] for b in bundles if kind in b)) for kind in kinds
    }
