"""Card rules as column expressions over one page's card array (PR1-PR6, PX7-PX10).

A page is one row and its cards one array, bounded by the page itself, so filters,
choices and limits need no shuffle. Each rule gives every surviving card a state:

    ready   accepted, date known
    fetch   accepted if the linked article names a date
    broken  would make the reference's reader give up on the page, once reached
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from resultlake.functions import (
    absolute_url,
    canonical_url,
    finish_more_url,
    is_malformed_url,
    is_unfetchable_url,
    lb_trigger_url,
    normalize_text,
    nullif_empty,
    parse_clean_date,
)

# Fixed values of the portal.
PORTAL = "https://search.naver.com"
SEARCH_PAGE = PORTAL + "/search.naver"
CLIP_PREFIX = "https://keep.naver.com/"
HELP_HOST = "help.naver.com"
IGNORED_BLOCK_CLASSES = [
    "_scrollLog",
    "_scrollLogEndline",
    "_search_option_detail_wrap",
    "api_sc_page_wrap",
    "ct_feed_wrap",
]

READY, FETCH, BROKEN, SKIP = "ready", "fetch", "broken", "skip"


def _dated(state: Column, date: Column, name: Column, subject: Column, url: Column) -> Column:
    return F.struct(
        state.alias("state"),
        name.alias("name"),
        subject.alias("subject"),
        url.alias("url"),
        date.alias("date"),
    )


def _kept(cards: Column) -> Column:
    return F.filter(cards, lambda c: c["state"] != SKIP)


def _is_subject(link: Column, name: Column, author: Column) -> Column:
    """The post's own link: not the author, a clip button, an in-page jump or help."""
    jump = link["url"].startswith(SEARCH_PAGE) & link["url"].contains("#")
    return (
        link["url"].isNotNull()
        & (link["text"] != "")
        & (link["url"] != author)
        & (link["text"] != name)
        & ~link["url"].startswith(CLIP_PREFIX)
        & ~jump
        & ~link["url"].contains(HELP_HOST)
    )


def _may_be_subject(link: Column) -> Column:
    """Cheap tests on an anchor as written, before its text is cleaned and its address
    resolved: what fails them is neither a subject nor malformed."""
    href = link["href"]
    harmless = href.rlike(r"\A[\x00-\x5a\x5c\x5e-\x7f]*\z")  # ASCII without brackets
    unusable = href.isin("#", "") | href.startswith("javascript:")
    elsewhere = href.startswith(CLIP_PREFIX) | href.startswith("https://" + HELP_HOST)
    return ~harmless | ~(unusable | elsewhere | (F.trim(link["text"]) == ""))


def blog_cards(cards: Column, page_url: Column) -> Column:
    """Raw blog cards to stated cards (PX4, PX10, PR3, PR5)."""
    shown = F.filter(cards, lambda c: ~c["is_ad"] & c["has_profile"])
    read = F.transform(
        shown,
        lambda c: F.struct(
            (c["name"].isNull() | is_malformed_url(c["name"]["href"])).alias("no_author"),
            normalize_text(c["name"]["text"]).alias("name"),
            absolute_url(PORTAL, c["name"]["href"]).alias("author"),
            F.when(c["date_text"].isNotNull(), normalize_text(c["date_text"])).alias("date_text"),
            F.transform(
                F.filter(c["anchors"], _may_be_subject),
                lambda a: F.struct(
                    normalize_text(a["text"]).alias("text"),
                    absolute_url(PORTAL, a["href"]).alias("url"),
                    is_malformed_url(a["href"]).alias("malformed"),
                ),
            ).alias("links"),
        ),
    )
    chosen = F.transform(
        read,
        lambda c: F.struct(
            c["no_author"].alias("no_author"),
            c["name"].alias("name"),
            c["author"].alias("author"),
            c["date_text"].alias("date_text"),
            parse_clean_date(c["date_text"]).alias("date"),
            F.try_element_at(
                F.filter(
                    c["links"],
                    lambda link: link["malformed"] | _is_subject(link, c["name"], c["author"]),
                ),
                F.lit(1),
            ).alias("link"),
        ),
    )
    return _kept(
        F.transform(
            chosen,
            lambda c: _dated(
                F.when(c["no_author"], BROKEN)
                .when((c["name"] == "") | c["author"].isNull(), SKIP)
                .when(c["link"].isNull() | c["link"]["malformed"] | c["date_text"].isNull(), BROKEN)
                .when(c["date"].isNotNull(), READY)
                .when(is_unfetchable_url(c["link"]["url"]), BROKEN)
                .otherwise(FETCH),
                c["date"],
                c["name"],
                c["link"]["text"],
                c["link"]["url"],
            ),
        )
    )


def cafe_cards(cards: Column, page_url: Column) -> Column:
    """Raw community cards to stated cards (PX6, PR4, PR6)."""
    shown = F.filter(
        cards,
        lambda c: ~c["is_ad"]
        & c["name_text"].isNotNull()
        & c["date_text"].isNotNull()
        & c["subject"].isNotNull(),
    )
    read = F.transform(
        shown,
        lambda c: F.struct(
            normalize_text(c["name_text"]).alias("name"),
            normalize_text(c["subject"]["text"]).alias("subject"),
            canonical_url(PORTAL, c["subject"]["href"]).alias("url"),
            is_malformed_url(c["subject"]["href"]).alias("malformed"),
            parse_clean_date(normalize_text(c["date_text"])).alias("date"),
        ),
    )
    return _kept(
        F.transform(
            read,
            lambda c: _dated(
                F.when(c["malformed"], BROKEN)
                .when((c["name"] == "") | (c["subject"] == "") | c["url"].isNull(), SKIP)
                .when(c["date"].isNotNull(), READY)
                .otherwise(FETCH),
                c["date"],
                c["name"],
                c["subject"],
                c["url"],
            ),
        )
    )


def _is_block(block: Column) -> Column:
    return (
        ~block["tag"].isin("script", "link")
        & ~F.arrays_overlap(block["classes"], F.lit(IGNORED_BLOCK_CLASSES))
        & F.when(block["tag"] == "section", block["has_powerlink"]).otherwise(
            F.coalesce(block["slog"], F.lit("")) != ""
        )
        & block["has_text"]
    )


def _block_title(block: Column) -> Column:
    titles = F.filter(F.transform(block["titles"], normalize_text), lambda t: t != "")
    return F.when(
        block["tag"] == "section", nullif_empty(normalize_text(block["ad_title"]))
    ).otherwise(F.try_element_at(titles, F.lit(1)))


def smartblock_cards(cards: Column, page_url: Column, max_rows: int) -> Column:
    """Raw blocks of the main page to stated cards (PX2, PX7-PX9, PR1, PR2, URL5-URL7).

    Every block that passes the filters becomes a row, so the limit comes first.
    """
    base = F.coalesce(nullif_empty(page_url), F.lit(SEARCH_PAGE))
    blocks = F.slice(F.filter(cards, _is_block), 1, max_rows)
    linked = F.transform(
        blocks,
        lambda b: F.struct(
            _block_title(b).alias("title"),
            F.transform(
                F.concat(
                    F.filter(
                        F.array(F.struct(b["footer"]["lb_trigger"], b["footer"]["href"])),
                        lambda _: (normalize_text(b["footer"]["subject"]) != "")
                        & (normalize_text(b["footer"]["button"]) != ""),
                    ),
                    b["fallbacks"],
                ),
                lambda a: F.struct(
                    lb_trigger_url(base, a["lb_trigger"]).alias("lazy"),
                    absolute_url(base, a["href"]).alias("direct"),
                    is_malformed_url(a["lb_trigger"]).alias("lazy_malformed"),
                    is_malformed_url(a["href"]).alias("direct_malformed"),
                ),
            ).alias("links"),
        ),
    )
    picked = F.transform(
        linked,
        lambda b: F.struct(
            b["title"].alias("title"),
            F.try_element_at(
                F.filter(
                    F.transform(
                        b["links"],
                        lambda a: F.struct(
                            F.coalesce(a["lazy"], a["direct"]).alias("url"),
                            F.when(a["lazy"].isNotNull(), a["lazy_malformed"])
                            .otherwise(a["direct_malformed"])
                            .alias("malformed"),
                        ),
                    ),
                    lambda a: a["url"].isNotNull() | a["malformed"],
                ),
                F.lit(1),
            ).alias("link"),
        ),
    )
    return F.transform(
        picked,
        lambda b: F.struct(
            F.when(b["link"]["malformed"], BROKEN).otherwise(READY).alias("state"),
            F.coalesce(b["title"], F.lit("None")).alias("title"),
            F.coalesce(finish_more_url(b["link"]["url"]), F.lit("None")).alias("url"),
        ),
    )
