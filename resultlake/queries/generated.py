"""Captured pages made from the driver's tables.

Every row of a table becomes one result page, its cards numbered within the page, so
pages grow in number with the table and never in size, and no shuffle is needed to make
them. What a card holds follows from its ``card_id`` (page key * 100 + card number); the
same rules, stated as SQL both engines understand, give the expected rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _keys(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table's key rows, dealt over the cores before pages are made of them."""
    cores = spark.sparkContext.defaultParallelism
    return table(spark, sf_dir, name).select(*columns).repartition(cores, columns[0])


# Rules shared with the oracles, in terms of card_id.
POSTED = "date_add(date '2019-01-01', cast((card_id * 37) % 2500 as int))"
FOUND = "date_add(date '2019-01-01', cast((card_id * 37) % 2500 + 1 as int))"
IS_AD = "card_id % 7 = 0"
IS_RELATIVE = "card_id % 9 = 8"
HAS_ARTICLE = "card_id % 2 = 0"
HAS_FRAME = "card_id % 12 <> 4"
HAS_FRAMED_PAGE = "card_id % 12 <> 8"
IS_BROKEN = "card_id % 17 = 9"

BLOG_SIZE = "6 + k % 15"
BLOG_NO_PROFILE = "card_id % 11 = 3"
BLOG_NO_NAME = "card_id % 13 = 5"
BLOG_ROOTED = "card_id % 4 = 0"

CAFE_SIZE = "5 + k % 14"
CAFE_NO_NAME = "card_id % 11 = 3"
CAFE_BLANK_SUBJECT = "card_id % 13 = 5"
CAFE_JUNK_FIRST = "card_id % 6 = 2"

BLOCK_SIZE = "14 + k % 12"

_SHOWN = f"""case card_id % 9
    when 0 then date_format({POSTED}, 'yyyy.MM.dd.')
    when 1 then date_format({POSTED}, 'yyyy.M.d')
    when 2 then date_format({POSTED}, 'yyyy. M. d.')
    when 3 then date_format({POSTED}, 'yyyy-MM-dd')
    when 4 then date_format({POSTED}, 'yyyyMMdd')
    when 5 then concat(date_format({POSTED}, 'yyyy-MM-dd'), 'T23:30:00Z')
    when 6 then concat(date_format({POSTED}, 'yyyy.M.d.'), ' 9:05')
    when 7 then concat('  ', date_format({POSTED}, 'yyyy. M. d'), ' 23:59 ')
    else concat(card_id % 6 + 1, '일 전') end"""

# An article no card links to: it must not be read.
UNLINKED = "<html><body><iframe id=\"mainFrame\" src=\"/x\"></iframe>" + "<p>text</p>" * 40 + "</body></html>"

_AD_BADGE = (
    '<a class="fender-ui_1a x" href="https://ader.naver.com/1">'
    '<svg class="fender-ui_c3b5e09c y fender-ui_08aaffd5"></svg></a>'
)


def _pages(keys: DataFrame, size: str, card: str, head: str, tail: str) -> DataFrame:
    """``(k, keyword)`` to captured pages; ``card`` is one card's HTML, given card_id."""
    card = re.sub(r"\bcard_id\b", "(k * 100 + i)", card)
    html = f"concat('{head}', array_join(transform(sequence(1, cast({size} as int)), i -> {card}), ''), '{tail}')"
    return keys.selectExpr(
        "'naver' as platform",
        "keyword",
        "concat('https://search.naver.com/search.naver?where=nexearch&query=', k, '#top') as page_url",
        f"{html} as html",
    )


def _cards(keys: DataFrame, size: str) -> DataFrame:
    """One row per card, for what exists once per card (its article)."""
    numbers = f"explode(sequence(1, cast({size} as int))) as i"
    return keys.selectExpr("k", numbers).selectExpr("k", "k * 100 + i as card_id")


def blog_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _keys(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment")
    return rows.selectExpr(
        "c_custkey as k", "concat(c_mktsegment, ' ', c_name) as keyword", "c_name as name", "c_mktsegment as seg"
    )


_BLOG_HREF = (
    f"case when {BLOG_ROOTED} then concat('/u', k, '/', card_id) else concat('https://blog.naver.com/u', k, '/', card_id, '?utm=1#x') end"
)


def blog_pages(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """Blog tab pages from ``customer``; with ``broken`` some cards lack their date
    element or every link but the author's."""
    date = f"concat('<span class=\"sds-comps-profile-info-subtext\"><i>', {_SHOWN}, '</i></span>')"
    post = (
        f"concat('<a href=\"', {_BLOG_HREF}, '\"><img src=\"t.png\"></a><a href=\" ', {_BLOG_HREF}, "
        "'\">Order \t', card_id, ' &amp; <b>', seg, '</b></a>')"
    )
    if broken:
        date = f"case when {IS_BROKEN} and card_id % 2 = 0 then '' else {date} end"
        post = f"case when {IS_BROKEN} and card_id % 2 = 1 then '' else {post} end"
    profile = (
        "concat('<div class=\"sds-comps-profile x\"><div class=\"sds-comps-profile-info-title-text\">"
        "<a href=\"https://blog.naver.com/u', k, '\">', "
        f"case when {BLOG_NO_NAME} then '&nbsp;' else concat('  ', name, ' ') end, '</a></div>', {date}, '</div>')"
    )
    opening = "case when card_id % 5 = 0 then '<div class=\"_fe_view_power_content\">' else '<div data-template-id=\"ugcItem\">' end"
    card = (
        f"concat({opening}, case when {BLOG_NO_PROFILE} then '<p>' else {profile} end, "
        f"case when {IS_AD} then '{_AD_BADGE}' else '' end, "
        "'<a href=\"https://keep.naver.com/save\">Keep</a><a href=\"/search.naver?q=1#more\">More</a>"
        "<a href=\"https://help.naver.com/support\">Help</a><a href=\"#\">Top</a><a href=\"javascript:void(0)\">Menu</a>', "
        f"{post}, '<script>var a = \"</div>\";</script></div>')"
    )
    return _pages(
        blog_keys(spark, sf_dir),
        BLOG_SIZE,
        card,
        "<!DOCTYPE html><html><body><section class=\"sc_new sp_nblog\">",
        "</section></body></html>",
    )


def blog_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article pages behind blog cards with a relative date: outer page and frame."""
    cards = _cards(blog_keys(spark, sf_dir), BLOG_SIZE).where(f"{IS_RELATIVE} and {HAS_ARTICLE}")
    outer = cards.selectExpr(
        f"case when {BLOG_ROOTED} then concat('https://search.naver.com/u', k, '/', card_id) "
        "else concat('https://blog.naver.com/u', k, '/', card_id, '?utm=1#x') end as url",
        f"concat('<html><body>', case when {HAS_FRAME} then concat('<iframe id=\"mainFrame\" src=\"/PostView.naver?b=u', k, "
        "'&amp;no=', card_id, '\"></iframe>') else '<p>' end, '</body></html>') as html",
    )
    failed = outer.selectExpr("url", "cast(null as string) as html")  # captured again, in vain
    unlinked = _cards(blog_keys(spark, sf_dir), BLOG_SIZE).selectExpr(
        "concat('https://elsewhere.example/', card_id) as url", f"'{UNLINKED}' as html"
    )
    inner = cards.where(HAS_FRAMED_PAGE).selectExpr(
        "concat('https://blog.naver.com/PostView.naver?b=u', k, '&no=', card_id) as url",
        "concat('<div class=\"se-component-content\"><span class=\"blog_date\">today</span>"
        f"<span class=\"se_publishDate pcol2\">', date_format({FOUND}, 'yyyy. M. d.'), ' 10:20</span></div>') as html",
    )
    return outer.unionByName(failed).unionByName(inner).unionByName(unlinked)


def cafe_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _keys(spark, sf_dir, "part", "p_partkey", "p_name")
    return rows.selectExpr("p_partkey as k", "concat(p_name, ' ', p_partkey) as keyword", "p_name as name")


def cafe_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Community tab pages from ``part``."""
    ad = f"case when {IS_AD} then case card_id % 3 when 0 then '{_AD_BADGE}' when 1 then '<i class=\"ico_ad\"></i>' else '<a class=\"link_ad\"></a>' end else '' end"
    name = f"case when {CAFE_NO_NAME} then '' else concat('<a class=\"name\" href=\"/c', k, '\">Club <b>', name, '</b></a>') end"
    card = (
        f"concat('<li class=\"bx\">', {ad}, '<div class=\"user_info\">', {name}, '<span class=\"sub\">', {_SHOWN}, "
        "'</span></div><div class=\"title_area\"><a class=\"title_link\">no link</a>"
        "<a class=\"api_txt title_link\" href=\"https://cafe.naver.com/c', k, '/', card_id, '?q=1#f\">', "
        f"case when {CAFE_BLANK_SUBJECT} then '<br>' else concat('Post', '<br>', card_id, '<!-- x -->') end, '</a></div></li>')"
    )
    return _pages(
        cafe_keys(spark, sf_dir),
        CAFE_SIZE,
        card,
        "<html><body><div id=\"main_pack\"><section class=\"sc_new sp_ncafe\"><ul>",
        "</ul></section></div></body></html>",
    )


def cafe_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards = _cards(cafe_keys(spark, sf_dir), CAFE_SIZE).where(f"{IS_RELATIVE} and {HAS_ARTICLE}")
    outer = cards.selectExpr(
        "concat('https://cafe.naver.com/c', k, '/', card_id) as url",
        f"case when {HAS_FRAME} then concat('<iframe id=\"cafe_main\" src=\"../ca-fe/', card_id, '?from=x\"></iframe>') "
        "else '<iframe id=\"other\" src=\"/x\"></iframe>' end as html",
    )
    inner = cards.where(HAS_FRAMED_PAGE).selectExpr(
        "concat('https://cafe.naver.com/ca-fe/', card_id, '?from=x') as url",
        f"concat('<div class=\"article_header\">', case when {CAFE_JUNK_FIRST} then '<span class=\"date\">now</span>' else '' end, "
        f"'<span class=\"date\">', date_format({FOUND}, 'yyyy.MM.dd.'), ' 10:20</span></div>') as html",
    )
    again = inner.selectExpr("url", "'<html><body>gone</body></html>' as html")  # an error page
    return outer.unionByName(inner).unionByName(again)


def block_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _keys(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    return rows.selectExpr("s_suppkey as k", "s_name as keyword", "s_name as name")


def smartblock_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main result pages from ``supplier``: eight kinds of block in turn."""
    footer = (
        "'<div data-template-id=\"footer\" data-template-type=\"more\"><a href=\"/more?id=', card_id, '\" data-lb-trigger=\"https://s.search.naver.com/p/qa?ssc=tab.itb.qab&amp;id=', card_id, '\">"
        "<span class=\"fds-comps-footer-more-subject\">', name, '</span><span class=\"fds-comps-footer-more-button-text\">'"
    )
    card = f"""case card_id % 8
        when 0 then '<script data-slog-container="s">var x = 1;</script>'
        when 1 then '<div class="api_sc_page_wrap z" data-slog-container="s">paging</div>'
        when 2 then '<section data-slog-container="s">plain</section>'
        when 3 then concat('<section><div id="pcPowerLink_1"><div class="mod_title_area"><h2 class="title">Ad ', card_id, '</h2></div>',
            '<a href="https://map.naver.com/1">map</a><a href="https://ad.search.naver.com/search.naver?where=ad&amp;query=', card_id, '">more</a></div></section>')
        when 4 then concat('<div data-slog-container="s"><div data-sds-comp="Header"><span class="sds-comps-text-type-headline1 q">Asked ', card_id, '</span></div>', {footer}, 'more</span></a></div></div>')
        when 5 then concat('<div data-slog-container="s"><div data-sds-comp="Header"><h2 class="sds-comps-text">', name, ' <em>images</em></h2></div>', {footer}, '</span></a></div>',
            '<a href="#">x</a><a href="?where=image&amp;query=', card_id, '">images</a></div>')
        when 6 then concat('<div data-slog-container="s"><div class="mod_title_area"><h2 class="title">', case when card_id % 3 = 0 then ' ' else 'Plain' end, '</h2></div></div>')
        else '<div>no container</div>' end"""
    return _pages(
        block_keys(spark, sf_dir),
        BLOCK_SIZE,
        card.replace("\n", " "),
        "<html><body><div id=\"main_pack\">text<link rel=\"x\">",
        "</div><div id=\"main_pack\"><div data-slog-container=\"s\">second</div></div></body></html>",
    )


def captured(spark: SparkSession, sf_dir: str, platforms=("naver",)) -> DataFrame:
    """All three surfaces as one captures table, the same pages for each platform."""
    made = {
        "smartblock": smartblock_pages(spark, sf_dir),
        "cafe": cafe_pages(spark, sf_dir),
        "blog": blog_pages(spark, sf_dir),
    }
    pages = None
    for surface, found in made.items():
        for platform in platforms:
            one = found.withColumn("surface", F.lit(surface)).withColumn("platform", F.lit(platform))
            pages = one if pages is None else pages.unionByName(one)
    return pages.select("platform", "surface", "keyword", "page_url", "html")
