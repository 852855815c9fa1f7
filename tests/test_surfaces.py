"""Surfaces on hand-written pages: what is kept, dropped, followed and failed."""

import datetime
import random

import pytest

from resultlake.operators import cards
from resultlake.operators.cards import extract
from resultlake.plans.extraction import surface_table
from resultlake.sources.registry import BLOG, CAFE, SMARTBLOCK

D = datetime.date
SVG = "<a class='fender-ui_x'><svg class='fender-ui_08aaffd5 fender-ui_c3b5e09c'></svg></a>"


def pages_of(spark, *html, page_url="https://search.naver.com/search.naver?query=x#f"):
    rows = [("naver", f"k{i}", page_url, page) for i, page in enumerate(html)]
    return spark.createDataFrame(rows, "platform string, keyword string, page_url string, html string")


def articles_of(spark, **pages):
    return spark.createDataFrame(list(pages.items()) or [("-", "-")], "url string, html string")


def rows_of(table, *columns):
    found = sorted(table.collect(), key=lambda r: (r["keyword"], r["order"]))
    orders = {}
    for row in found:
        orders.setdefault(row["keyword"], []).append(row["order"])
    assert all(o == list(range(1, len(o) + 1)) for o in orders.values())
    return [tuple(r[c] for c in columns) for r in found]


# -- blog --------------------------------------------------------------------
def blog_card(date="2025.01.02.", name="Name", name_href="https://blog.naver.com/u", post="<a href='/p'>Post</a>",
              profile=True, extra=""):
    link = "" if name is None else f"<a href='{name_href}'>{name}</a>"
    shown = "" if date is None else f"<span class='sds-comps-profile-info-subtext'>{date}</span>"
    inner = f"<div class='sds-comps-profile'><p class='sds-comps-profile-info-title-text'>{link}</p>{shown}</div>"
    return f"<div data-template-id='ugcItem'>{inner if profile else ''}{extra}{post}</div>"


def blog_page(*cards):
    return "<section class='sc_new sp_nblog'>" + "".join(cards) + "</section>"


def blog(spark, *cards, articles=None, **options):
    table = surface_table(pages_of(spark, blog_page(*cards)), BLOG, articles, **options)
    return rows_of(table, "date", "blog_name", "subject", "url")


GOOD = (D(2025, 1, 2), "Name", "Post", "https://search.naver.com/p")


def test_blog_clean_card(spark):
    assert blog(spark, blog_card()) == [GOOD]


def test_blog_limits(spark):
    from dataclasses import replace

    pages = pages_of(spark, blog_page(*[blog_card()] * 12))
    for surface, max_rows, count in [(BLOG, None, 10), (BLOG, 3, 3), (BLOG, -1, 1), (replace(BLOG, max_rows=2), None, 2)]:
        assert surface_table(pages, surface, max_rows=max_rows).count() == count


def test_blog_cards_outside_the_section(spark):
    card = blog_card()
    html = card + "<div class='_fe_view_power_content'>" + card + "</div>" + "<section class='sc_new sp_nblog'>" + card
    table = surface_table(pages_of(spark, html), BLOG)
    assert rows_of(table, "subject") == [("Post",), ("Post",)]


def test_blog_skipped_cards(spark):
    cards = [
        blog_card(extra=SVG),
        blog_card(profile=False),
        blog_card(name="  "),
        blog_card(name_href="#"),
        blog_card(name_href="javascript:x"),
        blog_card(date="3일 전"),
        blog_card(post="<a href='/p'>ok</a>"),
    ]
    assert [r[2] for r in blog(spark, *cards)] == ["ok"]


def test_blog_subject_choice(spark):
    links = (
        "<a href='https://blog.naver.com/u'>author page</a><a href='/n'>Name</a><a href='https://keep.naver.com/x'>keep</a>"
        "<a href='/search.naver?a=1#more'>jump</a><a href='https://help.naver.com/x'>help</a><a href='#'>top</a>"
        "<a href='javascript:go()'>go</a><a href='/img'><img></a><a>no link</a>"
        "<a href=' /search.naver?a=1 '>The  <b>post</b>!</a><a href='/later'>later</a>"
    )
    assert blog(spark, blog_card(post=links)) == [
        (D(2025, 1, 2), "Name", "The post !", "https://search.naver.com/search.naver?a=1")
    ]


@pytest.mark.parametrize(
    "broken",
    [
        blog_card(name=None),
        blog_card(date=None),
        blog_card(post=""),
        blog_card(name_href="http://["),
        blog_card(post="<a href='//]'>x</a><a href='/p'>Post</a>"),
        blog_card(date="어제", post="<a href='/한글'>x</a>"),
        blog_card(date="어제", post="<a href='/a b'>x</a>"),
    ],
)
def test_blog_broken_card_fails_its_page_once_reached(spark, broken):
    pages = pages_of(
        spark,
        blog_page(blog_card(), broken),
        blog_page(*[blog_card()] * 10, broken),
        blog_page(*[blog_card()] * 9, broken, blog_card()),
        blog_page(blog_card()),
    )
    found = rows_of(surface_table(pages, BLOG), "keyword")
    assert found == [("k1",)] * 10 + [("k3",)]
    milder = rows_of(surface_table(pages, BLOG, on_bad_card="card"), "keyword")
    assert milder == [("k0",)] + [("k1",)] * 10 + [("k2",)] * 10 + [("k3",)]


def test_blog_malformed_link_behind_the_subject_is_harmless(spark):
    assert blog(spark, blog_card(post="<a href='/p'>Post</a><a href='http://['>x</a>")) == [GOOD]


def test_unreadable_card_without_name_is_skipped_before_it_can_fail(spark):
    assert blog(spark, blog_card(name=" ", date=None, post=""), blog_card()) == [GOOD]


def blog_frame(date):
    return f"<div class='se-component-content'><i class='se_publishDate'>{date}</i></div>"


def test_blog_articles(spark):
    outer = "https://search.naver.com/"
    articles = articles_of(
        spark,
        **{
            outer + "a": "<iframe src='/PostView.naver?x=1&amp;y=2'></iframe><iframe id='mainFrame' src=' /main  '></iframe>",
            "https://blog.naver.com/main": "<div class='se-component-content'><b class='blog_date'>soon</b>"
            "<b class='blog_date'>2024. 2. 29. 10:20</b><i class='se_publishDate'>2023.1.1.</i></div>",
            outer + "b": "<iframe src='https://x/PostView.naver'></iframe>",
            "https://x/PostView.naver": blog_frame("2022-02-02"),
            outer + "c": "<iframe id='mainFrame'></iframe><p>no frame address</p>",
            outer + "d": "<iframe id='mainFrame' src='/gone'></iframe>",
            outer + "e": "<iframe id='mainFrame' src='/none'></iframe>",
            "https://blog.naver.com/none": blog_frame("어제"),
        },
    )
    cards = [blog_card(date="1시간 전", post=f"<a href='/{p}'>{p}</a>") for p in "abcdef"]
    assert [(r[0], r[2]) for r in blog(spark, *cards, articles=articles)] == [
        (D(2024, 2, 29), "a"),
        (D(2022, 2, 2), "b"),
    ]


def test_blog_shown_date_wins_over_article(spark):
    articles = articles_of(spark, **{
        "https://search.naver.com/p": "<iframe id='mainFrame' src='/i'></iframe>",
        "https://blog.naver.com/i": blog_frame("2020.1.1"),
    })
    assert blog(spark, blog_card(), articles=articles) == [GOOD]


def test_blog_refused_frame_address_fails_the_page(spark):
    articles = articles_of(spark, **{
        "https://search.naver.com/a": "<iframe id='mainFrame' src='/한글'></iframe>",
        "https://search.naver.com/b": "<iframe id='mainFrame' src='/i'></iframe>",
        "https://blog.naver.com/i": blog_frame("2020.1.1"),
    })
    undated = {p: blog_card(date="어제", post=f"<a href='/{p}'>{p}</a>") for p in "ab"}
    assert blog(spark, blog_card(), undated["a"], articles=articles) == []
    assert len(blog(spark, undated["b"], undated["a"], articles=articles, max_rows=1)) == 1
    assert len(blog(spark, undated["b"], undated["a"], articles=articles, max_rows=2)) == 0
    kept = blog(spark, undated["a"], undated["b"], articles=articles, on_bad_card="card")
    assert [r[2] for r in kept] == ["b"]


def test_found_dates_count_towards_the_limit_before_a_broken_card(spark):
    articles = articles_of(spark, **{
        "https://search.naver.com/b": "<iframe id='mainFrame' src='/i'></iframe>",
        "https://blog.naver.com/i": blog_frame("2020.1.1"),
    })
    found = blog_card(date="어제", post="<a href='/b'>b</a>")
    missed = blog_card(date="어제", post="<a href='/z'>z</a>")
    assert len(blog(spark, found, found, blog_card(date=None), articles=articles, max_rows=2)) == 2
    assert len(blog(spark, found, missed, blog_card(date=None), articles=articles, max_rows=2)) == 0


# -- cafe --------------------------------------------------------------------
def cafe_card(date="2025.1.2", name="<a class='name' href='/c'>Club</a>", link="<a class='title_link' href='/p?q=1#f'>Post</a>", extra=""):
    return (
        f"<li class='bx'>{extra}<div class='user_info'>{name}<span class='sub'>{date}</span></div>"
        f"<div class='title_area'>{link}</div></li>"
    )


def cafe(spark, *cards, articles=None, **options):
    page = "<div id='main_pack'><section class='sc_new sp_ncafe'><ul>" + "".join(cards) + "</ul></section></div>"
    table = surface_table(pages_of(spark, page), CAFE, articles, **options)
    return rows_of(table, "date", "cafe_name", "subject", "url")


def test_cafe_cards(spark):
    cards = [
        cafe_card(),
        cafe_card(extra="<i class='ico_ad'></i>"),
        cafe_card(extra="<a class='link_ad'></a>"),
        cafe_card(extra=SVG),
        cafe_card(name=""),
        cafe_card(link="<a class='title_link'>x</a>"),
        cafe_card(link="<a class='title_link' href='#'>x</a>"),
        cafe_card(link="<a class='title_link' href='/p'> </a>"),
        cafe_card(date="어제"),
        cafe_card(date="", name="<a class='name'>x</a>"),
        cafe_card(date="2025-01-03", link="<a class='title_link' href='HTTP://X.y/a;p?q#f'>Two  <b>words</b></a>"),
    ]
    assert cafe(spark, *cards) == [
        (D(2025, 1, 2), "Club", "Post", "https://search.naver.com/p"),
        (D(2025, 1, 3), "Club", "Two words", "http://X.y/a;p"),
    ]


def test_cafe_malformed_link_fails_the_page_only_with_all_elements(spark):
    bad = "<a class='title_link' href='http://['>x</a>"
    assert cafe(spark, cafe_card(), cafe_card(link=bad)) == []
    assert len(cafe(spark, cafe_card(), cafe_card(link=bad, name=""))) == 1


def test_cafe_articles_take_the_first_date_only(spark):
    articles = articles_of(spark, **{
        "https://search.naver.com/a": "<iframe src='/x'></iframe><iframe id='cafe_main' src='in?1'></iframe>",
        "https://search.naver.com/in?1": "<div class='article_header'><span class='date'>2024.01.05. 9:00</span></div>",
        "https://search.naver.com/b": "<iframe id='cafe_main' src='//h/2'></iframe>",
        "https://h/2": "<div class='article_header'><span class='date'>now</span><span class='date'>2024.1.5</span></div>",
    })
    cards = [cafe_card(date="어제", link=f"<a class='title_link' href='/{p}?x'>{p}</a>") for p in "abc"]
    assert [(r[0], r[2]) for r in cafe(spark, *cards, articles=articles)] == [(D(2024, 1, 5), "a")]


# -- smartblock --------------------------------------------------------------
def block(content, more=""):
    return f"<div data-slog-container='s'>{content}{more}</div>"


def smart(spark, *blocks, page_url="https://search.naver.com/search.naver?query=x#f", **options):
    pages = pages_of(spark, "<div id='main_pack'>" + "".join(blocks) + "</div>", page_url=page_url)
    return rows_of(surface_table(pages, SMARTBLOCK, **options), "title", "url")


def footer(subject="s", button="b", attrs="href='/more'"):
    return (
        f"<div data-template-id='footer' data-template-type='more'><a {attrs}><b class='fds-comps-footer-more-subject'>{subject}</b>"
        f"<b class='fds-comps-footer-more-button-text'>{button}</b></a></div>"
    )


HEADLINE = "<p data-sds-comp='Header'><span class='sds-comps-text-type-headline1'>One</span></p>"


def test_smartblock_blocks(spark):
    assert smart(
        spark,
        "<script data-slog-container='s'>x</script>",
        "<div data-slog-container=''>x</div>",
        "<div data-slog-container='s' class='a ct_feed_wrap'>x</div>",
        "<div data-slog-container='s'><img></div>",
        "<section data-slog-container='s'>x</section>",
        "<section><i id='pcPowerLink_z'></i><p class='mod_title_area'><b class='title'>Ads</b></p></section>",
        "<section><i class='pcPowerLink_dacf'></i>x</section>",
        "<div><div data-slog-container='s'>nested</div></div>",
        block(HEADLINE),
        block("<p class='mod_title_area'><h2 class='title'>Three</h2></p>"),
        block("<p data-sds-comp='Header'><span class='sds-comps-text-type-headline1'> </span><h2 class='sds-comps-text'>Two</h2></p>"),
    ) == [("Ads", "None"), ("None", "None"), ("One", "None"), ("Three", "None"), ("Two", "None")]


def test_smartblock_more_urls(spark):
    base = "https://search.naver.com"
    found = smart(
        spark,
        block(HEADLINE, footer()),
        block(HEADLINE, footer(button="") + "<a href='?page=2'>2</a>"),
        block(HEADLINE, footer(attrs="href='#' data-lb-trigger=' /api?a=b '")),
        block(HEADLINE, footer(attrs="href='/more' data-lb-trigger='javascript:x'")),
        block(HEADLINE, footer(attrs="href='#'") + "<a href='https://map.naver.com/p'>m</a><a href='/?where=image'>i</a>"),
        block(HEADLINE, "<a href='#lb_api=zz'>z</a>"),
        block(HEADLINE, footer(attrs="href='/m' data-lb-trigger='https://s.x/qa?ssc=tab.itb.qab'")),
        block(HEADLINE, "<a href='/?page=20'>first</a><a href='https://ad.search.naver.com/search.naver?where=ad'>ad</a>"),
    )
    page = base + "/search.naver?query=x"
    assert [url for _, url in found] == [
        base + "/more",
        base + "/search.naver?page=2",
        page + "#lb_api=https%3A%2F%2Fsearch.naver.com%2Fapi%3Fa%3Db",
        base + "/more",
        base + "/?where=image",
        page + "#lb_api=zz",
        page + "#lb_api=https%3A%2F%2Fs.x%2Fqa%3Fssc%3Dtab.itb.qab%26faq_opened%3D1",
        "https://ad.search.naver.com/search.naver?where=ad",
    ]


def test_smartblock_without_page_address(spark):
    for page_url in ("", None):
        assert smart(spark, block(HEADLINE, footer()), page_url=page_url) == [("One", "https://search.naver.com/more")]


def test_smartblock_limit_and_failure(spark):
    good, bad = block(HEADLINE, footer()), block(HEADLINE, footer(attrs="href='http://['"))
    assert len(smart(spark, *[good] * 12)) == 10
    assert len(smart(spark, *[good] * 10, bad)) == 10
    assert smart(spark, *[good] * 9, bad) == []
    assert len(smart(spark, *[good] * 3, bad, max_rows=3)) == 3
    assert len(smart(spark, *[good] * 3, max_rows=0)) == 1
    assert len(smart(spark, good, bad, good, on_bad_card="card")) == 2


# -- any surface ---------------------------------------------------------------
@pytest.mark.parametrize("html", ["", "<p>", None, "<![bad", "<section class='sc_new sp_nblog'>"])
def test_pages_without_cards(spark, html):
    for surface in (BLOG, CAFE, SMARTBLOCK):
        assert surface_table(pages_of(spark, html), surface).collect() == []


def test_result_does_not_depend_on_partitioning(spark):
    rng = random.Random(5)
    kinds = [blog_card(), blog_card(date=None), blog_card(extra=SVG), blog_card(date="x"), blog_card(date="2020-01-01")]
    pages = pages_of(spark, *[blog_page(*rng.choices(kinds, [8, 1, 2, 2, 4], k=20)) for _ in range(40)])
    once = rows_of(surface_table(pages.coalesce(1), BLOG), "keyword", "order", "date")
    many = rows_of(surface_table(pages.repartition(13), BLOG), "keyword", "order", "date")
    assert once == many and once


def test_added_ads_change_nothing(spark):
    ad = blog_card(extra=SVG)
    plain = [blog_card(date=f"2025.1.{i}") for i in range(1, 9)]
    assert blog(spark, *plain) == blog(spark, ad, *[c for p in plain for c in (p, ad)])


# -- batches -----------------------------------------------------------------
def test_cards_of_few_pages_are_held_at_a_time(spark):
    def read(page):
        import builtins

        held = builtins.__dict__.setdefault("_held_cards", [0])

        class Held(dict):
            def __del__(self):
                held[0] -= 1

        held[0] += 1
        return [Held(text=str(held[0]), href=None)]

    pages = spark.range(0, 3000, 1, 1).selectExpr("id", "'<a href=x>y</a>' as html")
    found = extract(pages, read, cards.ANCHOR).selectExpr("id", "cast(cards[0].text as int) as held").collect()
    assert sorted(r["id"] for r in found) == list(range(3000))
    assert max(r["held"] for r in found) <= 2 * cards.BATCH_PAGES
