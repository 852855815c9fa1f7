"""Tags that differ in their links alone are told apart once, and read as they are written."""

import random

import numpy as np
import pyarrow as pa
import pytest

from test_bulk import READERS, both

from resultlake.operators import bulk, cards
from resultlake.operators.bulk import Forest
from resultlake.operators.dom import PageTree, css

LINKS = [
    '<a href="/{n}">', '<a class="name" href="/c{n}">', '<a href="/x{n}?a=1" class="api title_link" data-x="y">', '<a href="">',
    '<a href="/{n}" href="/twice{n}">', '<a class="a=b" href="/{n}">', '<a href="/{n}?a=1&amp;b=2">', "<a href='/{n}'>", "<a href=/bare{n}>",
    '<A HREF="/{n}">', '<a title="x href=" class="name" href="/{n}">', '<a  href="/{n}">', '<a href="/{n}" >', '<a href="/{n}"/>', '<a data-href="/{n}">',
    '<a href="/{n}" disabled>', '<a href="/한글{n}">', '<a href="/{n}\n">', '<a class="fender-ui_1" href="/{n}">', '<iframe id="mainFrame" src="/f{n}" href="/{n}">',
    '<iframe src="/PostView.naver?x={n}" href="/y">', '<div class="user_info" href="/{n}">', '<li class="bx" href="/{n}">', '<link href="/{n}">',
]
REST = [
    "</a>", "</a>", "</div>", "</li>", "</iframe>", "text", " a &lt;b&gt; &quot;c&quot; ", "&amp;lt;", "&amp;&amp;", "&#39;", "&nbsp;", "&nbsp;&amp;", "&copy; &amp;", "& &amp;", "&ampx", "한", " 　 ",
    '<svg class="fender-ui_c3b5e09c fender-ui_08aaffd5">', "</svg>", "<script>a('<script>', \"</b>\")</script>", "<script></script><style>x</style>", "<script>a <!-- b</script>", "<style><script></style>",
    '<div class="title_area">', '<span class="sub">', "</span>", '<section class="sc_new sp_nblog">', '<div data-template-id="ugcItem">', '<div class="sds-comps-profile">',
]


def made_pages(seed, count=400):
    rng = random.Random(seed)
    return [
        "<html>" + "".join(rng.choice(rng.choice((LINKS, REST))).replace("{n}", str(rng.randrange(50))) for _ in range(rng.randrange(1, 50))) + "</html>"
        for _ in range(count)
    ]


@pytest.mark.parametrize("read, card", READERS)
def test_links_are_read_as_written(read, card):
    pages = made_pages(3)
    made, alone, regular = both(pages, read, card)
    for page, one, other, whole in zip(pages, made, alone, regular):
        assert not whole or one == other, page
    assert np.mean(regular) > 0.2


BLOCKS = [
    '<div id="main_pack">', "<div class='api_sc_page_wrap  z' data-slog-container=\"s\">", '<div data-slog-container="">', "<section>", "</section>", "<div>", "</div>", "</div>", "<p>", "<br>",
    '<div id="pcPowerLink_1">', '<i class="pcPowerLink_dacf">', '<div data-sds-comp="Header">', '<span class="sds-comps-text-type-headline1 q">', '<h2 class="sds-comps-text">', "</h2>",
    '<div class="mod_title_area">', '<h2 class="title">', '<b class="title">', '<div data-template-id="footer" data-template-type="more">', '<a href="/more?{n}" data-lb-trigger="/x?a=1&amp;b={n}">',
    '<span class="fds-comps-footer-more-subject">', '<span class="fds-comps-footer-more-button-text">', "</span>", "</a>", '<a href="?page=2{n}">', '<a href="?where=image&amp;query={n}">',
    '<a href="https://map.naver.com/{n}">', '<a href="https://ad.search.naver.com/search.naver?where=ad&amp;q={n}">', '<a href="#lb_api={n}">', "<a href='?where=influencer'>", '<a href="https://search.shopping.naver.com/{n}" title="where=image">',
    "<script>x</script>", "<script data-slog-container='s'> </script>", "<script></script>", "<style>a > b</style>", "<script>a('</b>')</script>", "text", " ", "&nbsp;", " two  words &amp; ", '<link rel="x">', "<title>x</title>",
]


def test_blocks_are_read_alike():
    rng = random.Random(9)
    pages = ["", "<p>none</p>", '<div id="main_pack"></div>', '<div id="main_pack">', '<div id="main_pack"><p>a<p>b</div><div>c</div>']
    for _ in range(800):
        some = "".join(rng.choice(BLOCKS).replace("{n}", str(rng.randrange(9))) for _ in range(rng.randrange(1, 40)))
        pages.append(f'<html><div id="main_pack">{some}' + rng.choice(["", "</div><p>x</p></html>"]))
    made, alone, regular = both(pages, cards.read_blocks, cards.BLOCK)
    for page, one, other, whole in zip(pages, made, alone, regular):
        assert not whole or one == other, page
    assert np.mean(regular) > 0.9


def test_pages_of_blocks_are_read_together(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("read alone")

    monkeypatch.setattr(cards, "PageTree", refuse)
    page = '<div id="main_pack">' + '<div data-slog-container="s"><a href="?page=2">x</a></div><script>a("</p>")</script>' * 600 + "</div>"
    rows = spark.createDataFrame([(i, page) for i in range(3)], "id int, html string").coalesce(1)
    found = cards.extract(rows, cards.read_blocks, cards.BLOCK, error="error").selectExpr("error", "size(cards) n").collect()
    assert [tuple(r) for r in found] == [(None, 1200)] * 3


@pytest.mark.parametrize("text", ["a[href*='1']", "a[href='/7'], li[href^='/4']", "[href='/twice3']", "a.name[href]"])
def test_selectors_of_links(text):
    selectors, pages = css(text), made_pages(4)
    forest = Forest(pa.array(pages, pa.string()), {})
    found, upto = forest.all(selectors, *forest.pages())
    links = forest.attributes(found, "href").to_pylist()
    ends = [0, *upto.tolist()]
    for i, page in enumerate(pages):
        if forest.regular[i]:
            tree = PageTree(page)
            assert links[ends[i] : ends[i + 1]] == [tree.attr(n, "href") for n in tree.select(selectors)], page


def test_tags_with_other_links_are_taken_apart_once(monkeypatch):
    taken = []
    monkeypatch.setattr(bulk, "_read_tag", lambda tag, read=bulk._read_tag: taken.append(tag) or read(tag))
    pages = [f'<p><a class="x" href="/u/{n}?a={n}">t</a></p>' for n in range(3000)]
    found, _, regular = both(pages, cards.read_anchors, cards.ANCHOR)
    assert regular.all() and [p[0]["href"] for p in found] == [f"/u/{n}?a={n}" for n in range(3000)]
    assert len(taken) < 10
