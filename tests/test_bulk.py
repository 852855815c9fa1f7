"""Pages read many at a time give the cards that one page's reader gives."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from resultlake.operators import cards
from resultlake.operators.bulk import Forest, unescaped
from resultlake.operators.dom import PageTree

READERS = [
    (cards.read_anchors, cards.ANCHOR),
    (cards.read_blog_cards, cards.BLOG_CARD),
    (cards.read_cafe_cards, cards.CAFE_CARD),
    (cards.read_article, cards.ARTICLE),
]
PIECES = [
    '<section class="sc_new sp_nblog">', '<section class="x sc_new  sp_ncafe">', "</section>", '<div id="main_pack">',
    '<div data-template-id="ugcItem">', "<div class='_fe_view_power_content'>", "</div>", "</DIV >", "<p>", "</p>", "<br>",
    '<img src="t.png">', '<li class="bx">', "</li>", '<ul>', "</ul>", '<div class="user_info">', '<div class="title_area">',
    '<a class="name" href="/c1">', '<a class="api title_link" href="/x?a=1&amp;b=2">', "<a href=/bare>", "<a>", "</a>", "<b>", "</b>",
    '<span class="sub">', '<span class="sds-comps-profile-info-subtext">', '<span class="date">', "</span>", '<i class="ico_ad">', "</i>",
    '<div class="sds-comps-profile x">', '<div class="sds-comps-profile-info-title-text">', '<iframe id="mainFrame" src="/f?a&amp;b">',
    '<iframe src="/PostView.naver?x">', '<iframe id="cafe_main" src="../a">', "</iframe>", '<div class="article_header">',
    '<div class="se-component-content">', '<span class="blog_date">', '<i class="se_publishDate">',
    '<a class="fender-ui_1 x"><svg class="fender-ui_c3b5e09c fender-ui_08aaffd5"></svg></a>',
    "text", " two  words ", "2025.01.02.", " ", "\n", "&amp;", "&nbsp;", "a &lt; b", "&#44032; x", "한글", "\xa0", "\x1c", " & ", "1 > 0",
    "<!-- x -->", "<!doctype html>", '<script>var a = "</div>";</script>', "<style>a > b</style>", "<script>a < b && c</script >",
]
# What only the lenient reader takes.
ODD = ["<br/>", "</br>", "<", "&", "&x", "<!-- a > b -->", "<a title='x>y' href='z'>", "<rt>", "<script>", "<?x?>", "<a href='", "<script><!-- </script>", "&#x110000;", "<![CDATA[x]]>", "<plaintext>"]


def both(pages, read, card):
    arrow = to_arrow_type(T.ArrayType(card))
    forest = Forest(pa.array(pages, pa.string()), {})
    made = cards.TOGETHER[read](forest, arrow)
    assert len(made) == len(pages)
    alone = pa.array([read(PageTree(p)) for p in pages], type=arrow)
    return made.to_pylist(), alone.to_pylist(), forest.regular


@pytest.mark.parametrize("read, card", READERS)
def test_any_markup_reads_alike(read, card):
    rng = random.Random(7)
    for odd in (0, 0.02):
        pages = ["", "text only", "a & b", "<ul><li class='bx'><b>x</b></li></ul>", "</b>"]
        for _ in range(500):
            size = rng.randrange(1, 60)
            page = "".join(rng.choice(ODD if rng.random() < odd else PIECES) for _ in range(size))
            pages.append(page if rng.random() < 0.1 else f"<html>{page}</html>")
        made, alone, regular = both(pages, read, card)
        for page, one, other, whole in zip(pages, made, alone, regular):
            assert not whole or one == other, page
        assert np.mean(regular) > (0.9 if not odd else 0.4)


@pytest.mark.parametrize("pages", [["<p>x</p>"], ["</p>"], ["<p>"], ["x"], ["<div><p>x</p></div>"] * 40])
def test_few_tags(pages):
    made, alone, _ = both(pages, *READERS[0])
    assert made == alone


def test_references():
    assert unescaped("a &amp; b&nbsp;&#44032;") == "a & b\xa0가"
    assert unescaped("5 & 6") == "5 & 6"
    assert unescaped("a&b=1") == "a&b=1"
    assert unescaped("&x!") is None


def test_odd_pages_and_missing_ones_keep_their_place(spark, monkeypatch):
    monkeypatch.setattr(cards, "TOGETHER_TEXT", 0)
    pages = ['<a href="/1">one</a>', None, '<a href="/2"/>two', "", '<a href="/3">thr&ee!</a>', '<p><a href="/4"> four </a>']
    rows = spark.createDataFrame(list(enumerate(pages)), "id int, html string").coalesce(1)
    found = {r["id"]: r for r in cards.extract(rows, cards.read_anchors, cards.ANCHOR, error="error").collect()}
    for i, page in enumerate(pages):
        if page is None:
            assert found[i]["cards"] is None and found[i]["error"] == "no page"
        else:
            assert [c.asDict() for c in found[i]["cards"]] == cards.read_anchors(PageTree(page))
            assert found[i]["error"] is None


def test_most_pages_are_read_together(spark, monkeypatch):
    """A well-formed page, unclosed tags and all, is not read tag by tag."""

    def refuse(*_):
        raise AssertionError("read alone")

    monkeypatch.setattr(cards, "PageTree", refuse)
    page = '<ul><li class="bx"><p><div class="user_info"><a class="name" href="/c">N</a><script>a("</li>")</script></li></ul>'
    rows = spark.createDataFrame([(1, page * 1000)], "id int, html string")
    row = cards.extract(rows, cards.read_cafe_cards, cards.CAFE_CARD, error="error").first()
    assert row["error"] is None
