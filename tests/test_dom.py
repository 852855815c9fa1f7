"""The page reader: tree rules, selectors, and the fast scan against the lenient reader."""

import random

import duckdb
import pytest

from resultlake.operators import cards
from resultlake.operators.dom import PageTree, css


class Lenient(PageTree):
    """Everything through the standard library's reader."""

    def _scan(self, page):
        return 0


def shape(tree):
    return (
        tree.tags,
        [tree.attrs(i) for i in range(len(tree.tags))],
        tree.parents,
        tree.ends,
        tree.spans,
        [(kind, text) for kind, text in tree.strings if text.strip()],
    )


PIECES = [
    "<div>", "</div>", "<p class='a b'>", "</p>", "<br>", "<br/>", "</br>", "<img src=x.png>", "<a href=/x/y>",
    "<a href=\"?a=1&amp;b=2&copy=3\">", "</a>", "<li class=bx>", "</li>", "<b", ">", "<script>var a='</p>'</script>",
    "<style>p{}</style>", "<!-- c -->", "<!-- a -- b -->", "<!DOCTYPE html>", "text", " a < b & c ", "&amp;", "&nbsp;",
    "&#44032;", "&#x41;", "&copy x", "&bogus;", "&", "<", "<?php x ?>", "<![CDATA[x]]>", "</ div>", "</>", "<DIV ID=M>",
    "<input disabled value='<>'/>", "<svg:path d='M 1'/>", "<p a=1 a=2>", "<template><i>t</i></template>", "<rt>r</rt>",
    "<title>T &lt; U</title>", "<textarea><b>x</textarea>", "<x-y z.w=1 @c='d'>", "</x-y>", "&#", "&#x;", "\n\t", "<script/>",
    "<script>a<!--<script>--></script>", "<p class=\"a&#98;c\">", "<iframe src=a></iframe>", "<>", "<a b=c/>", "<a\nb = 'c'\n>",
]
# White space of other kinds separates nothing in a tag.
PIECES += [f"<li{c}class=bx>" for c in "\u00a0\u000b\u001c\u0085\u2028\u3000"]
PIECES += [f"<p a={c}b>" for c in "\u00a0\u000b\u0085\u3000"] + [f"</p{c}>" for c in "\u00a0\u000b\u2028"]
PIECES += [f"<{c}b>" for c in "\u00a0\u0661"] + [f"&amp{c}" for c in "\u00a0\u0085"] + ["<li\fclass=bx\f>"]


def test_scan_agrees_with_lenient_reader():
    rng = random.Random(3)
    for _ in range(20000):
        page = "".join(rng.choices(PIECES, k=rng.randint(1, 12)))
        assert shape(PageTree(page)) == shape(Lenient(page)), page


def test_scan_agrees_on_pages():
    rows = duckdb.sql("select html from '/root/testdata/sf0.01/pages.parquet'").fetchall()
    for (page,) in rows:
        assert shape(PageTree(page)) == shape(Lenient(page))


def test_tree_rules():
    tree = PageTree("<div id=a><p>one<p>two<br>three</div><i>4</i></b>5")
    assert tree.tags == ["div", "p", "p", "br", "i"]
    assert tree.parents == [-1, 0, 1, 2, -1]  # an unclosed <p> nests
    assert tree.text(0) == "one two three"
    assert PageTree("<p><b>a</b>b<!-- x -->c</q>d</p>").text(0) == "a b c d"
    assert PageTree("<p>x<script>y</script><style>z</style><template>t</template></p>").text(0) == "x"
    assert PageTree("<p>a&amp;b &#44032;&nbsp;</p>").text(0) == "a&b 가"


@pytest.mark.parametrize(
    "selector,expected",
    [
        ("li.bx", [2, 4]),
        ("section.s.t li.bx", [2]),
        ("#m li.bx, section li.bx", [2, 4]),
        ("[data-k='v']", [3]),
        ("a[href^='/x']", [3]),
        ("a[href*='y'][data-k='v']", [3]),
        ("[class^='s t']", [1]),
        ("div[id]", [0]),
        ("li a[href]", [3]),
        (".nope", []),
    ],
)
def test_selectors(selector, expected):
    tree = PageTree(
        "<div id='m'><section class=' s  t u'><li class='bx q'><a href='/x/y' data-k=v>1</a></li></section>"
        "<li class=bx>2</li><li class='bxx'>3</li></div>"
    )
    assert tree.select(css(selector)) == expected


def test_select_below_looks_at_all_ancestors():
    tree = PageTree("<div class=o><li class=bx><a class=n>1</a></li></div>")
    assert tree.select(css(".o a.n"), 1) == [2]
    assert tree.first(css("li"), 1) is None


def test_nested_cards_are_all_seen_once():
    page = PageTree(
        "<section class='sc_new sp_ncafe'><div id='main_pack'><ul><li class=bx>a<li class=bx>b</ul></div></section>"
    )
    assert len(cards.read_cafe_cards(page)) == 2


def test_tags_seen_on_earlier_pages_change_nothing():
    rng, seen = random.Random(4), {}
    for _ in range(3000):
        page = "".join(rng.choices(PIECES, k=rng.randint(1, 12)))
        assert shape(PageTree(page, seen)) == shape(Lenient(page)), page


def test_tags_written_alike_are_taken_apart_once():
    seen = {}
    first, second = (PageTree("<ul>" + "<li class='a b'>x &amp; y</li>" * 3 + "</ul>", seen) for _ in range(2))
    assert first.elements[1] is first.elements[3] is second.elements[2]
    assert second.select(css("li.b")) == [1, 2, 3] and second.text(2) == "x & y"
