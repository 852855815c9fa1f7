"""Cards ruled over columns are the cards of the rules' expressions."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from resultlake.operators import cards, ruled, rules
from resultlake.operators.cards import extract
from resultlake.plans import extraction
from resultlake.sources.registry import BLOG, CAFE

TEXTS = [
    "", " ", "Ann", " Ann ", "two  words", "a\tb", "a\x1cb", "\x85", "\xa0x\u3000y ", "글 \u2003 하나", "x\u200by", "Ann\u2028", "\x00", "&", "é",
]
PLAIN_HREFS = [
    "/u1/2", "https://blog.naver.com/u1", "https://blog.naver.com/u1/5?utm=1#x", "http://a.b/c", "https://keep.naver.com/save", "#", "", " ",
    "/search.naver?q=1#more", "https://search.naver.com/search.naver?x#y", "https://help.naver.com/s", "javascript:void(0)", " /u1/3\t", "/a/b?c=/./d",
    "https://a.b", "https://x.y/a\\b", "/p%20q", "https://u@h.k/x", "https://a.b?q=1", "\x1f/z\x1c", "/a:b", "/(x)'\"!$&*+,=@^_`{|}~",
]
ODD_HREFS = [
    "//cdn.x/y", "a/b", "?x=1", "#f", "../z", "/a/../b", "/.", "/a;p", "https://a.b/c;d?e", "mailto:a@b", "http://[::1]/x", "http://[bad/x", "/한글", "https://한.글/",
    "/a b", "https://a.b:80/", "https://a.b:x/", "HTTP://A.b/c", "/a?", "/a#", "http://\u2100.com/", "/\x7f", "/a\nb", "\u3000/x", "x://y", "https://", "/a[1]", "[", None,
]
PLAIN_DATES = [
    "2025.01.02.", "2025.1.2", "2025. 1. 2.", "2025.1. 2", " 2025. 1. 2 23:59 ", "2025.1.2. 9:5", "2025.1.2. 24:00", "20250102", "2025-01-02 10Z", "2025-01-02T23:30:00-09:00",
    "2024.2.29", "2025.02.30.", "2025-02-30", "0000.01.01.", "0001-01-01", "9999.12.31.", "3일 전", "어제", "12시간 전", "now", "2025", "2025-01", "2025-1-2", "20250102T1030+09", "2025. 1.2",
    "2025.01.02.10:20", "2025.13.1", "", " ", "2025-01-02x10:30:15,5", "2025-01-02T10:3", "2025-01-02Z",
]
ODD_DATES = ["2025-W01-1", "2025W011", "2025W54", "٢٠٢٥.1.2", "2025.1.٢", "2025-01-02é10", "20가5", "２０２５.1.2."]


def pick(rng, plain, odd, share):
    return rng.choice(odd if rng.random() < share else plain)


def blog_page(rng, share):
    def link():
        return {"text": rng.choice(TEXTS), "href": pick(rng, PLAIN_HREFS, ODD_HREFS, share)}

    return [
        {
            "is_ad": rng.random() < 0.1,
            "has_profile": rng.random() < 0.9,
            "name": None if rng.random() < 0.1 else link(),
            "date_text": None if rng.random() < 0.1 else pick(rng, PLAIN_DATES, ODD_DATES, share),
            "anchors": [link() for _ in range(rng.randrange(5))],
        }
        for _ in range(rng.randrange(4))
    ]


def cafe_page(rng, share):
    def maybe(value):
        return None if rng.random() < 0.1 else value

    return [
        {
            "is_ad": rng.random() < 0.1,
            "name_text": maybe(rng.choice(TEXTS)),
            "date_text": maybe(pick(rng, PLAIN_DATES, ODD_DATES, share)),
            "subject": maybe({"text": rng.choice(TEXTS), "href": pick(rng, PLAIN_HREFS, ODD_HREFS, share)}),
        }
        for _ in range(rng.randrange(4))
    ]


@pytest.mark.parametrize(
    "page, rule", [(blog_page, rules.blog_cards), (cafe_page, rules.cafe_cards)], ids=["blog", "cafe"]
)
def test_ruled_alike(spark, page, rule):
    rng = random.Random(11)
    card, arrow_rule = ruled.RULED[rule]
    for share, least in ((0.0, 0.999), (0.15, 0.3)):
        pages = [page(rng, share) for _ in range(1500)] + [None, []]
        arrow = pa.array(pages, to_arrow_type(T.ArrayType(card)))
        known: dict = {}
        made, plain = arrow_rule(arrow.slice(3), known)
        first, told = arrow_rule(arrow.slice(0, 3), known)
        found = [*first.to_pylist(), *made.to_pylist()]
        plain = [*told, *plain]
        assert sum(plain) >= least * len(pages) - 1 and not plain[-2] and plain[-1]
        schema = T.StructType().add("id", "integer").add("cards", T.ArrayType(card))
        rows = spark.createDataFrame(list(enumerate(pages)), schema)
        said = {r["id"]: r["c"] for r in rows.select("id", rule(F.col("cards"), F.lit("")).alias("c")).collect()}
        for i, one in enumerate(found):
            if plain[i]:
                assert one == [c.asDict() for c in said[i]], pages[i]
            else:
                assert one is None


def test_dates_alike(spark):
    from resultlake.functions.dates import parse_clean_date

    rng = random.Random(5)
    texts = [t.strip() for t in PLAIN_DATES + ODD_DATES]
    for _ in range(4000):
        text = list(rng.choice(texts))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text) + 1)
            text[at : at + rng.randrange(2)] = rng.choice("0123459. -:TZW,+일x")
        texts.append("".join(text))
    texts = sorted(set(texts))
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_clean_date(F.col("t")).alias("d"))
    said = {r["t"]: r["d"] for r in rows.collect()}
    sure = 0
    for text in texts:
        day = ruled._day(text)
        if day != ruled._UNSURE:
            sure += 1
            expected = ruled._NO_DATE if said[text] is None else said[text].toordinal() - ruled._EPOCH
            assert day == expected, text
    assert sure > len(texts) / 2


@pytest.mark.parametrize("surface", [BLOG, CAFE], ids=["blog", "cafe"])
def test_plain_pages_meet_no_expression(spark, sf_dir, monkeypatch, surface):
    """Pages of plain cards leave their reader with states, and without raw cards."""
    from resultlake.queries import generated as made

    pages = {"blog": made.blog_pages, "cafe": made.cafe_pages}[surface.name](spark, sf_dir)
    card, rule = ruled.RULED[surface.rule]
    read = extract(pages, surface.read, surface.card, error="error", ruled=(rule, ruled.STATED))
    counted = read.selectExpr("count(*) n", "count(ruled) ruled", "count(cards) raw").first()
    assert counted["n"] == counted["ruled"] > 0 and counted["raw"] == 0

    def rows():
        found = extraction._read_pages(pages, surface, None, "page").select("keyword", "error", "cards").collect()
        return sorted(map(repr, found))

    quick = rows()
    monkeypatch.setattr(extraction, "RULED", {})
    assert quick == rows()


def test_rejects_read_states_alone(spark, sf_dir):
    from resultlake.queries import generated as made
    from resultlake.session import stage

    pages = made.blog_pages(spark, sf_dir, broken=True)
    staged = stage(extraction._read_pages(pages, BLOG, None, "page"), "blog-pages")
    rejected = extraction._rejected(staged, BLOG, 10)
    assert rejected.count() > 0
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")  # a plan names all columns read
    try:
        plan = rejected._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "cards:array<struct<state:string>>" in plan
