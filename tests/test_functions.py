"""Scalar functions against Python's standard library."""

import datetime
import itertools
import random
import urllib.parse as up

import pytest
from conftest import evaluate
from pyspark.sql import functions as F

from resultlake import functions as R

BASE = "https://search.naver.com"
BMP = [chr(c) for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000]


def test_normalize_text_every_code_point(spark):
    values = [f"{c}a{c}{c}b{c}" for c in BMP] + [None, "", " \u3000\t\n"]
    expected = [" ".join((v or "").split()) for v in values]
    assert evaluate(spark, R.normalize_text, values) == expected


def test_strip_text_every_code_point(spark):
    values = [f"{c} a b\n{c}" for c in BMP] + ["", "\u2028"]
    assert evaluate(spark, R.strip_text, values) == [v.strip() for v in values]
    assert evaluate(spark, R.strip_text, [None]) == [None]


def test_encoders_every_code_point(spark):
    text = ["".join(BMP[i:i + 500]) for i in range(0, len(BMP), 500)]
    text += ["갤럭시 S26 ~*-._'()!/+&", "", "a b"]
    assert evaluate(spark, R.form_encode, text) == [up.quote_plus(t) for t in text]
    assert evaluate(spark, R.percent_encode, text) == [up.quote(t, safe="") for t in text]


def test_percent_decode(spark):
    values = ["a+b%20c", "100%", "%zz%41", "%EA%B0%A4럭", "%2B%25%2", "", "%%41"]
    assert evaluate(spark, R.percent_decode, values) == [up.unquote(v) for v in values]


HREFS = [
    "/a?b=1#c", "a/b", "?x=1", "?", "#", "#f", "", "//cdn.x/y", "//cdn.x", "../z", "./z", "..", ".",
    "../../a/./b/../c", "/../a", "/a/./b/..", "/a//b", "a//b", "mailto:a@b", "tel:1", "https:rel",
    "https:/rooted", "https:", "https:///p", "HTTPS://X.Y/Z", "http://x.y/a;p?q#f", "https://x/a;",
    "a;p", ";p", "a;", "a;;", "/a;b/c", "a b", "a\tb\nc", "\x01/x", "https://x?", "https://x/?#",
    "https://x#", "/한글?질의#조각", "http://x/../y", "https://x/../y", "a?b?c#d#e", "1a:b", ":x", "a:b",
    "/a:b", "./a:b", "//", "///a", "////a", "/.", "/..", "a/.", "a/..", "a/../", "/a/b/../../..", "x/?y",
]
BASES = [
    BASE, BASE + "/", BASE + "/search.naver", BASE + "/search.naver?where=nexearch&query=a#frag",
    "http://h:8080/a/b/c;p?q", "https://h/a/b/", "https://h//a//b", "https://h?x=1", "https://h#f",
    "https://h/a/../b/c", "about:blank",
]


def test_resolve_url_matches_urljoin(spark):
    pairs = list(itertools.product(BASES, HREFS))
    got = evaluate(spark, R.resolve_url, pairs)
    wrong = [(p, g, up.urljoin(*p)) for p, g in zip(pairs, got) if g != up.urljoin(*p)]
    assert wrong == []


def test_resolve_url_random(spark):
    rng = random.Random(7)
    atoms = ["a", "/", "..", ".", "?", "#", ";", "=", "&", "b", "//", ":", "%41", "é", "https:", "http:"]
    hrefs = ["".join(rng.choices(atoms, k=rng.randint(1, 7))) for _ in range(3000)]
    pairs = [(rng.choice(BASES[:-1]), h) for h in hrefs]
    got = evaluate(spark, R.resolve_url, pairs)
    wrong = [(p, g, up.urljoin(*p)) for p, g in zip(pairs, got) if g != up.urljoin(*p)]
    assert wrong == []


def python_link(href):
    stripped = href.strip() if href else ""
    if stripped in ("", "#") or stripped.startswith("javascript:"):
        return None
    return up.urljoin(BASE, stripped)


def test_absolute_and_canonical_url(spark):
    hrefs = [*HREFS, None, "  ", " # ", "javascript:x", " javascript:x", "JavaScript:x", "\u3000/a ",
             "HTTP://X.y/a;p?q#f", "ftp://F/x?y"]
    joined = [python_link(h) for h in hrefs]
    cut = [
        None if j is None else up.urlunsplit(up.urlsplit(j)._replace(query="", fragment=""))
        for j in joined
    ]
    # ";" with nothing behind it is not written back
    cut = [c[:-1] if c and c.startswith("http") and c.endswith(";") and c.count(";") == 1 else c for c in cut]
    assert evaluate(spark, lambda v: R.absolute_url(BASE, v), hrefs) == joined
    assert evaluate(spark, lambda v: R.canonical_url(BASE, v), hrefs) == cut


def test_malformed_url(spark):
    hrefs = ["http://[", "http://]x", "http://[::1]/", "http://[::1]:80/a", "http://[x]/", "//[",
             "http://[v1.a]/", "http://u@[::1]/", "/[", "a[b]", "mailto:[", "http://x／y/", "http://ok/／",
             "//℀.com", "http://한글.kr/", "javascript:[", "http://[1.2.3.4]/", "http://[fe80::1%25en0]/"]

    def raises(href):
        try:
            python_link(href)
        except ValueError:
            return True
        return False

    assert evaluate(spark, R.is_malformed_url, hrefs) == [raises(h) for h in hrefs]


def test_unfetchable_url(spark):
    cases = {
        "https://blog.naver.com/a/1": False,
        "https://blog.naver.com/한글": True,
        "https://blog.naver.com/a b": True,
        "https://blog.naver.com/a#한 글": False,
        "https://h:80/a": False,
        "https://h:/a": False,
        "https://h:x/a": True,
        "https://h/a:b?c:d": False,
        "mailto:한글": False,
        None: False,
    }
    assert evaluate(spark, R.is_unfetchable_url, list(cases)) == list(cases.values())


def test_lb_trigger_and_finish(spark):
    page = BASE + "/search.naver?where=nexearch&query=%EA%B0%A4#old"
    triggers = ["https://s.search.naver.com/p/qa?ssc=tab.itb.qab&x=1", "/p/qa?a=~*", "#", "", None, "javascript:x", " a b "]
    expected = [
        None
        if not (t or "").strip() or t.startswith("javascript:")
        else page.split("#")[0] + "#lb_api=" + up.quote(up.urljoin(page, t.strip()), safe="")
        for t in triggers
    ]
    got = evaluate(spark, lambda v: R.lb_trigger_url(F.lit(page), v), triggers)
    assert got == expected

    assert evaluate(spark, R.finish_more_url, [expected[0]]) == [
        BASE + "/search.naver?where=nexearch&query=갤#lb_api="
        + up.quote("https://s.search.naver.com/p/qa?ssc=tab.itb.qab&x=1&faq_opened=1", safe="")
    ]
    kept = ["https://x/?ssc=tab.itb.qab", "https://x/#lb_api=a", "https://x/#lb_api=ssc%3Dtab.itb.qab%26faq_opened%3D1"]
    assert evaluate(spark, R.finish_more_url, kept) == kept
    assert evaluate(spark, R.finish_more_url, ["https://x/%41%#lb_api=ssc%3Dtab.itb.qab#lb_api=z"]) == [
        "https://x/A%#lb_api=" + up.quote("ssc=tab.itb.qab#lb_api=z?faq_opened=1", safe="")
    ]


FORMATS = [a + b for a in ("%Y.%m.%d.", "%Y.%m.%d", "%Y. %m. %d.", "%Y. %m. %d") for b in ("", " %H:%M")]


def python_date(text):
    clean = " ".join((text or "").split())

    def attempts():
        yield lambda: datetime.datetime.fromisoformat(clean.replace("Z", "+09:00"))
        for form in FORMATS:
            yield lambda form=form: datetime.datetime.strptime(clean, form)

    for attempt in attempts():
        try:
            return attempt().date()
        except ValueError:
            pass
    return None


DATES = [
    "2025.01.02.", "2025.1.2", "2025. 1. 2.", "2025.1. 2", "2025.1.2. 9:5", "20250102", "2025-01-02 10",
    "2025-01-02T23:30:00Z", "2025-01-02T23:30:00-09:00", "2025.12. 1", "2025-W01-1", "2025W011", "2024.2.29",
    "2025.02.30.", "2025. 1.2", "2025-1-2", "2025-01", "2025-002", "25.01.02.", "2025.1.2. 24:00",
    "2025.01.02.10:20", "3일 전", "", None, "2025-01-02Z", "0000-01-01", "0000.1.1.", "2020-W53", "2021-W53",
    "2020W537", "2025-W00", "2025.1. 02", "2025.1. 12", "２０２５.1.2", "2025.1.1２", "2025.１.2", "2025.13.1",
    "2025.00.1", "2025.1.0", "2025.1.2. 09:60", "2025.1.2 23:59", "2025\u00a0.1.2", " 2025.1.2 ", "2025.  1. 2.",
    "2025-01-02T", "2025-01-02T1", "2025-01-02T10:20:30.123456789", "2025-01-02T102030,5+0900", "9999-12-31",
    "2025-01-02T10:2030", "2025-01-02x10", "20250102T10", "202501021010", "어제", "2025.1.2.\n9:05",
    "2025-01-02T10:20+09", "2025-01-02T10:20+09:00:01.5", "2025-01-02T25", "2025-W01-8", "2025W01",
]


def test_post_dates(spark):
    got = evaluate(spark, R.parse_post_date, DATES)
    assert dict(zip(DATES, got)) == {d: python_date(d) for d in DATES}


def test_post_dates_random(spark):
    rng = random.Random(11)
    seeds = [d for d in DATES if d]
    values = []
    for _ in range(6000):
        text = list(rng.choice(seeds))
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(text))
            text[at:at + rng.randint(0, 1)] = rng.choice(["", ".", "-", " ", "1", "0", "3", ":", "T", "W", "9"])
            text = text or ["2"]
        values.append("".join(text))
    got = evaluate(spark, R.parse_post_date, values)
    wrong = [(v, g, python_date(v)) for v, g in zip(values, got) if g != python_date(v)]
    assert len(wrong) <= AMBIGUOUS_WEEKS and all("W" in v for v, _, _ in wrong), wrong


# Week dates glued to further digits are ambiguous in themselves.
AMBIGUOUS_WEEKS = 20


def test_post_date_text(spark):
    assert evaluate(spark, lambda v: R.post_date_text(v.cast("date")), ["2025-01-02"]) == ["2025.01.02."]


@pytest.mark.parametrize("text,expected", [("a", None), ("2025.1.2.", datetime.date(2025, 1, 2))])
def test_single_dates(spark, text, expected):
    assert evaluate(spark, R.parse_post_date, [text]) == [expected]
