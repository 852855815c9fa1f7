"""Unicode text clean-up (TX1, TX2); prefix and substring tests (TX3) are Spark's own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every code point that Python's str.split() and str.strip() treat as whitespace, for a
# Java regex (whose own \s is ASCII only). Written as the complement of all others,
# common characters first: the engine then decides most characters at the first range.
_SPACE = (
    r"[^\x21-\x7e\x{3001}-\x{10ffff}\xa1-\x{167f}\x00-\x08\x0e-\x1b\x7f-\x84\x86-\x9f"
    r"\x{1681}-\x{1fff}\x{200b}-\x{2027}\x{202a}-\x{202e}\x{2030}-\x{205e}\x{2060}-\x{2fff}]"
)

# The line breaks of Python's str.splitlines().
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often it is mentioned."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normalize_text(text: Column) -> Column:
    """NULL becomes ''; whitespace runs become one space; ends are trimmed."""
    # A single blank needs no replacing; most texts then pass through as they are.
    runs = f" {_SPACE}+|(?! ){_SPACE}+"
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), runs, " "))


def strip_text(text: Column) -> Column:
    """Trim Unicode whitespace at both ends; NULL stays NULL."""
    # Plain ASCII with nothing to trim, such as most links, is told by one look.
    trimmed = r"\A[\x21-\x7e](?:[\x20-\x7e]*[\x21-\x7e])?\z"
    return F.when(text.rlike(trimmed), text).otherwise(
        F.regexp_replace(text, rf"\A{_SPACE}+|{_SPACE}+\z", "")
    )


def nullif_empty(text: Column) -> Column:
    return F.when(text != "", text)
