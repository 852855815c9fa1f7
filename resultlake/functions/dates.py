"""Displayed post dates (DT1, DT2).

A date text is accepted in ISO 8601 form (calendar or week date, optional time and
offset, which never shifts the day) or in one of eight dotted forms. Relative texts
such as "3 days ago" are not dates; the linked article decides then.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from resultlake.functions.text import bind, normalize_text

# Dotted forms: "2025.01.02.", "2025. 1. 2.", each with or without the last dot and
# a clock time. Only the year, a day's or hour's second digit and the minute may be
# non-ASCII digits, and an unpadded day may follow one blank.
_CLOCK = r"(?: (?:2[0-3]|[01]\p{Nd}|\p{Nd}):(?:[0-5]\p{Nd}|\p{Nd}))?"
_MONTH = r"(1[0-2]|0[1-9]|[1-9])"
_DAY = r"3[01]|[12]\p{Nd}|0[1-9]|[1-9]"
_TIGHT = rf"\A(\p{{Nd}}{{4}})\.{_MONTH}\.( [1-9]|{_DAY})\.?{_CLOCK}\z"
_SPACED = rf"\A(\p{{Nd}}{{4}})\. {_MONTH}\. ({_DAY})\.?{_CLOCK}\z"

# ISO forms. The time may follow any one character; its parts are all separated by
# colons or not at all. A clock may carry one stray character if an offset follows.
_HOUR, _SIXTY, _FRACTION = r"(?:[01]\d|2[0-3])", r"[0-5]\d", r"[.,]\d+"


def _parts(hour: str, part: str) -> str:
    colons = rf":{part}(?:{_FRACTION}|:{part}(?:[.,:]\d+)?)?"
    glued = rf"{part}(?:{_FRACTION}|{part}(?:[.,]?\d+)?)?"
    return rf"{hour}(?:{_FRACTION}|{colons}|{glued})?"


_TIME_OF_DAY = _parts(_HOUR, _SIXTY)
_STRAY = rf"{_HOUR}(?::{_SIXTY}(?::{_SIXTY})?|{_SIXTY}(?:{_SIXTY})?)?[^+\-]"
_OFFSET = "[+-]" + _parts(_HOUR, r"\d\d")
_TIME = rf"(?:(?s:.)(?:{_TIME_OF_DAY}|(?:{_TIME_OF_DAY}|{_STRAY}){_OFFSET}))?\z"
_EXTENDED = rf"\A(\d{{4}})-(\d\d)-(\d\d){_TIME}"
_BASIC = rf"\A(\d{{4}})(\d\d)(\d\d){_TIME}"
_WEEK = rf"\A(\d{{4}})(?:-W(\d\d)(?:-([1-7]))?|W(\d\d)([1-7])?){_TIME}"


@lru_cache(maxsize=1)
def _digits() -> tuple[str, str]:
    """All non-ASCII decimal digits and the ASCII digits they stand for."""
    found = [
        chr(c) for c in range(0x80, 0x20000) if unicodedata.category(chr(c)) == "Nd"
    ]
    return "".join(found), "".join(str(unicodedata.decimal(d)) for d in found)


def _calendar(text: Column, pattern: str) -> Column:
    digits = F.regexp_replace(F.regexp_replace(text, pattern, "$1-$2-$3"), " ", "")
    return F.when(text.rlike(pattern), digits.try_cast("date"))


def _iso_week(text: Column) -> Column:
    def group(number: int) -> Column:
        return F.regexp_extract(text, _WEEK, number)

    week = F.concat(group(2), group(4)).try_cast("int")
    day = F.coalesce(F.concat(group(3), group(5)).try_cast("int"), F.lit(1))
    jan4 = F.concat(group(1), F.lit("-01-04")).try_cast("date")
    found = F.date_add(jan4, (week - 1) * 7 + day - 1 - F.weekday(jan4))
    return F.when(text.rlike(_WEEK) & (week >= 1) & (F.weekofyear(found) == week), found)


def parse_post_date(text: Column) -> Column:
    """Date named by a displayed date text, or NULL."""
    return bind(normalize_text(text), parse_clean_date)


def parse_clean_date(clean: Column) -> Column:
    """``parse_post_date`` for text that is normalized already."""
    dotted = F.coalesce(
        F.when(clean.rlike(_TIGHT), _calendar(F.translate(clean, *_digits()), _TIGHT)),
        F.when(clean.rlike(_SPACED), _calendar(F.translate(clean, *_digits()), _SPACED)),
    )
    iso = bind(
        F.replace(clean, F.lit("Z"), F.lit("+09:00")),
        lambda t: F.coalesce(_calendar(t, _EXTENDED), _calendar(t, _BASIC), _iso_week(t)),
    )
    # Relative texts leave at the first test; there is no year 0.
    found = F.when(F.substr(clean, F.lit(5), F.lit(1)) == ".", dotted).otherwise(iso)
    return F.when(clean.rlike(r"\A\p{Nd}{4}") & ~clean.startswith("0000"), found)


def post_date_text(date: Column) -> Column:
    """Dotted rendering of a date, "2025.01.02."."""
    return F.date_format(date, "yyyy.MM.dd.")
