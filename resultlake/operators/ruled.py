"""The card rules of ``rules.py`` over Arrow columns, for cards of plain links and dates.

Most links are complete web addresses or rooted paths in ASCII, most dates one of a few
written forms: what the rules say of those needs no taking apart of addresses, and is said
here of all cards of a batch at a time. A page with a card that needs more, and before that
card is out of the question, is not ruled here but by its column expressions; tests hold
both to the same cards.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable
from datetime import date

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from resultlake.functions.dates import _BASIC, _EXTENDED, _SPACED, _TIGHT
from resultlake.operators import rules
from resultlake.operators.cards import BLOG_CARD, CAFE_CARD

_PORTAL, _SEARCH_PAGE, _CLIP, _HELP = rules.PORTAL, rules.SEARCH_PAGE, rules.CLIP_PREFIX, rules.HELP_HOST
READY, FETCH, BROKEN, SKIP = range(4)
_STATES = pa.array([rules.READY, rules.FETCH, rules.BROKEN], pa.string())

#: Cards with their states, as the rules of dated surfaces give them.
STATED = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("state", "name", "subject", "url")]
    + [T.StructField("date", T.DateType())]
)
_STATED = to_arrow_type(T.ArrayType(STATED))

# What Python takes for whitespace, and where a text has other than single blanks inside.
_OTHER_BLANKS = r"\t-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_UNEVEN = rf"[{_OTHER_BLANKS}]|  |\A | \z"
_ASCII_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "

# ASCII without brackets, which no URL splitter refuses.
_HARMLESS = r"\A[\x00-\x5a\x5c\x5e-\x7f]*\z"
_SEGMENTS = r"[!\"$-:<->@-Z\\^-~]"  # no "#", ";", "?"
_REST = r"(?:\?[!-\"$-Z\\^-~]+)?(?:#[!-Z\\^-~]+)?\z"
_COMPLETE = rf"\Ahttps?://[!\"$-.0-9<->@-Z\\^-~]+(?:/{_SEGMENTS}*)?{_REST}"
_ROOTED = rf"\A/{_SEGMENTS}*{_REST}"
_DOTTED = r"\A//|\A[^?#]*/\."


def _true(found: pa.Array) -> np.ndarray:
    """A mask in which what is not known does not count."""
    return pc.fill_null(found, False).to_numpy(zero_copy_only=False)


def _normalized(texts: pa.Array) -> pa.Array:
    """``functions.normalize_text``."""
    texts = pc.fill_null(texts, "")
    uneven = pc.match_substring_regex(texts, _UNEVEN)
    if not pc.any(uneven).as_py():
        return texts
    even = pc.replace_substring_regex(texts.filter(uneven), rf"[ {_OTHER_BLANKS}]+", " ")
    return pc.replace_with_mask(texts, uneven, pc.utf8_trim(even, characters=" "))


class _Links:
    """What hrefs come to, by every way of writing: their address on the portal (null for
    those of no use), and whether it takes more to tell."""

    def __init__(self, hrefs: pa.Array) -> None:
        coded = hrefs.dictionary_encode()
        self.codes, written = coded.indices, coded.dictionary
        href = pc.utf8_trim(written, characters=_ASCII_BLANKS)
        self._harmless = _true(pc.match_substring_regex(written, _HARMLESS))
        unusable = _true(pc.is_in(href, pa.array(["", "#"], href.type))) | _true(pc.starts_with(href, "javascript:"))
        complete = _true(pc.match_substring_regex(href, _COMPLETE))
        rooted = _true(pc.match_substring_regex(href, _ROOTED)) & ~_true(pc.match_substring_regex(href, _DOTTED))
        there = pc.binary_join_element_wise(pa.scalar(_PORTAL), href, "")
        address = pc.if_else(pa.array(complete), href, there)
        self._unsure = ~self._harmless | ~(unusable | complete | rooted)
        self.addresses = pc.if_else(pa.array((complete | rooted) & self._harmless & ~unusable), address, pa.scalar(None, address.type))

    def of(self, by_writing: np.ndarray) -> np.ndarray:
        """A mask of the ways of writing as one of the hrefs; False for null."""
        return _true(pa.array(by_writing, pa.bool_()).take(self.codes))

    def address(self) -> pa.Array:
        return self.addresses.take(self.codes)

    def unsure(self) -> np.ndarray:
        return self.of(self._unsure)

    def odd(self) -> np.ndarray:
        """Which may be malformed, whatever is around them."""
        return self.of(~self._harmless)

    def subjects(self) -> np.ndarray:
        """Which may lead to a post, or take more to tell."""
        there, no = self.addresses, np.zeros(len(self.addresses), bool)
        if len(there):
            jump = _true(pc.starts_with(there, _SEARCH_PAGE)) & _true(pc.match_substring(there, "#"))
            no = jump | _true(pc.starts_with(there, _CLIP)) | _true(pc.match_substring(there, _HELP))
        return self.of(self._unsure | (there.is_valid().to_numpy(zero_copy_only=False) & ~no))


_DIGIT = re.compile(r"\\p\{Nd\}")
_DOTS, _ISO = (
    [re.compile(_DIGIT.sub("[0-9]", form).replace(r"\z", r"\Z"), re.ASCII) for form in forms]
    for forms in ((_TIGHT, _SPACED), (_EXTENDED, _BASIC))
)
#: Date texts that are remembered.
_REMEMBERED = 1 << 16
_UNSURE = -(1 << 31)
_NO_DATE = _UNSURE + 1
_EPOCH = date(1970, 1, 1).toordinal()


def _day(clean: str) -> int:
    """``functions.parse_clean_date`` in days since 1970."""
    year = clean[:4]
    if len(year) < 4 or any(c.isalpha() or (c.isascii() and not c.isdigit()) for c in year):
        return _NO_DATE
    if not clean.isascii() or "W" in clean:  # other digits, weeks
        return _UNSURE
    if year == "0000":
        return _NO_DATE
    dotted = clean[4:5] == "."
    text = clean if dotted else clean.replace("Z", "+09:00")
    for form in _DOTS if dotted else _ISO:
        found = form.match(text)
        if found:
            try:
                return date(*(int(part) for part in found.groups())).toordinal() - _EPOCH
            except ValueError:
                return _NO_DATE
    return _NO_DATE


def _days(texts: pa.Array, known: dict[str, int]) -> np.ndarray:
    """Days of date texts without nulls, ``_NO_DATE`` or ``_UNSURE``; ``known`` are those read before."""
    found, coded = [], texts.dictionary_encode()
    for text in coded.dictionary.to_pylist():
        day = known.get(text)
        if day is None:
            if len(known) >= _REMEMBERED:
                known.clear()
            day = known[text] = _day(text)
        found.append(day)
    return np.array(found, np.int64)[coded.indices.to_numpy()] if found else np.zeros(0, np.int64)


class _Cards:
    """The cards of some pages that are shown, in one column a field."""

    def __init__(self, pages: pa.ListArray, shown: Callable[[pa.StructArray], pa.Array]) -> None:
        self.sizes = pc.fill_null(pc.list_value_length(pages), 0).to_numpy()
        self.missing = pages.is_null().to_numpy(zero_copy_only=False)
        cards = pages.flatten()
        self.at = np.flatnonzero(_true(shown(cards)))
        self.cards = cards.take(pa.array(self.at))
        self.page = np.repeat(np.arange(len(pages)), self.sizes)[self.at]

    def field(self, *names: str) -> pa.Array:
        return pc.struct_field(self.cards, list(names))

    def stated(self, state, name, subject, url, days, unsure) -> tuple[pa.ListArray, np.ndarray]:
        """Pages of stated cards, null where a card is ``unsure``; and where they are not."""
        plain = ~self.missing
        plain[self.page[unsure]] = False
        kept = (state != SKIP) & plain[self.page]
        dates = pa.array(np.where(days == _NO_DATE, 0, days).astype(np.int32)[kept], mask=(days == _NO_DATE)[kept])
        chosen = pa.array(kept)
        columns = [
            _STATES.take(pa.array(state[kept])), name.filter(chosen), subject.filter(chosen), url.filter(chosen), dates.cast(pa.date32())
        ]
        card = _STATED.value_type
        values = pa.StructArray.from_arrays(columns, fields=[card.field(i) for i in range(card.num_fields)])
        ends = np.cumsum(np.bincount(self.page[kept], minlength=len(plain)))
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, values, type=_STATED, mask=pa.array(~plain)), plain


def blog_cards(pages: pa.ListArray, known: dict[str, int]) -> tuple[pa.ListArray, np.ndarray]:
    """``rules.blog_cards``."""
    cards = _Cards(pages, lambda c: pc.and_(pc.invert(c.field("is_ad")), c.field("has_profile")))
    nobody = cards.field("name").is_null().to_numpy(zero_copy_only=False)
    name = _normalized(cards.field("name", "text"))
    author_link = _Links(cards.field("name", "href"))
    author = author_link.address()
    undated = cards.field("date_text").is_null().to_numpy(zero_copy_only=False)
    days = _days(_normalized(cards.field("date_text")), known)
    days[undated] = _NO_DATE

    anchors = cards.field("anchors")
    owner = np.repeat(np.arange(len(anchors)), pc.fill_null(pc.list_value_length(anchors), 0).to_numpy())
    anchors = anchors.flatten()
    links, texts = _Links(anchors.field("href")), anchors.field("text")
    may = links.subjects() & (links.odd() | _true(pc.not_equal(texts, "")))
    at = np.flatnonzero(may)
    taken = pa.array(at)
    owner, text, url = owner[at], _normalized(texts.take(taken)), links.address().take(taken)
    unsure, odd = links.unsure()[at], links.odd()[at]
    own = pa.array(owner)
    told = _true(pc.not_equal(text, "")) & _true(pc.not_equal(text, name.take(own)))
    fits = odd | (unsure & told) | (told & _true(pc.not_equal(url, author.take(own))))
    at = np.flatnonzero(fits)
    first = at[np.unique(owner[at], return_index=True)[1]]
    place = np.full(len(nobody), -1)
    place[owner[first]] = first
    none = place < 0
    choice = pa.array(place, mask=none)
    subject, url = text.take(choice), url.take(choice)

    doubt = author_link.unsure() | (days == _UNSURE)
    doubt[owner[first]] |= unsure[first]
    nameless = _true(pc.equal(name, "")) | author.is_null().to_numpy(zero_copy_only=False)
    state = np.select([nobody, nameless, none | undated, days != _NO_DATE], [BROKEN, SKIP, BROKEN, READY], FETCH)
    return cards.stated(state, name, subject, url, days, doubt)


def cafe_cards(pages: pa.ListArray, known: dict[str, int]) -> tuple[pa.ListArray, np.ndarray]:
    """``rules.cafe_cards``."""

    def shown(c: pa.StructArray) -> pa.Array:
        there = [c.field(name).is_valid() for name in ("name_text", "date_text", "subject")]
        return pc.and_(pc.invert(c.field("is_ad")), pc.and_(there[0], pc.and_(there[1], there[2])))

    cards = _Cards(pages, shown)
    name, subject = _normalized(cards.field("name_text")), _normalized(cards.field("subject", "text"))
    links = _Links(cards.field("subject", "href"))
    bare = pc.replace_substring_regex(links.addresses, r"(?s)[?#].*\z", "")
    url = bare.take(links.codes)
    days = _days(_normalized(cards.field("date_text")), known)
    blank = _true(pc.equal(name, "")) | _true(pc.equal(subject, "")) | url.is_null().to_numpy(zero_copy_only=False)
    state = np.select([blank, days != _NO_DATE], [SKIP, READY], FETCH)
    return cards.stated(state, name, subject, url, days, links.unsure() | (days == _UNSURE))


#: The rules that can be said of columns, by the expression whose cards they give, with the
#: raw cards they read.
RULED = {rules.blog_cards: (BLOG_CARD, blog_cards), rules.cafe_cards: (CAFE_CARD, cafe_cards)}

cloudpickle.register_pickle_by_value(sys.modules[__name__])
