"""Reading many pages of a batch together: the trees of ``dom.PageTree`` as arrays.

Tags are told apart once per batch and way of writing, selectors are tried on these, and
what lies within what is a range of positions. Only pages of well-formed tags are read
so; ``Forest.regular`` says which, and all others are ``PageTree``'s.
"""

from __future__ import annotations

import html
import re
from html.entities import html5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from resultlake.operators.dom import (
    _ESCAPABLE,
    _LONGEST,
    _RAW,
    _REMEMBERED,
    _TAG,
    APART,
    VOID,
    Compound,
    Element,
    Selectors,
)

# What a tag is; an end tag has its name's number besides.
ODD, OPEN, ALONE, HIDDEN, TITLE, CLOSE, MARKUP = range(7)
_COMMENT = re.compile(r"!--(?!-?>)[^-]*(?:-[^-]+)*--|!(?i:doctype)[ \t\n\r\f][^<>\[]*")
# What ``str.strip`` drops.
_BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_REFERENCE = re.compile(
    r"""&(?:\#([0-9]+|[xX][0-9a-fA-F]+);
    |([a-zA-Z][a-zA-Z0-9]*)(?:;|(?=[ \t\n\r\f<&"'(),:/=]))
    |(?=[ \t\n\r\f0-9.,]))""",
    re.VERBOSE,
)


# A start tag of quoted attributes among which is a link: most tags that no other is written
# like differ from others in it alone. No value but the link's holds what may begin another.
_LINKED = (
    r'(?s)\A(?P<before>[a-zA-Z][a-zA-Z0-9]*(?: [a-z][a-z-]*="[^"&=]*")*? href=")(?P<link>[^"&]*)'
    r'(?P<after>"(?: [a-z][a-z-]*="[^"&=]*")*)\z'
)
# References most texts have no others of; the last one resolved is the one that makes more.
_COMMON = [("&nbsp;", "\xa0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


# Tests of links, and compounds without theirs.
_PASSES = {"=": pc.equal, "^=": pc.starts_with, "*=": pc.match_substring}
_UNLINKED: dict[Compound, tuple[Compound, list]] = {}


def _referred(found: re.Match) -> str:
    number, name = found[1], found[2]
    if number:
        return html.unescape(f"&#{number};")
    return (html5.get(name + ";") or html5.get(name) or "&" + name) if name else "&"


def unescaped(text: str) -> str | None:
    """A text before a tag with its references resolved; None if one is not well-formed."""
    made, count = _REFERENCE.subn(_referred, text + "<")
    return made[:-1] if count == text.count("&") else None


def _read_tag(written: str) -> tuple[int, str, Element | None]:
    """Kind, name and element of a tag, from a "<" to the first ">"."""
    if written.startswith("!"):
        return (MARKUP if _COMMENT.fullmatch(written) else ODD), "", None
    found = _TAG.fullmatch(written)
    if not found:
        return ODD, "", None
    if found[1]:
        tag = found[1].lower()
        return (ODD if tag in VOID else CLOSE), tag, None
    tag = found[2].lower()
    if found[4]:
        return ODD, tag, None
    element = Element(tag, found[3])
    if tag in _RAW:
        return (HIDDEN if tag in APART else ODD), tag, element
    if tag in APART:
        return ODD, tag, element
    if tag in _ESCAPABLE:
        return TITLE, tag, element
    return (ALONE if tag in VOID else OPEN), tag, element


class Forest:
    """Pages (strings without nulls) cut at their "<": piece by piece a tag and the text behind it. Elements
    are numbers in document order over all pages, with the piece that opens and the one
    that closes them. ``seen`` are tags that earlier batches hold."""

    def __init__(self, pages: pa.Array, seen: dict) -> None:
        # What tags are written like, their links left out, is told apart once; ``codes`` are
        # of that, ``whole`` of tags as written.
        cut = pc.split_pattern(pages, "<")
        edges = cut.offsets.to_numpy().astype(np.int64)
        self.edges = edges - edges[0]
        parts = pc.split_pattern(cut.flatten(), ">", max_splits=1)
        offsets = parts.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        flat = parts.flatten()
        count, closed = len(parts), np.diff(offsets) == 2
        self.page = np.repeat(np.arange(len(pages)), np.diff(self.edges))
        self.regular = np.ones(len(pages), bool)

        coded = flat.take(pa.array(offsets[:-1])).dictionary_encode()
        self.whole, self._tags_whole = coded.indices.to_numpy(), coded.dictionary
        self._part_links()
        written = self._written.to_pylist()
        self._tags(written, seen)
        # Before a page's first tag there is but text, which belongs to no element.
        starts = self.edges[:-1]
        self.regular &= ~closed[starts] & np.array(["&" not in written[c] for c in self.codes[starts].tolist()], bool)
        # A piece without ">" is no tag; it has no text but within raw text.
        self._pieces = flat.take(pa.array(np.where(closed, offsets[1:] - 1, 0)))
        kinds = np.where(closed, self._kinds[self.codes], ODD)
        kinds[starts] = MARKUP
        silent = np.zeros(count, bool)
        silent[starts] = True
        self._hide(kinds, silent)
        self._nest(kinds)
        self._visible = self._shown(silent)
        titles = np.flatnonzero(kinds == TITLE)
        behind = np.minimum(titles + 1, count - 1)
        names = self._names[self.codes]
        kinds[titles[(kinds[behind] != CLOSE) | (names[behind] != names[titles])]] = ODD
        self.regular[self.page[kinds == ODD]] = False

    # -- reading -----------------------------------------------------------
    def _part_links(self) -> None:
        """Tags without their links, and the links by tag as written; null for other tags."""
        written = self._tags_whole
        found = pc.extract_regex(written, _LINKED)
        before, links, after = (pc.struct_field(found, name) for name in ("before", "link", "after"))
        again = pc.fill_null(pc.match_substring(after, ' href="'), True)
        self._links = pc.if_else(again, pa.scalar(None, links.type), links)
        bare = pc.if_else(again, written, pc.binary_join_element_wise(before, after, "")).dictionary_encode()
        self._written, self._like = bare.dictionary, bare.indices
        self.codes = bare.indices.to_numpy()[self.whole]

    def _tags(self, written: list[str], seen: dict) -> None:
        numbers: dict[str, int] = {}
        kinds, names, self._elements = [], [], []
        for tag in written:
            found = seen.get(tag)
            if found is None:
                found = _read_tag(tag)
                if len(tag) <= _LONGEST:
                    if len(seen) >= _REMEMBERED:
                        seen.clear()
                    seen[tag] = found
            kinds.append(found[0])
            names.append(numbers.setdefault(found[1], len(numbers)))
            self._elements.append(found[2])
        self._kinds, self._names, self._numbers = np.array(kinds, np.int8), np.array(names), numbers
        self._comments = np.array([tag.startswith("!--") for tag in written], bool)
        self._refers = np.array(["&" in tag for tag in written], bool)
        self._opening = np.array([e is not None for e in self._elements], bool)

    def _hide(self, kinds: np.ndarray, silent: np.ndarray) -> None:
        """Mark what scripts and styles hold: their pieces are neither tags nor text."""
        raw = np.flatnonzero(kinds == HIDDEN)
        names, behind = self._names[self.codes], np.zeros(len(raw), np.int64)
        for name in set(names[raw].tolist()):
            own = names[raw] == name
            ends = np.append(np.flatnonzero((kinds == CLOSE) & (names == name)), len(kinds))
            behind[own] = ends[np.searchsorted(ends, raw[own])]
        pages = self.page[raw]
        upto = np.minimum(behind, self.edges[pages + 1])
        if (raw[1:] < upto[:-1]).any():  # one within another is its text
            kept, last = np.zeros(len(raw), bool), -1
            for i, (at, end) in enumerate(zip(raw.tolist(), upto.tolist())):
                if at >= last:
                    kept[i], last = True, end
            raw, behind, upto, pages = raw[kept], behind[kept], upto[kept], pages[kept]
        comments = np.concatenate([[0], np.cumsum(self._comments[self.codes])])
        self.regular[pages[(upto < behind) | (comments[behind] > comments[raw + 1])]] = False
        kinds[_marked(raw + 1, upto, len(kinds))] = MARKUP
        silent |= _marked(raw, upto, len(kinds))

    def _nest(self, kinds: np.ndarray) -> None:
        """Positions of all elements and of what closes them."""
        opens = (kinds == OPEN) | (kinds == HIDDEN) | (kinds == TITLE)
        elements = opens | (kinds == ALONE)
        self.at = np.flatnonzero(elements)
        self.end = self.at.copy()
        number = np.cumsum(elements) - 1
        events = np.flatnonzero(opens | (kinds == CLOSE))
        names = self._names[self.codes[events]]
        names = np.where(kinds[events] == CLOSE, ~names, names)
        # An end tag right behind its start tag, but for such pairs, closes it whatever is open.
        while True:
            pair = (names[:-1] >= 0) & (names[:-1] == ~names[1:]) & (self.page[events[:-1]] == self.page[events[1:]])
            first = np.flatnonzero(pair)
            if len(first) * 16 < len(events) or not len(events):
                break
            self.end[number[events[first]]] = events[first + 1]
            left = np.ones(len(events), bool)
            left[first] = left[first + 1] = False
            events, names = events[left], names[left]
        bounds = np.searchsorted(events, self.edges).tolist()
        signed, places, numbers = names.tolist(), events.tolist(), number[events].tolist()
        closed, closing = [], []
        for page, (low, high) in enumerate(zip(bounds, bounds[1:])):
            opened, tags = [], []
            for i in range(low, high):
                name = signed[i]
                if name >= 0:
                    opened.append(numbers[i])
                    tags.append(name)
                elif tags and tags[-1] == ~name:
                    tags.pop()
                    closed.append(opened.pop())
                    closing.append(places[i])
                elif ~name in tags:
                    while True:
                        closed.append(opened.pop())
                        closing.append(places[i])
                        if tags.pop() == ~name:
                            break
            closed += opened
            closing += [int(self.edges[page + 1])] * len(opened)
        self.end[np.array(closed, np.int64)] = np.array(closing, np.int64)

    def _shown(self, silent: np.ndarray) -> np.ndarray:
        """Before every piece, the number of pieces whose text counts and is not blank."""
        texts = self._pieces
        shown = np.zeros(len(texts), bool)
        some = np.flatnonzero(~silent & (pc.binary_length(texts).to_numpy() > 0))
        told = texts.take(pa.array(some))
        shown[some] = plain = pc.match_substring_regex(told, r"[\x21-\x25\x27-\x7e]").to_numpy(zero_copy_only=False)
        refers = pc.match_substring(told, "&").to_numpy(zero_copy_only=False)
        doubt = refers | ~plain
        told, refers, doubt = told.filter(pa.array(doubt)), refers[doubt], some[doubt]
        at, written = doubt[refers], told.filter(pa.array(refers))
        # Behind a page's last tag a reference may go on.
        self.regular[self.page[at[np.isin(at, self.edges[1:] - 1)]]] = False
        made = self._resolved(written, at)
        shown[doubt[~refers]] = _not_blank(told.filter(pa.array(~refers)))
        shown[at] = _not_blank(made)
        if len(at):
            own = np.arange(len(texts))
            own[at] = len(texts) + np.arange(len(made))
            self._pieces = pa.concat_arrays([texts, made])
            self._text_of = own[shown]
        else:
            self._text_of = np.flatnonzero(shown)
        return np.concatenate([[0], np.cumsum(shown)])

    def _resolved(self, texts: pa.Array, at: np.ndarray) -> pa.Array:
        """Texts of pieces ``at`` with their references resolved."""
        plain = texts
        for written, meant in _COMMON[:-1]:
            plain = pc.replace_substring(plain, written, meant)
        written, meant = _COMMON[-1]
        others = np.flatnonzero(pc.not_equal(pc.count_substring(plain, "&"), pc.count_substring(plain, written)).to_numpy(zero_copy_only=False))
        plain = pc.replace_substring(plain, written, meant)
        if not len(others):
            return plain
        made = [unescaped(text) for text in texts.take(pa.array(others)).to_pylist()]
        self.regular[self.page[at[others[[text is None for text in made]]]]] = False
        mask = np.zeros(len(texts), bool)
        mask[others] = True
        return pc.replace_with_mask(plain, pa.array(mask), pa.array([text or "" for text in made], texts.type))

    # -- asking ------------------------------------------------------------
    def _matching(self, compound: Compound) -> np.ndarray:
        """Which elements pass one compound, whatever is above them."""
        if any(name == "href" and value for name, _, value in compound.tests):
            return self._matching_links(compound)
        may = self._opening
        if compound.tag is not None:
            may = may & (self._names == self._numbers.get(compound.tag, -1))
        if compound.word:  # an attribute may hold it in another writing
            may = may & (pc.match_substring(self._written, compound.word).to_numpy(zero_copy_only=False) | self._refers)
        fits = np.zeros(len(self._names), bool)
        for code in np.flatnonzero(may).tolist():
            fits[code] = self._elements[code].fits(compound)
        return fits[self.codes[self.at]]

    def _matching_links(self, compound: Compound) -> np.ndarray:
        """``_matching`` for a compound that reads links, which are columns of their own."""
        if compound not in _UNLINKED:
            links = [test for test in compound.tests if test[0] == "href" and test[2]]
            others = [test for test in compound.tests if test not in links]
            _UNLINKED[compound] = Compound(compound.tag, list(compound.classes), others), links
        bare, links = _UNLINKED[compound]
        kept = pa.array([e and e.attrs().get("href") for e in self._elements], pa.string())
        written = pc.coalesce(self._links, kept.take(self._like))
        fits = np.ones(len(written), bool)
        for _, operator, value in links:
            fits &= pc.fill_null(_PASSES[operator](written, value), False).to_numpy(zero_copy_only=False)
        return self._matching(bare) & fits[self.whole[self.at]]

    def _below(self, tops: np.ndarray) -> np.ndarray:
        """Which elements are within one of those marked."""
        size, at = len(self.codes) + 2, self.at[tops] + 1
        change = np.bincount(at, minlength=size) - np.bincount(np.maximum(at, self.end[tops]), minlength=size)
        return np.cumsum(change)[self.at] > 0

    def select(self, selectors: Selectors) -> np.ndarray:
        """Numbers of matching elements, in document order."""
        hits = np.zeros(len(self.at), bool)
        for first, *rest in selectors:
            found = self._matching(first)
            for compound in rest:
                found = self._matching(compound) & self._below(found)
            hits |= found
        return np.flatnonzero(hits)

    def pages(self) -> tuple[np.ndarray, np.ndarray]:
        """The range of each page."""
        return self.edges[:-1], self.edges[1:]

    def ranges(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranges within elements; nothing for -1."""
        none = numbers < 0
        if not len(self.at):
            return np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
        return np.where(none, 0, self.at[numbers]), np.where(none, 0, self.end[numbers])

    def within(self, found: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the elements ``found``, where those of each range begin and end."""
        at = self.at[found]
        first = np.searchsorted(at, low, "right")
        return first, np.maximum(first, np.searchsorted(at, high, "left"))

    def first(self, selectors: Selectors, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The first match in each range, or -1."""
        found = self.select(selectors)
        first, behind = self.within(found, low, high)
        return np.where(first < behind, np.append(found, -1)[first], -1)

    def all(self, selectors: Selectors, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The matches in each range, one range behind the other, and where each ends."""
        found = self.select(selectors)
        first, behind = self.within(found, low, high)
        places, upto = _spread(first, behind)
        return found[places], upto

    def children(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What is right below elements, none of which is within another (-1: nothing), one
        after the other, and where each one's end."""
        first, behind = self.within(np.arange(len(self.at)), *self.ranges(numbers))
        places, upto = _spread(first, behind)
        owner = np.repeat(np.arange(len(numbers)), np.diff(upto, prepend=0))
        before = np.maximum.accumulate(np.concatenate([[-1], self.end[places]]))[:-1]
        own = self.at[places] > before  # not within one before it
        return places[own], np.cumsum(np.bincount(owner[own], minlength=len(numbers)))

    def tags(self, numbers: np.ndarray) -> pa.Array:
        return pa.array([e and e.tag for e in self._elements], pa.string()).take(pa.array(self.codes[self.at[numbers]]))

    def classes(self, numbers: np.ndarray) -> pa.Array:
        codes, place = np.unique(self.codes[self.at[numbers]], return_inverse=True)
        words = [self._elements[code].attrs().get("class", "").split() for code in codes.tolist()]
        return pa.array(words, pa.list_(pa.string())).take(pa.array(place))

    def have_text(self, numbers: np.ndarray) -> np.ndarray:
        """Whether ``PageTree.text`` of elements is anything."""
        low, high = self.ranges(numbers)
        shown = self._visible[high] > self._visible[low]
        # A script's text is its own; more than a piece of it has a "<".
        raw = np.flatnonzero(self._kinds[self.codes[low]] == HIDDEN) if len(numbers) else np.zeros(0, np.int64)
        shown[raw] = (high[raw] - low[raw] > 1) | _not_blank(self._pieces.take(pa.array(low[raw])))
        return shown

    def texts(self, numbers: np.ndarray) -> pa.Array:
        """``PageTree.text`` of elements; null for -1."""
        own = self.at[numbers[numbers >= 0]]
        self.regular[self.page[own[self._kinds[self.codes[own]] == HIDDEN]]] = False  # their text is their own
        low, high = self.ranges(numbers)
        first, behind = self._visible[low], self._visible[high]
        places, upto = _spread(first, behind)
        words = pc.utf8_trim(self._pieces.take(pa.array(self._text_of[places])), characters=_BLANKS)
        ends = pa.array(np.concatenate([[0], upto]).astype(np.int32))
        joined = pc.binary_join(pa.ListArray.from_arrays(ends, words), " ")
        return pc.if_else(pa.array(numbers >= 0), joined, pa.scalar(None, joined.type))

    def attributes(self, numbers: np.ndarray, name: str) -> pa.Array:
        """An attribute of elements; null for -1."""
        if not len(self.at):
            return pa.nulls(len(numbers), pa.string())
        pieces = self.at[numbers]
        codes = self.codes[pieces]
        values = [None] * len(self._elements)
        for code in np.flatnonzero(np.bincount(codes[numbers >= 0], minlength=len(values))).tolist():
            values[code] = self._elements[code].attrs().get(name)
        found = pa.array(values, pa.string()).take(pa.array(codes, mask=numbers < 0))
        if name != "href":
            return found
        return pc.coalesce(self._links.take(pa.array(self.whole[pieces], mask=numbers < 0)), found)


def _marked(first: np.ndarray, behind: np.ndarray, size: int) -> np.ndarray:
    """A mask of some ranges."""
    change = np.bincount(first, minlength=size + 1) - np.bincount(np.maximum(first, behind), minlength=size + 1)
    return np.cumsum(change)[:size] > 0


def _not_blank(texts: pa.Array) -> np.ndarray:
    return pc.binary_length(pc.utf8_trim(texts, characters=_BLANKS)).to_numpy(zero_copy_only=False) > 0


def _spread(first: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of some ranges, one range behind the other, and where each ends."""
    sizes = behind - first
    upto = np.cumsum(sizes)
    return np.repeat(first - upto + sizes, sizes) + np.arange(int(sizes.sum())), upto
