"""Reading one HTML page inside a task: a flat document-order tree and the few CSS
selectors the surfaces need. Raw strings go out; every rule is a column expression.

Tree rules are those of a lenient HTML reader without implied end tags: an unclosed
``<p>`` nests, void elements close at once, an end tag closes everything up to its
start tag, and an end tag that matches nothing is ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from html import parser as stdlib
from html.entities import html5

# Elements without content.
VOID = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
# Elements whose text does not belong to the text of what surrounds them.
APART = frozenset(["script", "style", "template", "rt", "rp"])

_SIMPLE = re.compile(r"""([.#]?)([\w-]+)|\[([\w-]+)(?:([\^*]?=)'([^']*)')?\]""")


class Compound:
    """What one element has to be; told apart by identity, which is cheap to look up."""

    __slots__ = ("tag", "classes", "tests", "word")

    def __init__(self, tag: str | None, classes: list, tests: list) -> None:
        self.tag, self.classes, self.tests = tag, frozenset(classes), tuple(tests)
        words = [*classes, *(word for *_, value in tests for word in value.split())]
        self.word = words[0] if words else ""  # what the attributes as written must hold


class Selectors(tuple):
    """A union of descendant chains, told apart by identity."""

    __hash__ = object.__hash__

    def __eq__(self, other) -> bool:
        return self is other


def css(selectors: str) -> Selectors:
    """Type, class, id and attribute tests, descendants and comma unions."""
    return Selectors(
        tuple(_compound(part) for part in re.findall(r"(?:\[[^\]]*\]|[^\s\[])+", one))
        for one in selectors.split(",")
    )


def _compound(text: str) -> Compound:
    tag, classes, tests = None, [], []
    for mark, name, attr, operator, value in _SIMPLE.findall(text):
        if attr:
            tests.append((attr, operator, value))
        elif mark == ".":
            classes.append(name)
        elif mark == "#":
            tests.append(("id", "=", name))
        else:
            tag = name
    return Compound(tag, classes, tests)


# Well-formed markup, read token by token, separated by HTML's own five blanks; from the first token that is anything else
# the standard library's lenient reader takes over.
_TOKEN = re.compile(
    r"""([^<&]+)
    |<([a-zA-Z][a-zA-Z0-9:_-]*)
      ((?:[ \t\n\r\f]+[^\s"'<>/=]+(?:[ \t\n\r\f]*=[ \t\n\r\f]*(?:"[^"]*"|'[^']*'|[^\s"'<>=`]+))?)*)[ \t\n\r\f]*(/?)>
    |</([a-zA-Z][a-zA-Z0-9:_-]*)[ \t\n\r\f]*>
    |&\#([0-9]+|[xX][0-9a-fA-F]+);
    |&([a-zA-Z][a-zA-Z0-9]*)(?:;|(?=[ \t\n\r\f<&"'(),:/=]))
    |(<!--(?!-?>)[^-]*(?:-[^-]+)*-->|<!(?i:doctype)[ \t\n\r\f][^<>\[]*>)
    |([<&](?=[ \t\n\r\f0-9.,]))""",
    re.VERBOSE,
)
_TEXT, _START, _ATTRS, _SELF_CLOSED, _END, _CHARACTER, _ENTITY, _MARKUP, _BARE = range(1, 10)
# The same start and end tags alone, from "<" to the first ">".
_TAG = re.compile(
    r"""/([a-zA-Z][a-zA-Z0-9:_-]*)[ \t\n\r\f]*
    |([a-zA-Z][a-zA-Z0-9:_-]*)
      ((?:[ \t\n\r\f]+[^\s"'<>/=]+(?:[ \t\n\r\f]*=[ \t\n\r\f]*(?:"[^"]*"|'[^']*'|[^\s"'<>=`]+))?)*)[ \t\n\r\f]*(/?)""",
    re.VERBOSE,
)
# Longest tag that is remembered, and how many of them are.
_LONGEST, _REMEMBERED = 1024, 4096
_ATTR = re.compile(
    r"""([^\s"'<>/=]+)(?:[ \t\n\r\f]*=[ \t\n\r\f]*(?:"([^"]*)"|'([^']*)'|([^\s"'<>=`]+)))?"""
)
_unescape = getattr(stdlib, "_unescape_attrvalue", None) or html.unescape
_RAW = frozenset(stdlib.HTMLParser.CDATA_CONTENT_ELEMENTS)
_RAW_END = {tag: re.compile(rf"</{tag}[ \t\n\r\f]*>", re.IGNORECASE) for tag in _RAW}
_ESCAPABLE = frozenset(getattr(stdlib.HTMLParser, "RCDATA_CONTENT_ELEMENTS", ())) | {"plaintext"}


def _passes(value: str | None, operator: str, wanted: str) -> bool:
    if value is None:
        return False
    if operator == "=":
        return value == wanted
    if operator == "^=":
        return value.startswith(wanted)
    return wanted in value  # "*=", or presence alone, where wanted is ""


class Element:
    """A start tag as written, shared by all elements written alike: its attributes are
    taken apart once, when asked for, and each compound is tried once."""

    __slots__ = ("tag", "raw", "hint", "simple", "_read", "_fits")

    def __init__(self, tag: str, raw: str, attrs: dict[str, str] | None = None) -> None:
        self.tag, self.raw, self._read, self._fits = tag, raw, attrs, {}
        self.simple = tag not in VOID and tag not in APART
        # Text that holds every attribute value.
        if attrs is not None:
            self.hint = " ".join(attrs.values())
        else:
            self.hint = raw if "&" not in raw else raw + html.unescape(raw)

    def attrs(self) -> dict[str, str]:
        found = self._read
        if found is None:
            found = self._read = {}
            for name, double, single, bare in _ATTR.findall(self.raw):
                value = double or single or bare
                found[name.lower()] = _unescape(value) if "&" in value else value
        return found

    def fits(self, wanted: Compound) -> bool:
        """Whether its attributes pass a compound, whatever is above it."""
        found = self._fits.get(wanted)
        if found is None:
            found = self._fits[wanted] = self._passes(wanted)
        return found

    def _passes(self, wanted: Compound) -> bool:
        attrs = self.attrs()
        if wanted.classes and not wanted.classes.issubset(attrs.get("class", "").split()):
            return False
        for name, operator, value in wanted.tests:
            own = attrs.get(name)
            if own is not None and name == "class":
                own = " ".join(own.split())
            if not _passes(own, operator, value):
                return False
        return True


def _tag(written: str) -> Element | str:
    """A well-formed tag, from a "<" to the first ">": an element, or the name of an end
    tag. "" for what has to be read token by token."""
    found = _TAG.fullmatch(written)
    if not found:
        return ""
    if found[1]:
        return found[1].lower()
    tag = found[2].lower()
    return "" if found[4] or tag in _RAW or tag in _ESCAPABLE else Element(tag, found[3])


class PageTree(stdlib.HTMLParser):
    """Elements by number in document order; a subtree is a number range. ``seen`` are
    tags that earlier pages hold, kept by whoever reads many."""

    def __init__(self, page: str, seen: dict[str, Element | str] | None = None) -> None:
        super().__init__(convert_charrefs=False)
        self.tags: list[str] = []
        self.elements: list[Element] = []
        self.parents: list[int] = []
        self.ends: list[int] = []
        self.spans: list[list[int]] = []
        self.strings: list[tuple[str | None, str]] = []
        self._open: list[int] = []
        self._apart: list[int] = []
        self._pending: list[str] = []
        self._closed_void: list[str] = []
        self._found: dict[Selectors, list[int]] = {}
        self._alike: dict[Element, list[int]] = {}
        self._seen = {} if seen is None else seen
        rest = self._scan(page)
        if rest < len(page):
            self.feed(page[rest:])
        self.close()
        self._flush()
        while self._open:
            self._pop()
        for number, element in enumerate(self.elements):
            self._alike.setdefault(element, []).append(number)

    # -- reading -----------------------------------------------------------
    def _scan(self, page: str) -> int:
        """Read well-formed markup; returns where it ends."""
        at, token, pending = 0, _TOKEN.match, self._pending
        tags, opened, apart, seen = self.tags, self._open, self._apart, self._seen
        elements, parents, ends, spans, strings = self.elements, self.parents, self.ends, self.spans, self.strings
        pieces = iter(page.split("<"))
        start = len(next(pieces))  # where the next piece begins
        whole = len(page)
        while at < whole:
            while start <= at and start < whole:
                written = next(pieces)
                if start < at:  # part of a token read already
                    start += len(written) + 1
                    continue
                start += len(written) + 1
                tag, closed, text = written.partition(">")
                element = seen.get(tag) if closed else ""
                if element is None:
                    element = _tag(tag)
                    if len(tag) <= _LONGEST:
                        if len(seen) >= _REMEMBERED:
                            seen.clear()
                        seen[tag] = element
                if not element:
                    break
                # What _start, handle_endtag and _pop do, mostly without calling them.
                if element.__class__ is Element:
                    if element.simple:
                        if pending:
                            self._flush()
                        parents.append(opened[-1] if opened else -1)
                        opened.append(len(tags))
                        tags.append(element.tag)
                        elements.append(element)
                        ends.append(-1)
                        spans.append([len(strings), -1])
                    else:
                        self._start(element)
                elif opened and tags[opened[-1]] == element and element not in VOID:
                    if pending:
                        self._flush()
                    number = opened.pop()
                    if apart and apart[-1] == number:
                        apart.pop()
                    ends[number] = len(tags)
                    spans[number][1] = len(strings)
                else:
                    self.handle_endtag(element)
                if "&" in text:
                    at += len(tag) + 2
                    break
                if text:
                    pending.append(text)
                at = start
            if at >= whole:
                break
            found = token(page, at)
            if not found:
                break
            kind = found.lastindex
            if kind == _TEXT:
                pending.append(found[_TEXT])
            elif kind == _END:
                tag = found[_END].lower()
                if opened and tags[opened[-1]] == tag and tag not in VOID:
                    if pending:
                        self._flush()
                    self._pop()
                else:
                    self.handle_endtag(tag)
            elif kind == _SELF_CLOSED:
                tag = found[_START].lower()
                if found[_SELF_CLOSED]:
                    self._start(Element(tag, found[_ATTRS]), void_closes=False)
                    self.handle_endtag(tag)
                elif tag in _RAW:
                    end = _RAW_END[tag].search(page, found.end())
                    if not end or page.find("<!--", found.end(), end.start()) >= 0:
                        break
                    self._start(Element(tag, found[_ATTRS]))
                    pending.append(page[found.end():end.start()])
                    self.handle_endtag(tag)
                    at = end.end()
                    continue
                elif tag in _ESCAPABLE and not page[page.find("<", found.end()):].lower().startswith(f"</{tag}"):
                    break
                else:
                    self._start(Element(tag, found[_ATTRS]))
            elif kind == _CHARACTER:
                self.handle_charref(found[_CHARACTER])
            elif kind == _ENTITY:
                self.handle_entityref(found[_ENTITY])
            elif kind == _MARKUP:
                self._flush()
            else:
                pending.append(found[_BARE])
            at = found.end()
        return at

    def _start(self, element, void_closes=True):
        if self._pending:
            self._flush()
        number, tag = len(self.tags), element.tag
        self.tags.append(tag)
        self.elements.append(element)
        self.parents.append(self._open[-1] if self._open else -1)
        self.ends.append(-1)
        self.spans.append([len(self.strings), -1])
        self._open.append(number)
        if tag in APART:
            self._apart.append(number)
        if void_closes and tag in VOID:
            self._close(tag)
            self._closed_void.append(tag)

    def handle_starttag(self, tag, attrs):
        self._start(Element(tag, "", {name: value or "" for name, value in attrs}))

    def handle_startendtag(self, tag, attrs):
        self._start(Element(tag, "", {name: value or "" for name, value in attrs}), void_closes=False)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in self._closed_void:
            self._closed_void.remove(tag)
        else:
            self._close(tag)

    def handle_data(self, data):
        self._pending.append(data)

    def handle_charref(self, name):
        self._pending.append(html.unescape(f"&#{name};"))

    def handle_entityref(self, name):
        self._pending.append(html5.get(name + ";") or html5.get(name) or "&" + name)

    def handle_comment(self, data):
        self._flush()

    def handle_decl(self, decl):
        self._flush()

    def handle_pi(self, data):
        self._flush()

    def unknown_decl(self, data):
        self._flush()
        if data.upper().startswith("CDATA["):
            self.strings.append((None, data[6:]))

    def updatepos(self, i, j):
        return j  # nobody asks for line numbers

    def _flush(self):
        if self._pending:
            kind = self.tags[self._apart[-1]] if self._apart else None
            self.strings.append((kind, "".join(self._pending)))
            self._pending.clear()

    def _close(self, tag):
        if self._pending:
            self._flush()
        tags = self.tags
        if self._open and (
            tags[self._open[-1]] == tag or any(tags[number] == tag for number in reversed(self._open))
        ):
            while self._pop() != tag:
                pass

    def _pop(self):
        number = self._open.pop()
        if self._apart and self._apart[-1] == number:
            self._apart.pop()
        self.ends[number] = len(self.tags)
        self.spans[number][1] = len(self.strings)
        return self.tags[number]

    # -- asking ------------------------------------------------------------
    def attrs(self, number: int) -> dict[str, str]:
        return self.elements[number].attrs()

    def attr(self, number: int | None, name: str) -> str | None:
        return None if number is None else self.elements[number].attrs().get(name)

    def classes(self, number: int) -> list[str]:
        return self.attrs(number).get("class", "").split()

    def select(self, selectors: Selectors, top: int | None = None) -> list[int]:
        """Matching elements below ``top`` (or anywhere), in document order. Ancestors
        count up to the root, so a page's matches are found once."""
        found = self._found.get(selectors)
        if found is None:
            hits = set()
            for *above, last in selectors:
                numbers = self._matching(last)
                hits.update(self._below(numbers, above) if above else numbers)
            found = self._found[selectors] = sorted(hits)
        if top is None:
            return found
        return found[bisect_left(found, top + 1):bisect_left(found, self.ends[top])]

    def first(self, selectors: Selectors, top: int | None = None) -> int | None:
        found = self.select(selectors, top)
        return found[0] if found else None

    def children(self, top: int) -> list[int]:
        found, number = [], top + 1
        while number < self.ends[top]:
            found.append(number)
            number = self.ends[number]
        return found

    def text(self, number: int | None) -> str | None:
        """Stripped text pieces of an element, joined by one blank."""
        if number is None:
            return None
        kind = self.tags[number] if self.tags[number] in APART else None
        low, high = self.spans[number]
        if high - low == 1:
            own, text = self.strings[low]
            return text.strip() if own == kind else ""
        pieces = [text.strip() for own, text in self.strings[low:high] if own == kind]
        return pieces[0] if len(pieces) == 1 else " ".join(filter(None, pieces))

    def _matching(self, compound: Compound) -> set[int]:
        """Elements that pass one compound, whatever is above them."""
        found: set[int] = set()
        tag, word = compound.tag, compound.word
        for element, numbers in self._alike.items():
            if (tag is None or element.tag == tag) and word in element.hint and element.fits(compound):
                found.update(numbers)
        return found

    def _below(self, numbers: set[int], above: list) -> set[int]:
        """Those of ``numbers`` that have the wanted ancestors, nearest first."""
        wanted = [self._matching(compound) for compound in reversed(above)]
        if not all(wanted):
            return set()
        parents, kept = self.parents, set()
        for number in numbers:
            at = number
            for ancestors in wanted:
                at = parents[at]
                while at >= 0 and at not in ancestors:
                    at = parents[at]
                if at < 0:
                    break
            else:
                kept.add(number)
        return kept
