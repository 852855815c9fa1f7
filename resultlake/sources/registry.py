"""Platforms and surfaces (SC9, SC10, URL3, SR2)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resultlake.functions import form_encode
from resultlake.operators import cards, rules

DEFAULT_MAX_ROWS = 10
DEFAULT_SORT_ORDER = "rel"


@dataclass(frozen=True)
class Surface:
    """One kind of result page.

    ``read`` and ``card`` describe the raw cards of a page, ``rule`` turns the card
    array into stated cards, ``columns`` names their fields in the result table.
    ``parameters`` are the search request's, with ``query`` and ``sort`` filled in.
    ``max_rows`` and ``sort_order`` hold unless a run names its own; a variant is
    ``dataclasses.replace(BLOG, max_rows=5)``.
    """

    name: str
    read: cards.Reader
    card: T.StructType
    rule: Callable[..., Column]
    columns: Mapping[str, str]
    search_page: str
    parameters: Sequence[tuple[str, str]]
    has_articles: bool = False
    sort_order: str | None = DEFAULT_SORT_ORDER
    max_rows: int = DEFAULT_MAX_ROWS

    def order_of(self, sort_order: str | None = None) -> str | None:
        """Sort order of a request; None where the surface takes none."""
        return self.sort_order and (sort_order or self.sort_order)

    def search_url(self, keyword: Column, sort_order: str | None = None) -> Column:
        pieces, mark = [F.lit(self.search_page)], "?"
        for name, value in self.parameters:
            pieces += [
                F.lit(f"{mark}{name}="),
                form_encode(keyword) if value == "{query}" else F.lit(value.format(sort=self.order_of(sort_order))),
            ]
            mark = "&"
        return F.concat(*pieces)


# Request parameters of the three surfaces.
SMARTBLOCK = Surface(
    "smartblock",
    cards.read_blocks,
    cards.BLOCK,
    rules.smartblock_cards,
    {"title": "title", "url": "url"},
    rules.SEARCH_PAGE,
    [("where", "nexearch"), ("query", "{query}")],
    sort_order=None,
)
CAFE = Surface(
    "cafe",
    cards.read_cafe_cards,
    cards.CAFE_CARD,
    rules.cafe_cards,
    {"date": "date", "name": "cafe_name", "subject": "subject", "url": "url"},
    rules.SEARCH_PAGE,
    [("ssc", "tab.cafe.all"), ("query", "{query}"), ("st", "{sort}")],
    has_articles=True,
)
BLOG = Surface(
    "blog",
    cards.read_blog_cards,
    cards.BLOG_CARD,
    rules.blog_cards,
    {"date": "date", "name": "blog_name", "subject": "subject", "url": "url"},
    rules.SEARCH_PAGE,
    [("ssc", "tab.blog.all"), ("query", "{query}"), ("st", "{sort}")],
    has_articles=True,
)

SURFACES = {s.name: s for s in (SMARTBLOCK, CAFE, BLOG)}


@dataclass
class Platforms:
    """Registered platforms, each with the surfaces it is read through."""

    known: dict[str, Mapping[str, Surface]] = field(default_factory=dict)

    def register(self, name: str, surfaces: Mapping[str, Surface]) -> None:
        self.known[name] = dict(surfaces)

    def chosen(self, names: Sequence[str] | None = None) -> list[str]:
        """Requested platforms in order, repeats kept; all of them if none is named."""
        wanted = list(names or self.known)
        unknown = set(wanted) - set(self.known)
        if unknown:
            raise ValueError(f"unknown platforms: {sorted(unknown)}")
        return wanted


PLATFORMS = Platforms()
PLATFORMS.register("naver", SURFACES)
