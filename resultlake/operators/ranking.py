"""Reach, page failure, limit and order inside one page's card array (PR9, LM1, WN1)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resultlake.operators.rules import BROKEN, READY


def limit_of(max_rows: int) -> int:
    return max(1, max_rows)


def reached(cards: Column, max_rows: int) -> Column:
    """Cards a reader stopping at the ``max_rows``-th accepted one could get to.

    Nothing behind the ``max_rows``-th card that is sure to be accepted, or behind the
    first broken card, can change the page's rows.
    """
    states = F.transform(cards, lambda c: c["state"])
    sure = F.filter(
        F.transform(cards, lambda c, i: F.when(c["state"] == READY, i + 1)),
        lambda i: i.isNotNull(),
    )
    end = F.least(
        F.size(cards),
        F.try_element_at(sure, F.lit(limit_of(max_rows))),
        F.when(F.array_contains(states, BROKEN), F.array_position(states, BROKEN)).cast("int"),
    )
    return F.slice(cards, F.lit(1), end)


def accepted(pages: DataFrame, max_rows: int, cards: str = "cards") -> DataFrame:
    """Reduce a page's stated cards to its rows: none if a reached card is broken, else
    the first ones. Done in steps, so that no step is evaluated twice."""
    decided = F.filter(cards, lambda c: c["state"].isin(READY, BROKEN))
    within = pages.withColumn(cards, decided).withColumn(cards, reached(F.col(cards), max_rows))
    fails = F.exists(cards, lambda c: c["state"] == BROKEN)
    return within.withColumn(cards, F.when(fails, F.slice(cards, 1, 0)).otherwise(F.col(cards)))


def isolation(on_bad_card: str) -> Callable[[Column], Column]:
    """What to do to a card array so that a broken card takes its ``page`` with it, or
    the ``card`` alone."""
    if on_bad_card == "page":
        return lambda cards: cards
    if on_bad_card == "card":
        return lambda cards: F.filter(cards, lambda c: c["state"] != BROKEN)
    raise ValueError("on_bad_card is 'page' or 'card'")


def numbered(pages: DataFrame, *keys: str, rows: str = "rows") -> DataFrame:
    """One row per accepted card with its dense order number from 1."""
    flat = exploded(pages, *keys, array=rows, name="row")
    return flat.select(*keys, (F.col("position") + 1).cast("int").alias("order"), "row.*")


def exploded(df: DataFrame, *keys: str, array: str, name: str) -> DataFrame:
    """``keys``, the ``position`` from 0 and the elements of a computed array.

    The outer form keeps the optimizer from adding a "not empty" filter below, which
    would evaluate the whole array expression a second time.
    """
    flat = df.select(*keys, F.posexplode_outer(array).alias("position", name))
    return flat.where(F.col("position").isNotNull())
