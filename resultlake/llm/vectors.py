"""Embeddings as valid numeric rows, for the operators on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid(vector: Column) -> Column:
    """Not null, and without null or non-finite components."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(True))


def as_doubles(df: DataFrame, name: str = "embedding") -> Column:
    return F.col(name).cast("array<double>")
