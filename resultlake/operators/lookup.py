"""Equi-joins against tables that are unique on the key (JN1-JN3), and pruning by key
below the page reader."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words of 64 bits a key filter may have; what it sends to every executor has at most as
# many rows, whatever the number of keys.
FILTER_WORDS = 1 << 20
# Bits of the filter for every key, and how many of its own a key sets: all of them in
# one word, so that a lookup is one equi-join.
KEY_BITS, OWN_BITS = 12, 4


def lookup_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join ``left`` to its at most one match in ``right``; ``how`` is ``inner``,
    ``left``, ``left_semi`` or ``left_anti``. AQE splits the partitions of hot keys and
    broadcasts a side that turns out to be small."""
    return left.join(right, keys, how)


def bucket_of(key: Column, buckets: int) -> Column:
    """Bucket of a key in a store; independent of the key's place in a filter."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _own_bits(key: str) -> Column:
    """The bits a key sets in its word."""
    at = F.xxhash64(F.col(f"`{key}`"), F.lit("bits"))
    picks = [F.shiftrightunsigned(at, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(OWN_BITS)]
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in picks])


def _word(key: str, words: int) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{key}`"), F.lit("word")), F.lit(words))


def words_for(keys: int) -> int:
    """Words of a filter in which few foreign keys pass."""
    return max(1, -(-keys * KEY_BITS // 64))


def key_count(keys: DataFrame, key: str) -> int:
    return keys.agg(F.approx_count_distinct(f"`{key}`", 0.02)).first()[0]


def likely(rows: DataFrame, keys: DataFrame, key: str, words: int | None = None) -> DataFrame:
    """``rows`` whose ``key`` may be among ``keys (key)``: none of them is lost, and
    under two percent of the others stay while the keys fit the filter's words: as many
    as these keys need, ``FILTER_WORDS`` at most. ``likely_in_buckets`` has no such end.

    The filter is one row per used word, so it is broadcast under a bound and ``rows``
    are never shuffled. An exact join follows where the others matter.
    """
    words = words or min(FILTER_WORDS, words_for(key_count(keys, key)))
    own = keys.where(F.col(f"`{key}`").isNotNull()).select(
        _word(key, words).alias("_word"), _own_bits(key).alias("_bits")
    )
    filter_rows = F.broadcast(own.groupBy("_word").agg(F.bit_or("_bits").alias("_bits")))
    marked = rows.where(F.col(f"`{key}`").isNotNull()).join(filter_rows, _word(key, words) == F.col("_word"))
    bits = _own_bits(key)
    return marked.where(F.col("_bits").bitwiseAND(bits) == bits).select(*(F.col(f"`{c}`") for c in rows.columns))


def likely_in_buckets(
    rows: DataFrame, keys: DataFrame, key: str, buckets: int, words: int = FILTER_WORDS
) -> DataFrame:
    """``likely`` for rows stored by ``bucket``, a partition column that holds
    ``bucket_of(key)``, and any number of keys: the buckets are taken in ranges, each
    with a filter of its own keys alone, of at most ``words`` words, over its own files.
    A file is opened for one range, so all ranges read the rows once. A range is a
    bucket at least: a store should have a bucket for every few million keys."""
    ranges = min(buckets, max(1, -(-words_for(key_count(keys, key)) // words)))
    own = bucket_of(F.col(f"`{key}`"), buckets)
    parts = []
    for at in range(ranges):
        low, high = at * buckets // ranges, (at + 1) * buckets // ranges - 1
        some = rows if ranges == 1 else rows.where(F.col("bucket").between(low, high))
        parts.append(likely(some, keys if ranges == 1 else keys.where(own.between(low, high)), key))
    return reduce(DataFrame.unionByName, parts)
