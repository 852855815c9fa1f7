"""Lookup joins and key filters."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from resultlake.operators.lookup import likely, lookup_join


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "warm").otherwise(F.col("id").cast("string")).alias("k"),
        "id",
    )
    right = spark.range(0, 3000, 5).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    return left, right.unionByName(spark.createDataFrame([("hot", -1)], "k string, v long"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup(sides, how):
    left, right = sides
    found = lookup_join(left, right, ["k"], how)
    assert Counter(found.collect()) == Counter(left.join(right, "k", how).collect())


@pytest.mark.parametrize("words", [1, 16, 1 << 18])
def test_key_filter_loses_nothing(spark, sides, words):
    left, right = sides
    kept = likely(left, right, "k", words)
    wanted = {r.k for r in right.collect()}
    rows = kept.collect()
    assert kept.columns == left.columns
    assert Counter(r for r in rows if r.k in wanted) == Counter(r for r in left.collect() if r.k in wanted)
    if words == 1 << 18:
        assert all(r.k in wanted for r in rows)
    assert likely(left, right.limit(0), "k", words).isEmpty()
    assert likely(left, spark.createDataFrame([(None,)], "k string"), "k", words).isEmpty()


def test_filters_by_bucket_prune_for_any_number_of_keys(spark, monkeypatch):
    """Ten times as many keys as one filter has room for: few others pass, none is lost."""
    from resultlake.operators import lookup

    keys = spark.range(30_000).select(F.concat(F.lit("k"), "id").alias("k"))
    rows = spark.range(60_000).select(F.concat(F.lit("k"), "id").alias("k"), "id")
    rows = rows.withColumn("bucket", lookup.bucket_of(F.col("k"), 64))
    one = likely(rows, keys, "k", words=600)
    kept = lookup.likely_in_buckets(rows, keys, "k", 64, words=600)
    passed = {r.id for r in kept.collect()}
    assert passed >= set(range(30_000)) and len(passed) - 30_000 < 0.02 * 30_000
    assert one.count() - 30_000 > 0.5 * 30_000


def test_a_filter_is_sized_by_its_keys(spark):
    from resultlake.operators import lookup

    assert lookup.words_for(10**8) * 64 >= 10**9
    rows = spark.range(200_000).select(F.col("id").cast("string").alias("k"), "id")
    keys = spark.range(0, 200_000, 40).select(F.col("id").cast("string").alias("k"))
    passed = {r.id for r in likely(rows, keys, "k").collect()}
    assert passed >= set(range(0, 200_000, 40)) and len(passed) - 5000 < 0.02 * 195_000
