"""Connected components of a link table, by alternating star contraction.

Every round is two grouped minima and two joins; groups are summed up before they
are shuffled, and AQE splits what a vertex with many links makes of a join. Rounds
are staged, so a lost executor costs a round at most, and their number grows with the
logarithm of the graph's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resultlake.session import stage


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
    ).first()
    return row["n"], row["s"]


def components(links: DataFrame, stage_name: str = "components") -> DataFrame:
    """``links (a, b)`` to ``(id, component_id)`` for every id in a link with another;
    the component's id is its smallest member. Repeated, reversed and self links do
    no harm; an empty table gives an empty one."""
    a, b = F.col("a"), F.col("b")
    edges = stage(
        links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(),
        stage_name,
    )
    seen = _signature(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(b > a).select(b.alias("a"), F.col("m").alias("b"))
        large = stage(large.where(a != b).distinct(), stage_name)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .where(b != F.col("m"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b")))
        )
        edges = stage(small.distinct(), stage_name)
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component_id"))
    return edges.select(a.alias("id"), b.alias("component_id")).unionByName(roots)
