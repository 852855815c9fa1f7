"""Session settings and staged tables.

A staged table is written once and read back, so that what follows can scan it
several times, prune columns and push filters down, and survives lost executors
without running the page extraction again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from resultlake.sinks.files import is_local, remove

STAGE_SETTING = "spark.checkpoint.dir"

# Ceiling for anything broadcast on purpose, measured before it is broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings the jobs rely on; call it once per session. Batches of pages are
    bounded in bytes by Spark's own ``spark.sql.execution.arrow.maxBytesPerBatch``."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def stage_root(spark: SparkSession) -> str:
    """Folder shared by all executors: the one the cluster names, else the warehouse,
    which a session keeps its tables in anyway. A warehouse that is a folder of each
    machine is refused on a cluster, where parts staged in it would be lost."""
    named = spark.conf.get(STAGE_SETTING, None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    alone = (spark.conf.get("spark.master", None) or "local").startswith("local")
    if not alone and is_local(spark, warehouse):
        raise ValueError(f"set {STAGE_SETTING} to a folder all executors share; {warehouse} is local")
    return warehouse.rstrip("/")


def _stage_folder(spark: SparkSession) -> str:
    return f"{stage_root(spark)}/resultlake/{spark.conf.get('spark.app.id', 'app')}"


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{_stage_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_stage(spark: SparkSession) -> None:
    """Drop everything this application staged; tables that read it end with it."""
    remove(spark, _stage_folder(spark))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the stage folder and return a scan of it."""
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, name: str, *counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """``stage``, and what the aggregates ``counts`` come to, taken by the tasks that
    write: the counts cost no job and no second reading. A task that is run again is
    counted once, as its parts are."""
    seen = Observation()
    staged = stage(df.observe(seen, *counts), name)
    return staged, seen.get


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure a table of strings and numbers; True if it is small enough to send
    to every executor."""
    width = sum(
        (
            F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) + 16
            for f in df.schema.fields
        ),
        F.lit(0),
    )
    size = df.agg(F.sum(width).alias("bytes")).first()["bytes"]
    return (size or 0) <= limit
