"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import resultlake
from resultlake.session import fits_broadcast, stage

# Word of the corpus contracts: a run of anything but U+0020 and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
# Rows of whole texts handed to Python at a time, and bytes of them, whichever is less.
TEXTS_PER_BATCH, BATCH_BYTES = 2000, 16 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_batches(spark: SparkSession, most_bytes: int = BATCH_BYTES) -> None:
    """Bound what one Arrow batch of whole texts may hold, and see that the executors
    have what is to work on it."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXTS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most_bytes))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def col(name: str) -> Column:
    """A column by its plain name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def held_out(doc_id: Column) -> Column:
    """True for the third of the ids that nothing is learned from; false for no id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learnable(doc_id: Column) -> Column:
    """Rows a model may learn from; a row without an id is not among them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1, F.lit(False))


def numbered_rows(df: DataFrame, name: str, stage_name: str) -> DataFrame:
    """``df`` with a row number that stays the same from here on, since it is staged."""
    return stage(df.withColumn(name, F.monotonically_increasing_id()), stage_name)


def small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if its measured size allows; else Spark joins it as
    it sees fit. Stage what is costly to make: it is read for its size first."""
    return F.broadcast(df) if fits_broadcast(df) else df


def give_back() -> None:
    """Return what this worker has freed to its machine, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def frugal(function):
    """``function`` over a partition's batches, giving freed memory back after each one:
    a worker outlives its task, and what it keeps is missing in the stages after."""

    def run(batches):
        try:
            for made in function(batches):
                yield made
                del made
                give_back()
        finally:
            give_back()

    return run


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that it need not be
    installed there."""
    context = spark.sparkContext
    package = Path(resultlake.__file__).parent
    if context.applicationId in _SHIPPED or not package.is_dir():
        return
    _SHIPPED.add(context.applicationId)
    base = os.path.join(tempfile.mkdtemp(prefix="resultlake-"), "resultlake")
    context.addPyFile(shutil.make_archive(base, "zip", package.parent, package.name))
