"""CSV export (SK1-SK6) and hand-over forms (SK7)."""

from __future__ import annotations

import csv
import uuid

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resultlake.errors import ExportError
from resultlake.functions import post_date_text
from resultlake.plans.extraction import final_order
from resultlake.schema import ROWS, with_positions
from resultlake.session import stage, stage_path
from resultlake.sinks.files import (
    ensure_folder,
    exists,
    is_local,
    join_parts,
    qualified,
    remove,
    replace,
    replace_with_only_part,
)

# Header names and date renderings that differ from the tables'.
_RENDERED = {
    "smartblock": {},
    "cafe": {"date": post_date_text, "cafe_name": lambda c: c.alias("café")},
    "blog": {"date": lambda c: c.cast("string"), "blog_name": lambda c: c.alias("blog")},
}
_HEADERS = {"cafe_name": "café", "blog_name": "blog"}

_CSV = dict(
    header=True,
    sep=",",
    quote='"',
    escape='"',
    emptyValue="",
    nullValue="",
    lineSep="\n",
    ignoreLeadingWhiteSpace=False,
    ignoreTrailingWhiteSpace=False,
    encoding="UTF-8",
)


_WHOLE = "whole"


def csv_columns(kind: str) -> list:
    """A kind's file columns; the first header carries the byte order mark."""
    columns = []
    for i, name in enumerate(ROWS[kind].fieldNames()):
        render = _RENDERED[kind].get(name)
        column = render(F.col(f"`{name}`")) if render else F.col(f"`{name}`")
        header = _HEADERS.get(name, name)
        columns.append(column.alias("\ufeff" + header if i == 0 else header))
    return columns


def _drafted(table: DataFrame, kind: str, path: str, single_file: bool) -> str:
    """Write one kind beside ``path`` in final order; returns where."""
    spark, order, draft = table.sparkSession, final_order(table), f"{path}.{uuid.uuid4().hex}.draft"
    if single_file and is_local(spark, path):
        # The rows as parts in order, then all parts at their places of one file.
        head = spark.createDataFrame([], with_positions(kind)).repartition(1).select(*csv_columns(kind))
        rows = table.orderBy(*order).select(*csv_columns(kind))
        try:
            head.write.options(**_CSV).csv(f"{draft}/head")
            rows.write.options(**{**_CSV, "header": False}).csv(f"{draft}/rows")
            join_parts(spark, [f"{draft}/head", f"{draft}/rows"], f"{draft}/{_WHOLE}")
        except Exception:
            remove(spark, draft)
            raise
        return draft
    ordered = table.repartition(1).sortWithinPartitions(*order) if single_file else table.orderBy(*order)
    ordered.select(*csv_columns(kind)).write.options(**_CSV).csv(draft)
    return draft


def _put(spark: SparkSession, draft: str, path: str, single_file: bool) -> str:
    if single_file and exists(spark, f"{draft}/{_WHOLE}"):
        replace(spark, f"{draft}/{_WHOLE}", path)
    elif single_file:
        replace_with_only_part(spark, draft, path)
    else:
        replace(spark, draft, path)
    return qualified(spark, path)


def write_csv(table: DataFrame, kind: str, path: str, single_file: bool = False) -> str:
    """Write one kind to ``path`` in final order, replacing what is there once all of it
    is written: a folder of ordered part files, each with its header, or one file. On a
    folder that tasks can open its parts are written side by side; elsewhere one task
    writes the file."""
    spark = table.sparkSession
    draft = _drafted(table, kind, path, single_file)
    try:
        return _put(spark, draft, path, single_file)
    finally:
        remove(spark, draft)


def export(tables: dict[str, DataFrame], output_dir: str, single_file: bool = False) -> dict[str, str]:
    """Write the three result tables as ``<output_dir>/<kind>.csv``; a kind that is
    not given is written with its header only. Returns the path of each kind.

    All three are written beside their places before the first takes its own, so a
    writer that fails leaves the former result as it was."""
    spark = next((t.sparkSession for t in tables.values()), None) or SparkSession.active()
    for table in tables.values():
        final_order(table)
    drafts: dict[str, str] = {}
    paths = {kind: f"{output_dir.rstrip('/')}/{kind}.csv" for kind in ROWS}
    try:
        ensure_folder(spark, output_dir)
        try:
            for kind, path in paths.items():
                table = tables[kind] if kind in tables else spark.createDataFrame([], with_positions(kind))
                drafts[kind] = _drafted(table, kind, path, single_file)
            return {kind: _put(spark, drafts[kind], path, single_file) for kind, path in paths.items()}
        finally:
            for draft in drafts.values():
                remove(spark, draft)
    except (OSError, PySparkException, Py4JError) as error:
        raise ExportError(f"cannot write results to {output_dir}") from error


# How a reader of the files gets the table back.
_READ = dict(_CSV, multiLine=True)


def read_csv(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """An exported kind as its table again."""
    names = [_HEADERS.get(n, n) for n in ROWS[kind].fieldNames()]
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.schema(text).options(**_READ, enforceSchema=True).csv(path)
    fields = zip(names, ROWS[kind].fields)
    return raw.select(
        *(
            (
                F.regexp_replace(F.regexp_replace(f"`{header}`", r"\.$", ""), r"\.", "-")
                if field.name == "date"
                else F.coalesce(F.col(f"`{header}`"), F.lit(""))
            )
            .cast(field.dataType)
            .alias(field.name)
            for header, field in fields
        )
    )


def file_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of one exported file as text, with the ``line`` each has in it, from 1.

    The file is read in splits, though a quoted value may hold line breaks: a line begins
    a row if an even number of quotes is before it. Quotes and rows are added up by split,
    so no task sees more than one split and a few lines of the next.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    first = text.where("_metadata.file_block_start = 0").first()["value"].removeprefix("\ufeff")
    names = next(csv.reader([first]))

    block = F.struct("_metadata.file_path", "_metadata.file_block_start").alias("block")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = text.select(block, F.monotonically_increasing_id().alias("at"), "value", (quotes % 2).alias("odd"))

    def before(total: str):  # one row per split: small by construction
        return F.coalesce(F.sum(total).over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    odd = lines.groupBy("block").agg(F.sum("odd").alias("odds")).select("block", before("odds").alias("odds"))
    earlier = Window.partitionBy("block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    up_to = Window.partitionBy("block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    begins = (F.col("odds") + F.coalesce(F.sum("odd").over(earlier), F.lit(0))) % 2 == 0
    told = lines.join(F.broadcast(odd), "block").withColumn("begins", begins.cast("int"))
    placed = stage(told.select("block", "at", "value", F.sum("begins").over(up_to).alias("row")), "file-lines")

    rows = placed.groupBy("block").agg(F.max("row").alias("rows")).select("block", before("rows").alias("rows"))
    numbered = placed.join(F.broadcast(rows), "block").select((F.col("rows") + F.col("row")).alias("row"), "block", "at", "value")
    together = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    whole = numbered.where("row > 1").groupBy("row").agg(
        F.array_join(F.transform(together, lambda line: line["value"]), "\n").alias("text")
    )
    schema = ", ".join(f"`{name}` string" for name in names)
    read = F.from_csv("text", schema, dict(quote='"', escape='"', lineSep="\n"))
    return whole.select((F.col("row") - 1).alias("line"), read.alias("r")).select("line", "r.*")


def save_tables(tables: dict[str, DataFrame], path: str | None = None, spark: SparkSession | None = None) -> str:
    """Hand result tables over as Parquet; returns the folder."""
    spark = spark or next(iter(tables.values())).sparkSession
    path = path or stage_path(spark, "results")
    for kind, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{kind}")
    return path


def load_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Handed-over tables; a kind that was not saved is an empty table."""
    return {
        kind: spark.read.schema(with_positions(kind)).parquet(f"{path}/{kind}")
        if exists(spark, f"{path}/{kind}")
        else spark.createDataFrame([], with_positions(kind))
        for kind in ROWS
    }


def to_json_rows(table: DataFrame, kind: str) -> DataFrame:
    """One JSON object per row, with its kind; positions go along if there are any."""
    names = [n for n in with_positions(kind).fieldNames() if n in table.columns]
    return table.select(F.lit(kind).alias("kind"), F.to_json(F.struct(*(F.col(f"`{n}`") for n in names))).alias("row"))


def from_json_rows(rows: DataFrame, kind: str) -> DataFrame:
    """The rows of one kind from their JSON form, with the positions that give them
    their order; none if the kind is missing."""
    return (
        rows.where(F.col("kind") == kind)
        .select(F.from_json("row", with_positions(kind)).alias("r"))
        .select("r.*")
    )
