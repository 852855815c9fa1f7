"""Line dedup by ranges of line hashes (operator 11).

A line's key is the line in lower case (A-Z) without white space at its ends; an empty
key repeats nothing. Lines travel as 128-bit hashes of their keys with document and
position, never as text: they are range-partitioned by hash, sorted within a hash by
document and position, and streamed once, which gives every hash its first occurrence
and the number of documents it is found in. What repeats too often is marked, and a
document's marks are its keep bitmap, compressed to runs of kept lines. The text is
read again only to apply bitmaps.

A hash that holds a large part of all lines would be one long range. So the range key
is the hash and a slice of the documents: there are a few times as many slices as the
input has splits, hence a slice of one hash is no more than a split could hold,
however often the line occurs. Slices are streamed each on their own and their counts,
a row per hash and slice, are summed partially before they are shuffled.

A document is its id and its text. Rows that repeat both are one document, counted
once, and each such row gets the result; rows that share an id but not a text are two.
A null text is an empty one, which is one empty line. Rows without an id are told apart
by their text. Texts of any length are taken whole: everything is linear in a text's
lines but for the sort. Extra columns, whatever their names, are passed through by
``apply_bitmaps`` and ignored otherwise; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resultlake.llm.common import col, fresh, small
from resultlake.session import stage

#: A line in this many documents repeats too often.
MIN_DOCUMENTS = 10
# Slices of a hash for every split of the input.
SLICES_PER_SPLIT = 4
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_lines(text: Column) -> Column:
    """The lines of a text; an empty or null one has one empty line."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def line_keys(text: Column) -> Column:
    """The keys of a text's lines, in order."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    # Where all characters are ASCII, Spark's lower() changes A-Z and nothing else.
    plain = F.octet_length(whole) == F.length(whole)
    low = F.when(plain, F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))
    return F.transform(F.split(low, "\n", -1), lambda line: F.btrim(line, F.lit(SPACE)))


def _hash(value: Column, half: int) -> Column:
    return F.xxhash64(F.lit(half), value)


def _identity(docs: DataFrame, id_column: str, text_column: str) -> tuple[Column, Column]:
    text = F.coalesce(col(text_column).cast("string"), F.lit(""))
    return col(id_column).cast("long").alias("doc"), F.xxhash64(text).alias("version")


def _occurrences(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """A row per line with a key: hash, document, position, and the slice it falls in."""
    splits = docs.select(F.spark_partition_id().alias("split")).agg(F.max("split").alias("last")).first()["last"]
    slices = SLICES_PER_SPLIT * (1 + (splits or 0))
    rows = docs.select(
        *_identity(docs, id_column, text_column), F.posexplode(line_keys(col(text_column))).alias("pos", "key")
    )
    return rows.where("key <> ''").select(
        _hash(F.col("key"), 1).alias("h1"),
        _hash(F.col("key"), 2).alias("h2"),
        F.pmod(F.xxhash64("doc", "version"), F.lit(slices)).cast("int").alias("slice"),
        "doc",
        "version",
        "pos",
    )


def _streamed(lines: DataFrame) -> DataFrame:
    """Lines in ranges of hash and slice, in order of document and position, with what
    a single pass over that order tells: ``number`` of the occurrence in its slice (0
    for one more copy of the same line of the same document), ``documents`` met so far,
    and whether the slice ends here."""
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = lines.repartitionByRange(parts, "h1", "h2", "slice")
    order = Window.partitionBy("h1", "h2", "slice").orderBy("doc", "version", "pos")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = F.lag("pos").over(order).isNotNull() & F.lag("doc").over(order).eqNullSafe(F.col("doc"))
    same = same & (F.lag("version").over(order) == F.col("version"))
    opens = ranged.withColumn("opens", F.when(same, 0).otherwise(1)).withColumn(
        "number", F.row_number().over(order)
    )
    return opens.withColumn("documents", F.sum("opens").over(so_far)).withColumn(
        "ends", F.lead("pos").over(order).isNull()
    )


def repeated_lines(lines: DataFrame, min_documents: int, firsts: bool) -> DataFrame:
    """Streamed lines to ``h1, h2, slice, first``: the slices of every hash found in so
    many documents, and if asked for its first occurrence as ``(doc, version, pos)``."""
    slices = lines.where("ends").select("h1", "h2", "slice", "documents")
    often = slices.groupBy("h1", "h2").agg(F.sum("documents").alias("documents"))
    often = small(stage(often.where(F.col("documents") >= min_documents).select("h1", "h2"), "repeated-hashes"))
    found = slices.drop("documents").join(often, ["h1", "h2"])
    if not firsts:
        return found.withColumn("first", F.lit(None).cast("int"))
    here = F.struct("doc", "version", "pos")
    first = lines.where("number = 1").join(often, ["h1", "h2"]).groupBy("h1", "h2").agg(F.min(here).alias("first"))
    return found.join(small(stage(first, "first-occurrences")), ["h1", "h2"])


def keep_bitmaps(
    docs: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    keep_first: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` to ``doc, version, dropped, kept``: per document that loses lines their
    number and its keep bitmap, as runs ``(start, length)`` of the lines that stay.
    Documents that keep everything have no row. With ``keep_first`` the first
    occurrence of a line in the corpus, by id, version and position, stays."""
    spark = docs.sparkSession
    lines = stage(_streamed(_occurrences(docs, id_column, text_column)), "line-hashes")
    often = small(stage(repeated_lines(lines, min_documents, keep_first), "repeated-lines"))
    marked = lines.select("h1", "h2", "slice", "doc", "version", "pos").join(often, ["h1", "h2", "slice"])
    if keep_first:
        here = F.struct("doc", "version", "pos")
        marked = marked.where(~here.eqNullSafe(F.col("first")))

    # Neighbouring marks are one run; a gap before a run, and one after the last, is kept.
    order = Window.partitionBy("doc", "version").orderBy("pos")
    run = marked.withColumn("run", F.col("pos") - F.dense_rank().over(order))
    runs = run.groupBy("doc", "version", "run").agg(
        F.min("pos").alias("start"), (F.max("pos") + 1).alias("end")
    )
    cut = runs.groupBy("doc", "version").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cut"),
        F.sum(F.col("end") - F.col("start")).alias("dropped"),
    )
    past = F.array(F.struct(F.lit(-1).alias("start"), F.lit(0).alias("end")))
    edges = F.concat(past, F.col("cut"), F.array(F.struct(F.lit(END).alias("start"), F.lit(END).alias("end"))))
    cut = cut.select("doc", "version", "dropped", edges.alias("edges"))
    gaps = F.transform(
        F.slice("edges", 2, F.size("edges") - 1),
        lambda edge, i: F.struct(
            F.get("edges", i)["end"].alias("start"), (edge["start"] - F.get("edges", i)["end"]).alias("length")
        ),
    )
    kept = F.filter(gaps, lambda gap: gap["length"] > 0).alias("kept")
    return cut.select("doc", "version", "dropped", kept)


#: Past the last line of any text; a run that ends there has no end of its own.
END = 2**31 - 1


def apply_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, name: str = "lines", id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` and a column ``name`` of ``(n_lines, n_dropped, text)``: the text's lines
    that its bitmap keeps, joined by newlines."""
    doc, version, seen = (fresh(docs, n) for n in ("line_doc", "line_version", "line_cut"))
    own = _identity(docs, id_column, text_column)
    cut = bitmaps.select(
        F.col("doc").alias(doc), F.col("version").alias(version), F.struct("dropped", "kept").alias(seen)
    )
    rows = docs.withColumn(f"{doc}_own", own[0]).withColumn(f"{version}_own", own[1])
    alike = F.col(f"{doc}_own").eqNullSafe(F.col(doc)) & (F.col(f"{version}_own") == F.col(version))
    joined = rows.join(small(cut), alike, "left")
    runs, whole = F.col(f"{seen}.kept"), F.coalesce(col(text_column).cast("string"), F.lit(""))
    dropped = F.coalesce(F.col(f"{seen}.dropped"), F.lit(0)).cast("long")

    def kept(lines: Column) -> Column:
        stay = F.transform(runs, lambda run: F.slice(lines, run["start"] + 1, run["length"]))
        text = F.when(runs.isNull(), whole).otherwise(F.array_join(F.flatten(stay), "\n"))
        return F.struct(F.size(lines).cast("long").alias("n_lines"), dropped.alias("n_dropped"), text.alias("text"))

    # The text is split once, outside the runs.
    result = F.transform(F.array(text_lines(col(text_column))), kept)[0]
    return joined.select(*(col(c) for c in docs.columns), result.alias(name))


def drop_repeated_lines(docs: DataFrame, name: str = "lines", **options) -> DataFrame:
    """``docs`` and what stays of their texts, see ``apply_bitmaps``."""
    bitmaps = stage(keep_bitmaps(docs, **options), "keep-bitmaps")
    columns = {k: v for k, v in options.items() if k in ("id_column", "text_column")}
    return apply_bitmaps(docs, bitmaps, name, **columns)
