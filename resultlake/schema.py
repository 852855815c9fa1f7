"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_text, _int, _date, _long = T.StringType(), T.IntegerType(), T.DateType(), T.LongType()

KEYWORDS = _table(kw_pos=_long, keyword=_text)
CAPTURES = _table(platform=_text, surface=_text, keyword=_text, page_url=_text, html=_text)
ARTICLES = _table(url=_text, html=_text)

# The three result tables, in export order.
ROWS = {
    "smartblock": _table(keyword=_text, order=_int, title=_text, url=_text),
    "cafe": _table(
        keyword=_text, order=_int, date=_date, cafe_name=_text, subject=_text, url=_text
    ),
    "blog": _table(
        keyword=_text, order=_int, date=_date, blog_name=_text, subject=_text, url=_text
    ),
}

# Positions carried until the final sort.
POSITIONS = ["platform_pos", "kw_pos"]

RUN_SUMMARY = _table(
    keyword_count=_long,
    smartblock_count=_long,
    cafe_count=_long,
    blog_count=_long,
    output_dir=_text,
    output_files=T.MapType(_text, _text),
)


def empty_table(spark, kind: str):
    return spark.createDataFrame([], ROWS[kind])


def with_positions(kind: str) -> T.StructType:
    positions = [T.StructField(p, _long if p == "kw_pos" else _int) for p in POSITIONS]
    return T.StructType([*positions, *ROWS[kind].fields])
