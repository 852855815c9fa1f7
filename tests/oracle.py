"""Run a driver query and its DuckDB counterpart and compare columns, types, rows."""

import datetime
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DATE": "date", "HUGEINT": "hugeint",
    "DOUBLE": "double", "TIMESTAMP": "timestamp", "BOOLEAN": "boolean",
}


def connect(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return db


def plain(value):
    return value.isoformat() if isinstance(value, datetime.date) else value


def compare(found, db, sql):
    """Differences between a DataFrame and a query, as text; empty if they agree."""
    expected = db.sql(sql)
    wanted = {n: KINDS.get(str(t), str(t)) for n, t in zip(expected.columns, expected.types)}
    have = dict(found.dtypes)
    if have != wanted:
        return f"columns {have} instead of {wanted}"
    names = sorted(have)
    at = [expected.columns.index(n) for n in names]
    rows = Counter(tuple(plain(r[n]) for n in names) for r in found.collect())
    goal = Counter(tuple(plain(r[i]) for i in at) for r in expected.fetchall())
    if rows == goal:
        return "" if sum(goal.values()) else "no rows on either side"
    extra, lost = rows - goal, goal - rows
    return f"{sum(rows.values())} rows, {sum(goal.values())} wanted; extra {list(extra)[:3]}; lost {list(lost)[:3]}"


def main(sf_dir, *only):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    for name, run in entry.queries().items():
        if (only and name not in only) or name not in entry.oracle_sql():
            continue
        start = time.time()
        try:
            problem = compare(run(spark, sf_dir), db, entry.oracle_sql()[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:26s} {time.time() - start:6.2f}s {'ok' if not problem else problem}", flush=True)


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    main(*sys.argv[1:])
