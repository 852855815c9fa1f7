"""CSV files byte for byte, hand-over forms, summary and counts."""

import csv
import datetime
import io
import os

import pytest
from pyspark.sql import functions as F

import resultlake as rl
from resultlake.schema import ROWS, with_positions
from resultlake.sinks.csv import file_rows

D = datetime.date
WILD = ['plain', 'a,b', 'say "hi"', 'two\nlines', ' edges ', '', '가나다', "it's", '#x', 'a\\b', 'tab\there', 'cr\rx', '"', ',']


def dated(kind):
    return [(1 + i % 2, 10 - i, f"k{i}", i + 1, D(2025, 1, i + 1), text, text[::-1], f"https://x/{i}") for i, text in enumerate(WILD)]


@pytest.fixture
def tables(spark):
    rows = {
        "smartblock": [(1, i, f"k{i}", i + 1, text, f"u{text}") for i, text in enumerate(WILD)],
        "cafe": dated("cafe"),
        "blog": dated("blog"),
    }
    return {kind: spark.createDataFrame(rows[kind], with_positions(kind)).repartition(3) for kind in ROWS}


def expected_csv(kind, table):
    header = {"cafe_name": "café", "blog_name": "blog"}
    names = ROWS[kind].fieldNames()
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow([header.get(n, n) for n in names])
    for row in sorted(table.collect(), key=lambda r: (r.platform_pos, r.kw_pos, r.order)):
        values = [row[n] for n in names]
        if kind == "cafe":
            values[names.index("date")] = row.date.strftime("%Y.%m.%d.")
        writer.writerow(values)
    return out.getvalue().encode("utf-8-sig")


def test_files_are_what_pythons_writer_writes(spark, tables, tmp_path):
    files = rl.export(tables, str(tmp_path / "new" / "out"), single_file=True)
    assert files == {kind: str(tmp_path / "new" / "out" / f"{kind}.csv") for kind in ROWS}
    for kind, path in files.items():
        with open(path, "rb") as file:
            assert file.read() == expected_csv(kind, tables[kind])


def test_export_replaces_and_writes_headers_for_missing_kinds(spark, tables, tmp_path):
    out = str(tmp_path)
    rl.export(tables, out)
    files = rl.export({"cafe": tables["cafe"].limit(0)}, out, single_file=True)
    assert {kind: open(path, "rb").read().decode("utf-8-sig") for kind, path in files.items()} == {
        "smartblock": "keyword,order,title,url\n",
        "cafe": "keyword,order,date,café,subject,url\n",
        "blog": "keyword,order,date,blog,subject,url\n",
    }
    assert sorted(n for n in os.listdir(out) if not n.startswith(".")) == ["blog.csv", "cafe.csv", "smartblock.csv"]


def test_parts_in_order_hold_what_one_file_does(spark, tables, tmp_path):
    small = rl.export(tables, str(tmp_path / "one"), single_file=True)
    large = rl.export(tables, str(tmp_path / "many"))
    for kind in ROWS:
        parts = sorted(n for n in os.listdir(large[kind]) if n.startswith("part-"))
        texts = [open(os.path.join(large[kind], n), "rb").read().decode("utf-8-sig") for n in parts]
        header = texts[0].split("\n", 1)[0] + "\n"
        joined = header + "".join(t.removeprefix(header) for t in texts)
        assert joined == open(small[kind], "rb").read().decode("utf-8-sig")
    again = rl.export(tables, str(tmp_path / "many"), single_file=True)
    assert os.path.isfile(again["blog"])


def test_export_failure(spark, tables, tmp_path):
    (tmp_path / "file").write_text("x")
    with pytest.raises(rl.ExportError):
        rl.export(tables, str(tmp_path / "file"))


def plain(table, kind):
    return sorted(map(tuple, table.select(*ROWS[kind].fieldNames()).collect()), key=str)


def test_read_back(spark, tables, tmp_path):
    files = rl.export(tables, str(tmp_path))
    for kind, path in files.items():
        assert plain(rl.read_csv(spark, kind, path), kind) == plain(tables[kind], kind)


def test_handover(spark, tables, tmp_path):
    path = rl.save_tables({"blog": tables["blog"]}, str(tmp_path / "stage"))
    loaded = rl.load_tables(spark, path)
    assert plain(loaded["blog"], "blog") == plain(tables["blog"], "blog")
    assert loaded["cafe"].columns == tables["cafe"].columns and loaded["cafe"].isEmpty()


def test_json_form(spark, tables):
    rows = rl.to_json_rows(tables["blog"], "blog").unionByName(rl.to_json_rows(tables["smartblock"], "smartblock"))
    for kind in ("blog", "smartblock"):
        back = rl.from_json_rows(rows, kind)
        assert plain(back, kind) == plain(tables[kind], kind)
        assert rl.public_table(back, kind).collect() == rl.public_table(tables[kind], kind).collect()
    assert rl.from_json_rows(rows, "cafe").isEmpty()


def test_public_table_is_ordered(spark, tables):
    found = rl.public_table(tables["blog"], "blog").collect()
    assert list(found[0].asDict()) == ROWS["blog"].fieldNames()
    want = sorted(tables["blog"].collect(), key=lambda r: (r.platform_pos, r.kw_pos, r.order))
    assert [r.url for r in found] == [r.url for r in want]


def test_no_positions_no_final_order(spark, tables, tmp_path):
    bare = tables["blog"].drop("kw_pos")
    for sort in (lambda: rl.public_table(bare, "blog"), lambda: rl.export({"blog": bare}, str(tmp_path / "none"))):
        with pytest.raises(ValueError, match="kw_pos"):
            sort()
    assert not (tmp_path / "none").exists()


def test_platform_counts(spark, tables):
    found = rl.platform_counts({k: tables[k] for k in ("cafe", "blog")}, ["a", "b", "a"]).collect()
    n = {1: (len(WILD) + 1) // 2, 2: len(WILD) // 2, 3: 0}
    assert sorted(map(tuple, found)) == sorted((p, "aba"[p - 1], s, n[p]) for p in n for s in ("cafe", "blog"))


def test_union_keeps_everything(spark, tables):
    both = rl.union_tables(tables, {"blog": tables["blog"]}, {})
    assert both["blog"].count() == 2 * len(WILD) and both["cafe"].count() == len(WILD)
    assert set(rl.union_tables({"cafe": tables["cafe"]})) == {"cafe"}


def test_counts_and_summary(spark, tables):
    tables = {**tables, "cafe": tables["cafe"].limit(0)}
    n = len(WILD)
    counts = {r.surface: r.row_count for r in rl.surface_counts(tables).collect()}
    assert counts == {"smartblock": n, "cafe": 0, "blog": n, "all": 2 * n}
    keywords = spark.range(7)
    summary = rl.run_summary(keywords, tables, "out", {"blog": "out/blog.csv"}).first().asDict()
    assert summary == {
        "keyword_count": 7, "smartblock_count": n, "cafe_count": 0, "blog_count": n,
        "output_dir": "out", "output_files": {"blog": "out/blog.csv"},
    }
    assert rl.run_summary(keywords, tables).first().output_files is None


def test_a_failed_export_leaves_the_former_result(spark, tables, tmp_path):
    out = str(tmp_path)
    for single in (True, False):
        files = rl.export(tables, out, single_file=single)
        before = {kind: sorted(map(tuple, read.collect()), key=str) for kind, path in files.items() for read in [rl.read_csv(spark, kind, path)]}
        bad = tables["blog"].withColumn("subject", F.raise_error(F.lit("lost")))
        with pytest.raises(rl.ExportError):
            rl.export({**tables, "blog": bad}, out, single_file=single)
        after = {kind: sorted(map(tuple, rl.read_csv(spark, kind, path).collect()), key=str) for kind, path in files.items()}
        assert after == before
        assert sorted(n for n in os.listdir(out) if not n.startswith(".")) == ["blog.csv", "cafe.csv", "smartblock.csv"]


def test_one_file_is_written_and_read_by_many_tasks(spark, tables, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    many = {kind: table.withColumn("kw_pos", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(40).cast("long")))) for kind, table in tables.items()}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
        files = rl.export(many, str(tmp_path), single_file=True)
        for kind in ("cafe", "blog"):
            text = open(files[kind], encoding="utf-8-sig", newline="").read()
            names, *want = csv.reader(io.StringIO(text, newline=""))
            found = file_rows(spark, files[kind])
            assert spark.read.text(files[kind]).rdd.getNumPartitions() > 10
            got = sorted(map(tuple, found.collect()))
            assert found.columns == ["line", *names] and len(want) == 40 * len(WILD)
            assert [r[0] for r in got] == list(range(1, len(want) + 1))
            assert [["" if v is None else v for v in r[1:]] for r in got] == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
