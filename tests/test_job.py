"""Whole runs: from files to files, once and as captures arrive."""

import datetime

import pytest
from pyspark.sql import functions as F
from test_surfaces import HEADLINE, block, blog_card, blog_frame, blog_page, cafe_card, footer

import resultlake as rl
from resultlake.operators import lookup
from resultlake.plans import extraction
from resultlake.schema import ARTICLES, CAPTURES
from resultlake.sources.registry import BLOG, SURFACES
from resultlake.streaming import incremental
from resultlake.streaming.incremental import read_increments, run_increment


def captures_of(spark, *rows):
    return spark.createDataFrame([(p, s, k, "https://search.naver.com/search.naver", h) for p, s, k, h in rows], CAPTURES)


def cafe_page(*cards):
    return "<div id='main_pack'><ul>" + "".join(cards) + "</ul></div>"


PAGES = [
    ("naver", "blog", "가", blog_page(blog_card(), blog_card(date="어제", post="<a href='/a'>a</a>"))),
    ("naver", "blog", "나", blog_page(blog_card(date=None))),
    ("naver", "cafe", "가", cafe_page(cafe_card(), cafe_card(date="2025-02-03"))),
    ("naver", "smartblock", "가", "<div id='main_pack'>" + block(HEADLINE, footer()) + "</div>"),
    ("naver", "smartblock", "다", "<div id='main_pack'>" + block(HEADLINE) + "</div>"),
    ("other", "blog", "가", blog_page(blog_card(name="Other"))),
]
ARTICLE_ROWS = [
    ("https://search.naver.com/a", "<iframe id='mainFrame' src='/i'></iframe>"),
    ("https://blog.naver.com/i", blog_frame("2020.1.1")),
    ("https://blog.naver.com/i", blog_frame("2020.1.1")),
]


@pytest.fixture
def files(spark, tmp_path):
    (tmp_path / "keywords.txt").write_text(" 가\n\n나\r\n가 \n라", encoding="utf-8")
    captures_of(spark, *PAGES).write.partitionBy("platform", "surface").parquet(str(tmp_path / "captures"))
    spark.createDataFrame(ARTICLE_ROWS, ARTICLES).write.parquet(str(tmp_path / "articles"))
    return tmp_path


def lines(path):
    return open(path, encoding="utf-8-sig").read().splitlines()


def test_run_job(spark, files):
    run = rl.run_job(
        spark, "keywords.txt", str(files / "captures"), str(files / "articles"),
        output_dir=str(files / "out"), base_dir=str(files), single_file=True,
    )
    assert lines(run.output_files["smartblock"])[1:] == ["가,1,One,https://search.naver.com/more"] * 2
    assert lines(run.output_files["cafe"])[1:] == [
        "가,1,2025.01.02.,Club,Post,https://search.naver.com/p",
        "가,2,2025.02.03.,Club,Post,https://search.naver.com/p",
    ] * 2
    assert lines(run.output_files["blog"])[1:] == [
        "가,1,2025-01-02,Name,Post,https://search.naver.com/p",
        "가,2,2020-01-01,Name,a,https://search.naver.com/a",
    ] * 2
    summary = run.summary.first()
    assert (summary.keyword_count, summary.smartblock_count, summary.cafe_count, summary.blog_count) == (4, 2, 4, 4)
    assert summary.output_files == run.output_files and summary.output_dir == str(files / "out")


def test_counts_of_a_run_are_taken_while_it_is_staged(spark, files):
    known = rl.Platforms()
    known.register("naver", SURFACES)
    known.register("other", {"blog": BLOG})
    run = rl.run_job(
        spark, str(files / "keywords.txt"), str(files / "captures"), str(files / "articles"),
        platforms=["other", "naver", "naver"], output_dir=str(files / "out"), known=known,
    )
    names = ["other", "naver", "naver"]
    # What was seen in passing is what the tables hold.
    order = ["platform_pos", "surface"]
    found = run.platform_counts.orderBy(*order).collect()
    assert found == rl.platform_counts(run.tables, names).orderBy(*order).collect() and len(found) == 9
    keywords = rl.read_keywords(spark, str(files / "keywords.txt"))
    assert run.summary.collect() == rl.run_summary(keywords, run.tables, str(files / "out"), run.output_files).collect()
    assert {t: run.tables[t].count() for t in run.tables} == {t: run.summary.first()[f"{t}_count"] for t in run.tables}
    for counted in (run.summary, run.platform_counts):
        assert "FileScan" not in counted._jdf.queryExecution().toString()


def test_counts_of_a_run_without_rows(spark, files):
    (files / "none.txt").write_text("nothing of this was captured\n", encoding="utf-8")
    run = rl.run_job(spark, str(files / "none.txt"), str(files / "captures"), output_dir=str(files / "out"))
    assert run.summary.select("keyword_count", "smartblock_count", "cafe_count", "blog_count").first() == (1, 0, 0, 0)
    assert [r.row_count for r in run.platform_counts.collect()] == [0, 0, 0]
    known = rl.Platforms()
    known.register("other", {"blog": BLOG})
    run = rl.run_job(spark, str(files / "none.txt"), str(files / "captures"), output_dir=str(files / "out"), known=known)
    assert [r.row_count for r in run.platform_counts.collect()] == [0, 0, 0]


def test_run_job_without_articles_and_with_default_folder(spark, files):
    with pytest.raises(rl.ExportError):
        rl.run_job(spark, str(files / "keywords.txt"), str(files / "captures"))
    spark.conf.set("spark.resultlake.output.dir", str(files / "default"))
    try:
        run = rl.run_job(spark, str(files / "keywords.txt"), str(files / "captures"), single_file=True)
    finally:
        spark.conf.unset("spark.resultlake.output.dir")
    assert len(lines(str(files / "default" / "blog.csv"))) == 3 == run.summary.first().blog_count + 1


def test_run_job_refuses_bad_arguments(spark, files):
    where = dict(captures_path=str(files / "captures"), output_dir=str(files / "o"))
    with pytest.raises(ValueError, match="nowhere"):
        rl.run_job(spark, str(files / "keywords.txt"), platforms=["nowhere"], **where)
    with pytest.raises(FileNotFoundError):
        rl.run_job(spark, str(files / "none.txt"), **where)
    with pytest.raises(ValueError, match="on_bad_card"):
        rl.run_job(spark, str(files / "keywords.txt"), on_bad_card="never", **where)
    with pytest.raises(rl.CollectionError):
        rl.run_job(spark, str(files / "keywords.txt"), str(files / "none"), output_dir=str(files / "o"))
    assert not (files / "o").exists()


def two_platforms():
    known = rl.Platforms()
    known.register("naver", SURFACES)
    known.register("other", {"blog": BLOG})
    return known


def table_rows(table):
    return sorted(map(tuple, table.collect()))


def test_platforms_repeat_and_keep_their_order(spark):
    keywords = spark.createDataFrame([(1, "가"), (2, "나"), (3, "가")], "kw_pos int, keyword string")
    tables = rl.extract_tables(
        keywords, captures_of(spark, *PAGES), platforms=["other", "naver", "other"], known=two_platforms()
    )
    found = table_rows(tables["blog"].select("platform_pos", "kw_pos", "order", "blog_name"))
    assert found == [(p, k, 1, "Other" if p != 2 else "Name") for p in (1, 2, 3) for k in (1, 3)]
    assert {r.platform_pos for r in tables["cafe"].collect()} == {2}
    only = rl.extract_tables(keywords, captures_of(spark, *PAGES), platforms=["other"], known=two_platforms())
    assert only["cafe"].isEmpty() and only["cafe"].columns == tables["cafe"].columns


def test_a_key_filter_of_one_word_gives_the_same_rows(spark, monkeypatch):
    keywords = spark.range(60).select(
        F.col("id").alias("kw_pos"), F.element_at(F.lit(["가", "나", "다"]), (F.col("id") % 3 + 1).cast("int")).alias("keyword")
    )
    captures, articles = captures_of(spark, *PAGES), spark.createDataFrame(ARTICLE_ROWS, ARTICLES)
    usual = rl.extract_tables(keywords, captures, articles)
    monkeypatch.setattr(lookup.likely, "__defaults__", (1,))
    other = rl.extract_tables(keywords, captures, articles)
    for kind in usual:
        assert table_rows(usual[kind]) == table_rows(other[kind]) != []


def test_rejected_and_missing(spark, files):
    run = rl.run_job(
        spark, str(files / "keywords.txt"), str(files / "captures"), str(files / "articles"), output_dir=str(files / "o"), sort_order="date"
    )
    assert [(r.surface, r.keyword, r.reason) for r in run.rejected.collect()] == [("blog", "나", "broken card after rows: 0")]
    assert sorted({(r.keyword, r.surface) for r in run.missing.collect()}) == [
        ("나", "cafe"), ("나", "smartblock"), ("라", "blog"), ("라", "cafe"), ("라", "smartblock")
    ]
    assert all(r.search_url.endswith("st=date") for r in run.requests.where("surface = 'blog'").collect())


def test_repeated_captures_and_articles(spark):
    """A failed capture hides no good one, whichever comes first."""
    keywords = spark.createDataFrame([(1, "가")], "kw_pos int, keyword string")
    undated = blog_page(blog_card(date="어제", post="<a href='/a'>a</a>"))
    for pages in ([undated, None, "<p>"], [None, "<p>", undated]):
        for rows in (ARTICLE_ROWS, ARTICLE_ROWS[::-1]):
            broken = [(rows[0][0], None), (rows[0][0], "<p>"), *rows, ("https://blog.naver.com/i", None), ("https://blog.naver.com/i", "<p>")]
            captures = captures_of(spark, *(("naver", "blog", "가", p) for p in pages))
            found = rl.extract_tables(keywords, captures, spark.createDataFrame(broken, ARTICLES))["blog"].collect()
            assert [(r.order, r.date) for r in found] == [(1, datetime.date(2020, 1, 1))]


def test_only_asked_articles_are_read(spark):
    """The key filter sits below the reader of article pages."""
    from resultlake.operators import articles as A

    table = spark.createDataFrame(ARTICLE_ROWS, ARTICLES)
    asked = spark.createDataFrame([("https://search.naver.com/a",)], "url string")
    plan = A._facts(lookup.likely(table, asked, "url"))._jdf.queryExecution().executedPlan().toString()
    reader, rest = plan.split("MapInArrow", 1)
    assert "BroadcastHashJoin" in rest and "BroadcastHashJoin" not in reader and "SortMergeJoin" not in plan
    kept = lookup.likely(spark.range(5000).selectExpr("cast(id as string) url", "id"), spark.range(7).selectExpr("cast(id as string) url"), "url")
    assert {r.id for r in kept.collect()} >= set(range(7)) and kept.count() < 20


def test_a_platform_of_ones_own(spark):
    """A new kind of page is a reader of raw cards, a rule, and a registration."""
    from dataclasses import replace

    from resultlake.operators import cards, rules

    forum = replace(BLOG, read=cards.read_cafe_cards, card=cards.CAFE_CARD, rule=rules.cafe_cards)
    known = rl.Platforms()
    known.register("forum", {"blog": forum})
    keywords = spark.createDataFrame([(1, "가")], "kw_pos int, keyword string")
    pages = captures_of(spark, ("forum", "blog", "가", cafe_page(cafe_card())))
    assert rl.extract_tables(keywords, pages, known=known)["blog"].first().blog_name == "Club"


# -- increments ----------------------------------------------------------------
def test_increments(spark, tmp_path):
    landing, out, progress = (str(tmp_path / n) for n in ("landing", "out", "progress"))
    spark.createDataFrame(ARTICLE_ROWS, ARTICLES).write.parquet(str(tmp_path / "articles"))

    def land(*rows):
        captures_of(spark, *rows).coalesce(1).write.mode("append").parquet(landing)
        run_increment(spark, landing, out, progress, str(tmp_path / "articles"))
        return {k: table_rows(read_increments(spark, out, k).select("keyword", "order", "url")) for k in rl.SURFACES}

    first = land(*PAGES[:2])
    assert first["blog"] == [("가", 1, "https://search.naver.com/p"), ("가", 2, "https://search.naver.com/a")]
    assert first["cafe"] == []
    second = land(*PAGES[2:5])
    assert second["blog"] == first["blog"] and len(second["cafe"]) == 2 and len(second["smartblock"]) == 2
    run_increment(spark, landing, out, progress)
    assert len(read_increments(spark, out, "cafe").collect()) == 2


def test_a_batch_run_again_replaces_its_rows(spark, tmp_path, monkeypatch):
    landing, out, progress = (str(tmp_path / n) for n in ("landing", "out", "progress"))
    captures_of(spark, *PAGES[2:5]).coalesce(1).write.parquet(landing)
    real, calls = incremental.rows_of, []

    def failing(stated, kind, *rest):
        calls.append(kind)
        if len(calls) == 3:
            raise OSError("lost")
        return real(stated, kind, *rest)

    monkeypatch.setattr(incremental, "rows_of", failing)
    with pytest.raises(Exception, match="lost"):
        run_increment(spark, landing, out, progress)
    run_increment(spark, landing, out, progress)
    assert len(read_increments(spark, out, "smartblock").collect()) == 2
    assert len(read_increments(spark, out, "cafe").collect()) == 2
    assert read_increments(spark, out, "cafe").first().date == datetime.date(2025, 1, 2)


def test_pages_captured_again_count_once(spark, tmp_path, monkeypatch):
    """Increments over any batches give what one run over all captures gives."""
    landing, out, progress = (str(tmp_path / n) for n in ("landing", "out", "progress"))
    monkeypatch.setattr(incremental, "MERGE_AFTER", 2)
    fewer = ("naver", "cafe", "가", cafe_page(cafe_card()))
    failed = ("naver", "blog", "가", None)
    batches = [PAGES[:3], [fewer, failed], [PAGES[0], *PAGES[3:5]], [PAGES[2], ("naver", "blog", "나", blog_page(blog_card()))]]
    for rows in batches:
        captures_of(spark, *rows).coalesce(1).write.mode("append").parquet(landing)
        run_increment(spark, landing, out, progress)
    keywords = spark.createDataFrame([(1, "가"), (2, "나"), (3, "다")], "kw_pos int, keyword string")
    whole = rl.extract_tables(keywords, captures_of(spark, *(r for b in batches for r in b)))
    for kind in rl.SURFACES:
        columns = [c for c in whole[kind].columns if c not in ("platform_pos", "kw_pos")]
        assert table_rows(read_increments(spark, out, kind).select(columns)) == table_rows(whole[kind].select(columns)) != []
    assert {(r.surface, r.keyword, r.reason) for r in incremental.read_rejected(spark, out).collect()} == {
        ("blog", "가", "no page"), ("blog", "나", "broken card after rows: 0")
    }
    # A stream begun anew meets known pages only.
    before = table_rows(read_increments(spark, out, "cafe"))
    run_increment(spark, landing, out, str(tmp_path / "anew"))
    assert table_rows(read_increments(spark, out, "cafe")) == before


def test_a_batch_is_seen_as_a_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    landing, out, progress = (str(tmp_path / n) for n in ("landing", "out", "progress"))
    captures_of(spark, *PAGES[:1]).coalesce(1).write.parquet(landing)
    run_increment(spark, landing, out, progress)
    before = {kind: table_rows(read_increments(spark, out, kind)) for kind in rl.SURFACES}
    captures_of(spark, *PAGES[2:5]).coalesce(1).write.mode("append").parquet(landing)

    def lost(*_):
        raise OSError("lost before the manifest")

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "_commit", lost)
        with pytest.raises(Exception, match="lost before the manifest"):
            run_increment(spark, landing, out, progress)
    assert {kind: table_rows(read_increments(spark, out, kind)) for kind in rl.SURFACES} == before
    run_increment(spark, landing, out, progress)
    assert len(read_increments(spark, out, "cafe").collect()) == 2


def test_one_pass_over_articles_a_hop(spark, monkeypatch):
    """Blog and cafe cards ask together, and a url visited is not read again."""
    from resultlake.operators import articles as A

    passes, real = [], A.asked_articles
    monkeypatch.setattr(A, "asked_articles", lambda rows, urls: passes.append({r.url for r in urls.collect()}) or real(rows, urls))
    rows = [*ARTICLE_ROWS, ("https://search.naver.com/c", "<iframe id='cafe_main' src='/a'></iframe>")]
    pages = [PAGES[0], ("naver", "cafe", "가", cafe_page(cafe_card(date="어제", link="<a class='title_link' href='/c'>c</a>")))]
    keywords = spark.createDataFrame([(1, "가")], "kw_pos int, keyword string")
    tables = rl.extract_tables(keywords, captures_of(spark, *pages), spark.createDataFrame(rows, ARTICLES))
    assert tables["blog"].count() == 2
    assert passes[0] >= {"https://search.naver.com/a"} and passes[1] == {"https://blog.naver.com/i"} and len(passes) == 2


def test_a_page_that_never_ends_is_a_reject(spark):
    from resultlake.operators import cards

    def endless(page):
        while page.text(page.first(cards.MAIN_PACK) or 0) == "stuck":
            pass
        return [{"text": "x", "href": "y"}]

    pages = spark.createDataFrame([(1, "<p id='main_pack'>stuck"), (2, "<p id='main_pack'>fine"), (3, "<p id='main_pack'>stuck")], "id int, html string")
    found = cards.extract(pages.coalesce(1), endless, cards.ANCHOR, error="error", seconds=0.3).collect()
    assert [(r.id, r.cards is not None) for r in found] == [(1, False), (2, True), (3, False)]
    assert found[0].error == "PageTimeout: not read within 0.3 seconds"


# -- command line and staging ----------------------------------------------------
def test_command_line(spark, files, capsys, monkeypatch):
    import json

    from resultlake import __main__ as cli

    cleared = []
    monkeypatch.setattr(cli, "clear_stage", cleared.append)  # other tests still read theirs
    cli.main(
        ["--keywords-file", "keywords.txt", "--base-dir", str(files), "--captures", str(files / "captures"),
         "--articles", str(files / "articles"), "--output-dir", str(files / "cli"), "--max-rows", "1"]
    )
    summary = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert summary["blog_count"] == 2 and summary["output_files"]["cafe"] == str(files / "cli" / "cafe.csv")
    assert cleared


def test_clear_stage(spark, tmp_path, monkeypatch):
    import os

    from resultlake import session

    monkeypatch.setattr(session, "stage_root", lambda spark: str(tmp_path))
    staged = session.stage(spark.range(3), "numbers")
    assert staged.count() == 3 and len(os.listdir(tmp_path / "resultlake")) == 1
    session.clear_stage(spark)
    assert os.listdir(tmp_path / "resultlake") == []


def test_stage_folder(spark):
    from resultlake import session

    class Session:
        def __init__(self, **settings):
            self.conf = {k.replace("_", "."): v for k, v in settings.items()}

    assert session.stage_root(Session(spark_checkpoint_dir="hdfs://x/y/")) == "hdfs://x/y"
    assert session.stage_root(Session(spark_sql_warehouse_dir="s3://w/h")) == "s3://w/h"
    assert session.stage_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_pages_are_read_once_and_never_shuffled(spark, files):
    captures = rl.read_captures(spark, str(files / "captures"))
    from resultlake.sources.captures import surface_pages

    pages = surface_pages(captures.coalesce(1), ["naver"], "smartblock")
    table = extraction.page_rows(captures.where("surface = 'smartblock'").drop("surface"), rl.SURFACES["smartblock"])
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan
    blog = captures.where("surface = 'blog'").drop("surface")
    before = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    extraction.surface_table(blog, BLOG)
    assert spark.sparkContext._jsc.sc().dagScheduler().nextJobId() == before  # nothing runs before an action
    assert pages.columns == ["platform", "keyword", "page_url", "html"]
