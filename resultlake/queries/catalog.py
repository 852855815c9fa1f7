"""Driver queries: name -> (spark, sf_dir) -> DataFrame, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resultlake import functions as R
from resultlake.operators import cards
from resultlake.operators.cards import ANCHOR, extract, read_anchors
from resultlake.operators.ranking import exploded, numbered
from resultlake.operators.rules import cafe_cards
from resultlake.plans.extraction import extract_tables, public_table, rejected_pages, surface_table, union_tables
from resultlake.plans.job import run_job
from resultlake.plans.summary import platform_counts, run_summary, surface_counts
from resultlake.queries import generated as made
from resultlake.queries.generated import table
from resultlake.schema import ROWS
from resultlake.session import configure, stage, stage_path
from resultlake.sinks.csv import export, file_rows, from_json_rows, load_tables, read_csv, save_tables, to_json_rows
from resultlake.sources.articles import write_article_store
from resultlake.sources.captures import missing_captures, request_list, write_captures
from resultlake.sources.keywords import keyword_lines, read_keywords
from resultlake.sources.registry import BLOG, CAFE, SMARTBLOCK, SURFACES, Platforms
from resultlake.streaming.incremental import read_increments, read_rejected, run_increment

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(configure(spark), sf_dir)

    QUERIES[run.__name__] = configured
    return configured


# -- sources ---------------------------------------------------------------
@query
def keyword_scan(spark, sf_dir):
    """SC1 PR8 TX2: every document as a keyword file."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = documents.select("doc_id", keyword_lines(F.col("text")).alias("lines"))
    return exploded(lines, "doc_id", array="lines", name="keyword").select(
        "doc_id", (F.col("position") + 1).cast("bigint").alias("kw_pos"), "keyword"
    )


@query
def keyword_file(spark, sf_dir):
    """SC1-SC3: part names written as a text file and read back in file order."""
    path = stage_path(spark, "keyword-file")
    table(spark, sf_dir, "part").orderBy("p_partkey").select(F.concat(F.lit("  "), "p_name", F.lit("\t"))).write.text(path)
    return read_keywords(spark, path)


@query
def request_urls(spark, sf_dir):
    """JN1 URL3 SR2: search requests of every part name on every surface."""
    keywords = table(spark, sf_dir, "part").selectExpr("p_partkey as kw_pos", "p_name as keyword")
    return request_list(keywords, ["naver"]).select(
        "kw_pos", "keyword", "platform", "surface", "sort_order", "search_url"
    )


@query
def missing_pages(spark, sf_dir):
    """JN1: requests for customers and parts, of which only some were captured."""
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey as kw_pos", "c_mktsegment as keyword")
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey as kw_pos", "p_name as keyword")
    captures = table(spark, sf_dir, "customer").selectExpr(
        "'naver' as platform",
        "case when c_nationkey < 8 then 'blog' when c_nationkey < 16 then 'cafe' else 'smartblock' end as surface",
        "c_mktsegment as keyword",
    ).where("not (keyword = 'BUILDING' and surface = 'cafe')").distinct()
    return missing_captures(request_list(customers.unionByName(parts)), captures).select(
        "kw_pos", "keyword", "platform", "surface"
    )


# -- text, URLs, dates -----------------------------------------------------
@query
def text_normalize(spark, sf_dir):
    """TX1 over all documents and conversations."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text").selectExpr(
        "'document' as source", "doc_id as id", "0L as part", "text"
    )
    turns = table(spark, sf_dir, "conversations").selectExpr("'turn' as source", "conv_id as id", "turn as part", "text")
    return documents.unionByName(turns).select("source", "id", "part", R.normalize_text(F.col("text")).alias("text"))


@query
def page_anchors_topk(spark, sf_dir):
    """PX PR7 URL4 WN1 LM1: the first three usable links of every page."""
    pages = table(spark, sf_dir, "pages")
    read = extract(pages, read_anchors, ANCHOR, "anchors")
    links = F.transform(
        "anchors",
        lambda a: F.struct(
            R.normalize_text(a["text"]).alias("text"), R.absolute_url(F.col("url"), a["href"]).alias("link")
        ),
    )
    usable = F.slice(F.filter(links, lambda a: a["link"].isNotNull()), 1, 3)
    return numbered(read.select("page_id", usable.alias("rows")), "page_id")


@query
def page_links(spark, sf_dir):
    """PX URL1 URL2: every link of every page, absolute and canonical."""
    read = extract(table(spark, sf_dir, "pages"), read_anchors, ANCHOR, "anchors")
    flat = exploded(read, "page_id", "url", array="anchors", name="a")
    return flat.select(
        "page_id",
        (F.col("position") + 1).cast("int").alias("order"),
        R.absolute_url(F.lit("https://search.naver.com"), F.col("a.href")).alias("link"),
        R.canonical_url(F.lit("https://search.naver.com"), F.concat("a.href", F.lit("?from=1#x"))).alias("canonical"),
    )


HREFS = ["/a?b=1#c", "a/b", "?x=1", "#f", "//cdn.x/y", "../z", "./", "mailto:a@b", "http://h/p;q", " ", "#", "javascript:x"]


@query
def url_resolve(spark, sf_dir):
    """URL1 URL4 PR7: every kind of reference against every page address."""
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", F.explode(F.lit(HREFS)).alias("href")).select(
        "page_id", "href", R.absolute_url(F.col("url"), F.col("href")).alias("resolved")
    )


@query
def url_canonical(spark, sf_dir):
    """URL2 over all page addresses."""
    return table(spark, sf_dir, "pages").select(
        "page_id", R.canonical_url("https://search.naver.com", F.col("url")).alias("canonical")
    )


@query
def lb_trigger_urls(spark, sf_dir):
    """URL5 URL6: lazily loaded block addresses on every page address."""
    pages = table(spark, sf_dir, "pages")
    trigger = F.concat(F.lit("/p/api?id="), F.col("page_id"), F.lit("&q=a b~*"))
    lazy = R.lb_trigger_url(F.col("url"), F.when(F.col("page_id") % 5 != 0, trigger))
    return pages.select(
        "page_id", F.coalesce(lazy, R.absolute_url(F.col("url"), F.lit("/direct"))).alias("more_url")
    )


@query
def faq_opened_urls(spark, sf_dir):
    """URL7: question-and-answer blocks get opened, others stay as they are."""
    pages = table(spark, sf_dir, "pages")
    api = F.concat(
        F.lit("https://s.search.naver.com/p/qa?id="),
        F.col("page_id"),
        F.when(F.col("page_id") % 3 != 0, F.lit("&ssc=tab.itb.qab")).otherwise(F.lit("")),
        F.when(F.col("page_id") % 4 == 0, F.lit("&faq_opened=1")).otherwise(F.lit("")),
    )
    return pages.select(
        "page_id", R.finish_more_url(R.lb_trigger_url(F.col("url"), api)).alias("more_url")
    )


@query
def post_date_normalize(spark, sf_dir):
    """DT1 DT2: every order date in one of ten shapes, one of them no date."""
    day = F.col("o_orderdate").cast("date")
    shapes = [
        F.date_format(day, "yyyy.MM.dd."),
        F.date_format(day, "yyyy.M.d"),
        F.date_format(day, "yyyy. M. d."),
        F.date_format(day, "yyyy-MM-dd"),
        F.date_format(day, "yyyyMMdd"),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T23:30:00-09:00")),
        F.concat(F.lit(" "), F.date_format(day, "yyyy.M.d."), F.lit("\t9:5 ")),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 10Z")),
        F.concat(F.date_format(day, "yyyy. M.d")),
        F.concat(F.date_format(day, "d"), F.lit("일 전")),
    ]
    text = F.element_at(F.array(*shapes), (F.col("o_orderkey") % 10 + 1).cast("int"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return orders.select(
        "o_orderkey",
        R.parse_post_date(text).alias("post_date"),
        R.post_date_text(R.parse_post_date(text)).alias("post_date_text"),
    )


# -- surfaces --------------------------------------------------------------
@query
def blog_extract(spark, sf_dir):
    """PX3 PX4 PX10 PR3 PR5 DT1 WN1 LM1: blog tab pages without article pages."""
    return surface_table(made.blog_pages(spark, sf_dir), BLOG)


@query
def blog_date_fallback(spark, sf_dir):
    """JN2 PX11 URL8 DT3: undated blog cards ask their article's frame."""
    return surface_table(made.blog_pages(spark, sf_dir), BLOG, made.blog_articles(spark, sf_dir))


@query
def cafe_extract(spark, sf_dir):
    """PX5 PX6 PR4 PR6 URL2 DT2 WN1 LM1."""
    return surface_table(made.cafe_pages(spark, sf_dir), CAFE)


@query
def cafe_date_fallback(spark, sf_dir):
    """JN3 PX12 DT3."""
    return surface_table(made.cafe_pages(spark, sf_dir), CAFE, made.cafe_articles(spark, sf_dir))


@query
def smartblock_extract(spark, sf_dir):
    """PX1 PX2 PX7-PX9 PR1 PR2 URL5-URL7."""
    return surface_table(made.smartblock_pages(spark, sf_dir), SMARTBLOCK)


@query
def page_failure_isolation(spark, sf_dir):
    """PR9: a broken card, once reached, empties its page and no other."""
    pages = made.blog_pages(spark, sf_dir, broken=True)
    return surface_table(pages, BLOG, made.blog_articles(spark, sf_dir), max_rows=4)


@query
def card_failure_isolation(spark, sf_dir):
    """PR9, milder: a broken card is left out alone."""
    pages = made.blog_pages(spark, sf_dir, broken=True)
    return surface_table(pages, BLOG, made.blog_articles(spark, sf_dir), max_rows=4, on_bad_card="card")


# -- whole runs ------------------------------------------------------------
def _supplier_run(spark, sf_dir, platforms=None):
    """Main pages of all suppliers, asked for by nation-wide keyword lists that repeat."""
    known = Platforms()
    known.register("naver", SURFACES)
    known.register("mirror", SURFACES)
    pages = made.smartblock_pages(spark, sf_dir).withColumn("surface", F.lit("smartblock"))
    captures = pages.withColumn("platform", F.explode(F.lit(["naver", "mirror"])))
    suppliers = table(spark, sf_dir, "supplier")
    keywords = suppliers.selectExpr("explode(array(s_suppkey * 2, s_suppkey * 2 + 1)) as kw_pos", "s_name as keyword")
    return keywords, extract_tables(keywords, captures, platforms=platforms, known=known)


def _customer_run(spark, sf_dir):
    """Blog and community pages of all customers' and parts' keywords, with articles;
    some keywords have no page, and some pages were asked for by no keyword."""
    captures = made.captured(spark, sf_dir)
    captures = captures.unionByName(captures.where("surface = 'smartblock'").withColumn("keyword", F.concat(F.lit("unasked "), "keyword")))
    articles = made.blog_articles(spark, sf_dir).unionByName(made.cafe_articles(spark, sf_dir))
    keywords = (
        made.blog_keys(spark, sf_dir).selectExpr("k as kw_pos", "keyword")
        .unionByName(made.cafe_keys(spark, sf_dir).selectExpr("k + 1000000000 as kw_pos", "keyword"))
        .unionByName(made.block_keys(spark, sf_dir).selectExpr("k + 2000000000 as kw_pos", "keyword"))
    )
    return keywords, extract_tables(keywords, captures, articles)


def _as_one(tables: dict[str, DataFrame]) -> DataFrame:
    """All kinds under one schema, for comparing whole runs."""
    parts = None
    for kind, found in tables.items():
        title, name, date = ("title", F.lit(None).cast("string"), F.lit(None).cast("date"))
        if kind != "smartblock":
            title, name, date = "subject", F.col(f"{kind}_name"), F.col("date")
        one = found.select(
            F.lit(kind).alias("surface"), "keyword", "order", F.col(title).alias("title"),
            name.alias("name"), date.alias("date"), "url",
        )
        parts = one if parts is None else parts.unionByName(one)
    return parts


@query
def platform_union(spark, sf_dir):
    """SC9 ST1 ST3 SR1: two platforms, one of them named twice, keywords repeated."""
    _, tables = _supplier_run(spark, sf_dir, ["mirror", "naver", "mirror"])
    return tables["smartblock"]


@query
def keyword_results(spark, sf_dir):
    """SC4-SC8 JN1-JN3 ST2: a whole run over the three surfaces, in final order."""
    _, tables = _customer_run(spark, sf_dir)
    return _as_one({kind: public_table(t, kind) for kind, t in tables.items()})


@query
def bundle_union(spark, sf_dir):
    """ST1: two bundles, kind by kind, nothing dropped."""
    blog = surface_table(made.blog_pages(spark, sf_dir), BLOG)
    cafe = surface_table(made.cafe_pages(spark, sf_dir), CAFE)
    staged = {"blog": stage(blog, "blog"), "cafe": stage(cafe, "cafe")}
    return _as_one(union_tables(staged, {"blog": staged["blog"]}))


@query
def row_counts(spark, sf_dir):
    """AG1 AG2."""
    return surface_counts(_customer_run(spark, sf_dir)[1])


@query
def run_report(spark, sf_dir):
    """AG3 AG4 (file map left to the export query, whose paths differ per run)."""
    keywords, tables = _customer_run(spark, sf_dir)
    return run_summary(keywords, tables, "out").drop("output_files")


@query
def export_roundtrip(spark, sf_dir):
    """SK1-SK6: three files, written in final order and read back."""
    _, tables = _customer_run(spark, sf_dir)
    files = export(tables, stage_path(spark, "export"))
    return _as_one({kind: read_csv(spark, kind, path) for kind, path in files.items()})


def _written_rows(spark, path, columns):
    """Rows of a file as text, numbered as they stand in it."""
    return file_rows(spark, path).select("line", *columns)


@query
def export_order(spark, sf_dir):
    """SR1 SK7: tables handed over as JSON rows, exported; lines as they stand."""
    _, tables = _customer_run(spark, sf_dir)
    handed = {kind: from_json_rows(stage(to_json_rows(t, kind), "json"), kind) for kind, t in tables.items()}
    files = export({k: t.repartition(5) for k, t in handed.items()}, stage_path(spark, "export"), single_file=True)
    parts = [_written_rows(spark, files[kind], ["keyword", "order", "url"]).withColumn("surface", F.lit(kind)) for kind in files]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def export_text(spark, sf_dir):
    """SK2-SK4: header names and dates as the community file writes them."""
    _, tables = _customer_run(spark, sf_dir)
    files = export({"cafe": tables["cafe"]}, stage_path(spark, "export"), single_file=True)
    return _written_rows(spark, files["cafe"], ["keyword", "date", "café", "subject", "url"])


@query
def handover_roundtrip(spark, sf_dir):
    """SK7: staged tables and their JSON form, a kind that was not handed over is empty."""
    blog = surface_table(made.blog_pages(spark, sf_dir), BLOG).selectExpr("1 as platform_pos", "0L as kw_pos", "*")
    tables = load_tables(spark, save_tables({"blog": blog}))
    rows = None
    for kind, found in tables.items():
        one = to_json_rows(found, kind)
        rows = one if rows is None else rows.unionByName(one)
    return _as_one({kind: from_json_rows(rows, kind) for kind in tables})


@query
def rejected_blog_pages(spark, sf_dir):
    """PR9: the pages a reached broken card empties, and one that holds no page."""
    pages = made.blog_pages(spark, sf_dir, broken=True)
    pages = pages.withColumn("html", F.when(~F.col("keyword").endswith("7"), F.col("html")))
    found = rejected_pages(pages, BLOG, made.blog_articles(spark, sf_dir), max_rows=4)
    return found.select("platform", "surface", "keyword", "reason")


@query
def repeated_captures(spark, sf_dir):
    """JN1: of several captures of a page the one that can be read counts."""
    pages = made.smartblock_pages(spark, sf_dir).withColumn("surface", F.lit("smartblock"))
    failed = pages.withColumn("html", F.lit("<html><body>error</body></html>"))
    captures = pages.unionByName(failed).unionByName(pages.withColumn("html", F.lit(None).cast("string")))
    keywords = made.block_keys(spark, sf_dir).selectExpr("k as kw_pos", "keyword")
    return extract_tables(keywords, captures)["smartblock"].select(*ROWS["smartblock"].fieldNames())


@query
def own_platform(spark, sf_dir):
    """SC10: a platform registered beside the known one, with a surface of its own."""
    known = Platforms()
    known.register("naver", SURFACES)
    known.register("forum", {"blog": replace(BLOG, read=cards.read_cafe_cards, card=cards.CAFE_CARD, rule=cafe_cards, max_rows=3)})
    pages = made.cafe_pages(spark, sf_dir).withColumn("surface", F.lit("blog")).withColumn("platform", F.lit("forum"))
    keywords = made.cafe_keys(spark, sf_dir).selectExpr("k as kw_pos", "keyword")
    return extract_tables(keywords, pages, platforms=["forum"], known=known)["blog"].select(*ROWS["blog"].fieldNames())


@query
def platform_row_counts(spark, sf_dir):
    """AG1 per platform, one of them without captures."""
    known = Platforms()
    known.register("naver", SURFACES)
    known.register("silent", SURFACES)
    pages = made.smartblock_pages(spark, sf_dir).withColumn("surface", F.lit("smartblock"))
    keywords = made.block_keys(spark, sf_dir).selectExpr("k as kw_pos", "keyword")
    tables = extract_tables(keywords, pages, platforms=["silent", "naver", "naver"], known=known)
    return platform_counts(tables, ["silent", "naver", "naver"])


@query
def job_run(spark, sf_dir):
    """SC2 SC11 AG3 ST4 SR2: a whole job from files, its keyword file by a relative
    path; the summary with its file map, what is missing and what was rejected."""
    base = stage_path(spark, "job")
    lines = made.block_keys(spark, sf_dir).orderBy("k").select(F.concat(F.lit(" "), "keyword"))
    lines.unionByName(spark.createDataFrame([("asked but not captured",)], lines.schema)).write.text(f"{base}/keywords")
    pages = made.smartblock_pages(spark, sf_dir).withColumn("surface", F.lit("smartblock"))
    pages.write.partitionBy("platform", "surface").parquet(f"{base}/captures")
    run = run_job(spark, "keywords", f"{base}/captures", base_dir=base, output_dir=f"{base}/out", sort_order="date")
    files = F.transform_values("output_files", lambda _, path: F.element_at(F.split(path, "/"), -1))
    names = F.array_join(F.array_sort(F.map_values(files)), ",")
    folder = F.element_at(F.split("output_dir", "/"), -1)
    one = run.summary.select("keyword_count", *(f"{kind}_count" for kind in ROWS), folder.alias("output_dir"), names.alias("files"))
    # One row each, added up into one.
    nothing = {c: F.lit(None).cast(t).alias(c) for c, t in one.dtypes}
    counted = [
        rows.agg(F.count("*").alias("n")).select(*nothing.values(), *(F.col("n").alias(c) if c == name else F.lit(0).cast("long").alias(c) for c in ("missing_count", "rejected_count")))
        for name, rows in (("missing_count", run.missing), ("rejected_count", run.rejected))
    ]
    zero = F.lit(0).cast("long")
    every = one.withColumn("missing_count", zero).withColumn("rejected_count", zero).unionByName(counted[0]).unionByName(counted[1])
    return every.agg(
        *(F.max(c).alias(c) for c in one.columns), *(F.sum(c).alias(c) for c in ("missing_count", "rejected_count"))
    )


def _in_two_batches(spark, base, pages, articles):
    """Land pages in two batches, a third of them in both, and take each up."""
    articles.write.parquet(f"{base}/articles")
    turn = F.pmod(F.xxhash64("keyword"), F.lit(3))
    dealt = stage(pages.withColumn("turn", turn), "landing")
    for batch in (1, 2):
        landed = dealt.where(F.col("turn").isin(0, batch)).select("platform", "surface", "keyword", "page_url", "html")
        landed.write.mode("append").parquet(f"{base}/landing")
        run_increment(spark, f"{base}/landing", f"{base}/out", f"{base}/progress", f"{base}/articles")
    return f"{base}/out"


@query
def incremental_run(spark, sf_dir):
    """RS1 JN1: captures of all surfaces landing in two batches, a third of the pages in
    both; each run takes up what is new and asks articles for what it needs."""
    articles = made.blog_articles(spark, sf_dir).unionByName(made.cafe_articles(spark, sf_dir))
    out = _in_two_batches(spark, stage_path(spark, "increments"), made.captured(spark, sf_dir), articles)
    return _as_one({kind: read_increments(spark, out, kind) for kind in ("smartblock", "cafe", "blog")})


@query
def incremental_rejects(spark, sf_dir):
    """RS1 PR9: the pages increments could not read, with the reason."""
    pages = made.blog_pages(spark, sf_dir, broken=True).withColumn("surface", F.lit("blog"))
    pages = pages.withColumn("html", F.when(~F.col("keyword").endswith("7"), F.col("html")))
    out = _in_two_batches(spark, stage_path(spark, "increments"), pages, made.blog_articles(spark, sf_dir))
    return read_rejected(spark, out).select("platform", "surface", "keyword", "reason").distinct()


@query
def article_store(spark, sf_dir):
    """SC7 JN2 PX11: undated blog cards answered from a store of article pages, of which
    only the buckets of asked urls are read."""
    store = write_article_store(made.blog_articles(spark, sf_dir), stage_path(spark, "articles"), buckets=16)
    return surface_table(made.blog_pages(spark, sf_dir), BLOG, store)


@query
def capture_store(spark, sf_dir):
    """SC4 SC5 SC6 JN1: a run over stored captures of two platforms, of which one is
    asked for, with key filters taken by buckets of keywords."""
    store = write_captures(made.captured(spark, sf_dir, ("naver", "mirror")), stage_path(spark, "captures"), buckets=8)
    keywords = made.block_keys(spark, sf_dir).selectExpr("k as kw_pos", "keyword").unionByName(
        made.cafe_keys(spark, sf_dir).selectExpr("k as kw_pos", "keyword")
    )
    tables = extract_tables(keywords, store)
    return _as_one({kind: tables[kind] for kind in ("smartblock", "cafe")})
