"""Keyword files, platforms, requests and captures."""

import urllib.parse as up

import pytest
from pyspark.sql import functions as F

from resultlake import SURFACES, Platforms, missing_captures, read_keywords, request_list
from resultlake.sources import captures as C
from resultlake.sources.registry import PLATFORMS


def keywords_in(spark, tmp_path, data: bytes, name="keywords.txt"):
    (tmp_path / name).write_bytes(data)
    rows = read_keywords(spark, name, base_dir=str(tmp_path)).orderBy("kw_pos").collect()
    assert [r.kw_pos for r in rows] == list(range(1, len(rows) + 1))
    return [r.keyword for r in rows]


@pytest.mark.parametrize(
    "text",
    [
        "인터넷가입\n4인쇼파\nlg 홈캠",
        " a \r\n\r\n\u3000b\u3000\n\n\tc\n\na\n",
        "a\x0bb\x0cc\x1cd\x1de\x1ef\x85g\u2028h\u2029i\rj",
        "\ufeffa\nb\ufeff\n",
        "\ufeff\na",
        "  x y  \n \n",
    ],
)
def test_keyword_file(spark, tmp_path, text):
    expected = [line.strip() for line in text.splitlines() if line.strip()]
    assert keywords_in(spark, tmp_path, text.encode()) == expected


def test_keyword_file_in_many_splits(spark, tmp_path):
    lines = [f"keyword {i % 700} x{'x' * (i % 50)}" for i in range(5000)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        text = "\n\n".join(lines)
        assert keywords_in(spark, tmp_path, text.encode()) == lines
        assert keywords_in(spark, tmp_path, b"\xef\xbb\xbf" + text.encode()) == ["\ufeff" + lines[0], *lines[1:]]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_keyword_file_guards(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_keywords(spark, str(tmp_path / "none.txt"))
    for data in (b"", b" \n\n\t\n"):
        with pytest.raises(ValueError):
            keywords_in(spark, tmp_path, data)


def test_platforms():
    known = Platforms()
    known.register("one", SURFACES)
    known.register("two", {"blog": SURFACES["blog"]})
    assert known.chosen() == known.chosen([]) == ["one", "two"]
    assert known.chosen(["two", "one", "two"]) == ["two", "one", "two"]
    with pytest.raises(ValueError, match="three"):
        known.chosen(["one", "three"])
    assert PLATFORMS.chosen(None) == ["naver"]


def test_requests(spark):
    known = Platforms()
    known.register("one", SURFACES)
    known.register("two", {"blog": SURFACES["blog"]})
    words = ["갤럭시 S26", "a&b=c*~", "a"]
    keywords = spark.createDataFrame(list(enumerate(words, 1)), "kw_pos int, keyword string")
    found = request_list(keywords, ["two", "one", "two"], "date", known).collect()
    assert len(found) == 3 * (1 + 3 + 1)
    by = {(r.platform_pos, r.surface, r.kw_pos): r.search_url for r in found}
    root = "https://search.naver.com/search.naver?"
    for i, word in enumerate(words, 1):
        assert by[2, "smartblock", i] == root + up.urlencode({"where": "nexearch", "query": word})
        assert by[2, "cafe", i] == root + up.urlencode({"ssc": "tab.cafe.all", "query": word, "st": "date"})
        assert by[1, "blog", i] == by[3, "blog", i] == root + up.urlencode({"ssc": "tab.blog.all", "query": word, "st": "date"})


def test_surfaces_bring_their_own_numbers(spark):
    from dataclasses import replace

    known = Platforms()
    known.register("x", {"blog": replace(SURFACES["blog"], sort_order="date"), "smartblock": SURFACES["smartblock"]})
    keywords = spark.createDataFrame([(1, "a")], "kw_pos int, keyword string")
    found = {r.surface: r for r in request_list(keywords, known=known).collect()}
    assert found["blog"].search_url.endswith("&query=a&st=date") and found["blog"].sort_order == "date"
    assert found["smartblock"].sort_order is None and "st=" not in found["smartblock"].search_url


def test_missing_captures(spark):
    keywords = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "kw_pos int, keyword string")
    have = spark.createDataFrame(
        [("naver", "blog", "a"), ("naver", "cafe", "a"), ("naver", "smartblock", "a"), ("naver", "cafe", "b"), ("x", "blog", "b")],
        "platform string, surface string, keyword string",
    )
    found = missing_captures(request_list(keywords), have).select("kw_pos", "surface").collect()
    assert sorted(map(tuple, found)) == [(2, "blog"), (2, "smartblock")]


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "captures")
    rows = [(p, s, f"k{i}", "u", "<p>") for p in ("naver", "x") for s in SURFACES for i in range(3)]
    frame = spark.createDataFrame(rows, "platform string, surface string, keyword string, page_url string, html string")
    frame.write.partitionBy("platform", "surface").parquet(path)
    return C.read_captures(spark, path)


def test_captures_are_pruned_below_the_reader(spark, stored):
    wanted = spark.createDataFrame([("k1",), ("k1",)], "keyword string")
    pages = C.surface_pages(stored, ["naver"], "blog", wanted)
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(platform" in plan and "surface" in plan.split("PartitionFilters")[1]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert [tuple(r) for r in pages.select("platform", "keyword").collect()] == [("naver", "k1")]


def test_measured_size(spark):
    from resultlake.session import fits_broadcast

    table = spark.range(100).select(F.repeat(F.lit("가"), 10).alias("s"), "id", F.lit(None).cast("string").alias("n"))
    size = 100 * (30 + 16 + 16 + 16) + sum(len(str(i)) for i in range(100))
    assert fits_broadcast(table, size) and not fits_broadcast(table, size - 1)
    assert fits_broadcast(table.limit(0), 0)


def scanned(df):
    """Bytes of the files that the scans of a collected plan opened."""
    found, left = 0, [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            found += node.metrics().get("filesSize").get().value()
        children = node.children()
        left += [children.apply(i) for i in range(children.size())]
    return found


def test_bytes_read_from_a_store_grow_with_what_is_asked(spark, tmp_path):
    import resultlake as rl

    pages = spark.range(4000).select(F.concat(F.lit("https://x/"), "id").alias("url"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 40).alias("html"))
    pages = pages.unionByName(pages.limit(10)).unionByName(spark.createDataFrame([(None, "nobody asks")], "url string, html string"))
    rl.write_article_store(pages.where("url is null or url < 'https://x/3'"), str(tmp_path), buckets=64)
    rl.write_article_store(pages.where("url >= 'https://x/3'"), str(tmp_path), buckets=64)
    store = rl.read_articles(spark, str(tmp_path))
    assert store.buckets == 64
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan as it ran
    try:
        sizes = []
        for asked in (1, 8, 4000):
            urls = spark.range(asked).select(F.concat(F.lit("https://x/"), "id").alias("url"))
            found = store.asked(urls)
            rows = found.collect()
            assert {r.url for r in rows} >= {f"https://x/{i}" for i in range(asked)}
            sizes.append(scanned(found))
        whole = store.pages()
        assert len(whole.collect()) == 4010
        assert 0 < sizes[0] < scanned(whole) / 30 and sizes[0] < sizes[1] < scanned(whole) / 4 and sizes[2] == scanned(whole)
        assert store.asked(spark.createDataFrame([], "url string")).isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    with pytest.raises(ValueError):
        rl.write_article_store(pages, str(tmp_path), buckets=32)


def test_stored_captures(spark, tmp_path):
    rows = [(p, s, f"k{i}", "u", "<p>") for p in ("naver", "x") for s in SURFACES for i in range(30)]
    frame = spark.createDataFrame([*rows, ("naver", "blog", None, "u", "<p>")], "platform string, surface string, keyword string, page_url string, html string")
    C.write_captures(frame, str(tmp_path / "store"), buckets=4)
    store = C.read_captures(spark, str(tmp_path / "store"))
    wanted = spark.createDataFrame([("k1",), ("k7",), ("none",)], "keyword string")
    pages = C.surface_pages(store, ["naver"], "blog", wanted)
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(platform" in plan and "SortMergeJoin" not in plan
    assert {r.keyword for r in pages.collect()} == {"k1", "k7"}
    asked = wanted.selectExpr("1 as kw_pos", "keyword")
    assert {r.keyword for r in C.missing_captures(C.request_list(asked), store).collect()} == {"none"}
