"""DuckDB SQL for the driver queries, written from the base tables alone.

Generated pages (see ``generated``) hold what a card's ``card_id`` says, so the expected
rows follow from the table a page was made of, without any HTML.
"""

from __future__ import annotations

from resultlake.queries import generated as made

WS = (
    r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
PORTAL = "https://search.naver.com"


def _form(text: str) -> str:
    return f"replace(url_encode({text}), '%20', '+')"


def _cards(source: str, size: str) -> str:
    """One row per card of the pages made from ``source`` (columns k, keyword, ...)."""
    return f"""
    select s.*, i, k * 100 + i as card_id,
           date '2019-01-01' + cast(((k * 100 + i) * 37) % 2500 as int) as posted
    from ({source}) s, lateral (select unnest(range(1, {size} + 1)) as i) n"""


def _dated(with_articles: bool, also: str = "true") -> str:
    """Date of a card: shown, or found behind it one day later, or none."""
    found = f"case when {made.HAS_ARTICLE} and {made.HAS_FRAME} and {made.HAS_FRAMED_PAGE} and {also} then posted + 1 end"
    return f"case when not ({made.IS_RELATIVE}) then posted {'else ' + found if with_articles else ''} end"


BLOG_SOURCE = (
    "select c_custkey as k, concat(c_mktsegment, ' ', c_name) as keyword, c_name as name, "
    "c_mktsegment as seg from customer"
)
CAFE_SOURCE = "select p_partkey as k, concat(p_name, ' ', p_partkey) as keyword, p_name as name from part"
BLOCK_SOURCE = "select s_suppkey as k, s_name as keyword, s_name as name from supplier"


def blog(with_articles: bool) -> str:
    return f"""
    select keyword, cast(row_number() over (partition by k order by i) as int) as "order",
           cast(day as date) as date, name as blog_name, concat('Order ', card_id, ' & ', seg) as subject,
           case when {made.BLOG_ROOTED} then concat('{PORTAL}/u', k, '/', card_id)
                else concat('https://blog.naver.com/u', k, '/', card_id, '?utm=1#x') end as url
    from (select *, {_dated(with_articles)} as day from ({_cards(BLOG_SOURCE, made.BLOG_SIZE)}))
    where not ({made.IS_AD}) and not ({made.BLOG_NO_PROFILE}) and not ({made.BLOG_NO_NAME}) and day is not null
    qualify "order" <= 10"""


def cafe(with_articles: bool) -> str:
    return f"""
    select keyword, cast(row_number() over (partition by k order by i) as int) as "order",
           cast(day as date) as date, concat('Club ', name) as cafe_name, concat('Post ', card_id) as subject,
           concat('https://cafe.naver.com/c', k, '/', card_id) as url
    from (select *, {_dated(with_articles, f"not ({made.CAFE_JUNK_FIRST})")} as day
          from ({_cards(CAFE_SOURCE, made.CAFE_SIZE)}))
    where not ({made.IS_AD}) and not ({made.CAFE_NO_NAME}) and not ({made.CAFE_BLANK_SUBJECT}) and day is not null
    qualify "order" <= 10"""


SMARTBLOCK = f"""
    select keyword, cast(row_number() over (partition by k order by i) as int) as "order",
           case card_id % 8 when 3 then concat('Ad ', card_id) when 4 then concat('Asked ', card_id)
                when 5 then concat(name, ' images') else 'Plain' end as title,
           case card_id % 8
                when 3 then concat('https://ad.search.naver.com/search.naver?where=ad&query=', card_id)
                when 4 then concat('{PORTAL}/search.naver?where=nexearch&query=', k, '#lb_api=',
                     url_encode(concat('https://s.search.naver.com/p/qa?ssc=tab.itb.qab&id=', card_id, '&faq_opened=1')))
                when 5 then concat('{PORTAL}/search.naver?where=image&query=', card_id)
                else 'None' end as url
    from ({_cards(BLOCK_SOURCE, made.BLOCK_SIZE)})
    where card_id % 8 in (3, 4, 5) or (card_id % 8 = 6 and card_id % 3 <> 0)
    qualify "order" <= 10"""


def _failing(per_page: bool) -> str:
    """Blog cards with broken ones among them, at most four rows a page."""
    dates = _dated(True)
    cards = f"""
      select *, {dates} as day,
             {made.IS_BROKEN} and not ({made.BLOG_NO_NAME}) as broken
      from ({_cards(BLOG_SOURCE, made.BLOG_SIZE)})
      where not ({made.IS_AD}) and not ({made.BLOG_NO_PROFILE}) and not ({made.BLOG_NO_NAME})"""
    fails = "max(case when broken and coalesce(before, 0) < 4 then 1 else 0 end) over (partition by k) = 0"
    return f"""
    with cards as ({cards}),
    placed as (
      select *, sum(case when not broken and day is not null then 1 else 0 end)
                  over (partition by k order by i rows between unbounded preceding and 1 preceding) as before
      from cards),
    kept as (select * from placed {'qualify ' + fails if per_page else ''})
    select keyword, cast(row_number() over (partition by k order by i) as int) as "order",
           cast(day as date) as date, name as blog_name, concat('Order ', card_id, ' & ', seg) as subject,
           case when {made.BLOG_ROOTED} then concat('{PORTAL}/u', k, '/', card_id)
                else concat('https://blog.naver.com/u', k, '/', card_id, '?utm=1#x') end as url
    from kept where not broken and day is not null
    qualify "order" <= 4"""


def _as_one(**kinds: str) -> str:
    parts = []
    for kind, sql in kinds.items():
        kind = kind.rstrip("_")
        if kind == "smartblock":
            row = "title, cast(null as varchar) as name, cast(null as date) as date"
        else:
            row = f"subject as title, {kind}_name as name, date"
        parts.append(f"""select '{kind}' as surface, keyword, "order", {row}, url from ({sql})""")
    return " union all ".join(parts)


def _rejected(limit: int) -> str:
    return f"""
        with cards as (
          select *, {_dated(True)} as day, {made.IS_BROKEN} as broken
          from ({_cards(BLOG_SOURCE, made.BLOG_SIZE)})
          where not ({made.IS_AD}) and not ({made.BLOG_NO_PROFILE}) and not ({made.BLOG_NO_NAME})),
        placed as (
          select *, coalesce(sum(case when not broken and day is not null then 1 else 0 end)
                      over (partition by k order by i rows between unbounded preceding and 1 preceding), 0) as before
          from cards),
        failed as (select k, min(before) as rows from placed where broken and before < {limit} group by k)
        select 'naver' as platform, 'blog' as surface, keyword,
               case when keyword like '%7' then 'no page' else concat('broken card after rows: ', rows) end as reason
        from ({BLOG_SOURCE}) left join failed using (k)
        where keyword like '%7' or rows is not null"""


ALL_ROWS = _as_one(smartblock=SMARTBLOCK, cafe=cafe(True), blog=blog(True))
COUNTS = {
    "smartblock": f"(select count(*) from ({SMARTBLOCK}))",
    "cafe": f"(select count(*) from ({cafe(True)}))",
    "blog": f"(select count(*) from ({blog(True)}))",
}

# Link pattern of the pages table's own markup.
LINKS = """
    select page_id, url, i, hrefs[i] as href, texts[i] as text
    from (select *, unnest(range(1, len(hrefs) + 1)) as i
          from (select page_id, url,
                       regexp_extract_all(html, '<a href="([^"]*)"[^>]*>([^<]*)</a>', 1) as hrefs,
                       regexp_extract_all(html, '<a href="([^"]*)"[^>]*>([^<]*)</a>', 2) as texts
                from pages))"""
ORIGIN = "regexp_extract(url, '^[a-z]+://[^/?#]+')"
FOLDER = "regexp_replace(regexp_extract(url, '^[^?#]*'), '[^/]*$', '')"
PARENT = "regexp_replace(regexp_extract(url, '^[^?#]*'), '[^/]*/[^/]*$', '')"
BARE = "regexp_extract(url, '^[^#]*')"

ORACLES: dict[str, str] = {
    "keyword_scan": f"""
        select doc_id, row_number() over (partition by doc_id order by i) as kw_pos, keyword
        from (select doc_id, i, regexp_replace(line, '^[{WS}]+|[{WS}]+$', '', 'g') as keyword
              from (select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as i
                    from (select doc_id, string_split(text, chr(10)) as lines from documents)))
        where keyword <> ''""",
    "keyword_file": "select row_number() over (order by p_partkey) as kw_pos, p_name as keyword from part",
    "request_urls": f"""
        select p_partkey as kw_pos, p_name as keyword, 'naver' as platform, surface, sort_order,
               concat('{PORTAL}/search.naver?', replace(pattern, 'KEYWORD', {_form('p_name')})) as search_url
        from part cross join (values
          ('smartblock', null, 'where=nexearch&query=KEYWORD'),
          ('cafe', 'rel', 'ssc=tab.cafe.all&query=KEYWORD&st=rel'),
          ('blog', 'rel', 'ssc=tab.blog.all&query=KEYWORD&st=rel')) as s(surface, sort_order, pattern)""",
    "missing_pages": """
        with wanted as (
          select c_custkey as kw_pos, c_mktsegment as keyword from customer
          union all select p_partkey, p_name from part),
        captured as (
          select c_mktsegment as keyword,
                 case when c_nationkey < 8 then 'blog' when c_nationkey < 16 then 'cafe' else 'smartblock' end as surface
          from customer)
        select kw_pos, keyword, 'naver' as platform, surface
        from wanted cross join (values ('smartblock'), ('cafe'), ('blog')) as s(surface)
        where not exists (
          select 1 from captured c where c.keyword = wanted.keyword and c.surface = s.surface
             and not (c.keyword = 'BUILDING' and c.surface = 'cafe'))""",
    "text_normalize": f"""
        select source, id, part, trim(regexp_replace(text, '[{WS}]+', ' ', 'g')) as text
        from (select 'document' as source, doc_id as id, 0::bigint as part, text from documents
              union all select 'turn', conv_id, turn, text from conversations)""",
    "page_anchors_topk": f"""
        select page_id, cast(row_number() over (partition by page_id order by i) as int) as "order",
               trim(regexp_replace(text, '[{WS}]+', ' ', 'g')) as text, concat({ORIGIN}, href) as link
        from ({LINKS}) qualify "order" <= 3""",
    "page_links": f"""
        select page_id, cast(i as int) as "order", concat('{PORTAL}', href) as link,
               concat('{PORTAL}', href) as canonical from ({LINKS})""",
    "url_resolve": f"""
        select page_id, href, case href
          when '/a?b=1#c' then concat({ORIGIN}, href)
          when 'a/b' then concat({FOLDER}, 'a/b')
          when '?x=1' then concat(regexp_extract(url, '^[^?#]*'), '?x=1')
          when '#f' then concat({BARE}, '#f')
          when '//cdn.x/y' then concat(regexp_extract(url, '^[a-z]+:'), href)
          when '../z' then concat({PARENT}, 'z')
          when './' then {FOLDER}
          when 'mailto:a@b' then href
          when 'http://h/p;q' then href
          end as resolved
        from pages, (select unnest(['/a?b=1#c', 'a/b', '?x=1', '#f', '//cdn.x/y', '../z', './',
          'mailto:a@b', 'http://h/p;q', ' ', '#', 'javascript:x']) as href)""",
    "url_canonical": "select page_id, regexp_replace(url, '[?#].*$', '') as canonical from pages",
    "lb_trigger_urls": f"""
        select page_id, case when page_id % 5 = 0 then concat({ORIGIN}, '/direct')
          else concat({BARE}, '#lb_api=', url_encode(concat({ORIGIN}, '/p/api?id=', page_id, '&q=a b~*'))) end as more_url
        from pages""",
    "faq_opened_urls": f"""
        select page_id, concat({BARE}, '#lb_api=', url_encode(concat('https://s.search.naver.com/p/qa?id=', page_id,
          case when page_id % 3 <> 0 then '&ssc=tab.itb.qab' else '' end,
          case when page_id % 3 <> 0 or page_id % 4 = 0 then '&faq_opened=1' else '' end))) as more_url
        from pages""",
    "post_date_normalize": """
        select o_orderkey, case when o_orderkey % 10 < 8 then cast(o_orderdate as date) end as post_date,
               case when o_orderkey % 10 < 8 then strftime(o_orderdate, '%Y.%m.%d.') end as post_date_text
        from orders""",
    "blog_extract": blog(False),
    "blog_date_fallback": blog(True),
    "cafe_extract": cafe(False),
    "cafe_date_fallback": cafe(True),
    "smartblock_extract": SMARTBLOCK,
    "page_failure_isolation": _failing(True),
    "card_failure_isolation": _failing(False),
    "platform_union": f"""
        select platform_pos, s_suppkey * 2 + twice as kw_pos, keyword, "order", title, url
        from ({SMARTBLOCK}) r join supplier on s_name = keyword
        cross join (select unnest([1, 2, 3])::int as platform_pos) cross join (select unnest([0, 1]) as twice)""",
    "keyword_results": ALL_ROWS,
    "bundle_union": _as_one(blog=blog(False), cafe=cafe(False), blog_=blog(False)),
    "row_counts": f"""
        with counts as (select 'smartblock' as surface, {COUNTS['smartblock']} as row_count
          union all select 'cafe', {COUNTS['cafe']} union all select 'blog', {COUNTS['blog']})
        select * from counts union all select 'all', cast(sum(row_count) as bigint) from counts""",
    "run_report": f"""
        select (select count(*) from customer) + (select count(*) from part) + (select count(*) from supplier) as keyword_count,
               {COUNTS['smartblock']} as smartblock_count, {COUNTS['cafe']} as cafe_count,
               {COUNTS['blog']} as blog_count, 'out' as output_dir""",
    "export_roundtrip": ALL_ROWS,
    "handover_roundtrip": _as_one(blog=blog(False)),
    "export_order": f"""
        select 'smartblock' as surface, row_number() over (order by k, cast("order" as int)) as line, keyword, cast("order" as varchar) as "order", url
        from ({SMARTBLOCK}) join (select s_suppkey as k, s_name as keyword from supplier) using (keyword)
        union all
        select 'cafe', row_number() over (order by k, "order"), keyword, cast("order" as varchar), url
        from ({cafe(True)}) join (select p_partkey as k, concat(p_name, ' ', p_partkey) as keyword from part) using (keyword)
        union all
        select 'blog', row_number() over (order by k, "order"), keyword, cast("order" as varchar), url
        from ({blog(True)}) join (select c_custkey as k, concat(c_mktsegment, ' ', c_name) as keyword from customer) using (keyword)""",
    "export_text": f"""
        select row_number() over (order by k, "order") as line, keyword, strftime(date, '%Y.%m.%d.') as date,
               cafe_name as "café", subject, url
        from ({cafe(True)}) join (select p_partkey as k, concat(p_name, ' ', p_partkey) as keyword from part) using (keyword)""",
    "rejected_blog_pages": _rejected(4),
    "incremental_rejects": _rejected(10),
    "article_store": blog(True),
    "capture_store": _as_one(smartblock=SMARTBLOCK, cafe=cafe(False)),
    "repeated_captures": SMARTBLOCK,
    "own_platform": f"""
        select keyword, "order", date, cafe_name as blog_name, subject, url from ({cafe(False)}) where "order" <= 3""",
    "platform_row_counts": f"""
        select p::int as platform_pos, case p when 1 then 'silent' else 'naver' end as platform, surface,
               case when p > 1 and surface = 'smartblock' then {COUNTS['smartblock']} else 0 end as row_count
        from (select unnest([1, 2, 3]) as p) cross join (select unnest(['smartblock', 'cafe', 'blog']) as surface)""",
    "job_run": f"""
        select (select count(*) from supplier) + 1 as keyword_count, {COUNTS['smartblock']} as smartblock_count,
               0::bigint as cafe_count, 0::bigint as blog_count, 'out' as output_dir,
               'blog.csv,cafe.csv,smartblock.csv' as files,
               2 * (select count(*) from supplier) + 3 as missing_count, 0::bigint as rejected_count""",
    "incremental_run": ALL_ROWS,
}
