from pyspark.sql import functions as F

from inkline.functions import urls as U
from inkline.operators import links as LK

BASE = "https://www.site.cl/a/b/page.html?x=1#top"
CASES = {
    "https://other.cl/z": "https://other.cl/z",
    "/x": "https://www.site.cl/x",
    "//cdn.site.cl/y": "https://cdn.site.cl/y",
    "rel.html": "https://www.site.cl/a/b/rel.html",
    "?q=2": "https://www.site.cl/a/b/page.html?q=2",
    "#f": "https://www.site.cl/a/b/page.html?x=1#f",
    "": "https://www.site.cl/a/b/page.html?x=1",
    "../up": "https://www.site.cl/a/up",
    "./x/../y/.": "https://www.site.cl/a/b/y/",
    "/../../z?a=/../b": "https://www.site.cl/z?a=/../b",
}


def test_resolve(spark):
    df = spark.createDataFrame([(BASE, h) for h in CASES], "base string, href string")
    got = {r.href: r.abs for r in df.select("href", U.resolve(F.col("base"), F.col("href")).alias("abs")).collect()}
    assert got == CASES


def test_canonical_and_domains(spark):
    df = spark.createDataFrame([("HTTPS://News.Site.CL/p?b=2&a=1#x",)], "u string")
    r = df.select(U.canonical(F.col("u")).alias("c"), U.host(F.col("u")).alias("h")).first()
    assert r.c == "https://news.site.cl/p?a=1&b=2" and r.h == "news.site.cl"
    hosts = spark.createDataFrame([("site.cl",), ("news.site.cl",), ("badsite.cl",)], "h string")
    kept = [x.h for x in hosts.filter(U.on_domains(F.col("h"), ["site.cl"])).collect()]
    assert sorted(kept) == ["news.site.cl", "site.cl"]


def pages(spark):
    html = {
        1: '<a href="/b">b</a><a href="/b">dup</a><a href="mailto:x@y">m</a>',
        2: '<nav><a href="/c">c</a></nav><a href="https://off.org/z">off</a>',
        3: '<a href="/a#frag">a</a>',
    }
    rows = [(i, f"https://s.cl/{'abc'[i - 1]}", h) for i, h in html.items()]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_extract_dedup_frontier(spark):
    p = pages(spark)
    links = LK.extract_links(p)
    assert sorted(r.dst_url for r in links.filter("page_id = 1").collect()) == ["https://s.cl/b"]
    assert LK.offsite_filter(links, ["s.cl"]).filter("dst_url like '%off.org%'").count() == 0
    d = {r.canon_url: r.first_page_id for r in LK.dedup_urls(links).collect()}
    assert d["https://s.cl/a"] == 3
    assert LK.frontier(links, p).count() == 1   # only the off-site link is new


def test_route_first_rule_wins(spark):
    links = spark.createDataFrame([("https://s.cl/n/2023/x",), ("https://s.cl/page/2",), ("https://s.cl/v",)],
                                  "dst_url string")
    rules = [LK.LinkRule(allow=(r"/\d{4}/",), is_item=True, follow=False),
             LK.LinkRule(allow=(r"page/",), follow=True)]
    got = {r.dst_url: (r.rule_id, r.is_item, r.follow) for r in LK.route(links, rules).collect()}
    assert got == {"https://s.cl/n/2023/x": (0, True, False), "https://s.cl/page/2": (1, False, True)}


def test_hrefs_in_any_writing(spark):
    html = ("<A HREF='/x'>1</A><a class=c href=/y>2</a><a data-href='no' href=\"/z?a=1&amp;b=2\">3</a>"
            "<!-- <a href='/comment'> --><script>var s = '<a href=\"/script\">';</script>")
    p = spark.createDataFrame([(1, "https://s.cl/p", html)], "page_id long, url string, html string")
    assert [r.dst_url for r in LK.extract_links(p).collect()] == ["https://s.cl/x", "https://s.cl/y", "https://s.cl/z?a=1&b=2"]


def test_rules_with_regions(spark):
    html = ('<a class="next page-numbers" href="/page/2">next</a><div class="titulares"><h2><a href="/n/1">1</a></h2><a href="/no">x</a></div>'
            '<div class="titulares"><div><h2><a href="/n/2">2</a></h2></div></div><h2><a href="/fuera">f</a></h2>')
    rules = [LK.LinkRule(anchor_class="next page-numbers"), LK.LinkRule(region=("div.titulares", "h2"), is_item=True, follow=False),
             LK.LinkRule(allow=("fuera|page",), is_item=True)]
    p = spark.createDataFrame([("https://s.cl/", html)], "url string, html string")
    got = p.select(F.explode(LK.rule_links(F.col("url"), F.col("html"), rules)).alias("l")).select("l.*").collect()
    assert {(r.dst_url[12:], r.rule_id, r.is_item, r.follow) for r in got} == {
        ("/page/2", 0, False, True), ("/n/1", 1, True, False), ("/n/2", 1, True, False), ("/fuera", 2, True, True)}


def test_closure_keeps_items(spark):
    rows = [(1, "https://s.cl/list", '<a href="/page/2">2</a><a href="/nota/1">n</a>'), (2, "https://s.cl/page/2", '<a href="/nota/2">n</a>'),
            (3, "https://s.cl/nota/1", '<a href="/nota/3">not from here</a>'), (4, "https://s.cl/page/2", '<a href="/list">same page again</a>')]
    p = spark.createDataFrame(rows, "page_id long, url string, html string")
    seeds = spark.createDataFrame([("https://s.cl/list",)], "url string")
    rules = [LK.LinkRule(allow=("page/",)), LK.LinkRule(allow=("nota/",), is_item=True, follow=False)]
    got = {r.canon_url[13:]: (r.depth, r.page_id) for r in LK.crawl_closure(p, seeds, rules).collect()}
    assert got == {"list": (0, 1), "page/2": (1, 2), "nota/1": (1, 3), "nota/2": (2, None)}


def test_closure_on_a_cycle(spark):
    rows = [(1, "https://s.cl/a", '<a href="/b">'), (2, "https://s.cl/b", '<a href="/c">'),
            (3, "https://s.cl/c", '<a href="/a"><a href="/d">')]
    p = spark.createDataFrame(rows, "page_id long, url string, html string")
    seeds = spark.createDataFrame([("https://s.cl/a",)], "url string")
    got = {r.canon_url: (r.depth, r.page_id) for r in LK.crawl_closure(p, seeds).collect()}
    assert got == {"https://s.cl/a": (0, 1), "https://s.cl/b": (1, 2), "https://s.cl/c": (2, 3),
                   "https://s.cl/d": (3, None)}
    assert {r.depth for r in LK.crawl_closure(p, seeds, max_depth=1).collect()} == {0, 1}


def test_regions_with_positions(spark):
    """Crawl rules whose place in the page is a path; decoys stand at the wrong positions."""
    from inkline.operators.builtin_profiles import REGISTRY

    def found(media, html):
        df = spark.createDataFrame([("https://www.site.cl/", html)], "url string, html string")
        links = df.select(LK.rule_links(F.col("url"), F.col("html"), REGISTRY[media].rules).alias("l")).first()["l"]
        return [(x.dst_url.rsplit("/", 1)[1], x.is_item) for x in links]

    block = lambda k: f'<div><div><a href="/{k}1">x</a></div><div><a href="/{k}2">y</a><p><a href="/{k}3">in p</a></p><a href="/{k}4">z</a></div></div>'
    main = f"<main><div>{block('a')}</div><div>{block('b')}</div><div>{block('c')}{block('d')}</div><div>{block('e')}</div></main>"
    page = f'<a href="/top">t</a><div id="skin-branding"><div><div>{main}</div><div>{main.replace("/", "/q").replace("<q", "<").replace("</q", "</")}</div></div></div>'
    assert found("publimetro", page) == [(f"q{k}", True) for k in ("c2", "c4", "d2", "d4")]
    nav = ('<div class="pagination"><a href="/no1">n</a><nav><ul><li><a href="/p2">2</a><li><a href="/p3">3</a><span><a href="/no2">n</a></span></ul></nav></div>'
           '<div class="pagination x"><nav><ul><li><a href="/no3">n</a></ul></nav></div>'
           '<div class="headline | width_full hl"><h3><a href="/n1">N</a></h3><p><a href="/no4">n</a></p></div>')
    assert found("latercera", nav) == [("p2", False), ("p3", False), ("n1", True)]


def test_links_are_relative_to_the_base_element(spark):
    rows = [(1, "https://s.cl/a/b", '<head><base target=x><BASE HREF="/other/"></head><a href="x">x</a><a href="#f">f</a>'),
            (2, "https://s.cl/a/b", '<!-- <base href="/no/"> --><a href="x">x</a>'),
            (3, "https://s.cl/a/b", '<base href="https://t.cl/q/r?z=1"><a href="x&amp;y">x</a>')]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.dst_url) for r in LK.extract_links(df).collect())
    assert got == [(1, "https://s.cl/other/#f"), (1, "https://s.cl/other/x"), (2, "https://s.cl/a/x"), (3, "https://t.cl/q/x&y")]
    assert {(r.src, r.dst) for r in LK.link_edges(df).collect()} >= {("https://s.cl/a/b", "https://s.cl/other/x"), ("https://s.cl/a/b", "https://s.cl/a/x")}


def test_frontier_with_a_bit_array(spark):
    """Any size of the array, a full one too, gives the exact result."""
    links = spark.createDataFrame([(i, f"https://s.cl/{i % 300}#x{i}") for i in range(600)] + [(900, None)], "page_id long, dst_url string")
    visited = spark.createDataFrame([(f"https://s.cl/{i}",) for i in range(0, 300, 3)] + [(None,), ("https://s.cl/0#again",)], "url string")
    want = sorted(((r.page_id, r.canon_url) for r in LK.frontier(links, visited).collect()), key=str)
    assert len(want) == 401 and {u for _, u in want} == {f"https://s.cl/{i}" for i in range(300) if i % 3} | {None}
    for bits in (1, 64, 1 << 14):
        out = LK.frontier(links, visited, bits=bits)
        assert sorted(((r.page_id, r.canon_url) for r in out.collect()), key=str) == want
    array = LK.bit_array(visited.filter("url IS NOT NULL"), "url", 1 << 14)
    held = spark.createDataFrame([(f"https://s.cl/{i}",) for i in range(300)] + [(None,)], "u string").select("u", LK.may_hold(array, F.col("u"), 1 << 14).alias("m")).collect()
    assert all(r.m for r in held if r.u and int(r.u.rsplit("/", 1)[1]) % 3 == 0) and sum(r.m for r in held) < 130 and not held[-1].m


def test_unseen_links_are_not_shuffled(spark):
    links = spark.range(2000).selectExpr("id AS page_id", "concat('https://s.cl/', id) AS dst_url")
    visited = spark.range(50).selectExpr("concat('https://t.cl/', id) AS url")
    out = LK.frontier(links, visited, bits=1 << 12)
    assert out.count() == 2000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan
    # above the scan of the first branch there is its filter and nothing else
    first = plan.split("Union")[1].split("Exchange")[0]
    assert "Scan parquet" in first and "Join" not in first.split("Scan parquet")[0]


def chain(spark, n):
    rows = [(i, f"https://s.cl/{i}", f'<a href="/{i + 1}">n</a><a href="/{i // 2}">b</a>') for i in range(n)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_closure_of_a_long_chain(spark):
    """Every URL at its depth, whatever the rounds, with reached URLs merged on the way."""
    pages = chain(spark, 41)
    seeds = spark.createDataFrame([("https://s.cl/0",)], "url string")
    out = sorted((r.depth, r.canon_url, r.page_id) for r in LK.crawl_closure(pages, seeds).collect())
    assert out == [(i, f"https://s.cl/{i}", i if i < 41 else None) for i in range(42)]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("closure_")]


def test_closure_rounds_shuffle_no_edges(spark, monkeypatch):
    """With frontiers too large for a list, edges and reached URLs are joined bucket by bucket; the result is the same."""
    seeds = spark.createDataFrame([("https://s.cl/0",), ("https://s.cl/7",)], "url string")
    want = sorted((r.canon_url, r.depth) for r in LK.crawl_closure(chain(spark, 12), seeds).collect())
    plans, true = [], LK.links_from

    def seen_plan(edges, current, few):
        out = true(edges, current, few)
        plans.append((few, out._jdf.queryExecution().executedPlan().toString()))
        return out

    monkeypatch.setattr(LK, "FEW_URLS", 0)
    monkeypatch.setattr(LK, "links_from", seen_plan)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sorted((r.canon_url, r.depth) for r in LK.crawl_closure(chain(spark, 12), seeds).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == want and len(plans) > 3
    for few, plan in plans:
        assert few is None and "Bucketed: true" in plan and plan.count("Exchange") == 1  # that of the links found
        assert plan.index("Exchange") < plan.index("Join")
