"""The driver's query registry: one Spark plan per operator key, each with
the DuckDB SQL that must give the same rows (SURVEY §2 keys, §7.4 mapping).

Every query reads the driver's tables in full; columns are aliased the same
on both sides and every result carries a key column (page_id, doc_id,
event_id) so the order-insensitive comparison matches rows, not bags.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkline.functions import dates as D
from inkline.functions import html as H
from inkline.functions import text as T
from inkline.functions import urls as U
from inkline.operators import limits as L
from inkline.operators import links as LK
from inkline.operators import profiles as P
from inkline.operators.builtin_profiles import DRIVER_PAGES, PAGES_MEDIA_EXPR
from inkline.operators.dictionary import match_by_join, match_pairs, matches_of, text_matches
from inkline.operators.word_tables import with_clean, with_matches
from inkline.plans import articles as A
from inkline.plans import oracle_patterns as O
from inkline.plans import sql as S
from inkline.session import scratch_path

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- parameters of the driver checks ---------------------------------------
AS_OF_PAGES = "2024-01-20 00:00:00"
AS_OF_EVENTS = "2024-01-15 00:00:00"
AS_OF_EVENTS_LATE = "2024-01-30 12:00:00"
AS_OF_PREFIX = "2024-01-04 00:00:00"
FLAGSHIP_PLACES = ("Der", "Las", "Les", "The", "que", "und")
FREQUENT_PHRASES = ("the", "und", "que", "les")
EVENT_CAPS = {"view": 100, "error": 40, "click": 150, "signup": 200, "purchase": 30}
ARTICLE = P.Region(H.open_tag_re("article"), "article")
NAV = ("nav",)
ALLOW = (r"/[A-Z][^/]*$",)
DENY = (r"/(The|Les|Der|Las)$",)
RULES = (LK.LinkRule(allow=(r"/[A-Z][^/]*$",), is_item=True, follow=False),
         LK.LinkRule(allow=(r"/[a-z]+$",), deny=(r"/(the|and|de|que)$",), follow=True))
DOMAINS = ("example.com",)
HOSTS = (("example.com", "dotcom"), ("example.net", "dotnet"), ("example.org", "dotorg"))
PUBLISHED_SQL = "(TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST((page_id * 7919) % 720 AS BIGINT)))"


def published_at() -> Column:
    """Pages carry no date: a deterministic one spread over 30 days (same formula in SQL)."""
    hours = F.pmod(F.col("page_id") * 7919, F.lit(720))
    return F.timestamp_add("HOUR", hours, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))


def dated_pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").withColumn("published_at", published_at())


def container_col() -> Column:
    return ARTICLE.column(F.col("html"))


def container_sql(h: str = "html") -> str:
    return S.first_block(h, *O.ARTICLE)


MEDIA_SQL = PAGES_MEDIA_EXPR


# ------------------------------------------------------------- flagship ---

def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """pages -> driver profile -> cap 100 per language -> 48 h recency -> enrichment."""
    return A.articles(dated_pages(spark, sf), DRIVER_PAGES, AS_OF_PAGES, places=FLAGSHIP_PLACES)


def every_article(spark: SparkSession, sf: str) -> DataFrame:
    """All pages through extraction and enrichment, without caps and recency."""
    return A.all_articles(dated_pages(spark, sf), DRIVER_PAGES, places=FLAGSHIP_PLACES)


def _extract_sql(spec: H.ParagraphSpec = DRIVER_PAGES.paragraphs, join: str = "space") -> str:
    title = S.h1_title("html")
    subtitle = S.clean_text(S.first_p_all(container_sql()))
    body = S.body_text(container_sql(), spec, join)
    status = (f"CASE WHEN coalesce({title}, '') = '' THEN 'filtered' "
              f"WHEN {container_sql()} IS NULL THEN 'filtered' "
              f"WHEN published_at IS NULL THEN 'rejected' ELSE 'parsed' END")
    return (f"SELECT page_id, {MEDIA_SQL} AS media, page_id AS crawl_seq, url, "
            f"coalesce({title}, '') AS title, coalesce({subtitle}, '') AS subtitle, {body} AS body, "
            f"published_at, {status} AS status "
            f"FROM (SELECT *, {PUBLISHED_SQL} AS published_at FROM pages)")


def _enrich_sql(src: str) -> str:
    places = ", ".join(f"CASE WHEN instr(body, {S.lit(p)}) > 0 THEN {S.lit(p)} END" for p in FLAGSHIP_PLACES)
    comunas = f"array_to_string(list_filter([{places}], lambda x: x IS NOT NULL), ', ')"
    return (f"SELECT page_id, title, subtitle, body, published_at, media, url, "
            f"{S.normalize_text('title')} AS clean_title, {S.normalize_text('subtitle')} AS clean_subtitle, "
            f"{S.normalize_text('body')} AS clean_body, {comunas} AS comunas, '' AS category_1, "
            f"'' AS category_2, {S.keyphrase_flag('body')} AS gore, "
            f"CASE WHEN body IS NOT NULL THEN 'NEU' END AS sentiment, "
            f"CASE WHEN body IS NOT NULL THEN CAST(0.5 AS DOUBLE) END AS pos, CASE WHEN body IS NOT NULL THEN CAST(0.5 AS DOUBLE) END AS neu, "
            f"CASE WHEN body IS NOT NULL THEN CAST(0.5 AS DOUBLE) END AS neg FROM {src}")


FLAGSHIP_ROWS_SQL = (
    f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY media ORDER BY crawl_seq, page_id) AS rn "
    f"FROM ({_extract_sql()}) WHERE status = 'parsed') "
    f"WHERE rn <= 100 AND {S.is_fresh('published_at', AS_OF_PAGES)})")
FLAGSHIP_SQL = _enrich_sql(FLAGSHIP_ROWS_SQL)
register("flagship", FLAGSHIP_SQL)(flagship)
EVERY_SQL = _enrich_sql(f"(SELECT * FROM ({_extract_sql()}) WHERE status = 'parsed')")
register("enrich_all", EVERY_SQL)(every_article)


@register("sink_projection", "SELECT " + ", ".join(A.ARTICLE_COLUMNS) + f" FROM ({EVERY_SQL})")
def sink_projection(spark, sf):
    """K2: the 17 sink columns in table order."""
    from inkline.sources.sinks import sink_projection as proj
    return proj(every_article(spark, sf))


@register("csv_projection",
          "SELECT page_id, title, subtitle, body, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS date, media, url, "
          "comunas, category_1, CAST(NULL AS VARCHAR) AS pred_1, category_2, CAST(NULL AS VARCHAR) AS pred_2 "
          f"FROM ({EVERY_SQL})")
def csv_projection(spark, sf):
    """K1: the CSV column list (pred_1/pred_2 always empty), all text."""
    from inkline.sources.sinks import csv_projection as proj
    return proj(every_article(spark, sf), key="page_id")


@register("schema_conform",
          "SELECT page_id, title, subtitle, body, published_at, media, url, "
          "CAST(NULL AS VARCHAR) AS clean_title, CAST(NULL AS VARCHAR) AS clean_subtitle, "
          "CAST(NULL AS VARCHAR) AS clean_body, CAST(NULL AS VARCHAR) AS comunas, "
          "CAST(NULL AS VARCHAR) AS category_1, CAST(NULL AS VARCHAR) AS category_2, CAST(NULL AS INTEGER) AS gore, "
          "CAST(NULL AS VARCHAR) AS sentiment, CAST(NULL AS DOUBLE) AS pos, CAST(NULL AS DOUBLE) AS neu, "
          f"CAST(NULL AS DOUBLE) AS neg FROM ({_extract_sql()}) WHERE status = 'parsed'")
def schema_conform(spark, sf):
    """Extracted rows forced into the article schema (missing fields typed NULL)."""
    from inkline.sources.tables import conform_articles
    return conform_articles(P.parsed(dated_pages(spark, sf), DRIVER_PAGES), key="page_id")


@register("page_scan", "SELECT page_id, url, html FROM pages")
def page_scan(spark, sf):
    """The page table as (page_id, url, html)."""
    from inkline.sources.tables import read_pages
    return read_pages(spark, f"{sf.rstrip('/')}/pages.parquet")


# ---------------------------------------------------------- extraction ---

FIRST_H1_SQL = (f"regexp_extract({S.rr(S.rr(S._parts(S._prepare(S.all_blocks('html', O.open_tag_re('h1'), O.close_tag_re('h1')) + '[1]'), ()), O.MARK_RUN_RE, O.MARK), '^' + O.MARK)}, "
                f"'^([^{O.MARK}]*)', 1)")


@register("extract_title", f"SELECT page_id, {S.h1_title('html')} AS title, nullif({FIRST_H1_SQL}, '') AS title_first FROM pages")
def extract_title(spark, sf):
    """E1 (all h1 text nodes, cleaned) and E2 (the first text node of the first h1, as it is)."""
    return table(spark, sf, "pages").select("page_id", H.h1_title(F.col("html")).alias("title"),
                                            H.h1_title_strict(F.col("html")).alias("title_first"))


@register("extract_subtitle", f"SELECT page_id, {S.clean_text(S.first_p_all(container_sql()))} AS subtitle FROM pages")
def extract_subtitle(spark, sf):
    """E4 on the driver pages: string value of the first paragraph of the article."""
    f = P.TextField("first_p_all", region=ARTICLE)
    return table(spark, sf, "pages").select("page_id", f.column(F.col("html")).alias("subtitle"))


@register("extract_meta", f"SELECT page_id, {S.tag_attr('html', 'meta', 'charset')} AS charset FROM pages")
def extract_meta(spark, sf):
    """E5: attribute of a <meta> tag (charset on the driver pages)."""
    return table(spark, sf, "pages").select("page_id", H.tag_attr(F.col("html"), "meta", "charset").alias("charset"))


@register("extract_attr", f"SELECT page_id, {S.tag_attr('html', 'html', 'lang')} AS lang FROM pages")
def extract_attr(spark, sf):
    """Element attribute (<html lang>)."""
    return table(spark, sf, "pages").select("page_id", H.tag_attr(F.col("html"), "html", "lang").alias("lang"))


@register("extract_container", f"SELECT page_id, {container_sql()} AS container FROM pages")
def extract_container(spark, sf):
    """The article container's inner HTML."""
    return table(spark, sf, "pages").select("page_id", container_col().alias("container"))


@register("paragraphs",
          f"SELECT page_id, unnest(generate_series(0, len(ps) - 1)) AS pos, unnest(ps) AS paragraph "
          f"FROM (SELECT page_id, {S.paragraphs(container_sql(), DRIVER_PAGES.paragraphs)} AS ps FROM pages)")
def paragraphs(spark, sf):
    """One row per paragraph, in document order."""
    return table(spark, sf, "pages").select(
        "page_id", F.posexplode(H.paragraphs(container_col(), DRIVER_PAGES.paragraphs)).alias("pos", "paragraph"))


STRONG = H.ParagraphSpec("p", None, ("a", "strong"))
B = H.ParagraphSpec("p", None, ("a", "b"))


@register("inline_text_strong", f"SELECT page_id, {S.body_text(container_sql(), STRONG)} AS body FROM pages")
def inline_text_strong(spark, sf):
    """E10 with keep-set a, strong (the unclosed <b> paragraph is dropped)."""
    return table(spark, sf, "pages").select("page_id", H.body_text(container_col(), STRONG).alias("body"))


@register("inline_text_b", f"SELECT page_id, {S.body_text(container_sql(), B)} AS body FROM pages")
def inline_text_b(spark, sf):
    """E10 with keep-set a, b."""
    return table(spark, sf, "pages").select("page_id", H.body_text(container_col(), B).alias("body"))


@register("body_space_joined", f"SELECT page_id, {S.body_text(container_sql(), B, 'space', False)} AS body FROM pages")
def body_space_joined(spark, sf):
    """Paragraphs joined by a space, stripped, no newline deletion."""
    return table(spark, sf, "pages").select("page_id", H.body_text(container_col(), B, "space", False).alias("body"))


@register("body_glued", f"SELECT page_id, {S.body_text(container_sql(), B, 'glued')} AS body FROM pages")
def body_glued(spark, sf):
    """E12b + E13: newline join deleted by clean_text, so paragraphs touch."""
    return table(spark, sf, "pages").select("page_id", H.body_text(container_col(), B, "glued").alias("body"))


@register("extract_content", f"SELECT page_id, {S.extract_content(container_sql())} AS content FROM pages")
def extract_content(spark, sf):
    """All descendant text per paragraph, newline-joined."""
    return table(spark, sf, "pages").select("page_id", H.extract_content(container_col()).alias("content"))


@register("remove_nodes", f"SELECT page_id, {S.remove_first(S.remove_first('html', 'nav'), 'footer')} AS html FROM pages")
def remove_nodes(spark, sf):
    """Delete the first <nav> and the first <footer>."""
    h = H.remove_first(H.remove_first(F.col("html"), "nav"), "footer")
    return table(spark, sf, "pages").select("page_id", h.alias("html"))


@register("clean_text", f"SELECT doc_id, {S.clean_text('text')} AS text FROM documents")
def clean_text(spark, sf):
    """E13 on documents: newlines deleted, stripped."""
    return table(spark, sf, "documents").select("doc_id", T.clean_text(F.col("text")).alias("text"))


@register("json_field", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_field(spark, sf):
    """A JSON field (events.props)."""
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


# --------------------------------------------------------------- links ---

def _links_sql(scope: str = "html", http_only: bool = True) -> str:
    """Distinct absolute http(s) links per page (set semantics)."""
    hrefs = f"regexp_extract_all({scope}, {S.lit(O.ANCHOR_HREF_RE)}, 1)"
    inner = (f"SELECT page_id, page_id AS crawl_seq, url AS src_url, "
             f"{S.decode_entities(S.resolve('url', 'h'))} AS dst_url "
             f"FROM (SELECT page_id, url, unnest({hrefs}) AS h FROM pages)")
    where = f"WHERE {S.is_http('dst_url')}" if http_only else ""
    return f"SELECT DISTINCT page_id, crawl_seq, src_url, dst_url FROM ({inner}) {where}"


NAV_SCOPE_SQL = f"array_to_string({S.all_blocks('html', *O.NAV)}, ' ')"


def page_links(spark, sf) -> DataFrame:
    return LK.extract_links(table(spark, sf, "pages"))


def nav_links(spark, sf) -> DataFrame:
    return LK.extract_links(table(spark, sf, "pages"), region=NAV)


@register("link_extract", f"SELECT page_id, dst_url FROM ({_links_sql()})")
def link_extract(spark, sf):
    """L1: distinct absolute links of every page."""
    return LK.extract_links(table(spark, sf, "pages")).select("page_id", "dst_url")


@register("link_absolute",
          f"SELECT page_id, h AS href, {S.resolve('url', 'h')} AS abs_url "
          f"FROM (SELECT page_id, url, unnest(regexp_extract_all(html, {S.lit(O.ANCHOR_HREF_RE)}, 1)) AS h FROM pages)")
def link_absolute(spark, sf):
    """Every raw href next to its absolute form."""
    pages = table(spark, sf, "pages")
    return (pages.select("page_id", "url", F.explode(LK.hrefs(F.col("html"))).alias("href"))
            .select("page_id", "href", U.resolve(F.col("url"), F.col("href")).alias("abs_url")))


@register("link_region", f"SELECT page_id, dst_url FROM ({_links_sql(NAV_SCOPE_SQL)})")
def link_region(spark, sf):
    """L2: links inside the <nav> region only."""
    return nav_links(spark, sf).select("page_id", "dst_url")


def _any_sql(col: str, pats) -> str:
    return "(" + " OR ".join(S.rlike(col, p) for p in pats) + ")"


@register("link_allow_deny",
          f"SELECT page_id, dst_url FROM ({_links_sql()}) "
          f"WHERE {_any_sql('dst_url', ALLOW)} AND NOT {_any_sql('dst_url', DENY)}")
def link_allow_deny(spark, sf):
    """L3 + L4: allow patterns (search), deny wins."""
    return page_links(spark, sf).filter(LK.allow_deny(F.col("dst_url"), ALLOW, DENY)).select("page_id", "dst_url")


def _route_sql() -> str:
    cases = []
    for i, r in enumerate(RULES):
        cond = _any_sql("dst_url", r.allow) if r.allow else "true"
        if r.deny:
            cond += f" AND NOT {_any_sql('dst_url', r.deny)}"
        cases.append(f"WHEN {cond} THEN {i}")
    rid = "CASE " + " ".join(cases) + " END"
    item = "CASE " + " ".join(f"WHEN rule_id = {i} THEN {int(r.is_item)}" for i, r in enumerate(RULES)) + " END"
    fol = "CASE " + " ".join(f"WHEN rule_id = {i} THEN {int(r.follow)}" for i, r in enumerate(RULES)) + " END"
    return (f"SELECT page_id, dst_url, rule_id, {item} AS is_item, {fol} AS follow FROM "
            f"(SELECT page_id, dst_url, {rid} AS rule_id FROM ({_links_sql()})) "
            f"WHERE rule_id IS NOT NULL")


@register("link_route", _route_sql())
def link_route(spark, sf):
    """First matching rule claims a link; item / follow flags (as 0/1)."""
    r = LK.route(page_links(spark, sf), RULES)
    return r.select("page_id", "dst_url", "rule_id", F.col("is_item").cast("int").alias("is_item"),
                    F.col("follow").cast("int").alias("follow"))


@register("link_offsite",
          f"SELECT page_id, dst_url FROM ({_links_sql()}) WHERE {S.on_domains(S.host('dst_url'), DOMAINS)}")
def link_offsite(spark, sf):
    """Links on example.com or its sub-domains."""
    links = LK.extract_links(table(spark, sf, "pages"))
    return LK.offsite_filter(links, DOMAINS).select("page_id", "dst_url")


@register("url_dedup",
          f"SELECT canon_url, min(crawl_seq) AS first_seq, arg_min(page_id, crawl_seq) AS first_page_id, "
          f"arg_min(dst_url, [crawl_seq, page_id]) AS first_url, count(*) AS n_seen "
          f"FROM (SELECT *, {S.canonical('dst_url')} AS canon_url FROM ({_links_sql()})) GROUP BY canon_url")
def url_dedup(spark, sf):
    """One row per canonical URL, first seen in crawl order."""
    return LK.dedup_urls(LK.extract_links(table(spark, sf, "pages")))


# The driver's pages link to words on their own host, where no page lives.  For
# the crawl, a page lives where the last link of its <nav> points, without the
# sub-domain, so that pages reach each other over several steps.

def crawl_pages(spark, sf) -> DataFrame:
    pages = table(spark, sf, "pages")
    domain = F.regexp_extract(F.col("url"), r"^[a-z]+://(?:[^/]*[.])?(example[.][a-z]+)/", 1)
    host = F.concat(F.lit("https://"), domain)
    last = F.element_at(LK.hrefs(LK.region_html(F.col("html"), NAV)), -1)
    return pages.select("page_id", F.concat(host, last).alias("url"), "html")


CRAWL_SQL = (f"(SELECT page_id, 'https://' || regexp_extract(url, '^[a-z]+://(?:[^/]*[.])?(example[.][a-z]+)/', 1) || "
             f"list_extract(regexp_extract_all({NAV_SCOPE_SQL}, {S.lit(O.ANCHOR_HREF_RE)}, 1), -1) AS url, html FROM pages)")
CRAWL_LINKS_SQL = _links_sql().replace("FROM pages", f"FROM {CRAWL_SQL}")


@register("frontier_anti_join",
          f"SELECT page_id, dst_url, canon_url FROM (SELECT *, {S.canonical('dst_url')} AS canon_url "
          f"FROM ({CRAWL_LINKS_SQL})) WHERE canon_url NOT IN (SELECT {S.canonical('url')} FROM {CRAWL_SQL})")
def frontier_anti_join(spark, sf):
    """Extracted links not yet visited (anti join on the canonical URL)."""
    pages = crawl_pages(spark, sf)
    return LK.frontier(LK.extract_links(pages), pages).select("page_id", "dst_url", "canon_url")


CLOSURE_RULES = (LK.LinkRule(allow=(r"/[A-Z][^/]*$",), deny=(r"/(The|Les|Der|Las)$",), is_item=True, follow=False),
                 LK.LinkRule(follow=True))


@register("link_closure",
          f"WITH RECURSIVE pg AS (SELECT page_id, {S.canonical('url')} AS u, url FROM {CRAWL_SQL}), "
          f"e AS (SELECT DISTINCT {S.canonical('src_url')} AS src, {S.canonical('dst_url')} AS dst, "
          f"NOT {_any_sql('dst_url', (r'/[A-Z][^/]*$',))} OR {_any_sql('dst_url', (r'/(The|Les|Der|Las)$',))} AS follow FROM ({CRAWL_LINKS_SQL})), "
          "r AS (SELECT DISTINCT u, true AS follow, 0 AS depth FROM pg WHERE page_id IN (SELECT page_id FROM pages WHERE contains(url, '/es/')) "
          "UNION SELECT e.dst, e.follow, r.depth + 1 FROM r JOIN e ON e.src = r.u WHERE r.follow AND r.depth < 40) "
          "SELECT r.u AS canon_url, CAST(min(r.depth) AS INTEGER) AS depth, min(pg.page_id) AS page_id FROM r LEFT JOIN pg USING (u) GROUP BY r.u")
def link_closure(spark, sf):
    """Everything that links reach from the Spanish pages, item links included, to the empty frontier."""
    pages = crawl_pages(spark, sf)
    seeds = pages.join(table(spark, sf, "pages").filter(F.col("url").contains("/es/")).select("page_id"), "page_id", "left_semi").select("url")
    return LK.crawl_closure(pages, seeds, rules=CLOSURE_RULES)


HOST_PROFILES = {m: DRIVER_PAGES.with_(media=m, media_expr=None, hosts=(d,)) for d, m in HOSTS if m != "dotorg"}


@register("route_by_host",
          "SELECT page_id, CASE WHEN regexp_matches(url, '^[a-z]+://([^/]*[.])?example[.]com/') THEN 'dotcom' "
          "WHEN regexp_matches(url, '^[a-z]+://([^/]*[.])?example[.]net/') THEN 'dotnet' END AS media, "
          "CASE WHEN regexp_matches(url, '^[a-z]+://([^/]*[.])?example[.](com|net)/') THEN 'parsed' ELSE 'rejected' END AS status, "
          "CASE WHEN regexp_matches(url, '^[a-z]+://([^/]*[.])?example[.](com|net)/') THEN NULL ELSE 'unknown_host' END AS reason FROM pages")
def route_by_host(spark, sf):
    """A page's source by its host; pages of unknown hosts (here .org) stay, with a reason."""
    return P.judged(dated_pages(spark, sf), HOST_PROFILES).select("page_id", "media", "status", "reason")


# ------------------------------------------------------------- filters ---

@register("url_filters",
          "SELECT page_id, url FROM pages WHERE contains(url, '/en/') AND NOT contains(url, '#top')")
def url_filters(spark, sf):
    """P1 + P2: URL must contain '/en/' and must not contain '#top'."""
    return (table(spark, sf, "pages").filter(F.col("url").contains("/en/") & ~F.col("url").contains("#top"))
            .select("page_id", "url"))


@register("page_guards",
          f"SELECT page_id FROM pages WHERE {S.h1_title('html')} <> '' AND regexp_matches(html, '<p>[^<]*</p>\\s*<p>')")
def page_guards(spark, sf):
    """P3 + P4: a non-empty title and a container (here a plain paragraph that another one follows)."""
    box = P.Region(r"(?i:<p>)(?=[^<]*</p>\s*<p>)", "p")
    return (table(spark, sf, "pages")
            .filter((H.h1_title(F.col("html")) != "") & box.column(F.col("html")).isNotNull()).select("page_id"))


# one language for each way a page can fail: English by its URL alone, German without a container,
# French without a title, Spanish with a date that is none
REASON_PROFILES = {
    "en": DRIVER_PAGES.with_(url_not_contains="#top"),
    "de": DRIVER_PAGES.with_(container=P.Region(H.open_tag_re("section"), "section")),
    "fr": DRIVER_PAGES.with_(title=P.TextField("meta", "og:title", on_missing="reject")),
    "es": DRIVER_PAGES.with_(date=P.DateField("column", "url", "date10")),
}
REASON_SQL = ("(SELECT page_id, " + MEDIA_SQL + " AS media, url, CASE " + MEDIA_SQL +
              " WHEN 'en' THEN CASE WHEN contains(url, '#top') THEN 'url_excluded' END WHEN 'de' THEN 'no_container' "
              "WHEN 'fr' THEN 'no_title' ELSE 'bad_date' END AS reason FROM pages)")
STATUS_SQL = "CASE WHEN reason IS NULL THEN 'parsed' WHEN reason IN ('url_excluded', 'no_container') THEN 'filtered' ELSE 'rejected' END"


def reasons(spark, sf) -> DataFrame:
    pages = dated_pages(spark, sf).withColumn("media", F.expr(PAGES_MEDIA_EXPR))
    return P.judged(pages, REASON_PROFILES, with_media=False)


@register("rejects_by_reason", f"SELECT page_id, media, url, {STATUS_SQL} AS status, reason FROM {REASON_SQL} WHERE reason IS NOT NULL")
def rejects_by_reason(spark, sf):
    """Pages that are no article, with their reason; each reason and both outcomes occur."""
    return reasons(spark, sf).filter("status <> 'parsed'").select("page_id", "media", F.col("page_url").alias("url"), "status", "reason")


@register("source_counts",
          f"SELECT media, count(*) AS n_rows, count(*) FILTER (s = 'parsed') AS n_parsed, count(*) FILTER (s = 'filtered') AS n_filtered, "
          f"count(*) FILTER (s = 'rejected') AS n_rejected FROM (SELECT *, {STATUS_SQL} AS s FROM {REASON_SQL}) GROUP BY media")
def source_counts(spark, sf):
    """Rows, parsed, filtered, rejected per source."""
    return L.source_counts(reasons(spark, sf))


@register("recency", f"SELECT event_id, ts FROM events WHERE {S.is_fresh('ts', AS_OF_EVENTS)}")
def recency(spark, sf):
    """P5: kept iff younger than 48 h at as_of (future kept); pushed to the scan."""
    return table(spark, sf, "events").filter(D.is_fresh(F.col("ts"), AS_OF_EVENTS)).select("event_id", "ts")


@register("keyphrase_flag", f"SELECT doc_id, {S.keyphrase_flag('text', FREQUENT_PHRASES)} AS flag FROM documents")
def keyphrase_flag(spark, sf):
    """Any-of phrase test on lower-cased text (frequent words as phrases)."""
    return table(spark, sf, "documents").select("doc_id", T.keyphrase_flag(F.col("text"), FREQUENT_PHRASES).alias("flag"))


# --------------------------------------------------------- dates (events) ---

def ev_ts_z() -> Column:
    return F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(F.col("value") < 5, F.lit("")).otherwise(
                        F.concat(F.lit("."), F.date_format("ts", "SSS"), F.lit("Z"))))
EV_TS_Z_SQL = ("(strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN value < 5 THEN '' ELSE "
               "'.' || strftime(ts, '%g') || 'Z' END)")


@register("parse_ts_z", f"SELECT event_id, {EV_TS_Z_SQL} AS raw, {S.parse_ts_z(EV_TS_Z_SQL)} AS parsed FROM events")
def parse_ts_z(spark, sf):
    """ISO with fraction and Z; the fraction-less texts are rejected (NULL)."""
    return table(spark, sf, "events").select("event_id", ev_ts_z().alias("raw"), D.parse_ts_z(ev_ts_z()).alias("parsed"))


def ev_off() -> Column:
    return F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(F.col("value") < 2, F.lit("")).when(F.col("value") < 40, F.lit("-03:00"))
                    .otherwise(F.lit("+0530")))
EV_OFF_SQL = ("(strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN value < 2 THEN '' WHEN value < 40 THEN '-03:00' "
              "ELSE '+0530' END)")


@register("parse_ts_offset", f"SELECT event_id, {EV_OFF_SQL} AS raw, {S.parse_ts_offset(EV_OFF_SQL)} AS parsed FROM events")
def parse_ts_offset(spark, sf):
    """ISO with an offset, wall clock kept; no offset -> rejected."""
    return table(spark, sf, "events").select("event_id", ev_off().alias("raw"), D.parse_ts_offset(ev_off()).alias("parsed"))


def ev_iso() -> Column:
    return F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
EV_ISO_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%S')"


@register("parse_date10", f"SELECT event_id, {S.parse_date10(EV_ISO_SQL)} AS parsed FROM events")
def parse_date10(spark, sf):
    """D3: first ten characters as a date."""
    return table(spark, sf, "events").select("event_id", D.parse_date10(ev_iso()).alias("parsed"))


def ev_fb() -> Column:
    dmy = F.concat_ws("-", F.dayofmonth("ts").cast("string"), F.month("ts").cast("string"),
                      F.year("ts").cast("string"))
    return (F.when(F.col("value") >= 30, dmy).when(F.col("value") < 1, F.lit("garbage"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd")))
EV_FB_SQL = ("(CASE WHEN value >= 30 THEN CAST(day(ts) AS VARCHAR) || '-' || CAST(month(ts) AS VARCHAR) || '-' || "
             "CAST(year(ts) AS VARCHAR) WHEN value < 1 THEN 'garbage' ELSE strftime(ts, '%Y-%m-%d') END)")


@register("parse_date_fallback",
          f"SELECT event_id, {EV_FB_SQL} AS raw, {S.parse_date_fallback(EV_FB_SQL)} AS parsed FROM events")
def parse_date_fallback(spark, sf):
    """ISO date, else D-M-Y (one-digit day/month accepted), garbage rejected."""
    return table(spark, sf, "events").select("event_id", ev_fb().alias("raw"), D.parse_date_fallback(ev_fb()).alias("parsed"))


@register("parse_date_parts",
          "SELECT event_id, " + S.parse_date_parts("CAST(year(ts) AS VARCHAR)", "CAST(month(ts) AS VARCHAR)",
                                                   "CAST(day(ts) AS VARCHAR)") + " AS parsed FROM events")
def parse_date_parts(spark, sf):
    """Year, month, day attributes assembled with '-'."""
    y, m, d = (F.year("ts").cast("string"), F.month("ts").cast("string"), F.dayofmonth("ts").cast("string"))
    return table(spark, sf, "events").select("event_id", D.parse_date_parts(y, m, d).alias("parsed"))


@register("format_ts", f"SELECT event_id, {S.format_ts('ts')} AS date FROM events")
def format_ts(spark, sf):
    """D6: '%Y-%m-%d %H:%M:%S'."""
    return table(spark, sf, "events").select("event_id", D.format_ts(F.col("ts")).alias("date"))


@register("age_days", f"SELECT event_id, {S.age_days('ts', AS_OF_EVENTS)} AS age FROM events")
def age_days(spark, sf):
    """Whole days of age, floored (future -> negative)."""
    return table(spark, sf, "events").select("event_id", D.age_days(F.col("ts"), AS_OF_EVENTS).alias("age"))


# ------------------------------------------------------- windows (events) ---

def listing(spark, sf) -> DataFrame:
    """Events as a crawl: media = event_type, newest first (crawl_seq = -event_id)."""
    ev = table(spark, sf, "events")
    return ev.select("event_id", F.col("event_type").alias("media"), (-F.col("event_id")).alias("crawl_seq"),
                     F.col("ts").alias("published_at"), "value", "user_id")


LISTING_SQL = ("(SELECT event_id, event_type AS media, -event_id AS crawl_seq, ts AS published_at, value, user_id "
               "FROM events)")
CAPS_SQL = "CASE " + " ".join(f"WHEN media = {S.lit(m)} THEN {c}" for m, c in EVENT_CAPS.items()) + " END"


@register("source_cap",
          f"SELECT event_id, media, rn FROM (SELECT *, row_number() OVER (PARTITION BY media ORDER BY crawl_seq) AS rn "
          f"FROM {LISTING_SQL}) WHERE rn <= {CAPS_SQL}")
def source_cap(spark, sf):
    """First N rows per source in crawl order (N per source)."""
    return L.source_cap(listing(spark, sf), EVENT_CAPS, tiebreak="event_id").select("event_id", "media", "rn")


@register("cap_then_recency",
          f"SELECT event_id, media FROM (SELECT *, row_number() OVER (PARTITION BY media ORDER BY crawl_seq) AS rn "
          f"FROM {LISTING_SQL}) WHERE rn <= {CAPS_SQL} AND {S.is_fresh('published_at', AS_OF_EVENTS_LATE)}")
def cap_then_recency(spark, sf):
    """The cap counts stale rows; recency filters afterwards."""
    fresh = D.is_fresh(F.col("published_at"), AS_OF_EVENTS_LATE)
    return L.cap_then_recency(listing(spark, sf), EVENT_CAPS, fresh).select("event_id", "media")


PREFIX_SEQ_SQL = "(user_id * 100000000 + event_id)"


@register("prefix_stop",
          f"WITH l AS (SELECT event_id, event_type AS media, {PREFIX_SEQ_SQL} AS crawl_seq, ts FROM events), "
          f"f AS (SELECT media, min(crawl_seq) AS fs FROM l WHERE NOT {S.is_fresh('ts', AS_OF_PREFIX)} GROUP BY media) "
          f"SELECT event_id, l.media FROM l LEFT JOIN f USING (media) WHERE fs IS NULL OR crawl_seq < fs")
def prefix_stop(spark, sf):
    """Per source, rows before the first stale one (crawl order = user, then id)."""
    ev = table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("media"),
        (F.col("user_id") * 100000000 + F.col("event_id")).alias("crawl_seq"), "ts")
    return L.prefix_stop(ev, ~D.is_fresh(F.col("ts"), AS_OF_PREFIX)).select("event_id", "media")


@register("twin_cap",
          f"SELECT event_id, media, response_no, item_no FROM (SELECT *, row_number() OVER "
          f"(PARTITION BY media ORDER BY crawl_seq) AS item_no FROM (SELECT *, row_number() OVER "
          f"(PARTITION BY media ORDER BY crawl_seq) AS response_no FROM {LISTING_SQL}) "
          f"WHERE response_no <= 50 AND value >= 20) WHERE item_no <= 30")
def twin_cap(spark, sf):
    """At most 50 rows received and 30 items (value >= 20) per source."""
    out = L.twin_cap(listing(spark, sf), 50, 30, F.col("value") >= 20)
    return out.select("event_id", "media", "response_no", "item_no")


# ---------------------------------------------------------- text (documents) ---

@register("normalize_text", f"SELECT doc_id, {S.normalize_text('text')} AS clean_text FROM documents")
def normalize_text(spark, sf):
    """Lower, tokenise, alphabetic tokens, stopwords out, space-joined."""
    return table(spark, sf, "documents").select("doc_id", T.normalize_text(F.col("text")).alias("clean_text"))


@register("alpha_tokens",
          f"SELECT doc_id, array_to_string({S.alpha_tokens('text')}, ' ') AS tokens, "
          f"CAST(len({S.alpha_tokens('text')}) AS INTEGER) AS n_tokens FROM documents")
def alpha_tokens(spark, sf):
    """Purely alphabetic tokens (``covid-19``, ``gob.cl`` vanish whole)."""
    toks = T.alpha_tokens(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.array_join(toks, " ").alias("tokens"),
                                                F.size(toks).alias("n_tokens"))


@register("stopword_removal",
          f"SELECT doc_id, array_to_string({S.remove_stopwords(S.tokens('text'))}, ' ') AS words FROM documents")
def stopword_removal(spark, sf):
    """Stopwords removed from the token list, duplicates and order kept."""
    words = T.remove_stopwords(T.tokens(F.col("text")))
    return table(spark, sf, "documents").select("doc_id", F.array_join(words, " ").alias("words"))


@register("build_prompt", f"SELECT doc_id, {S.build_prompt('text')} AS prompt FROM documents")
def build_prompt(spark, sf):
    """T4 + T5: instruction + base + the first 7,500 characters."""
    return table(spark, sf, "documents").select("doc_id", T.build_prompt(F.col("text")).alias("prompt"))


ANSWER_SQL = ("(CASE WHEN source IN ('src1', 'src2') THEN 'Salud;Salud' "
              "WHEN source IN ('src3', 'src4') THEN 'Foo;Bar' "
              "WHEN lang = 'en' THEN 'Salud' WHEN lang = 'fr' THEN 'Movilidad; Salud' "
              "WHEN lang = 'de' THEN 'Foo;Deportes;Economía' WHEN source = 'src5' THEN NULL "
              "ELSE ' Política ' END)")


def answer_col() -> Column:
    """Classifier answers synthesised from lang and source, covering the T6 truth table."""
    return F.expr(ANSWER_SQL)


_C1, _C2 = S.parse_labels("answer")


@register("parse_labels",
          f"SELECT doc_id, answer, {_C1} AS category_1, {_C2} AS category_2 "
          f"FROM (SELECT doc_id, {ANSWER_SQL} AS answer FROM documents)")
def parse_labels(spark, sf):
    """First two labels, unknown -> Otro, repeated -> (A, NULL)."""
    docs = table(spark, sf, "documents").select("doc_id", answer_col().alias("answer"))
    lab = T.parse_labels(F.col("answer"))
    return docs.select("doc_id", "answer", lab["category_1"].alias("category_1"),
                       lab["category_2"].alias("category_2"))


@register("sentiment_default",
          "SELECT doc_id, CASE WHEN text IS NOT NULL THEN 'NEU' END AS sentiment, "
          "CASE WHEN text IS NOT NULL THEN CAST(0.5 AS DOUBLE) END AS pos, "
          "CASE WHEN text IS NOT NULL THEN CAST(0.5 AS DOUBLE) END AS neu, "
          "CASE WHEN text IS NOT NULL THEN CAST(0.5 AS DOUBLE) END AS neg FROM documents")
def sentiment_default(spark, sf):
    """The reference's stub scorer."""
    s = T.sentiment_default(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", s["sentiment"].alias("sentiment"), s["pos"].alias("pos"),
                                                s["neu"].alias("neu"), s["neg"].alias("neg"))


def _keyword_sql() -> str:
    """The stand-in classifier in SQL: keyword occurrences by length difference, the two best, ties in vocabulary order."""
    from inkline.operators.enrich import KEYWORDS
    low = "lower(text)"
    count = lambda k: f"(length({low}) - length(replace({low}, {S.lit(k)}, ''))) // {len(k)}"
    rows = ", ".join(f"{{'s': {' + '.join(map(count, KEYWORDS[c]))}, 'o': {-i}, 'c': {S.lit(c)}}}"
                     for i, c in enumerate(T.CATEGORIES) if c in KEYWORDS)
    best = f"list_reverse_sort(list_filter([{rows}], lambda x: x.s > 0))"
    return (f"SELECT doc_id, CASE WHEN text IS NULL THEN NULL WHEN len(b) = 0 THEN 'Otro' WHEN len(b) = 1 THEN b[1].c "
            f"ELSE b[1].c || ';' || b[2].c END AS answer FROM (SELECT doc_id, text, {best} AS b FROM documents)")


_K1, _K2 = S.parse_labels("answer")


@register("classify_default", f"SELECT doc_id, answer, {_K1} AS category_1, {_K2} AS category_2 FROM ({_keyword_sql()})")
def classify_default(spark, sf):
    """The pluggable batch classifier (deterministic keyword stand-in) on every whole text."""
    from inkline.operators.enrich import classify
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return classify(docs, "text").select("doc_id", "answer", "category_1", "category_2")


# ------------------------------------------------------------ dictionary ---

DICT_MATCH_SQL = ("SELECT d.doc_id, coalesce(m.matches, '') AS matches FROM documents d LEFT JOIN "
                  "(SELECT d.doc_id, string_agg(b.text, ', ' ORDER BY b.item_id) AS matches "
                  "FROM documents d JOIN benchmark b ON b.text <> '' AND instr(d.text, b.text) > 0 "
                  "GROUP BY d.doc_id) m USING (doc_id)")


def benchmark_terms(spark, sf) -> DataFrame:
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("ord"), F.col("text").alias("term"))


@register("dictionary_match", DICT_MATCH_SQL)
def dictionary_match(spark, sf):
    """T1 + T1b: benchmark passages found in each document, in item order (any dictionary size)."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return match_by_join(docs, benchmark_terms(spark, sf), out="matches")


@register("dictionary_match_join", DICT_MATCH_SQL)
def dictionary_match_join(spark, sf):
    """T1 in two steps: which terms each text holds, then the rows of that text."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return matches_of(docs, text_matches(docs, benchmark_terms(spark, sf)), out="matches")


@register("dictionary_pairs",
          "SELECT d.doc_id, b.item_id AS ord FROM documents d JOIN benchmark b "
          "ON b.text <> '' AND instr(d.text, b.text) > 0")
def dictionary_pairs(spark, sf):
    """(document, term) pairs, exact substring, via the aligned q-gram equi-join."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return match_pairs(docs, benchmark_terms(spark, sf)).select("doc_id", "ord")


def passage_words(spark, sf) -> DataFrame:
    """The distinct alphabetic words of the benchmark passages, as a dictionary or stopword table."""
    return table(spark, sf, "benchmark").select(F.explode(T.alpha_tokens(F.col("text"))).alias("word")).filter("word <> ''").distinct()


PASSAGE_WORDS_SQL = f"(SELECT DISTINCT w AS word FROM (SELECT unnest({S.alpha_tokens('text')}) AS w FROM benchmark) WHERE w <> '')"


@register("places_table",
          "SELECT d.doc_id, coalesce(m.comunas, '') AS comunas FROM documents d LEFT JOIN "
          "(SELECT d.doc_id, string_agg(p.word, ', ' ORDER BY p.word) AS comunas "
          f"FROM documents d JOIN {PASSAGE_WORDS_SQL} p ON length(p.word) >= 8 AND instr(d.text, p.word) > 0 GROUP BY d.doc_id) m USING (doc_id)")
def places_table(spark, sf):
    """S2 + T1: names from a table (the passages' words of eight letters and more), matched in every document as the article plan does."""
    places = passage_words(spark, sf).filter(F.length("word") >= 8).select(F.col("word").alias("ord"), F.col("word").alias("term"))
    return with_matches(table(spark, sf, "documents").select("doc_id", "text"), places, text="text").select("doc_id", "comunas")


@register("stopword_table",
          f"WITH sw AS (SELECT list(word) AS l FROM {PASSAGE_WORDS_SQL}) SELECT doc_id, "
          f"array_to_string(list_filter({S.alpha_tokens('text')}, lambda w: NOT list_contains(sw.l, w)), ' ') AS clean_text FROM documents, sw")
def stopword_table(spark, sf):
    """S3 + T2: normalised text of every document, with the stopwords from a table (the passages' words)."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return with_clean(docs, {"text": "clean_text"}, passage_words(spark, sf)).select("doc_id", "clean_text")


# ---------------------------------------------------------- sinks, union ---

@register("idempotent_append",
          "SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN "
          "(SELECT doc_id FROM documents WHERE lang = 'en')")
def idempotent_append(spark, sf):
    """K2 idempotent: of all documents, what a table that holds the English ones takes (``append_new`` twice on a real table)."""
    from inkline.sources.sinks import append_new
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    path = scratch_path(spark, f"documents/{uuid.uuid4().hex}")
    append_new(docs.filter(F.col("lang") == "en"), path, key="doc_id")
    return append_new(docs, path, key="doc_id")


COMPLETE_PROFILE = DRIVER_PAGES.with_(paragraphs=STRONG)


@register("require_complete",
          f"SELECT page_id FROM ({_extract_sql(STRONG)}) WHERE status = 'parsed' AND " + " AND ".join(
              f"coalesce(CAST({c} AS VARCHAR), '') <> ''" for c in ("title", "subtitle", "body", "published_at",
                                                                     "media", "url")))
def require_complete(spark, sf):
    """E19 (strict mode): articles whose required fields are all present and non-empty (pages of one bold paragraph have no body here)."""
    from inkline.plans.articles import require_complete as rc
    return rc(P.parsed(dated_pages(spark, sf), COMPLETE_PROFILE)).select("page_id")


UNION_PROFILES = {
    "en": DRIVER_PAGES.with_(paragraphs=STRONG),
    "de": DRIVER_PAGES.with_(paragraphs=STRONG, join="glued"),
    "fr": DRIVER_PAGES.with_(paragraphs=B),
    "es": DRIVER_PAGES.with_(paragraphs=B, join="glued"),
}


def _union_sql() -> str:
    parts = []
    for lang, prof in UNION_PROFILES.items():
        body = S.body_text(container_sql(), prof.paragraphs, prof.join)
        parts.append(f"SELECT page_id, {S.lit(lang)} AS media, {body} AS body FROM pages "
                     f"WHERE {MEDIA_SQL} = {S.lit(lang)}")
    return " UNION ALL ".join(parts)


@register("union_sources", _union_sql())
def union_sources(spark, sf):
    """All sources into one table: one scan, each page by its own source's keep-set and join."""
    pages = dated_pages(spark, sf).withColumn("media", F.expr(PAGES_MEDIA_EXPR))
    return P.parsed(pages, UNION_PROFILES, with_media=False).select("page_id", "media", "body")


# ------------------------------------------------------------- streaming ---

@register("stream_articles", EVERY_SQL)
def stream_articles(spark, sf):
    """The page table read as a stream (availableNow), same Columns as batch.

    The stream writes Parquet into the shared checkpoint folder; the result is
    read back in batch (nothing passes through the driver).
    """
    from inkline.streaming.articles import article_stream, read_page_stream, run_available
    path = f"{sf.rstrip('/')}/pages.parquet"
    pages = read_page_stream(spark, path, spark.read.parquet(path).schema).withColumn("published_at", published_at())
    out = article_stream(pages, DRIVER_PAGES, places=FLAGSHIP_PLACES)
    cols = ["page_id"] + list(A.ARTICLE_COLUMNS)
    result = run_available(out.select(*cols))
    return spark.read.parquet(result)
