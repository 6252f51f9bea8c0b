"""Link operators over a table of fetched pages.

Fetching is out of scope; given ``(page_id, url, html)`` rows these are
ordinary Spark jobs: a projection that lists anchors, filters on URL
patterns, an aggregate for dedup and joins for the crawl frontier.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkline.functions import html as H
from inkline.functions import urls as U
from inkline.functions.bits import bit_of, bit_places, word_of
from inkline.session import scratch_path

HREF_RE = f"(?i)<a\\s(?:[^>]*?\\s)?href\\s*=\\s*{H.VALUE_RE}"
#: Comments, scripts and styles hold no links.
NOT_MARKUP_RE = r"(?is)<!--.*?(?:-->|\z)|<(script|style)(?:[\s/][^>]*)?>.*?</\1\s*>"


def _unquoted(values: Column) -> Column:
    return F.transform(values, lambda v: F.regexp_replace(v, "^[\"']|[\"']\\z", ""))


def hrefs(scope: Column) -> Column:
    """Raw ``href`` values of every ``<a>`` in ``scope``, in document order, in all three quoting forms."""
    return _unquoted(F.regexp_extract_all(F.regexp_replace(scope, NOT_MARKUP_RE, ""), F.lit(HREF_RE), F.lit(1)))


def absolute_links(base: Column, found: Column) -> Column:
    """Absolute http(s) URLs of raw hrefs, duplicates removed, first order kept."""
    absolute = F.transform(found, lambda h: U.resolve(base, H.decode_entities(h)))
    return F.array_distinct(F.filter(absolute, lambda u: U.is_http(u)))


def page_links(base: Column, scope: Column) -> Column:
    """L1 + L1b: absolute http(s) links of a page or a part of it."""
    return absolute_links(base, hrefs(scope))


def blocks(html: Column, step: str) -> Column:
    """Inner HTML of every element ``tag`` or ``tag.class`` (the whole class attribute), each up to its own end."""
    tag, _, cls = step.partition(".")
    opens = H.class_exact_re(tag, cls) if cls else H.open_tag_re(tag)
    pieces = F.filter(F.split(html, f"(?={opens})"), lambda x: x.rlike(f"^{opens}"))
    return F.transform(pieces, lambda x: H.until_closed(F.regexp_replace(x, f"^{opens}", ""), tag))


def is_path(region: Sequence[str]) -> bool:
    """Whether steps name children, positions or ids, and not just elements within elements."""
    return any(s.startswith("/") or "#" in s or s.endswith("]") for s in region)


def region_html(html: Column, path: Sequence[str]) -> Column:
    """L2: what lies inside the elements of ``path``, one within the other; the elements themselves where the path names children (``H.path_elements``)."""
    if is_path(path):
        return F.array_join(H.path_elements(html, path), " ")
    html = F.regexp_replace(html, NOT_MARKUP_RE, "")
    for step in path:
        html = F.array_join(blocks(html, step), " ")
    return html


#: The first ``<base>`` that has an address.
BASE_RE = f"(?i)<base\\s(?:[^>]*?\\s)?href\\s*=\\s*{H.VALUE_RE}"


def base_url(url: Column, html: Column) -> Column:
    """What a page's links are relative to, its address or its ``<base href>`` (relative to that in turn)."""
    raw = F.regexp_extract(F.regexp_replace(html, NOT_MARKUP_RE, ""), BASE_RE, 1)
    href = H.decode_entities(F.regexp_replace(raw, "^[\"']|[\"']\\z", ""))
    # pages without the tag, nearly all, are told by a plain search
    return F.when(F.lower(html).contains("<base") & (raw != ""), U.resolve(url, href)).otherwise(url)


def extract_links(pages: DataFrame, region: Sequence[str] = (), crawl_seq: str | None = None) -> DataFrame:
    """L1 / L2: one row per (page, distinct absolute link), of the whole page or of a region (``region_html``)."""
    scope = region_html(F.col("html"), region) if region else F.col("html")
    seq = F.col(crawl_seq) if crawl_seq else F.col("page_id")
    return pages.select(
        "page_id", seq.cast("bigint").alias("crawl_seq"), F.col("url").alias("src_url"),
        F.posexplode(page_links(base_url(F.col("url"), F.col("html")), scope)).alias("pos", "dst_url"))


def any_match(c: Column, patterns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.rlike(p) for p in patterns])


def allow_deny(c: Column, allow: Sequence[str] = (), deny: Sequence[str] = ()) -> Column:
    """L3 + L4: some allow pattern is found (none = all) and no deny pattern; deny wins."""
    ok = any_match(c, allow) if allow else F.lit(True)
    if deny:
        ok = ok & ~any_match(c, deny)
    return ok


@dataclass(frozen=True)
class LinkRule:
    """One crawl rule: patterns, where in the page, and what a matching link is for."""

    allow: tuple[str, ...] = ()
    deny: tuple[str, ...] = ()
    is_item: bool = False    # has a callback (parse as an article)
    follow: bool = True      # extract links from it in turn
    region: tuple[str, ...] = ()        # elements that enclose the link (``region_html``)
    anchor_class: str | None = None     # the class attribute of the link itself

    def links(self, base: Column, html: Column) -> Column:
        """The links of a page that the rule's place and patterns allow."""
        if self.region:
            html = region_html(html, self.region)
        if self.anchor_class:
            tags = F.regexp_extract_all(F.regexp_replace(html, NOT_MARKUP_RE, ""), F.lit(H.class_exact_re("a", self.anchor_class)), F.lit(0))
            found = absolute_links(base, F.flatten(F.transform(tags, hrefs)))
        else:
            found = page_links(base, html)
        return F.filter(found, lambda u: allow_deny(u, self.allow, self.deny))

    def claim(self, number: int) -> Callable[[Column], Column]:
        return lambda u: F.struct(u.alias("dst_url"), F.lit(number).alias("rule_id"), F.lit(self.is_item).alias("is_item"), F.lit(self.follow).alias("follow"))


def rule_links(base: Column, html: Column, rules: Sequence[LinkRule]) -> Column:
    """L5 with regions: the page's links as (dst_url, rule_id, is_item, follow); the first rule that finds a link has it."""
    out, before = [], F.array().cast("array<string>")
    for i, rule in enumerate(rules):
        own = F.array_except(rule.links(base, html), before)
        before = F.concat(before, own)
        out.append(F.transform(own, rule.claim(i)))
    return F.concat(*out) if out else F.array().cast("array<struct<dst_url:string,rule_id:int,is_item:boolean,follow:boolean>>")


def route(links: DataFrame, rules: Sequence[LinkRule], url: str = "dst_url") -> DataFrame:
    """The first matching rule (list order) claims a link; unclaimed links are dropped."""
    rid = F.lit(None).cast("int")
    for i, r in reversed(list(enumerate(rules))):
        rid = F.when(allow_deny(F.col(url), r.allow, r.deny), F.lit(i)).otherwise(rid)
    item = F.lit(None).cast("boolean")
    follow = F.lit(None).cast("boolean")
    for i, r in enumerate(rules):
        item = F.when(F.col("rule_id") == i, F.lit(r.is_item)).otherwise(item)
        follow = F.when(F.col("rule_id") == i, F.lit(r.follow)).otherwise(follow)
    return (links.withColumn("rule_id", rid).filter(F.col("rule_id").isNotNull())
            .withColumn("is_item", item).withColumn("follow", follow))


def offsite_filter(links: DataFrame, domains: Sequence[str] | None, url: str = "dst_url") -> DataFrame:
    """Keep links on the allowed domains or their sub-domains (None = keep all)."""
    return links.filter(U.on_domains(U.host(F.col(url)), domains))


def dedup_urls(links: DataFrame, url: str = "dst_url", order: str = "crawl_seq") -> DataFrame:
    """One row per canonical URL, the first seen in crawl order.

    An aggregate (``min`` of a struct) rather than a window: partial
    aggregation collapses copies inside each map task, so a URL that holds a
    third of all rows costs one row per task in the shuffle.
    """
    first = F.min(F.struct(F.col(order), F.col("page_id"), F.col(url)))
    return (links.withColumn("canon_url", U.canonical(F.col(url)))
            .groupBy("canon_url").agg(first.alias("_f"), F.count(F.lit(1)).alias("n_seen"))
            .select("canon_url", F.col("_f")[order].alias("first_seq"),
                    F.col("_f")["page_id"].alias("first_page_id"), F.col("_f")[url].alias("first_url"),
                    "n_seen"))


#: Visited URLs up to so many are broadcast; the bits of a filter at most (8 MB).
BROADCAST_URLS = 100_000
FILTER_BITS = 1 << 26


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}/{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bit_array(keys: DataFrame, key: str, bits: int) -> bytes:
    """The bit array of all keys.  Words of 64 bits are combined map-side, so at most ``bits`` / 64 rows leave a task or reach the driver."""
    place = keys.select(F.explode(F.array(*bit_places(F.col(key), bits))).alias("p"))
    words = place.groupBy(word_of(F.col("p")).alias("word")).agg(F.bit_or(bit_of(F.col("p"))).alias("set")).toPandas()
    out = np.zeros(-(-bits // 64), "<i8")
    out[words["word"].to_numpy(np.int64)] = words["set"].to_numpy(np.int64)
    return out.tobytes()


def may_hold(array: bytes, key: Column, bits: int) -> Column:
    """Whether all bits of a key are set; false for NULL."""
    held = F.lit(bytearray(array))
    byte = lambda p: F.conv(F.hex(F.substring(held, F.floor(p / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    tests = [byte(p).bitwiseAND(F.pow(F.lit(2), p % 8).cast("int")) != 0 for p in bit_places(key, bits)]
    return F.coalesce(key.isNotNull() & reduce(lambda a, b: a & b, tests), F.lit(False))


def frontier(links: DataFrame, visited: DataFrame, url: str = "dst_url",
             visited_url: str = "url", bits: int | None = None) -> DataFrame:
    """Extracted links whose canonical URL was not visited.

    The visited URLs are written once and counted.  Few of them are broadcast.
    Else a bit array of them, sized by their count, tells most links as unseen
    where they are read; only links whose bits are all set go through the exact
    anti-join.  More URLs than the largest array serves (two bits each) are
    joined without it.  ``bits`` forces an array of that size.
    """
    seen = _written(visited.select(U.canonical(F.col(visited_url)).alias("canon_url")).distinct(), "visited")
    n = seen.count()
    rows = links.withColumn("canon_url", U.canonical(F.col(url)))
    if bits is None and n <= BROADCAST_URLS:
        return rows.join(F.broadcast(seen), "canon_url", "left_anti")
    if bits is None and 2 * n > FILTER_BITS:
        return rows.join(seen, "canon_url", "left_anti")
    bits = bits or min(FILTER_BITS, 1 << (10 * n).bit_length())
    rows = _written(rows, "links")  # read by both branches; links are narrow, the pages they come from aren't
    maybe = may_hold(bit_array(seen, "canon_url", bits), F.col("canon_url"), bits)
    hits = rows.filter(maybe).join(seen, "canon_url", "left_anti")
    return rows.filter(~maybe).unionByName(hits.select(rows.columns))


def link_edges(pages: DataFrame, rules: Sequence[LinkRule] | None = None, domains: Sequence[str] | None = None) -> DataFrame:
    """The crawl graph as a narrow table: (src, dst) canonical URLs, is_item, follow.  Pages are parsed once."""
    html = F.col("html")
    base = base_url(F.col("url"), html)
    if rules is None:
        links = F.transform(page_links(base, html), lambda u: F.struct(u.alias("dst_url"), F.lit(False).alias("is_item"), F.lit(True).alias("follow")))
    else:
        links = rule_links(base, html, rules)
    edges = pages.select(U.canonical(F.col("url")).alias("src"), F.explode(links).alias("l"))
    edges = edges.select("src", U.canonical(F.col("l.dst_url")).alias("dst"), F.col("l.is_item").alias("is_item"), F.col("l.follow").alias("follow"))
    return edges.filter(U.on_domains(U.host(F.col("dst")), domains))


#: Rows that a round may hand over as a list, so that only their buckets are read.
FEW_URLS = 500
#: Tables of reached URLs that a round looks into, at most.
SEGMENTS = 6


class Bucketed:
    """Tables below one scratch folder, all in the same number of buckets by their key, so that joins on it shuffle neither side.

    They are registered in the session's catalog while in use, as Spark keeps a table's buckets there, and their files stay in the scratch folder.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base, self.names = spark, base, []
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(self, df: DataFrame, key: str) -> str:
        name = f"closure_{uuid.uuid4().hex}"
        dealt = df.repartition(self.buckets, key)  # a file a bucket
        dealt.write.format("parquet").option("path", f"{self.base}/{name}").bucketBy(self.buckets, key).sortBy(key).saveAsTable(name)
        self.names.append(name)
        return name

    def table(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def files(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.base}/{name}")

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names.remove(name)

    def close(self) -> None:
        for name in list(self.names):
            self.drop(name)


def links_from(edges: DataFrame, current: DataFrame, few: Sequence[str] | None) -> DataFrame:
    """What the pages of the frontier ``current`` (canon_url) link to: canon_url, follow.  The edges aren't shuffled; with a list of the frontier only its buckets are read."""
    if few is not None:
        found = edges.filter(F.col("src").isin(*few))
    else:
        found = edges.join(current.select(F.col("canon_url").alias("src")), "src", "left_semi")
    return found.groupBy(F.col("dst").alias("canon_url")).agg(F.max("follow").alias("follow"))


def unseen(found: DataFrame, segments: Sequence[DataFrame], few: Sequence[str] | None) -> DataFrame:
    """Rows of ``found`` whose URL is in none of the tables of reached URLs, which aren't shuffled."""
    for seen in segments:
        seen = seen.select("canon_url")
        found = found.join(seen.filter(F.col("canon_url").isin(*few)) if few is not None else seen, "canon_url", "left_anti")
    return found


def crawl_closure(pages: DataFrame, seeds: DataFrame, rules: Sequence[LinkRule] | None = None,
                  domains: Sequence[str] | None = None, seed_url: str = "url", max_depth: int | None = None) -> DataFrame:
    """Breadth-first closure seeds -> pages -> links -> pages ... over ``pages``.

    The links of all pages become one narrow edge table, written once in
    buckets of ``src``; the URLs that a round reaches are written in the same
    buckets.  A round joins the frontier with the edges bucket by bucket and
    shuffles only the links it finds; a frontier of few URLs reads only their
    buckets.  Reached URLs are kept in a handful of tables: when there are more,
    the smaller ones are merged, and the largest too once they have grown to half
    of it, so a URL is rewritten a logarithmic number of times.  Item links
    stay in the result; only ``follow`` links reach further, and the first round
    that reaches a URL decides, as a crawler that asks for each URL once.  Runs
    until nothing is added, or to ``max_depth`` rounds if given.

    Output: ``(canon_url, depth, page_id)`` for every URL reached (the smallest
    page_id of its pages; NULL for links whose page is not in the table).
    """
    spark = pages.sparkSession
    schema = "canon_url string, follow boolean, depth int"
    base = scratch_path(spark, f"closure/{uuid.uuid4().hex}")
    store = Bucketed(spark, base)
    try:
        edges = store.table(store.write(link_edges(pages, rules, domains).filter("src IS NOT NULL AND dst IS NOT NULL").select("src", "dst", "follow"), "src"))
        start = seeds.select(U.canonical(F.col(seed_url)).alias("canon_url")).distinct().select("canon_url", F.lit(True).alias("follow"), F.lit(0).alias("depth"))
        last = store.write(start, "canon_url")
        segments, depth = [(store.table(last).count(), last)], 0
        while max_depth is None or depth < max_depth:
            depth += 1
            current = store.table(last).filter("follow")
            few = [r[0] for r in current.select("canon_url").limit(FEW_URLS + 1).collect()]
            if not few:
                break
            found = _written(links_from(edges, current, few if len(few) <= FEW_URLS else None), "found")
            names = [r[0] for r in found.select("canon_url").limit(FEW_URLS + 1).collect()]
            new = unseen(found, [store.table(t) for _, t in segments], names if len(names) <= FEW_URLS else None)
            last = store.write(new.select("canon_url", "follow", F.lit(depth).alias("depth")), "canon_url")
            n = store.table(last).count()
            if not n:
                break
            segments.append((n, last))
            if len(segments) > SEGMENTS:
                segments.sort(reverse=True)
                rest = segments[1:] if 2 * sum(n for n, _ in segments[1:]) < segments[0][0] else segments
                merged = store.write(reduce(DataFrame.unionByName, [store.table(t) for _, t in rest]), "canon_url")
                segments = [x for x in segments if x not in rest] + [(sum(n for n, _ in rest), merged)]
        reached = reduce(DataFrame.unionByName, [store.files(t, schema) for _, t in segments])
    finally:
        store.close()
    first = pages.groupBy(U.canonical(F.col("url")).alias("canon_url")).agg(F.min("page_id").alias("page_id"))
    return reached.select("canon_url", "depth").join(first, "canon_url", "left")
