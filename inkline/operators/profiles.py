"""Per-source extraction profiles compiled to Column expressions.

A :class:`Profile` is plain data.  :func:`extract` turns a page table
``(page_id, url, html[, crawl_seq])`` into one row per page with the raw
article fields, a parsed ``published_at`` and a ``status`` / ``reason`` pair:

* ``parsed``   - every required node was found (counts toward the row cap);
* ``filtered`` - the source skips the page on purpose (URL rule, empty title,
  missing container): no error in the reference;
* ``rejected`` - the reference raises and loses the row (missing required
  node, unparsable date); kept here with its reason (E16).

Several profiles extract together (:class:`Sources`): a page's source comes
from its host, and each field is one CASE.  :func:`judged` stops before the
body, so caps and recency can run on what they need.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkline.functions import dates as D
from inkline.functions import html as H
from inkline.functions import urls as U
from inkline.functions.text import clean_text
from inkline.operators.links import LinkRule, crawl_closure


@dataclass(frozen=True)
class Region:
    """An element: how its opening tag looks and its name, or the first one that ``path`` leads to; neither means the whole page."""

    open_re: str | None = None
    tag: str = "div"
    key_meta: str | None = None         # class computed from <meta name=key_meta>
    class_prefix: str | None = None
    path: tuple[str, ...] = ()          # steps with positions (``H.Step.of``)

    def column(self, html: Column) -> Column:
        if self.path:
            return H.inner_of(F.get(H.path_elements(html, self.path), 0))
        if self.key_meta is not None:
            key = H.meta_content(html, self.key_meta, key="name")
            return H.block_after_key(html, self.tag, self.class_prefix or "", key)
        if self.open_re is None:
            return html
        return H.first_block(html, self.open_re, self.tag)


@dataclass(frozen=True)
class TextField:
    """A title or subtitle selector.

    kinds: ``h1`` (all ``//h1/text()``), ``h1_first`` (first text node),
    ``meta`` (``<meta property=arg content>``), ``region_p`` (own text of the
    ``arg`` children of a region, ``p`` by default), ``region_own`` (own text of the region
    element itself), ``region_first`` (first text node of the
    first element matching ``region``), ``first_p_all`` (string value of the
    first paragraph of ``region``).
    ``on_missing``: ``reject`` (the reference raises) or ``empty``.
    """

    kind: str
    arg: str | None = None
    region: Region | None = None
    clean: bool = True
    on_missing: str = "empty"
    scope: Region | None = None     # an element that the rest must lie in

    def column(self, html: Column) -> Column:
        if self.scope:
            html = self.scope.column(html)
        if self.kind == "h1":
            scope = self.region.column(html) if self.region else html
            inner = F.array_join(H.all_blocks(scope, "h1"), H.MARK)
            val = H.own_text(inner)
            val = F.when(scope.isNotNull(), val)
        elif self.kind == "h1_first":
            scope = self.region.column(html) if self.region else html
            val = H.h1_title_strict(scope)
        elif self.kind == "meta":
            val = H.meta_content(html, self.arg)
        elif self.kind == "region_p":
            reg = self.region.column(html)
            child = self.arg or "p"
            inner = F.array_join(H.all_blocks(reg, child), H.MARK)
            val = F.when(reg.isNotNull(), H.own_text(inner))
        elif self.kind == "region_own":
            reg = self.region.column(html)
            val = F.when(reg.isNotNull(), H.own_text(reg))
        elif self.kind == "region_first":
            # of several elements at the end of a path, the first one with a text node of its own
            if self.region.path:
                texts = F.transform(H.path_elements(html, self.region.path), lambda e: H.first_own_text(H.inner_of(e)))
                val = F.get(F.filter(texts, lambda t: t.isNotNull()), 0)
            else:
                val = H.first_own_text(self.region.column(html))
        elif self.kind == "first_p_all":
            reg = self.region.column(html)
            first = F.regexp_extract(reg, f"(?s){H.open_tag_re('p')}(.*?)(?:{H.close_tag_re('p')}|(?i:<p[\\s/>])|\\z)", 1)
            val = F.when(reg.isNotNull(), H.all_text(first))
        else:
            raise ValueError(f"unknown text field kind {self.kind!r}")
        return clean_text(val) if self.clean else val


@dataclass(frozen=True)
class DateField:
    """Publication date: where the text comes from and its format.

    sources: ``meta`` (property ``arg``), ``jsonld`` (JSON path ``arg``),
    ``time`` (``datetime`` of the first ``<time>``, optionally with class
    ``arg``), ``post_parts`` (``data-post-year/month/day`` of the element with
    class ``arg``), ``column`` (an existing column named ``arg``).
    formats: ``ts_z``, ``ts_offset``, ``date10``, ``ymd_or_dmy``, ``ymd``, ``timestamp``.
    """

    source: str
    arg: str | None = None
    fmt: str = "date10"

    def raw(self, html: Column) -> Column:
        if self.source == "meta":
            return H.meta_content(html, self.arg)
        if self.source == "jsonld":
            return H.jsonld_field(html, self.arg)
        if self.source == "time":
            where = H.class_exact_re("time", self.arg) if self.arg else None
            return H.tag_attr(html, "time", "datetime", where=where)
        if self.source == "post_parts":
            where = H.class_open_re("div", self.arg)
            y = H.tag_attr(html, "div", "data-post-year", where=where)
            m = H.tag_attr(html, "div", "data-post-month", where=where)
            d = H.tag_attr(html, "div", "data-post-day", where=where)
            return F.concat(y, F.lit("-"), m, F.lit("-"), d)
        if self.source == "column":
            return F.col(self.arg).cast("string")
        raise ValueError(f"unknown date source {self.source!r}")

    def parse(self, raw: Column) -> Column:
        return {
            "timestamp": lambda c: c.try_cast("timestamp_ntz"),
            "ts_z": D.parse_ts_z,
            "ts_offset": D.parse_ts_offset,
            "date10": D.parse_date10,
            "ymd_or_dmy": D.parse_date_fallback,
            "ymd": D.parse_ymd,
        }[self.fmt](raw)


@dataclass(frozen=True)
class Profile:
    """Everything that differs between sources, as data."""

    media: str
    title: TextField
    subtitle: TextField
    container: Region
    paragraphs: H.ParagraphSpec
    date: DateField
    join: str = "space"                  # 'space' | 'glued'
    clean_body: bool = True
    on_missing_container: str = "filter"  # 'filter' | 'reject' | 'empty'
    require_title: bool = False          # P3: skip pages whose title is ''
    url_contains: str | None = None      # P1
    url_not_contains: str | None = None  # P2
    url_from_meta: str | None = None     # E14: e.g. 'og:url'
    row_cap: int | None = None           # W1
    response_cap: int | None = None      # W3 (all pages received)
    freshness: str | None = "window"     # 'window' (P5), 'prefix' (W2) or None
    allowed_domains: tuple[str, ...] | None = None   # L6; None: no off-site filter
    hosts: tuple[str, ...] = ()          # E15: hosts whose pages are this source's
    seeds: tuple[str, ...] = ()          # S4
    rules: tuple[LinkRule, ...] = ()     # L5, in order
    media_expr: str | None = None        # SQL expression deriving media per row

    def with_(self, **kw) -> "Profile":
        return replace(self, **kw)


ARTICLE_FIELDS = ("page_id", "media", "crawl_seq", "url", "title", "subtitle", "body",
                  "date_raw", "published_at", "status", "reason")

#: Pages of no known source.
UNKNOWN = "unknown_host"


class Sources:
    """One or several profiles as one set of Columns: each field is a CASE over the page's source.

    Sources that share a field's definition share its branch, and a page only
    evaluates the branch of its own source, so any number of sources is one
    scan and one projection.
    """

    def __init__(self, profiles: Profile | Mapping[str, Profile]):
        self.one = profiles if isinstance(profiles, Profile) else None
        self.profiles = {profiles.media: profiles} if self.one else dict(profiles)

    def media(self) -> Column:
        """The page's source; NULL for a host that no profile names."""
        if self.one:
            return F.expr(self.one.media_expr) if self.one.media_expr else F.lit(self.one.media)
        out, host = F.lit(None).cast("string"), U.host(F.col("url"))
        for name, p in self.profiles.items():
            out = F.when(U.on_domains(host, p.hosts or (name,)), F.lit(name)).otherwise(out)
        return out

    def pick(self, spec: Callable[[Profile], object], build: Callable[[Profile], Column], media: Column | None = None) -> Column:
        """``build`` of the page's own profile, one branch for each different ``spec``."""
        if self.one:
            return build(self.one)
        media = F.col("media") if media is None else media
        groups: dict[object, list[str]] = {}
        for name, p in self.profiles.items():
            groups.setdefault(spec(p), []).append(name)
        out = None
        for names in groups.values():
            value = build(self.profiles[names[0]])
            out = F.when(media.isin(*names), value) if out is None else out.when(media.isin(*names), value)
        return out

    def value(self, name: str) -> dict[str, object]:
        """A plain field of each profile that sets it."""
        return {m: v for m, p in self.profiles.items() if (v := getattr(p, name)) is not None}


def _checks(p: Profile) -> list[tuple[Column, str, str]]:
    """Why a page of this source is no article: condition, status, reason; the first that holds counts."""
    checks: list[tuple[Column, str, str]] = []
    url = F.col("page_url")
    if p.url_contains:
        checks.append((~F.coalesce(url.contains(p.url_contains), F.lit(False)), "filtered", "url_not_matching"))
    if p.url_not_contains:
        checks.append((F.coalesce(url.contains(p.url_not_contains), F.lit(False)), "filtered", "url_excluded"))
    if p.title.on_missing == "reject":
        checks.append((F.col("title").isNull(), "rejected", "no_title"))
    if p.subtitle.on_missing == "reject":
        checks.append((F.col("subtitle").isNull(), "rejected", "no_subtitle"))
    if p.url_from_meta:
        checks.append((F.col("url").isNull(), "rejected", "no_url"))
    if p.require_title:
        checks.append((F.coalesce(F.col("title"), F.lit("")) == "", "filtered", "empty_title"))
    if p.on_missing_container == "filter":
        checks.append((F.col("container").isNull(), "filtered", "no_container"))
    elif p.on_missing_container == "reject":
        checks.append((F.col("container").isNull(), "rejected", "no_container"))
    checks.append((F.col("date_raw").isNull(), "rejected", "no_date"))
    checks.append((F.col("published_at").isNull(), "rejected", "bad_date"))
    return checks


def _verdict(p: Profile) -> Column:
    out = F.struct(F.lit("parsed").alias("status"), F.lit(None).cast("string").alias("reason"))
    for cond, status, reason in reversed(_checks(p)):
        out = F.when(cond, F.struct(F.lit(status).alias("status"), F.lit(reason).alias("reason"))).otherwise(out)
    return out


def _body(p: Profile) -> Column:
    body = H.body_text(F.col("container"), p.paragraphs, join=p.join, clean=p.clean_body)
    return F.coalesce(body, F.lit("")) if p.on_missing_container == "empty" else body


def judged(pages: DataFrame, profiles: Profile | Mapping[str, Profile], with_media: bool = True) -> DataFrame:
    """Pages with every field but the body, the container's HTML, and their status and reason."""
    src, html = Sources(profiles), F.col("markup")
    crawl_seq = F.col("crawl_seq") if "crawl_seq" in pages.columns else F.col("page_id")
    tagged = pages.withColumn("media", src.media().cast("string")) if with_media else pages
    # once per page for all fields; only JSON-LD is read from the page as it came
    tagged = tagged.withColumn("markup", H.inert_free(F.col("html")))
    fields = tagged.select(
        "page_id", "media", crawl_seq.cast("bigint").alias("crawl_seq"), F.col("url").alias("page_url"),
        src.pick(lambda p: p.url_from_meta, lambda p: H.meta_content(html, p.url_from_meta) if p.url_from_meta else F.col("url")).alias("url"),
        src.pick(lambda p: p.title, lambda p: p.title.column(html)).alias("title"),
        src.pick(lambda p: p.subtitle, lambda p: p.subtitle.column(html)).alias("subtitle"),
        src.pick(lambda p: p.container, lambda p: p.container.column(html)).alias("container"),
        src.pick(lambda p: (p.date.source, p.date.arg), lambda p: p.date.raw(F.col("html") if p.date.source == "jsonld" else html)).alias("date_raw"),
        # keeps filters on the result above this projection, so that no field is computed twice
        F.spark_partition_id().alias("part"),
    )
    fields = fields.withColumn("published_at", src.pick(lambda p: p.date, lambda p: p.date.parse(F.col("date_raw"))))
    verdict = src.pick(lambda p: tuple((s, r) for _, s, r in _checks(p)) + (p.url_contains, p.url_not_contains), _verdict)
    unknown = F.struct(F.lit("rejected").alias("status"), F.lit(UNKNOWN).alias("reason"))
    verdict = verdict if src.one else F.when(F.col("media").isNull(), unknown).otherwise(verdict)
    return fields.withColumn("v", verdict).select("*", "v.status", "v.reason").drop("v")


def with_body(rows: DataFrame, profiles: Profile | Mapping[str, Profile]) -> DataFrame:
    """The body from the container; empty texts where a source treats a missing title or subtitle as empty."""
    src = Sources(profiles)
    text = lambda name: src.pick(lambda p: getattr(p, name).on_missing, lambda p: F.coalesce(F.col(name), F.lit("")) if getattr(p, name).on_missing == "empty" else F.col(name)).alias(name)
    body = src.pick(lambda p: (p.paragraphs, p.join, p.clean_body, p.on_missing_container), _body)
    return rows.select("page_id", "media", "crawl_seq", F.coalesce("url", "page_url").alias("url") if not src.one else "url",
                       text("title"), text("subtitle"), body.alias("body"), "date_raw", "published_at", "status", "reason")


def extract(pages: DataFrame, profiles: Profile | Mapping[str, Profile], with_media: bool = True) -> DataFrame:
    """Every page with its article fields, status and reason: one output row per input page, one scan for all sources."""
    return with_body(judged(pages, profiles, with_media), profiles)


def parsed(pages: DataFrame, profiles: Profile | Mapping[str, Profile], with_media: bool = True) -> DataFrame:
    """The pages that are articles, with their fields."""
    return with_body(judged(pages, profiles, with_media).filter((F.col("status") == "parsed") & (F.col("part") >= 0)), profiles)


def split_rejects(extracted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parsed rows, rejected-or-filtered rows with their reason)."""
    good = extracted.filter(F.col("status") == "parsed")
    bad = extracted.filter(F.col("status") != "parsed").select("page_id", "media", "url", "status", "reason")
    return good, bad


def crawl(pages: DataFrame, profile: Profile, max_depth: int | None = None) -> DataFrame:
    """L9 for one source: what its seeds reach over ``pages`` by its rules, within its allowed domains."""
    seeds = pages.sparkSession.createDataFrame([(u,) for u in profile.seeds], "url string")
    return crawl_closure(pages, seeds, profile.rules, profile.allowed_domains, max_depth=max_depth)
