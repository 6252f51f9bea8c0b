"""The nine source profiles of the reference, plus one for the driver's page table.

Selector strings, formats and limits are values that must equal the
reference's for the same pages to give the same records.
"""

from __future__ import annotations

from inkline.functions import html as H
from inkline.operators.links import LinkRule
from inkline.operators.profiles import DateField, Profile, Region, TextField


def _div(cls: str) -> Region:
    """``find('div', class_=cls)``."""
    return Region(H.class_open_re("div", cls))


def _exact(tag: str, cls: str) -> Region:
    """XPath ``tag[@class="cls"]``."""
    return Region(H.class_exact_re(tag, cls), tag)


# --- fixed values -----------------------------------------------------------
# Per-source selectors, keep-sets, joins, date formats and limits.
ADNRADIO = Profile(
    media="adnradio",
    url_contains="/2023/",
    title=TextField("h1"),
    require_title=True,
    subtitle=TextField("region_p", region=_exact("div", "the-single__excerpt")),
    container=_div("the-single__content the-single-content"),
    paragraphs=H.ParagraphSpec("p", None, ("a", "strong")),
    join="glued",
    date=DateField("post_parts", "old_post_message", "ymd"),
    row_cap=100,
    freshness="window",
    hosts=("adnradio.cl",),
    seeds=("https://www.adnradio.cl/category/nacional/page/1/",),
    rules=(LinkRule(allow=("nacional/page/",), is_item=True, follow=True),
           LinkRule(region=("h3",), is_item=True, follow=False)),
)
BIOBIO = Profile(
    media="biobio",
    title=TextField("h1"),
    subtitle=TextField("region_p", region=_exact("div", "post-excerpt")),
    container=Region(key_meta="identrada", class_prefix="banners-contenido-nota-"),
    on_missing_container="reject",
    paragraphs=H.ParagraphSpec("p", None, ("a", "strong")),
    join="glued",
    date=DateField("meta", "og:updated_time", "date10"),
    row_cap=40,
    freshness="prefix",
    allowed_domains=("biobiochile.cl",),
    hosts=("biobiochile.cl",),
    seeds=("https://www.biobiochile.cl/lista/categorias/region-metropolitana",),
    rules=(LinkRule(region=("div.article-text-container",), is_item=True, follow=False),),
)
CNNCHILE = Profile(
    media="cnnchile",
    title=TextField("h1"),
    require_title=True,
    subtitle=TextField("region_p", region=_exact("div", "main-single-header__excerpt")),
    container=_div("main-single-body__content"),
    paragraphs=H.ParagraphSpec("p", None, ("a", "strong")),
    date=DateField("jsonld", "$.datePublished", "date10"),
    row_cap=100,
    freshness="window",
    allowed_domains=("www.cnnchile.com",),
    hosts=("cnnchile.com",),
    seeds=("https://www.cnnchile.com/category/pais/",),
    rules=(LinkRule(region=("h2.inner-item__title",), is_item=True, follow=False),),
)
ELDINAMO = Profile(
    media="eldinamo",
    title=TextField("h1_first", clean=False, on_missing="reject"),
    subtitle=TextField("region_first", region=_exact("p", "bajada"),
                       clean=False, on_missing="reject"),
    container=_div("the-content"),
    on_missing_container="empty",
    paragraphs=H.ParagraphSpec("p", None, ("a", "strong")),
    clean_body=False,
    date=DateField("meta", "article:published_time", "ts_offset"),
    row_cap=100,
    freshness="window",
    hosts=("eldinamo.cl",),
    seeds=("https://www.eldinamo.cl/pais/",),
    rules=(LinkRule(anchor_class="next page-numbers"),
           LinkRule(region=("div.titulares", "h2"), is_item=True, follow=False)),
)
ELMOSTRADOR = Profile(
    media="elmostrador",
    title=TextField("h1"),
    require_title=True,
    subtitle=TextField("region_own", region=_exact("p", "d-the-single__excerpt | u-fw-600")),
    container=Region(H.open_tag_re("main"), "main"),
    on_missing_container="reject",
    paragraphs=H.ParagraphSpec("p", None, ("a", "strong")),
    date=DateField("time", None, "ymd_or_dmy"),
    row_cap=200,
    freshness="window",
    hosts=("elmostrador.cl",),
    seeds=("https://www.elmostrador.cl/categoria/pais/",
           "https://www.elmostrador.cl/categoria/agenda-sustentable/"),
    rules=(LinkRule(allow=("pais/page/", "agenda-sustentable/page/")),
           LinkRule(region=("h4.d-tag-card__title",), is_item=True, follow=False)),
)
EMOL = Profile(
    media="emol",
    title=TextField("meta", "og:title", on_missing="reject"),
    url_from_meta="og:url",
    subtitle=TextField("meta", "og:description", on_missing="reject"),
    container=Region(H.id_open_re("div", "texto_noticia")),
    paragraphs=H.ParagraphSpec("div", None, ("a", "b"), nested=True),
    join="glued",
    date=DateField("meta", "article:published_time", "date10"),
    row_cap=30,
    response_cap=50,
    freshness=None,
    allowed_domains=("emol.com",),
    hosts=("emol.com",),
    seeds=("https://www.emol.com/sitemap/",),
    rules=(LinkRule(allow=(r"noticias/[a-zA-Z\d\-]+/\d{4}/\d{2}/\d{2}/\d+/[\da-zA-Z\-]+\.html",), is_item=True, follow=False),
           LinkRule(allow=(r"sitemap/noticias/\d{4}/index.html", r"sitemap/noticias/\d{4}/emol_noticias.*\.html"),
                    deny=(r"sitemap/noticias/\d{4}/emol_videos.*\.html", r"sitemap/noticias/\d{4}/emol_fotos.*\.html"))),
)
LATERCERA = Profile(
    media="latercera",
    title=TextField("region_first", region=Region(path=(
        "*#fusion-app", "/div[1]", "/section", "/article", "/header", "/div", "/div[1]", "/h1", "/div")), on_missing="reject"),
    subtitle=TextField("region_first", region=_exact("p", "excerpt"),
                       on_missing="reject"),
    container=Region(None),
    paragraphs=H.ParagraphSpec("p", "paragraph", ("a", "b")),
    date=DateField("meta", "article:published_time", "ts_z"),
    row_cap=150,
    freshness="window",
    hosts=("latercera.com",),
    seeds=("https://www.latercera.com/categoria/nacional/",
           "https://www.latercera.com/etiqueta/medioambiente/",
           "https://www.latercera.com/etiqueta/seguridad/",
           "https://www.latercera.com/etiqueta/transporte/"),
    rules=(LinkRule(region=("div.pagination", "/nav", "/ul", "/li", "/a")),
           LinkRule(region=("div.headline | width_full hl", "/h3", "/a"), is_item=True, follow=False)),
)
PUBLIMETRO = Profile(
    media="publimetro",
    title=TextField("h1"),
    subtitle=TextField("region_p", "h2", region=_exact("div", "col-sm-xl-12 layout-section wrap-bottom promo1")),
    container=_exact("article", "default__ArticleBody-xb1qmn-2 dwgCRL article-body-wrapper"),
    on_missing_container="reject",
    paragraphs=H.ParagraphSpec("p", None, ("a", "b")),
    date=DateField("time", "primary-font__PrimaryFontStyles-o56yd5-0 ctbcAa date undefined", "ts_z"),
    row_cap=100,
    freshness="window",
    allowed_domains=("publimetro.cl",),
    hosts=("publimetro.cl",),
    seeds=("https://www.publimetro.cl/noticias/",),
    rules=(LinkRule(region=("*#skin-branding", "/div", "/div[2]", "/main", "/div[3]", "/div", "/div[2]", "/a"), is_item=True, follow=False),),
)
THECLINIC = Profile(
    media="theclinic",
    url_not_contains="/media/",
    title=TextField("h1_first", region=Region(H.class_token_re("article", "principal"), "article"),
                    on_missing="reject"),
    subtitle=TextField("region_first",
                       region=Region(H.class_token_re("p", "bajada"), "p"),
                       scope=Region(H.class_token_re("article", "principal"), "article"), on_missing="reject"),
    container=_div("the-content"),
    paragraphs=H.ParagraphSpec("p", None, ("a", "strong")),
    date=DateField("meta", "article:published_time", "date10"),
    row_cap=100,
    freshness="window",
    allowed_domains=("theclinic.cl",),
    hosts=("theclinic.cl",),
    seeds=("https://www.theclinic.cl/noticias/tendencias/movilidad/",
           "https://www.theclinic.cl/noticias/actualidad/nacional/"),
    rules=(LinkRule(anchor_class="next page-numbers", follow=True),
           LinkRule(region=("div.titulares", "h2"), is_item=True, follow=False)),
)
# --- end of fixed values ----------------------------------------------------

REGISTRY: dict[str, Profile] = {p.media: p for p in (
    ADNRADIO, BIOBIO, CNNCHILE, ELDINAMO, ELMOSTRADOR, EMOL, LATERCERA, PUBLIMETRO, THECLINIC)}

# The driver's ``pages`` table: one <article> with an <h1>, paragraphs whose
# first <p><b>… is left open, no dates.  Media is the language in the URL path,
# crawl order is page_id, and the date is a column the caller derives.
PAGES_MEDIA_EXPR = r"regexp_extract(url, '^[a-zA-Z]+://[^/]+/([a-z]{2})/', 1)"
DRIVER_PAGES = Profile(
    media="pages",
    media_expr=PAGES_MEDIA_EXPR,
    title=TextField("h1"),
    require_title=True,
    subtitle=TextField("first_p_all", region=Region(H.open_tag_re("article"), "article")),
    container=Region(H.open_tag_re("article"), "article"),
    paragraphs=H.ParagraphSpec("p", None, ("a", "b")),
    join="space",
    date=DateField("column", "published_at", "timestamp"),
    row_cap=100,
    freshness="window",
)
