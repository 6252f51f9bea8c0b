import datetime as dt

from pyspark.sql import functions as F

from inkline.operators.builtin_profiles import REGISTRY
from inkline.operators.profiles import extract
from inkline.plans.articles import articles

T = dt.datetime
P = "<p>Primer <a href='/x'>enlace</a> y <strong>fuerte</strong> <em>no</em> fin.</p><p>Segundo <b>negro</b>.</p>"

PAGES = {
    "adnradio": ("https://www.adnradio.cl/2023/05/04/nota",
                 '<h1>Título ADN</h1><div class="the-single__excerpt"><p>Bajada</p></div>'
                 f'<div class="the-single__content the-single-content">{P}</div>'
                 '<div class="old_post_message" data-post-year="2023" data-post-month="5" data-post-day="4"></div>'),
    "biobio": ("https://www.biobiochile.cl/n/1", '<meta name="identrada" content="9"><h1>Título BB</h1>'
               f'<div class="post-excerpt"><p>Bajada</p></div><div class="banners-contenido-nota-9">{P}</div>'
               '<meta property="og:updated_time" content="2023-05-04T10:00:00-04:00">'),
    "cnnchile": ("https://www.cnnchile.com/n", '<h1>Título CNN</h1><div class="main-single-header__excerpt"><p>Bajada</p>'
                 f'</div><div class="main-single-body__content">{P}</div>'
                 '<script type="application/ld+json">{"datePublished": "2023-05-04T10:00:00-04:00"}</script>'),
    "eldinamo": ("https://www.eldinamo.cl/n", '<h1>Título ED</h1><p class="bajada">Bajada</p>'
                 f'<div class="the-content">{P}</div>'
                 '<meta property="article:published_time" content="2023-05-04T10:00:00-03:00">'),
    "elmostrador": ("https://www.elmostrador.cl/n", '<h1>Título EM</h1><p class="d-the-single__excerpt | u-fw-600">'
                    f'Bajada</p><main>{P}</main><time datetime="04-05-2023">4 mayo</time>'),
    "emol": ("https://www.emol.com/x", '<meta property="og:title" content="Título Emol">'
             '<meta property="og:url" content="https://www.emol.com/nacional/2023/05/04/1/a.html">'
             '<meta property="og:description" content="Bajada">'
             '<div id="texto_noticia"><div>Uno <b>dos</b> <i>no</i></div><div>Tres</div></div>'
             '<meta property="article:published_time" content="2023-05-04T10:00:00Z">'),
    "latercera": ("https://www.latercera.com/n", '<h1><div>Menú</div></h1><div id="fusion-app"><header><h1><div>Cabecera</div></h1></header>'
                  '<div><section><article><header><div><div><h1>x<div>Título LT</div></h1></div><div><h1><div>Otro</div></h1></div></div></header></article></section></div>'
                  '<div><section><article><header><div><div><h1><div>Segundo</div></h1></div></div></header></article></section></div></div>'
                  '<p class="excerpt">Bajada</p>'
                  '<p class="paragraph">Uno <b>dos</b></p><p>fuera</p><p class="paragraph">Tres</p>'
                  '<meta property="article:published_time" content="2023-05-04T10:00:00.000Z">'),
    "publimetro": ("https://www.publimetro.cl/n", '<h1>Título PM</h1>'
                   '<div class="col-sm-xl-12 layout-section wrap-bottom promo1"><h2>Bajada</h2></div>'
                   f'<article class="default__ArticleBody-xb1qmn-2 dwgCRL article-body-wrapper">{P}</article>'
                   '<time class="primary-font__PrimaryFontStyles-o56yd5-0 ctbcAa date undefined" '
                   'datetime="2023-05-04T10:00:00.000Z">x</time>'),
    "theclinic": ("https://www.theclinic.cl/n", '<article class="principal grande"><h1>Título TC</h1>'
                  f'<p class="bajada">Bajada</p></article><div class="the-content">{P}</div>'
                  '<meta property="article:published_time" content="2023-05-04T10:00:00-04:00">'),
}
STRONG_BODY = "Primer  enlace  y  fuerte    fin. Segundo  ."
B_BODY = "Primer  enlace  y     fin. Segundo  negro ."
EXPECTED = {
    "adnradio": ("Título ADN", "Bajada", "Primer  enlace  y  fuerte    fin.Segundo  .", T(2023, 5, 4)),
    "biobio": ("Título BB", "Bajada", "Primer  enlace  y  fuerte    fin.Segundo  .", T(2023, 5, 4)),
    "cnnchile": ("Título CNN", "Bajada", STRONG_BODY, T(2023, 5, 4)),
    "eldinamo": ("Título ED", "Bajada", STRONG_BODY, T(2023, 5, 4, 10)),
    "elmostrador": ("Título EM", "Bajada", STRONG_BODY, T(2023, 5, 4)),
    "emol": ("Título Emol", "Bajada", "Uno  dosTres", T(2023, 5, 4)),
    "latercera": ("Título LT", "Bajada", "Uno  dos Tres", T(2023, 5, 4, 10)),
    "publimetro": ("Título PM", "Bajada", B_BODY, T(2023, 5, 4, 10)),
    "theclinic": ("Título TC", "Bajada", STRONG_BODY, T(2023, 5, 4)),
}


def frame(spark, media, url, html):
    return spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")


def test_every_profile_extracts_its_page(spark):
    for media, (url, html) in PAGES.items():
        r = extract(frame(spark, media, url, html), REGISTRY[media]).first()
        assert r.status == "parsed", (media, r.reason)
        assert (r.title, r.subtitle, r.body, r.published_at) == EXPECTED[media], media


def test_emol_url_comes_from_og_url(spark):
    url, html = PAGES["emol"]
    r = extract(frame(spark, "emol", url, html), REGISTRY["emol"]).first()
    assert r.url.endswith("/2023/05/04/1/a.html")


def test_reject_and_filter_reasons(spark):
    cases = [
        ("adnradio", "https://www.adnradio.cl/2022/x", PAGES["adnradio"][1], "filtered", "url_not_matching"),
        ("theclinic", "https://www.theclinic.cl/media/x", PAGES["theclinic"][1], "filtered", "url_excluded"),
        ("eldinamo", "u", PAGES["eldinamo"][1].replace("<h1>Título ED</h1>", ""), "rejected", "no_title"),
        ("cnnchile", "u", PAGES["cnnchile"][1].replace("<h1>Título CNN</h1>", "<h1></h1>"), "filtered", "empty_title"),
        ("cnnchile", "u", PAGES["cnnchile"][1].replace("main-single-body__content", "otro"), "filtered", "no_container"),
        ("biobio", "u", PAGES["biobio"][1].replace('content="9"', 'content="8"'), "rejected", "no_container"),
        ("latercera", "u", PAGES["latercera"][1].replace(".000Z", "Z"), "rejected", "bad_date"),
        ("elmostrador", "u", PAGES["elmostrador"][1].replace("<time", "<tiempo"), "rejected", "no_date"),
    ]
    for media, url, html, status, reason in cases:
        r = extract(frame(spark, media, url, html), REGISTRY[media]).first()
        assert (r.status, r.reason) == (status, reason), media


def test_eldinamo_missing_container_gives_empty_body(spark):
    url, html = PAGES["eldinamo"]
    r = extract(frame(spark, "eldinamo", url, html.replace("the-content", "x")), REGISTRY["eldinamo"]).first()
    assert r.status == "parsed" and r.body == ""


def test_article_plan_caps_then_recency(spark):
    url, html = PAGES["cnnchile"]
    rows = [(i, f"{url}/{i}", html.replace("2023-05-04", d)) for i, d in
            enumerate(["2023-05-04", "2023-05-01", "2023-05-04", "2023-05-05"], start=1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    prof = REGISTRY["cnnchile"].with_(row_cap=3)
    out = articles(df, prof, "2023-05-05 12:00:00", places=["enlace", "Segundo", "nada"]).collect()
    assert sorted(r.page_id for r in out) == [1, 3]
    r = out[0]
    assert r.comunas == "enlace, Segundo" and r.sentiment == "NEU" and r.category_1 == ""
    assert r.clean_body == "primer enlace fuerte fin segundo"


def mixed(spark):
    rows = [(i, url, html) for i, (url, html) in enumerate(PAGES.values())] + [(99, "https://otro.cl/x", "<h1>x</h1>")]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_all_sources_in_one_scan(spark):
    out = extract(mixed(spark), REGISTRY)
    got = {r.media: (r.title, r.subtitle, r.body, r.published_at) for r in out.collect() if r.media}
    assert got == EXPECTED
    lost = [r for r in out.collect() if r.media is None]
    assert [(r.page_id, r.status, r.reason) for r in lost] == [(99, "rejected", "unknown_host")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_mixed_plan_equals_each_source_alone(spark):
    as_of = "2023-05-05 08:00:00"
    together = {r.media: r for r in articles(mixed(spark), REGISTRY, as_of).collect()}
    for media in ("adnradio", "biobio", "emol", "eldinamo"):
        alone = articles(frame(spark, media, *PAGES[media]), REGISTRY[media], as_of).collect()
        assert [r.asDict() | {"page_id": 0} for r in alone] == ([together[media].asDict() | {"page_id": 0}] if media in together else []), media
    assert set(together) <= set(PAGES) and "emol" in together


def test_nested_divs_and_second_classes(spark):
    for media, (url, html) in PAGES.items():
        if media in ("latercera", "emol"):
            continue
        inner = P.replace("</p><p>Segundo", '</p><div class="ad">x<div>y</div></div><p>Segundo')
        r = extract(frame(spark, media, url, html.replace(P, inner)), REGISTRY[media]).first()
        assert r.body == EXPECTED[media][2], media
    for media, cls in (("cnnchile", "main-single-body__content"), ("eldinamo", "the-content"), ("theclinic", "the-content")):
        url, html = PAGES[media]
        r = extract(frame(spark, media, url, html.replace(f'class="{cls}"', f'class="a {cls} b"')), REGISTRY[media]).first()
        assert (r.status, r.body) == ("parsed", EXPECTED[media][2])


def test_every_source_has_seeds_rules_and_hosts():
    assert all(p.seeds and p.rules and p.hosts for p in REGISTRY.values())


def test_crawl_by_a_sources_own_rules(spark):
    from inkline.operators.profiles import crawl
    seed = REGISTRY["theclinic"].seeds[0]
    rows = [(1, seed, '<div class="titulares"><h2><a href="/n/1">1</a></h2></div><a class="next page-numbers" href="page/2/">next</a>'
                      '<a href="/other">no rule</a><div class="titulares"><h2><a href="https://off.org/x">off</a></h2></div>'),
            (2, seed + "page/2/", '<div class="titulares"><h2><a href="/n/2">2</a></h2></div>'),
            (3, "https://www.theclinic.cl/n/1", '<a class="next page-numbers" href="/n/9">items are not followed</a>')]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.canon_url.replace("https://www.theclinic.cl", ""): (r.depth, r.page_id) for r in crawl(pages, REGISTRY["theclinic"]).collect()}
    first = seed.replace("https://www.theclinic.cl", "")
    second = REGISTRY["theclinic"].seeds[1].replace("https://www.theclinic.cl", "")
    assert got == {first: (0, 1), second: (0, None), "/n/1": (1, 3), first + "page/2/": (1, 2), "/n/2": (2, None)}


def test_flagship_shuffles_no_page_content(spark):
    """No Exchange of the capped article plan holds HTML, a container or a body."""
    import re

    from inkline.plans.queries import flagship

    df = flagship(spark, "/root/testdata/sf0.001")
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    below = [" ".join(lines[k + 1:k + 3]) for k, x in enumerate(lines) if re.search(r"\bExchange (hash|range|single|round)", x, re.IGNORECASE)]
    assert not any(re.search(r"\b(html|container|body|title)#", x) for x in below)
    formatted = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    for part in re.split(r"\n\(\d+\) ", formatted):
        if part.startswith("Exchange"):
            assert not re.search(r"Input \[\d+\]:.*\b(html|container|body|title)#", part)


def test_bad_dates_reject_their_page_only(spark):
    from inkline.operators.profiles import DateField

    texts = ["garbage", "", "2024-13-45", "2024-01-02T99:00:00Z", None, "12-31", "2024-01-02T03:04:05.6Z"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, published_at string")
    for fmt in ("timestamp", "ts_z", "ts_offset", "date10", "ymd_or_dmy", "ymd"):
        field = DateField("column", "published_at", fmt)
        got = {r["i"]: r["d"] for r in df.select("i", field.parse(field.raw(F.lit(""))).alias("d")).collect()}
        assert got[0] is None and got[1] is None and got[2] is None and got[4] is None


def test_title_by_position_needs_its_place(spark):
    """A title elsewhere is no title: the page is rejected, as the reference finds nothing there."""
    url, html = PAGES["latercera"]
    moved = html.replace('<div id="fusion-app"><header>', '<div id="fusion-app"><div>ad</div><header>')
    assert extract(frame(spark, "latercera", url, moved), REGISTRY["latercera"]).first()["reason"] == "no_title"
