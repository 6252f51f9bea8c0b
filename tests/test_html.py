from pyspark.sql import functions as F

from inkline.functions import html as H
from conftest import one

STRONG = H.ParagraphSpec("p", None, ("a", "strong"))
B = H.ParagraphSpec("p", None, ("a", "b"))


def body(spark, html, spec=STRONG, join="space"):
    return one(spark, lambda c: H.body_text(F.col(c), spec, join), html)


def test_direct_children_keep_set(spark):
    html = ("<p>Uno <a href='x'>dos</a> <strong>tres</strong> <em>no</em> <span>nunca</span>"
            "<b>fuera</b> cuatro<br>cinco<!-- ad --></p>")
    assert body(spark, html) == "Uno  dos   tres      cuatro cinco"
    assert body(spark, html, B) == "Uno  dos       fuera  cuatro cinco"


def test_space_versus_glued(spark):
    html = "<p>fin uno.</p><p>Dos</p>"
    assert body(spark, html, join="space") == "fin uno. Dos"
    assert body(spark, html, join="glued") == "fin uno.Dos"


def test_unclosed_p_and_b(spark):
    html = "<p><b>Negrita abierta<br><p>Segundo</p>"
    assert body(spark, html, STRONG) == "Segundo"            # the b paragraph is dropped
    assert body(spark, html, B) == "Negrita abierta Segundo"


def test_entities_decode_once(spark):
    html = "<p>a &amp; b&nbsp;c &lt;x&gt; &amp;lt;</p>"
    assert body(spark, html) == "a & b c <x> &lt;"


def test_empty_paragraph_adds_a_space(spark):
    assert body(spark, "<p>a</p><p></p><p>b</p>") == "a  b"


def test_no_paragraph_gives_empty_body(spark):
    assert body(spark, "<div>sin parrafos</div>") == ""


def test_titles(spark):
    html = "<h1>Hola <span>x</span>mundo</h1><h1> y más\n</h1>"
    assert one(spark, lambda c: H.h1_title(F.col(c)), html) == "Hola mundo y más"
    assert one(spark, lambda c: H.h1_title_strict(F.col(c)), html) == "Hola "
    assert one(spark, lambda c: H.h1_title_strict(F.col(c)), "<p>no h1</p>") is None


def test_attributes_and_meta(spark):
    html = ('<html lang="es"><meta content="2023-05-04" property="article:published_time">'
            '<meta property="og:title" content="T &amp; T">')
    assert one(spark, lambda c: H.meta_content(F.col(c), "article:published_time"), html) == "2023-05-04"
    assert one(spark, lambda c: H.meta_content(F.col(c), "og:title"), html) == "T & T"
    assert one(spark, lambda c: H.meta_content(F.col(c), "og:url"), html) is None
    assert one(spark, lambda c: H.tag_attr(F.col(c), "html", "lang"), html) == "es"


def test_jsonld(spark):
    html = '<script type="application/ld+json">{"datePublished": "2023-05-04T10:00:00Z"}</script>'
    assert one(spark, lambda c: H.jsonld_field(F.col(c), "$.datePublished"), html) == "2023-05-04T10:00:00Z"


def test_container_and_computed_class(spark):
    html = '<meta name="identrada" content="77"><div class="banners-contenido-nota-77"><p>x</p></div>'
    key = H.meta_content(F.col("x"), "identrada", key="name")
    got = spark.createDataFrame([(html,)], "x string").select(
        H.block_after_key(F.col("x"), "div", "banners-contenido-nota-", key)).first()[0]
    assert got == "<p>x</p>"
    assert one(spark, lambda c: H.first_block(F.col(c), H.open_tag_re("main"), "main"), "<p>x</p>") is None


def test_extract_content_and_remove_first(spark):
    html = "<p>a <em>b</em>&nbsp;c</p><p>d\r\ne</p>"
    assert one(spark, lambda c: H.extract_content(F.col(c)), html) == "a b c\nd\ne"
    assert one(spark, lambda c: H.remove_first(F.col(c), "nav"), "x<nav>1</nav>y<nav>2</nav>") == "xy<nav>2</nav>"


def test_paragraph_class_selector(spark):
    spec = H.ParagraphSpec("p", "paragraph", ("a", "b"))
    html = '<p class="paragraph">uno</p><p>fuera</p><p class="paragraph">dos'
    assert one(spark, lambda c: H.body_text(F.col(c), spec), html) == "uno dos"


def test_kept_children_keep_all_their_text(spark):
    html = "<p>uno <a>dos <em>tres</em> cuatro</a> <strong><span>cinco</span></strong> <em>no <a>nada</a></em>fin</p>"
    assert body(spark, html) == "uno  dos tres cuatro   cinco   fin"
    assert body(spark, "<p><strong>a <a href='x'>b</a> c</strong><a>d <strong>e</strong></a></p>") == "a b c d e"
    assert body(spark, "<p>x <span>a <span>b</span> c</span> y <i>sin fin</p><p>z</p>") == "x   y z"
    assert body(spark, "<p>x <custom-tag>no</custom-tag><script>if (a<b) {}</script>y</p>") == "x  y"


def test_case_and_quoting(spark):
    assert body(spark, "<P CLASS=x>Uno <STRONG>dos</STRONG></P><p>Tres<BR/>Cuatro</p>") == "Uno  dos Tres Cuatro"
    for html in ("<META PROPERTY='og:title' CONTENT='T'>", "<meta property=og:title content=T>", '<meta content="T" property="og:title"/>'):
        assert one(spark, lambda c: H.meta_content(F.col(c), "og:title"), html) == "T"


def test_container_ends_where_it_closes(spark):
    html = '<div class="x"><div class="body wide"><p>Uno.</p><div class="ad">x<div>y</div></div><P>Dos.</P></div><p>fuera</p></div>'
    found = one(spark, lambda c: H.first_block(F.col(c), H.class_open_re("div", "body"), "div"), html)
    assert found == '<p>Uno.</p><div class="ad">x<div>y</div></div><P>Dos.</P>'
    assert one(spark, lambda c: H.first_block(F.col(c), H.class_open_re("div", "body"), "div"), '<div class="body">a<div>b</div>') == "a<div>b</div>"
    assert one(spark, lambda c: H.first_block(F.col(c), H.class_exact_re("div", "body"), "div"), html) is None
    assert one(spark, lambda c: H.first_block(F.col(c), H.class_open_re("div", "body wide"), "div"), html) == found
    assert one(spark, lambda c: H.first_block(F.col(c), H.class_open_re("div", "bod"), "div"), html) is None


def test_nested_div_paragraphs(spark):
    spec = H.ParagraphSpec("div", None, ("a", "b"), nested=True)
    html = "<div>Uno <b>dos</b> <i>no</i><div>dentro</div> tres</div><div>Cuatro</div>cola"
    assert one(spark, lambda c: H.paragraphs(F.col(c), spec), html) == ["Uno  dos    tres", "dentro", "Cuatro"]
    assert body(spark, html, spec, "glued") == "Uno  dos    tresdentroCuatro"
    assert one(spark, lambda c: H.paragraphs(F.col(c), spec), "nada") == []


def test_named_and_numeric_entities(spark):
    html = "<p>&ntilde;&eacute; &#8220;x&#8221; &hellip; &#241; &#xF1; &#128512; &amp;ntilde; &nada; &#0; R&D &lt;b&gt; &Ntilde;</p>"
    assert body(spark, html) == "ñé “x” … ñ ñ 😀 &ntilde; &nada; \ufffd R&D <b> Ñ"


def test_dropped_child_of_any_depth(spark):
    """Text after a dropped child stays, however deep elements of its name nest in it."""
    for n in (1, 3, 4, 5, 7, 10, 200):
        deep = "<span class='x'>in " * n + "out</SPAN > " * n
        assert body(spark, f"<p>Before {deep}after <strong>kept</strong> text.</p><p>Next</p>").split() == "Before after kept text. Next".split()
        assert one(spark, lambda c: H.h1_title(F.col(c)), f"<h1>Uno {deep}dos</h1>").split() == ["Uno", "dos"]
        div = "<div>" * n + "x" + "</div>" * n
        assert body(spark, f"<p>a <em>{div}</em>b {deep}{div}c</p>").split() == ["a", "b", "c"]


def test_dropped_child_malformed(spark):
    assert body(spark, "<p>a <span><span><span><span><span>x</span></span>lost</p><p>b</p>") == "a b"     # unclosed: to the end of its paragraph
    assert body(spark, "<p>a <div><div></div><em>x</div>y</em>z</p>") == "a  yz"                          # </div> ends <em>, too
    assert body(spark, "<p>a</span> b <span/>c</span>d</p>") == "a b  d"


def test_nothing_is_found_in_comments_and_scripts(spark):
    html = ('<script>var a="<article><p>script text</p></article>"</script><!-- <article>..old..</article> --><textarea><article>t</article></textarea>'
            "<style>article{}</style><template><article>x</article></template><article><p>real</p><SCRIPT>'</article>'</SCRIPT ><p>more</p></article>")
    assert one(spark, lambda c: H.body_text(H.first_block(F.col(c), H.open_tag_re("article"), "article")), html) == "real more"
    assert one(spark, lambda c: H.masked(F.col(c)), html) == H_masked(html) and len(one(spark, lambda c: H.masked(F.col(c)), html)) == len(html)
    assert one(spark, lambda c: H.masked(F.col(c)), "<p>plain</p>") == "<p>plain</p>" and one(spark, lambda c: H.masked(F.col(c)), "<!-- open") == " " * 9
    page = "<script type='application/ld+json'>{\"datePublished\": \"2024\"}</script>"
    assert one(spark, lambda c: H.jsonld_field(F.col(c), "$.datePublished"), page) == "2024"


def H_masked(html):
    import re
    return re.sub(H.INERT_RE.replace("(?is)", "").replace("\\z", "\\Z"), lambda m: " " * len(m[0]), html, flags=re.I | re.S)


def test_remove_nodes_by_selector(spark):
    def cut(html, *selectors):
        return one(spark, lambda c: H.remove_nodes(F.col(c), selectors), html)

    assert cut("<nav><nav>a</nav>tail</nav>z<nav>q</nav>", "nav") == "z<nav>q</nav>"
    assert cut('a<div class="big ad"><div>1</div></div>b<p id=x>q</p>c<br>d<br>', ".ad", "#x", "br") == "abcd<br>"
    assert cut('<div class="a"></div><div class="a b" id="k">x</div>y', "div.a.b#k") == '<div class="a"></div>y'
    assert cut("<!-- <i>no</i> --><script>'<i>'</script><i>yes</i>z", "i") == "<!-- <i>no</i> --><script>'<i>'</script>z"
    assert cut("<navx>a</navx><NAV>b", "nav") == "<navx>a</navx>" and cut("<p>a</p>", ".none", "b") == "<p>a</p>"


def test_paths_with_positions(spark):
    def at(html, *path):
        return one(spark, lambda c: H.path_elements(F.col(c), path), html)

    html = ('<h1>no</h1><div id="app"><p>x<p>y<div><div><h1>decoy</h1></div><section><h1>yes</h1><br></section><section>no<h1>two</h1></section></div>'
            "<div><section><h1>wrong</h1></section></div></div><!-- <div id=app><div><section><h1>old</h1></section></div></div> -->")
    assert at(html, "*#app", "/div[1]", "/section", "/h1") == ["<h1>yes</h1>", "<h1>two</h1>"]
    assert at(html, "*#app", "/div[2]", "/section[1]", "/h1") == ["<h1>wrong</h1>"] and at(html, "*#app", "/div[3]") == []
    assert at("<ul><li><a>1</a><li><a href=x>2</a> <a>3</a><li>z</ul>", "ul", "/li[2]", "/a") == ["<a href=x>2</a>", "<a>3</a>"]
    assert at('<div class="k"><nav><a>1</a></nav></div><div class="k l"><nav><a>2</a></nav></div>', "div.k", "/nav", "/a") == ["<a>1</a>"]
    assert at("<div><img src=1><img src=2></div>", "div", "/img[2]") == ["<img src=2>"]


def test_extraction_grows_with_the_page(spark):
    """Twice the dropped children or nested blocks cost at most 2.5 times, beyond what a query costs anyway."""
    import time

    def seconds(build, html):
        df = spark.createDataFrame([(html,)], "x string").select(F.length(build(F.col("x"))).alias("n"))
        runs = []
        for _ in range(3):
            t = time.perf_counter()
            df.collect()
            runs.append(time.perf_counter() - t)
        return min(runs)

    spec = H.ParagraphSpec("div", None, ("a",), nested=True)
    for build, piece in ((lambda c: H.body_text(c, STRONG), "x <span class=q>in</span> y"), (lambda c: H.body_text(c, spec), "<div>x</div> y")):
        wrap = lambda n, piece=piece: "<p>" + piece * n + "</p>"
        base = seconds(build, wrap(1))
        small, large = seconds(build, wrap(4000)) - base, seconds(build, wrap(8000)) - base
        assert large < 2.5 * max(small, 0.4) and large < 5


def test_scan_equals_a_plain_stack(spark):
    """Random markup, longer than a block of the scan: the same text as a stack in Python gives."""
    import random
    import re

    rnd = random.Random(3)
    pieces = ["<i>", "</i>", "<span>", "</span>", "<em class=x>", "</em>", "t ", "u", "<a>", "</a>", "</strong>", "<u>", "</u>"]
    for n in (5, 60, 64, 65, 500):
        x = "".join(rnd.choice(pieces) for _ in range(n))
        out, stack = "", []
        for tag, text in re.findall(r"(</?(?:i|span|em|u)(?: class=x)?>)|((?:(?!</?(?:i|span|em|u)[ >]).)+)", x):
            before = len(stack)
            if tag.startswith("</"):
                name = tag[2:-1]
                if name in stack:
                    while stack.pop() != name:
                        pass
            elif tag:
                stack.append(re.match(r"<(\w+)", tag)[1])
            # a closing tag and the text after it are one piece, kept as markup when nothing is open
            out += (text or tag) if not stack and not (tag and before) else ""
            if tag and stack and not before:
                out += H.MARK
            if tag and before and not stack:
                out += tag
        got = one(spark, lambda c: H.without_children(F.col(c), ("a", "strong")), x)
        assert re.sub("<[^>]*>", "", got) == re.sub("<[^>]*>", "", out)
