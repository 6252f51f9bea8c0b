"""HTML extraction as native Column expressions (no Python per row).

Semantics (see SURVEY §2.3):

* a container ends where its own element closes: opens and closes of its tag
  are counted over the text pieces between them;
* only *direct* children in the keep-set contribute text, and all of it, inner
  elements included; other child elements go with all they hold; ``<br>`` and
  other void tags between text nodes split them; parts are joined by a space
  and each paragraph is stripped;
* a new ``<p>`` closes the previous one (HTML5), an unclosed child ends with
  its paragraph; paragraphs that are ``div`` elements may nest;
* tags and attribute names match in either case, values in all three quoting
  forms; a single class name matches one of an element's classes, several
  match the whole attribute;
* comments are removed (the reference leaks comment text by accident), and what
  stands inside scripts, styles, templates and text areas is no markup
  (``inert_free``, ``masked``);
* named HTML 4 entities and numeric ones are decoded once, after tags are gone.

A container's paragraphs are rewritten as one string in which ``\\x02`` opens a
paragraph and ``\\x01`` marks a boundary between text parts.

Documented limit: a ``>`` inside an attribute value ends the tag.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkline.functions.text import WS, clean_text, let, strip_ws

MARK = "\x01"   # boundary between text parts
PSEP = "\x02"   # start of a paragraph
PEND = "\x03"   # end of a paragraph

VOID_TAGS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")

CONTROL_RE = "[\x01-\x03]"
COMMENT_RE = r"(?s)<!--.*?(?:-->|\z)"
#: Elements whose content is text to a parser, never markup.
INERT_TAGS = ("script", "style", "template", "textarea")
INERT_RE = rf"(?is)<!--.*?(?:-->|\z)|(<({'|'.join(INERT_TAGS)})(?:[\s/][^>]*)?>).*?(</\2\s*>|\z)"
ANY_TAG_RE = r"<[^>]*>"
MARK_RUN_RE = MARK + "+"
MARK_EDGE_RE = f"^{MARK}|{MARK}\\z"
MARK_AROUND_PSEP_RE = f"{MARK}?{PSEP}{MARK}?"
WS_AROUND_PSEP_RE = f"{WS}*{PSEP}{WS}*"
OUTSIDE_RE = f"{PEND}[^{PSEP}]*"
LEADING_RE = f"^[^{PSEP}]*"
VALUE_RE = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""


def rx_escape(s: str) -> str:
    """Escape regex metacharacters only (spaces stay literal)."""
    return re.sub(r"([.^$*+?{}\[\]\\|()])", r"\\\1", s)


def open_tag_re(tag: str) -> str:
    """Opening tag of ``tag`` with any attributes (``<p>`` does not match ``<pre>``)."""
    return f"(?i:<{tag}(?:[\\s/][^>]*)?>)"


def close_tag_re(tag: str) -> str:
    return f"(?i:</{tag}\\s*>)"


def attr_is(name: str, value: str) -> str:
    """``name=value`` inside a tag, in any quoting form."""
    v = rx_escape(value)
    return f"(?i:\\s{name}\\s*=\\s*)(?:\"{v}\"|'{v}'|{v}(?=[\\s>]))"


def class_exact_re(tag: str, cls: str) -> str:
    """Opening tag whose class attribute is exactly ``cls`` (XPath ``@class="..."``)."""
    return f"(?i:<{tag})(?=[^>]*{attr_is('class', cls)})\\s[^>]*>"


def class_token_re(tag: str, token: str) -> str:
    """Opening tag that has ``token`` among its classes (CSS ``tag.token``)."""
    t = rx_escape(token)
    return (f"(?i:<{tag})(?=[^>]*(?i:\\sclass\\s*=\\s*)(?:\"(?:[^\">]*\\s)?{t}(?:\\s[^\">]*)?\"|'(?:[^'>]*\\s)?{t}(?:\\s[^'>]*)?'"
            f"|{t}(?=[\\s>])))\\s[^>]*>")


def class_open_re(tag: str, cls: str) -> str:
    """``find(tag, class_=cls)``: one name matches a class of the element, several the whole attribute."""
    return class_exact_re(tag, cls) if re.search(r"\s", cls) else class_token_re(tag, cls)


def id_open_re(tag: str, ident: str) -> str:
    return f"(?i:<{tag})(?=[^>]*{attr_is('id', ident)})\\s[^>]*>"


def _names(tags: Sequence[str]) -> str:
    return "(?:" + "|".join(tags) + ")"


VOID_RE = f"(?i)<{_names(VOID_TAGS)}(?:[\\s/][^>]*)?>"


def inner_tags_re(tag: str) -> str:
    """Each tag inside an element ``tag``: a match starts at its opening tag or goes on where the last one ended."""
    return f"(?i)(?:(<{tag}(?:[\\s/][^>]*)?>)|(?!\\A)\\G)([^<{PSEP}{PEND}]*)<(?!/?{tag}[\\s/>])[^>]*>"


def child_tag_re(keep: Sequence[str]) -> str:
    """Opening or closing tag of a child that is not kept; its name is the group."""
    stay = _names((*keep, *VOID_TAGS, "p"))
    return f"</?(?!{stay}[\\s/>])([a-z][\\w:-]*)(?:[\\s/][^>]*)?>"


def kept_tags_re(keep: Sequence[str]) -> str:
    """Open/close tags of kept children plus void tags: all become part boundaries."""
    return f"(?i)</?{_names((*keep, *VOID_TAGS))}(?:[\\s/][^>]*)?>"


ENTITY_RE = r"^&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,8});"


def decode_entities(c: Column) -> Column:
    """Named HTML 4 and numeric entities, each decoded once (``&amp;lt;`` gives ``&lt;``); others stay."""
    table = F.create_map(*(F.lit(x) for name, code in name2codepoint.items() for x in (name, chr(code))), F.lit("apos"), F.lit("'"))

    def one(piece: Column) -> Column:
        name = F.regexp_extract(piece, ENTITY_RE, 1)
        hexa = F.lower(F.substring(name, 2, 1)) == "x"
        code = F.when(hexa, F.conv(F.substring(name, 3, 8), 16, 10)).otherwise(F.substring(name, 2, 8)).cast("int")
        good = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.when(good, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))
        found = F.when(name.startswith("#"), char).otherwise(F.element_at(table, name))
        return F.coalesce(F.concat(found, F.substring(piece, F.length(name) + 3, 1 << 30)), piece)

    pieces = F.split(c, "(?=&#?[A-Za-z0-9]{1,9};)")
    return F.array_join(F.transform(pieces, lambda p: F.when(p.startswith("&"), one(p)).otherwise(p)), "")


def nullif_empty(c: Column) -> Column:
    return F.when(c != "", c)


# ---------------------------------------------------------------- regions ---

def _delta(piece: Column, tag: str) -> Column:
    return F.when(piece.rlike(f"(?i)^<{tag}[\\s/>]"), 1).when(piece.rlike(f"(?i)^</{tag}[\\s/>]"), -1).otherwise(0)


def until_closed(rest: Column, tag: str) -> Column:
    """The inner HTML of an element whose opening tag ends where ``rest`` begins; all of it if it is never closed."""
    def inner(r: Column) -> Column:
        start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("at"), F.lit(-1).alias("end"))

        def step(s: Column, piece: Column) -> Column:
            depth = s["depth"] + _delta(piece, tag)
            open_ = s["end"] < 0
            return F.struct(F.when(open_, depth).otherwise(s["depth"]).alias("depth"),
                            (s["at"] + F.length(piece)).alias("at"),
                            F.when(open_ & (depth == 0), s["at"]).otherwise(s["end"]).alias("end"))

        end = F.aggregate(F.split(r, f"(?i)(?=</?{tag}[\\s/>])"), start, step, lambda s: F.when(s["end"] < 0, s["at"]).otherwise(s["end"]))
        return F.substring(r, F.lit(1), end)

    return let(rest, inner)


def inert_free(html: Column) -> Column:
    """The page without comments and without the content of scripts and the like; their tags stay."""
    return F.regexp_replace(html, INERT_RE, "$1$3")


def masked(html: Column) -> Column:
    """The page with blanks in place of comments, scripts and the like: a place in it is the same place in the page."""
    def blanked(found: Column) -> Column:
        parts = F.zip_with(F.split(html, INERT_RE), found, lambda p, i: F.concat(p, F.coalesce(F.repeat(F.lit(" "), F.length(i)), F.lit(""))))
        return F.when(F.size(found) > 0, F.array_join(parts, "")).otherwise(html)

    return let(F.regexp_extract_all(html, F.lit(INERT_RE), F.lit(0)), blanked)


def first_block(html: Column, open_re: str, tag: str) -> Column:
    """Inner HTML of the first element whose opening tag matches; NULL when there is none.

    Comments, and what scripts and the like contain, are left out, so no element is found in them.
    """
    def block(x: Column) -> Column:
        return F.when(F.regexp_like(x, F.lit(open_re)), until_closed(F.regexp_extract(x, f"(?s){open_re}(.*)\\z", 1), tag))

    return let(inert_free(html), block)


def all_blocks(html: Column, tag: str) -> Column:
    """Inner HTML of every closed ``tag`` element (they don't nest), in document order."""
    return F.regexp_extract_all(html, F.lit(f"(?s){open_tag_re(tag)}(.*?){close_tag_re(tag)}"), F.lit(1))


def block_after_key(html: Column, tag: str, class_prefix: str, key: Column) -> Column:
    """E8 with a class computed from another column, e.g. ``banners-contenido-nota-{id}``."""
    tags = F.regexp_extract_all(html, F.lit(f"(?i)<{tag}\\s[^>]*>"), F.lit(0))
    name = F.concat(F.lit(class_prefix), key)
    opened = F.get(F.filter(tags, lambda t: F.array_contains(F.split(F.coalesce(attr_value(t, "class"), F.lit("")), r"\s+"), name)), 0)
    rest = F.substring(html, F.instr(html, opened) + F.length(opened), F.length(html))
    return F.when(opened.isNotNull(), until_closed(rest, tag))


#: Pieces that one inner fold takes; its output is joined before the next one starts.
SCAN_BLOCK = 64


def scanned(pieces: Column, state: Column, out: Column, step: Callable[[Column, Column], Column], join: Callable[[Column], Column], finish: Callable[[Column], Column]) -> Column:
    """A fold over ``pieces`` that also collects: ``step(s, piece)`` returns ``s`` = (state, out) with something appended to ``out`` or not.

    An array that grows with every piece would be copied with every piece.  So
    the pieces are taken in blocks: a block is folded from the state that the
    one before ended with into an ``out`` of its own, ``join`` makes one value of
    that, and only those are collected; ``finish`` gets them as an array.
    """
    def block(s: Column, at: Column) -> Column:
        inner = F.aggregate(F.slice(pieces, at, F.lit(SCAN_BLOCK)), F.struct(s["state"].alias("state"), out.alias("out")), step)
        return let(inner, lambda x: F.struct(x["state"].alias("state"), F.array_append(s["out"], join(x["out"])).alias("out")))

    def run(pieces_: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(pieces_), F.lit(SCAN_BLOCK))
        return F.aggregate(starts, F.struct(state.alias("state"), F.array(join(out)).alias("out")), block, lambda s: finish(s["out"]))

    return run(pieces)


def nested_blocks(container: Column, tag: str) -> Column:
    """For each ``tag`` element, in document order, its content without that of ``tag`` elements inside it (a MARK instead).

    One scan gives each piece the number of the element it belongs to; sorted by that number, the pieces are joined and cut where it changes.
    """
    piece_type = "array<struct<own:int,html:string>>"
    start = F.struct(F.array().cast("array<int>").alias("stack"), F.lit(0).alias("n"))

    def step(s: Column, piece: Column) -> Column:
        stack, n = s["state"]["stack"], s["state"]["n"]
        opens, closes = _delta(piece, tag) == 1, _delta(piece, tag) == -1
        number = n + F.when(opens, 1).otherwise(0)
        size = F.size(stack)
        now = F.when(opens, F.array_append(stack, number)).when(closes & (size > 0), F.slice(stack, F.lit(1), F.greatest(size - 1, F.lit(0)))).otherwise(stack)

        def both(now: Column) -> Column:
            text = F.regexp_replace(piece, f"(?i)^</?{tag}(?:[\\s/][^>]*)?>", "")
            out = F.when(F.size(now) > 0, F.array_append(s["out"], F.struct(F.element_at(now, -1).alias("own"), text.alias("html")))).otherwise(s["out"])
            return F.struct(F.struct(now.alias("stack"), number.alias("n")).alias("state"), out.alias("out"))

        return let(now, both)

    def texts(found: Column) -> Column:
        def cut(rows: Column) -> Column:
            def edge(x: Column, i: Column) -> Column:
                before = F.when(i > 0, F.get(rows, i - 1)["own"])
                return F.concat(F.when(before.isNull(), F.lit("")).when(before == x["own"], F.lit(MARK)).otherwise(F.lit(PSEP)), x["html"])
            return F.when(F.size(rows) == 0, F.array().cast("array<string>")).otherwise(F.split(F.array_join(F.transform(rows, edge), ""), PSEP))

        # numbered first, so that sorting by element keeps the order within it
        rows = F.transform(F.flatten(found), lambda x, i: F.struct(x["own"].alias("own"), i.alias("i"), x["html"].alias("html")))
        return let(F.array_sort(rows), cut)

    pieces = F.split(container, f"(?i)(?=</?{tag}[\\s/>])")
    return let(pieces, lambda p: scanned(p, start, F.array().cast(piece_type), step, lambda out: out, texts))


def without_children(x: Column, keep: Sequence[str]) -> Column:
    """``x`` with a MARK in place of each child that is not kept, however deep its own elements nest.

    A closing tag ends the last open element of its name and all that is open inside; one without such an element counts for nothing.  No element reaches over the edge of a paragraph.
    """
    tag = child_tag_re(keep)
    none = F.array().cast("array<string>")

    def step(s: Column, piece: Column) -> Column:
        open_ = s["state"]

        def named(name: Column) -> Column:
            at = F.array_position(F.reverse(open_), name)  # from the end
            ended = F.when(at > 0, F.slice(open_, F.lit(1), (F.size(open_) - at).cast("int"))).otherwise(open_)
            now = F.when(piece.rlike(f"^[{PSEP}{PEND}]"), none).when(name == "", open_).when(piece.startswith("</"), ended).otherwise(F.array_append(open_, name))

            def both(now: Column) -> Column:
                out = F.when(F.size(now) == 0, F.array_append(s["out"], piece)).when(F.size(open_) == 0, F.array_append(s["out"], F.lit(MARK))).otherwise(s["out"])
                return F.struct(now.alias("state"), out.alias("out"))

            return let(now, both)

        return let(F.lower(F.regexp_extract(piece, f"(?i)^{tag}", 1)), named)

    joined = lambda out: F.array_join(out, "")
    pieces = F.split(x, f"(?i)(?={tag})|(?=[{PSEP}{PEND}])")
    return let(pieces, lambda p: scanned(p, none, none, step, joined, joined))


# ------------------------------------------------------------------ paths ---

@dataclass(frozen=True)
class Step:
    """A step of a path: elements ``tag`` (``*``: any), with a class attribute or an id, and which of them.

    ``child``: direct children only, else elements at any depth (those inside another match belong to it).  ``nth``
    counts from 1 among the parent's children of that tag, as in a path expression; with a class or id, those must hold, too.
    """

    tag: str
    cls: str | None = None
    ident: str | None = None
    nth: int | None = None
    child: bool = False

    @classmethod
    def of(cls, text: str) -> "Step":
        """``/div[2]`` (second ``div`` child), ``h3``, ``div.wide list`` (the whole class attribute), ``*#app``."""
        m = re.fullmatch(r"(/?)([\w*:-]+)(?:#([^\[]+)|\.([^\[]+))?(?:\[(\d+)\])?", text)
        if not m:
            raise ValueError(f"no step: {text!r}")
        return cls(m[2], m[4], m[3], int(m[5]) if m[5] else None, bool(m[1]))

    @property
    def name_re(self) -> str:
        return "[a-z][\\w:-]*" if self.tag == "*" else self.tag

    def matches(self, opened: Column) -> Column:
        """Whether an element that begins with its opening tag has the step's name, class and id."""
        ok = opened.rlike(f"^(?i:<{self.name_re}(?=[\\s/>]))")
        for name, value in (("class", self.cls), ("id", self.ident)):
            if value is not None:
                ok = ok & opened.rlike(f"^<(?=[^>]*{attr_is(name, value)})")
        return ok


#: Elements that a sibling of the same name ends.
SIBLING_ENDS = ("p", "li", "dt", "dd", "option", "tr", "td", "th")
#: Elements that end an open paragraph.
ENDS_P = ("address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3",
          "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "pre", "section", "table", "ul")
TAG_RE = r"</?[a-zA-Z][\w:-]*(?:[\s/][^>]*)?>"


def _elements(inner: Column, wanted: Callable[[Column, Column], Column]) -> Column:
    """Outer HTML of the elements of ``inner`` for which ``wanted(opening tag, depth)``, outermost first; one inside another is not listed.

    A running stack of names says where an element ends: at its closing tag, at one of an element around it, or at the end.
    """
    def step(s: Column, piece: Column) -> Column:
        open_ = s["open"]

        def named(name: Column) -> Column:
            at = F.array_position(F.reverse(open_), name)
            top = F.when(F.size(open_) > 0, F.element_at(open_, -1)).otherwise("")
            sibling = name.isin(*SIBLING_ENDS) & (top == name) | name.isin(*ENDS_P) & (top == "p")
            shorter = lambda n: F.slice(open_, F.lit(1), F.greatest(F.size(open_) - n, F.lit(0)).cast("int"))
            before = F.when(piece.startswith("</"), F.when(at > 0, shorter(at)).otherwise(open_)).when(sibling, shorter(F.lit(1))).otherwise(open_)

            def both(before: Column) -> Column:
                opens = (name != "") & ~piece.startswith("</")
                ended = s["begin"].isNotNull() & (F.size(before) < s["depth"])
                found = F.when(ended, F.array_append(s["found"], F.struct(s["begin"].alias("at"), (s["pos"] + F.when(piece.startswith("</") & (F.size(before) == s["depth"] - 1), F.length(F.regexp_extract(piece, f"^{TAG_RE}", 0))).otherwise(0) - s["begin"]).alias("n")))).otherwise(s["found"])
                begin, depth = F.when(~ended, s["begin"]), F.when(~ended, s["depth"])
                void = name.isin(*VOID_TAGS)
                starts = opens & begin.isNull() & wanted(piece, F.size(before))
                # a void element is all of itself
                found = F.when(starts & void, F.array_append(found, F.struct(s["pos"].alias("at"), F.length(F.regexp_extract(piece, f"^{TAG_RE}", 0)).alias("n")))).otherwise(found)
                starts = starts & ~void
                return F.struct(F.when(opens & ~void, F.array_append(before, name)).otherwise(before).alias("open"), (s["pos"] + F.length(piece)).alias("pos"),
                                F.when(starts, s["pos"]).otherwise(begin).alias("begin"), F.when(starts, F.size(before) + 1).otherwise(depth).alias("depth"), found.alias("found"))

            return let(before, both)

        return let(F.lower(F.regexp_extract(piece, "^</?([a-zA-Z][\\w:-]*)(?:[\\s/][^>]*)?>", 1)), named)

    nothing = F.lit(None).cast("int")
    start = F.struct(F.array().cast("array<string>").alias("open"), F.lit(0).alias("pos"), nothing.alias("begin"), nothing.alias("depth"), F.array().cast("array<struct<at:int,n:int>>").alias("found"))
    last = lambda s: F.when(s["begin"].isNotNull(), F.array_append(s["found"], F.struct(s["begin"].alias("at"), (s["pos"] - s["begin"]).alias("n")))).otherwise(s["found"])
    return F.aggregate(F.split(inner, f"(?={TAG_RE})"), start, step, last)


def inner_of(element: Column) -> Column:
    """What is between the tags of an element's outer HTML."""
    name = F.regexp_extract(element, "^<([a-zA-Z][\\w:-]*)", 1)
    return F.regexp_replace(F.regexp_replace(element, f"^{TAG_RE}", ""), F.concat(F.lit("(?i)</"), name, F.lit("\\s*>\\z")), F.lit(""))


def _following(x: Step) -> Callable[[Column], Column]:
    """From an element's outer HTML to those of the elements that the step finds in it."""
    name = lambda tag: tag.rlike(f"^(?i:<{x.name_re}(?=[\\s/>]))")

    def cut(inner: Column) -> Column:
        places = _elements(inner, lambda tag, depth: (depth == 0) & name(tag) if x.child else x.matches(tag))
        if x.nth:
            places = F.filter(places, lambda _, i: i == x.nth - 1)
        return F.filter(F.transform(places, lambda p: F.substring(inner, p["at"] + 1, p["n"])), lambda e: x.matches(e))

    return lambda parent: let(inner_of(parent), cut)


def path_elements(html: Column, path: Sequence[Step | str]) -> Column:
    """Outer HTML of all elements that ``path`` leads to, in document order; comments and scripts hold none."""
    steps = [x if isinstance(x, Step) else Step.of(x) for x in path]
    found = F.array(F.concat(F.lit("<page>"), inert_free(html), F.lit("</page>")))
    for x in steps:
        found = F.flatten(F.transform(found, _following(x)))
    return found


# ------------------------------------------------------------- attributes ---

def attr_value(tag_text: Column, attr: str) -> Column:
    """Raw value of an attribute in the text of a tag; NULL without it."""
    pattern = f"(?i)\\s{attr}\\s*=\\s*{VALUE_RE}"
    raw = F.regexp_extract(tag_text, pattern, 1)
    return F.when(F.regexp_like(tag_text, F.lit(pattern)), F.regexp_replace(raw, "^[\"']|[\"']\\z", ""))


def tag_attr(html: Column, tag: str, attr: str, where: str | None = None) -> Column:
    """Attribute ``attr`` of the first ``<tag>`` that has it.

    ``where`` is a pattern the tag must match (``attr_is``, or an opening-tag
    pattern).  The tag is found first and the attribute read second, so
    attribute order is free.  NULL when there is no such tag or attribute.
    """
    if where is None:
        pattern = f"(?i:<{tag})(?=[^>]*(?i:\\s{attr}\\s*=))\\s[^>]*>"
    else:
        pattern = where if where.startswith("(?i:<") else f"(?i:<{tag})(?=[^>]*{where})\\s[^>]*>"
    return decode_entities(attr_value(F.regexp_extract(html, pattern, 0), attr))


def meta_content(html: Column, prop: str, key: str = "property") -> Column:
    """E5: ``content`` of ``<meta {key}="{prop}">``."""
    return tag_attr(html, "meta", "content", where=attr_is(key, prop))


def jsonld_field(html: Column, path: str) -> Column:
    """A field of the first JSON-LD script block."""
    script = F.regexp_extract(
        html, f"(?is)<script(?=[^>]*{attr_is('type', 'application/ld+json')})\\s[^>]*>(.*?)</script\\s*>", 1)
    return F.get_json_object(nullif_empty(script), path)


# ----------------------------------------------------------- text content ---

@dataclass(frozen=True)
class ParagraphSpec:
    """How a container splits into paragraphs and which children keep text."""

    tag: str = "p"
    cls: str | None = None          # class of selected paragraphs
    keep: tuple[str, ...] = ("a", "strong")
    nested: bool = False            # paragraph elements may lie inside each other


def _prepare(c: Column) -> Column:
    c = F.regexp_replace(c, CONTROL_RE, "")
    return F.regexp_replace(c, COMMENT_RE, "")


def _parts(x: Column, keep: Sequence[str]) -> Column:
    """Turn markup into MARK-separated text parts (direct-child semantics)."""
    for tag in keep:  # a kept child has all its text: only the tags inside it go
        x = F.regexp_replace(x, inner_tags_re(tag), "$1$2")
    x = without_children(x, keep)
    x = F.regexp_replace(x, kept_tags_re(keep), MARK)
    x = F.regexp_replace(x, ANY_TAG_RE, "")
    return decode_entities(x)


def paragraph_stream(container: Column, spec: ParagraphSpec = ParagraphSpec()) -> Column:
    """E9 + E10 + E11: ``\\x02``-prefixed, stripped paragraph texts of a container."""
    x = _prepare(container)
    if spec.cls is None:
        x = F.regexp_replace(x, open_tag_re(spec.tag), PSEP)
    else:
        x = F.regexp_replace(x, class_open_re(spec.tag, spec.cls), PSEP)
        x = F.regexp_replace(x, open_tag_re(spec.tag), PEND)
    x = F.regexp_replace(x, close_tag_re(spec.tag), PEND)
    x = F.regexp_replace(x, OUTSIDE_RE, "")
    x = F.regexp_replace(x, LEADING_RE, "")
    x = _parts(x, spec.keep)
    x = F.regexp_replace(x, MARK_RUN_RE, MARK)
    x = F.regexp_replace(x, MARK_AROUND_PSEP_RE, PSEP)
    x = F.regexp_replace(x, MARK_EDGE_RE, "")
    x = F.replace(x, F.lit(MARK), F.lit(" "))
    x = F.regexp_replace(x, WS_AROUND_PSEP_RE, PSEP)
    return x


def paragraphs(container: Column, spec: ParagraphSpec = ParagraphSpec()) -> Column:
    """E9 as an array of paragraph texts (empty array when there is none)."""
    if spec.nested:
        def text(block: Column) -> Column:
            x = F.regexp_replace(_parts(block, spec.keep), MARK_RUN_RE, MARK)
            return strip_ws(F.replace(F.regexp_replace(x, MARK_EDGE_RE, ""), F.lit(MARK), F.lit(" ")))
        return F.transform(nested_blocks(_prepare(container), spec.tag), text)
    s = paragraph_stream(container, spec)
    return F.when(s == "", F.array().cast("array<string>")).otherwise(
        F.split(F.regexp_replace(s, f"^{PSEP}", ""), PSEP))


def body_text(container: Column, spec: ParagraphSpec = ParagraphSpec(),
              join: str = "space", clean: bool = True) -> Column:
    """E12a / E12b (+ E13): paragraphs joined by a space, or glued.

    ``glued`` reproduces the newline join that ``clean_text`` then deletes, so
    the last word of a paragraph touches the first of the next.
    """
    between = " " if join == "space" else ""
    if spec.nested:
        s = F.array_join(paragraphs(container, spec), between)
    else:
        s = F.regexp_replace(paragraph_stream(container, spec), f"^{PSEP}", "")
        s = F.replace(s, F.lit(PSEP), F.lit(between))
    return clean_text(s) if clean else strip_ws(s)


def own_text(inner: Column) -> Column:
    """``el/text()`` joined: the element's direct text nodes, child elements dropped."""
    x = _parts(_prepare(inner), ())
    return F.replace(x, F.lit(MARK), F.lit(""))


def first_own_text(inner: Column) -> Column:
    """``el/text()[0]``: the first direct text node (NULL when there is none)."""
    x = F.regexp_replace(_parts(_prepare(inner), ()), MARK_RUN_RE, MARK)
    x = F.regexp_replace(x, f"^{MARK}", "")
    first = F.regexp_extract(x, f"^([^{MARK}]*)", 1)
    return nullif_empty(first)


def all_text(inner: Column) -> Column:
    """String value: every descendant text node, tags removed."""
    x = F.regexp_replace(_prepare(inner), ANY_TAG_RE, "")
    return decode_entities(x)


def h1_title(html: Column) -> Column:
    """All ``//h1/text()`` nodes concatenated, then ``clean_text``."""
    inner = F.array_join(all_blocks(html, "h1"), MARK)
    return clean_text(own_text(inner))


def h1_title_strict(html: Column) -> Column:
    """First text node of the first ``h1``; NULL means the row is rejected."""
    inner = F.get(all_blocks(html, "h1"), 0)
    return first_own_text(inner)


def extract_content(container: Column, tag: str = "p") -> Column:
    """Descendant text of each paragraph joined by newlines, NBSP/CRLF normalised."""
    x = _prepare(container)
    x = F.regexp_replace(x, open_tag_re(tag), PSEP)
    x = F.regexp_replace(x, close_tag_re(tag), PEND)
    x = F.regexp_replace(x, OUTSIDE_RE, "")
    x = F.regexp_replace(x, LEADING_RE, "")
    x = decode_entities(F.regexp_replace(x, ANY_TAG_RE, ""))
    x = F.regexp_replace(x, f"^{PSEP}", "")
    x = F.replace(x, F.lit(PSEP), F.lit("\n"))
    x = F.replace(x, F.lit("\u00a0"), F.lit(" "))
    return F.replace(x, F.lit("\r\n"), F.lit("\n"))


def remove_nodes(html: Column, selectors: Sequence[str]) -> Column:
    """Delete, for each selector in turn, the first element that it finds, to the element's own end.

    Selectors are ``tag``, ``.class`` (one of the element's classes), ``#id`` and their combinations, such as ``div.ad#top``.
    Nothing is found inside comments, scripts and the like; a void element is its tag, one that is never closed goes to the end.
    """
    for selector in selectors:
        html = _without_first(html, selector)
    return html


def _selector_re(selector: str) -> str:
    m = re.fullmatch(r"([\w*:-]*)((?:[.#][^.#\s]+)*)", selector)
    if not m or not selector:
        raise ValueError(f"no selector: {selector!r}")
    tag = m[1] if m[1] not in ("", "*") else "[a-z][\\w:-]*"
    out = ""
    for kind, value in re.findall(r"([.#])([^.#\s]+)", m[2]):
        v = rx_escape(value)
        classes = f"(?i:\\sclass\\s*=\\s*)(?:\"(?:[^\">]*\\s)?{v}(?:\\s[^\">]*)?\"|'(?:[^'>]*\\s)?{v}(?:\\s[^'>]*)?'|{v}(?=[\\s>]))"
        out += f"(?=[^>]*{classes})" if kind == "." else f"(?=[^>]*{attr_is('id', value)})"
    return f"(?i:<({tag}))(?=[\\s/>]){out}[^>]*>"


def _without_first(html: Column, selector: str) -> Column:
    opened = _selector_re(selector)

    def cut(seen: Column) -> Column:
        def at(tag: Column) -> Column:
            place = F.instr(seen, tag)
            name = F.lower(F.regexp_extract(tag, opened, 1))
            rest = F.substring(seen, place + F.length(tag), F.length(seen))
            # up to the closing tag of this element: opens and closes of its name are counted over the pieces
            pieces = F.split(rest, F.concat(F.lit("(?i)(?=</?"), name, F.lit("[\\s/>])")))
            start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("at"), F.lit(-1).alias("end"))

            def step(s: Column, piece: Column) -> Column:
                named = lambda slash: F.regexp_like(piece, F.concat(F.lit(f"(?i)^<{slash}"), name, F.lit("[\\s/>]")))
                depth = s["depth"] + F.when(named("/"), -1).when(named(""), 1).otherwise(0)
                ends = (s["end"] < 0) & (depth == 0)
                return F.struct(F.when(s["end"] < 0, depth).otherwise(s["depth"]).alias("depth"), (s["at"] + F.length(piece)).alias("at"),
                                F.when(ends, s["at"] + F.length(F.regexp_extract(piece, "^</[^>]*>", 0))).otherwise(s["end"]).alias("end"))

            gone = F.aggregate(pieces, start, step, lambda s: F.when(s["end"] < 0, s["at"]).otherwise(s["end"]))
            gone = F.when(name.isin(*VOID_TAGS), F.lit(0)).otherwise(gone)
            return F.when(tag == "", html).otherwise(F.concat(F.substring(html, F.lit(1), place - 1), F.substring(html, place + F.length(tag) + gone, F.length(html))))

        return let(F.regexp_extract(seen, opened, 0), at)

    return let(masked(html), cut)


def remove_first(html: Column, tag: str) -> Column:
    """E18 for one tag name."""
    return remove_nodes(html, [tag])
