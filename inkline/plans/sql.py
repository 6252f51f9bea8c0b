"""DuckDB SQL builders mirroring the Column functions, for the oracle check.

Each builder takes SQL text and returns SQL text.  HTML goes by the oracle's
own patterns (``oracle_patterns``); texts, dates and URLs by the constants that
define them.  DuckDB differences handled here: ``'g'`` for global
replace, ``\\1`` instead of ``$1``, ``||`` (NULL if any side is NULL, like
Spark's ``concat``), 1-based list indexing, ``lambda x:`` syntax.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from inkline.functions import dates as D
from inkline.functions import text as T
from inkline.functions import urls as U
from inkline.functions.html import ParagraphSpec
from inkline.plans import oracle_patterns as H


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _rep(r: str) -> str:
    return re.sub(r"\$(\d)", r"\\\1", r)


def rr(x: str, pat: str, rep: str = "") -> str:
    return f"regexp_replace({x}, {lit(pat)}, {lit(_rep(rep))}, 'g')"


def rx(x: str, pat: str, group: int = 0) -> str:
    return f"regexp_extract({x}, {lit(pat)}, {group})"


def rlike(x: str, pat: str) -> str:
    return f"regexp_matches({x}, {lit(pat)})"


def rep(x: str, a: str, b: str) -> str:
    return f"replace({x}, {lit(a)}, {lit(b)})"


def cat(*parts: str) -> str:
    return "(" + " || ".join(parts) + ")"


def arr(items: Sequence[str]) -> str:
    return "[" + ", ".join(lit(i) for i in items) + "]::VARCHAR[]"


# ------------------------------------------------------------------ text ---

def strip_ws(x: str) -> str:
    return rr(x, T.STRIP_RE)


def clean_text(x: str) -> str:
    return strip_ws(rep(x, "\n", ""))


def tokens(x: str) -> str:
    y = f"lower({x})"
    y = rr(y, T.PUNCT_RE, " $1 ")
    y = rr(y, T.COLON_COMMA_RE, " $1 $2")
    y = rr(y, T.COLON_COMMA_END_RE, " $1 ")
    y = rr(y, T.FINAL_DOT_RE, " . $1")
    return f"string_split_regex({y}, {lit(T.WS + '+')})"


def alpha_tokens(x: str) -> str:
    return f"list_filter({tokens(x)}, lambda w: {rlike('w', T.ALPHA_RE)})"


def remove_stopwords(words: str, stopwords: Sequence[str] = T.DEFAULT_STOPWORDS) -> str:
    if not stopwords:
        return words
    return f"list_filter({words}, lambda w: NOT list_contains({arr(stopwords)}, w))"


def normalize_text(x: str, stopwords: Sequence[str] = T.DEFAULT_STOPWORDS) -> str:
    return f"array_to_string({remove_stopwords(alpha_tokens(x), stopwords)}, ' ')"


def keyphrase_flag(x: str, phrases: Sequence[str] = T.GORE_PHRASES) -> str:
    if not phrases:
        return "CAST(0 AS INTEGER)"
    ors = " OR ".join(f"instr(lower({x}), {lit(p)}) > 0" for p in phrases)
    return f"CAST(coalesce(({ors}), false) AS INTEGER)"


def build_prompt(x: str, max_chars: int = T.PROMPT_MAX_CHARS) -> str:
    return cat(lit(T.PROMPT_INSTRUCTION + T.PROMPT_BASE), f"substring({x}, 1, {max_chars})")


def parse_labels(answer: str, vocab: Sequence[str] = T.CATEGORIES) -> tuple[str, str]:
    voc = arr(vocab)
    parts = f"string_split({answer}, ';')"
    r1, r2 = strip_ws(f"{parts}[1]"), strip_ws(f"{parts}[2]")
    c1 = f"(CASE WHEN list_contains({voc}, {r1}) THEN {r1} ELSE 'Otro' END)"
    c2 = f"(CASE WHEN list_contains({voc}, {r2}) THEN {r2} ELSE 'Otro' END)"
    s = strip_ws(answer)
    single = f"(CASE WHEN list_contains({voc}, {s}) THEN {s} ELSE 'Otro' END)"
    multi = f"contains({answer}, ';')"
    cat1 = f"(CASE WHEN {answer} IS NULL THEN NULL WHEN {multi} THEN {strip_ws(c1)} ELSE {single} END)"
    cat2 = (f"(CASE WHEN {answer} IS NULL OR NOT {multi} THEN NULL WHEN {c1} = {c2} THEN NULL "
            f"ELSE {strip_ws(c2)} END)")
    return cat1, cat2


# ------------------------------------------------------------------ html ---

def decode_entities(x: str) -> str:
    for ent, ch in H.ENTITIES:
        x = rep(x, ent, ch)
    return x


def first_block(html: str, open_re: str, end_re: str) -> str:
    pat = f"(?s){open_re}(.*?)(?:{end_re}|\\z)"
    return f"(CASE WHEN {rlike(html, '(?s)' + open_re)} THEN {rx(html, pat, 1)} END)"


def all_blocks(html: str, open_re: str, end_re: str) -> str:
    return f"regexp_extract_all({html}, {lit(f'(?s){open_re}(.*?){end_re}')}, 1)"


def tag_attr(html: str, tag: str, attr: str) -> str:
    tag_txt = rx(html, H.tag_attr_pattern(tag, attr), 0)
    val = decode_entities(rx(tag_txt, H.attr_value_pattern(attr), 1))
    return f"(CASE WHEN {rlike(tag_txt, H.attr_value_pattern(attr))} THEN {val} END)"


def _prepare(x: str) -> str:
    return rr(rr(x, H.CONTROL_RE), H.COMMENT_RE)


def _parts(x: str, keep: Sequence[str]) -> str:
    for pat in H.drop_patterns(keep):
        x = rr(x, pat, H.MARK + "$1")
    x = rr(x, H.kept_tags_re(keep) if keep else H.VOID_RE, H.MARK)
    x = rr(x, H.ANY_TAG_RE)
    return decode_entities(x)


def paragraph_stream(container: str, spec: ParagraphSpec = ParagraphSpec()) -> str:
    x = _prepare(container)
    if spec.cls is None:
        x = rr(x, H.open_tag_re(spec.tag), H.PSEP)
    else:
        x = rr(x, H.class_open_re(spec.tag, spec.cls), H.PSEP)
        x = rr(x, H.open_tag_re(spec.tag), H.PEND)
    x = rr(x, H.close_tag_re(spec.tag), H.PEND)
    x = rr(x, H.OUTSIDE_RE)
    x = rr(x, H.LEADING_RE)
    x = _parts(x, spec.keep)
    x = rr(x, H.MARK_RUN_RE, H.MARK)
    x = rr(x, H.MARK_AROUND_PSEP_RE, H.PSEP)
    x = rr(x, H.MARK_EDGE_RE)
    x = rep(x, H.MARK, " ")
    x = rr(x, H.WS_AROUND_PSEP_RE, H.PSEP)
    return x


def paragraphs(container: str, spec: ParagraphSpec = ParagraphSpec()) -> str:
    s = paragraph_stream(container, spec)
    return (f"(CASE WHEN {s} = '' THEN []::VARCHAR[] ELSE "
            f"string_split({rr(s, '^' + H.PSEP)}, {lit(H.PSEP)}) END)")


def body_text(container: str, spec: ParagraphSpec = ParagraphSpec(), join: str = "space",
              clean: bool = True) -> str:
    s = rr(paragraph_stream(container, spec), "^" + H.PSEP)
    s = rep(s, H.PSEP, " " if join == "space" else "")
    return clean_text(s) if clean else strip_ws(s)


def own_text(inner: str) -> str:
    return rep(_parts(_prepare(inner), ()), H.MARK, "")


def all_text(inner: str) -> str:
    return decode_entities(rr(_prepare(inner), H.ANY_TAG_RE))


def h1_title(html: str) -> str:
    inner = f"array_to_string({all_blocks(html, H.open_tag_re('h1'), H.close_tag_re('h1'))}, {lit(H.MARK)})"
    return clean_text(own_text(inner))


def first_p_all(region: str) -> str:
    paras = all_blocks(cat(region, "'<p>'"), H.open_tag_re("p"), f"(?:{H.close_tag_re('p')}|<p[\\s/>])")
    return f"(CASE WHEN {region} IS NOT NULL THEN coalesce({all_text(paras + '[1]')}, '') END)"


def extract_content(container: str, tag: str = "p") -> str:
    x = _prepare(container)
    x = rr(x, H.open_tag_re(tag), H.PSEP)
    x = rr(x, H.close_tag_re(tag), H.PEND)
    x = rr(x, H.OUTSIDE_RE)
    x = rr(x, H.LEADING_RE)
    x = decode_entities(rr(x, H.ANY_TAG_RE))
    x = rr(x, "^" + H.PSEP)
    x = rep(x, H.PSEP, "\n")
    x = rep(x, "\u00a0", " ")
    return rep(x, "\r\n", "\n")


def remove_first(html: str, tag: str) -> str:
    pat = f"(?s)^(.*?){H.open_tag_re(tag)}.*?{H.close_tag_re(tag)}"
    return f"regexp_replace({html}, {lit(pat)}, '\\1')"


# ----------------------------------------------------------------- dates ---

def _pad(x: str) -> str:
    return f"lpad({x}, 2, '0')"


def _ts(y, mo, d, h=None, mi=None, s=None, frac=None) -> str:
    txt = cat(y, "'-'", _pad(mo), "'-'", _pad(d))
    if h is not None:
        txt = cat(txt, "' '", _pad(h), "':'", _pad(mi), "':'", _pad(s))
        if frac is not None:
            txt = cat(txt, "'.'", frac)
    return f"TRY_CAST({txt} AS TIMESTAMP)"


def _g(x: str, pat: str, i: int) -> str:
    return rx(x, pat, i)


def parse_ts_z(x: str) -> str:
    p = D.ISO_Z_RE
    return f"(CASE WHEN {rlike(x, p)} THEN {_ts(*(_g(x, p, i) for i in range(1, 8)))} END)"


def parse_ts_offset(x: str) -> str:
    p = D.ISO_OFFSET_RE
    return f"(CASE WHEN {rlike(x, p)} THEN {_ts(*(_g(x, p, i) for i in range(1, 7)))} END)"


def parse_ymd(x: str) -> str:
    p = D.YMD_RE
    return f"(CASE WHEN {rlike(x, p)} THEN {_ts(_g(x, p, 1), _g(x, p, 2), _g(x, p, 3))} END)"


def parse_dmy(x: str) -> str:
    p = D.DMY_RE
    return f"(CASE WHEN {rlike(x, p)} THEN {_ts(_g(x, p, 3), _g(x, p, 2), _g(x, p, 1))} END)"


def parse_date10(x: str) -> str:
    return parse_ymd(f"substring({x}, 1, 10)")


def parse_date_fallback(x: str) -> str:
    return f"coalesce({parse_ymd(x)}, {parse_dmy(x)})"


def parse_date_parts(y: str, m: str, d: str) -> str:
    return parse_ymd(cat(y, "'-'", m, "'-'", d))


def format_ts(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def ts_lit(v: str) -> str:
    return f"TIMESTAMP {lit(v)}"


def age_days(ts: str, as_of: str) -> str:
    return f"CAST(floor(date_diff('microsecond', {ts}, {ts_lit(as_of)}) / {D.DAY_MICROS}) AS BIGINT)"


def is_fresh(ts: str, as_of: str) -> str:
    return f"({ts} > {ts_lit(D.fresh_bound(as_of))})"


# ------------------------------------------------------------------ urls ---

def host(url: str) -> str:
    return f"lower({rx(url, U.HOST_RE, 1)})"


def resolve(base: str, href: str) -> str:
    h = strip_ws(href)
    origin = rx(base, U.ORIGIN_RE, 1)
    scheme = rx(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*):", 1)
    no_frag = rx(base, U.NO_FRAGMENT_RE, 1)
    no_query = rx(base, U.NO_QUERY_RE, 1)
    bdir = rx(base, U.DIR_RE, 1)
    bdir = f"(CASE WHEN ends_with({bdir}, '/') THEN {bdir} ELSE {bdir} || '/' END)"
    return (f"(CASE WHEN {href} IS NULL THEN NULL "
            f"WHEN {rlike(h, U.SCHEME_RE)} THEN {h} "
            f"WHEN starts_with({h}, '//') THEN {scheme} || ':' || {h} "
            f"WHEN starts_with({h}, '/') THEN {origin} || {h} "
            f"WHEN starts_with({h}, '?') THEN {no_query} || {h} "
            f"WHEN starts_with({h}, '#') THEN {no_frag} || {h} "
            f"WHEN {h} = '' THEN {no_frag} "
            f"ELSE {bdir} || {h} END)")


def is_http(url: str) -> str:
    return rlike(url, U.HTTP_RE)


def canonical(url: str) -> str:
    nf = rx(url, U.NO_FRAGMENT_RE, 1)
    origin_raw = rx(nf, U.ORIGIN_RE, 1)
    rest = f"substring({nf}, length({origin_raw}) + 1)"
    path = rx(rest, U.NO_QUERY_RE, 1)
    query = rx(nf, U.QUERY_RE, 1)
    q = f"array_to_string(list_sort(list_filter(string_split({query}, '&'), lambda p: p <> '')), '&')"
    return f"(lower({origin_raw}) || {path} || (CASE WHEN {q} <> '' THEN '?' || {q} ELSE '' END))"


def on_domains(h: str, domains: Sequence[str] | None) -> str:
    if not domains:
        return "true"
    return "(" + " OR ".join(f"({h} = {lit(d.lower())} OR ends_with({h}, {lit('.' + d.lower())}))"
                             for d in domains) + ")"
