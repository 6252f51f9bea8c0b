"""Patterns of the DuckDB oracle, in RE2's subset and apart from the Spark side's.

The Spark side matches elements by balance and keeps or drops children with
look-around patterns (``inkline.functions.html``).  The oracle shares none of
that: it is a plain chain of replacements that suffices for the driver's
pages, which hold one flat ``<article>`` each.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from inkline.functions.text import WS

MARK = "\x01"   # boundary between text parts
PSEP = "\x02"   # start of a paragraph
PEND = "\x03"   # end of a paragraph

ENTITIES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&nbsp;", "\u00a0"),
    ("&amp;", "&"),
)

CONTENT_TAGS = (
    "a", "b", "strong", "em", "i", "span", "u", "s", "small", "sub", "sup",
    "mark", "code", "time", "font", "q", "cite", "abbr", "del", "ins", "label",
)
# Embedded elements never kept: removed together by one pattern (they do not
# nest text that would survive anyway), which keeps the expression small.
EMBEDDED_TAGS = (
    "button", "script", "style", "iframe", "svg", "noscript", "figure",
    "figcaption", "video", "audio", "picture", "object", "select", "textarea",
)
VOID_TAGS = ("br", "img", "hr", "input", "wbr", "source", "meta", "link")

CONTROL_RE = "[\x01-\x03]"
COMMENT_RE = r"(?s)<!--.*?(?:-->|\z)"
ANY_TAG_RE = r"<[^>]*>"
MARK_RUN_RE = MARK + "+"
MARK_EDGE_RE = f"^{MARK}|{MARK}\\z"
MARK_AROUND_PSEP_RE = f"{MARK}?{PSEP}{MARK}?"
WS_AROUND_PSEP_RE = f"{WS}*{PSEP}{WS}*"
OUTSIDE_RE = f"{PEND}[^{PSEP}]*"
LEADING_RE = f"^[^{PSEP}]*"


def rx_escape(s: str) -> str:
    """Escape regex metacharacters only (spaces stay literal, valid in Java and RE2)."""
    return re.sub(r"([.^$*+?{}\[\]\\|()])", r"\\\1", s)


def open_tag_re(tag: str) -> str:
    """Opening tag of ``tag`` with any attributes (``<p>`` does not match ``<pre>``)."""
    return f"<{tag}(?:[\\s/][^>]*)?>"


def close_tag_re(tag: str) -> str:
    return f"</{tag}\\s*>"


def class_open_re(tag: str, cls: str) -> str:
    """Opening tag whose class attribute is exactly ``cls`` (bs4 rule for multi-token classes)."""
    return f'<{tag}\\s[^>]*class="{rx_escape(cls)}"[^>]*>'


def id_open_re(tag: str, ident: str) -> str:
    return f'<{tag}\\s[^>]*id="{rx_escape(ident)}"[^>]*>'


def drop_element_re(tag: str) -> str:
    """Element with its content, ended by its close tag, a paragraph edge or the end."""
    return f"(?s){open_tag_re(tag)}[^{PSEP}{PEND}]*?(?:{close_tag_re(tag)}|\\z|([{PSEP}{PEND}]))"


VOID_RE = "<(?:" + "|".join(VOID_TAGS) + r")(?:[\s/][^>]*)?>"


def kept_tags_re(keep: Sequence[str]) -> str:
    """Open/close tags of kept children plus void tags: all become part boundaries."""
    alt = "|".join(keep)
    return f"<(?:{alt})(?:[\\s/][^>]*)?>|</(?:{alt})\\s*>|{VOID_RE}"


def dropped_tags(keep: Sequence[str]) -> tuple[str, ...]:
    return tuple(t for t in CONTENT_TAGS if t not in keep)


def drop_patterns(keep: Sequence[str]) -> list[str]:
    """Patterns removing non-kept children with their content."""
    group = "(?:" + "|".join(EMBEDDED_TAGS) + ")"
    return [drop_element_re(t) for t in dropped_tags(keep)] + [drop_element_re(group)]


def tag_attr_pattern(tag: str, attr: str) -> str:
    return f'<{tag}\\s(?:[^>]*\\s)?{attr}="[^"]*"[^>]*>'


def attr_value_pattern(attr: str) -> str:
    return f'\\s{attr}="([^"]*)"'


ANCHOR_HREF_RE = r'<a href="([^"]*)"'
ARTICLE = (open_tag_re("article"), close_tag_re("article"))
NAV = (open_tag_re("nav"), close_tag_re("nav"))
