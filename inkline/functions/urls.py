"""URL functions: host, relative resolution, canonical form, domain tests."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkline.functions.text import let, strip_ws

SCHEME_RE = r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"
ORIGIN_RE = r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)"
HOST_RE = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"
NO_FRAGMENT_RE = r"^([^#]*)"
NO_QUERY_RE = r"^([^?#]*)"
DIR_RE = r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*(?:[^?#]*/)?)"
QUERY_RE = r"^[^?#]*\?([^#]*)"
HTTP_RE = r"^[hH][tT][tT][pP][sS]?://"


def host(url: Column) -> Column:
    """Lower-cased host name (no user info, no port)."""
    return F.lower(F.regexp_extract(url, HOST_RE, 1))


def resolve(base: Column, href: Column) -> Column:
    """Make ``href`` absolute against the page URL ``base``.

    Handles ``scheme:``, ``//host/x``, ``/x``, ``?q``, ``#f``, ``''`` and
    relative paths (against the base directory); ``.`` and ``..`` segments are
    resolved (RFC 3986, 5.2.4).
    """
    return let(strip_ws(href), lambda h: let(_against(base, h), without_dots))


def _against(base: Column, h: Column) -> Column:
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*):", 1)
    base_dir = F.regexp_extract(base, DIR_RE, 1)
    no_frag = F.regexp_extract(base, NO_FRAGMENT_RE, 1)
    return (
        F.when(h.isNull(), F.lit(None))
        .when(h.rlike(SCHEME_RE), h)
        .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(h.startswith("/"), F.concat(F.regexp_extract(base, ORIGIN_RE, 1), h))
        .when(h.startswith("?"), F.concat(F.regexp_extract(base, NO_QUERY_RE, 1), h))
        .when(h.startswith("#"), F.concat(no_frag, h))
        .when(h == "", no_frag)
        .otherwise(F.concat(F.regexp_replace(base_dir, "([^/])\\z", "$1/"), h))
    )


def without_dots(url: Column) -> Column:
    """The URL with ``.`` and ``..`` segments of its path resolved."""
    dotted = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*(?:/[^?#]*)?/\.{1,2}(?:[/?#]|\z)"
    path = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    tail = F.regexp_extract(url, r"^[^?#]*(.*)\z", 1)
    kept = F.aggregate(
        F.slice(F.split(path, "/"), F.lit(2), F.lit(1 << 30)), F.array().cast("array<string>"),
        lambda acc, x: F.when(x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).when(x == ".", acc).otherwise(F.array_append(acc, x)),
        lambda acc: F.when(F.size(acc) > 0, F.concat(F.lit("/"), F.array_join(acc, "/"))).otherwise(F.lit("")))
    ends = F.when(path.rlike(r"/\.{1,2}\z"), F.lit("/")).otherwise(F.lit(""))
    return F.when(url.rlike(dotted), F.concat(F.regexp_extract(url, ORIGIN_RE, 1), kept, ends, tail)).otherwise(url)


def is_http(url: Column) -> Column:
    return url.rlike(HTTP_RE)


def canonical(url: Column) -> Column:
    """Fragment dropped, scheme and host lower-cased, query pairs sorted."""
    no_frag = F.regexp_extract(url, NO_FRAGMENT_RE, 1)
    origin = F.lower(F.regexp_extract(no_frag, ORIGIN_RE, 1))
    rest = F.substring(no_frag, F.length(F.regexp_extract(no_frag, ORIGIN_RE, 1)) + 1, 1 << 30)
    path = F.regexp_extract(rest, NO_QUERY_RE, 1)
    query = F.regexp_extract(no_frag, QUERY_RE, 1)
    pairs = F.array_sort(F.filter(F.split(query, "&"), lambda p: p != ""))
    q = F.array_join(pairs, "&")
    return F.concat(origin, path, F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")))


def on_domains(h: Column, domains: Sequence[str] | None) -> Column:
    """Host equal to a domain or a sub-domain of it (None = no filter)."""
    if not domains:
        return F.lit(True)
    return reduce(lambda a, b: a | b,
                  [(h == d.lower()) | h.endswith("." + d.lower()) for d in domains])
