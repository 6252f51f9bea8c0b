"""Date parsing, formatting and recency, all wall-clock (``TIMESTAMP_NTZ``).

Python's ``strptime`` accepts one-digit months, days and time fields, so each
format is checked with a full-match regex, the parts are zero-padded and the
canonical text is cast with ``try_cast``: a bad value becomes NULL (a reject,
SURVEY E16) instead of aborting the job under ANSI mode.  Offsets and ``Z``
are dropped and the wall clock kept (P6).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_D = r"(\d{4})-(\d{1,2})-(\d{1,2})"
_T = r"(\d{1,2}):(\d{1,2}):(\d{1,2})"
ISO_Z_RE = rf"^{_D}T{_T}\.(\d{{1,6}})Z$"                       # %Y-%m-%dT%H:%M:%S.%fZ
ISO_OFFSET_RE = rf"^{_D}T{_T}(?:Z|[+-]\d{{2}}:?\d{{2}})$"      # %Y-%m-%dT%H:%M:%S%z
YMD_RE = rf"^{_D}$"                                            # %Y-%m-%d
DMY_RE = r"^(\d{1,2})-(\d{1,2})-(\d{4})$"                      # %d-%m-%Y

DAY_MICROS = 86_400_000_000
FRESH_HOURS = 48   # ``timedelta.days > 1`` drops a row, so kept iff age < 48 h


def _pad(c: Column) -> Column:
    return F.lpad(c, 2, "0")


def _ts(y: Column, mo: Column, d: Column, h: Column | None = None, mi: Column | None = None,
        s: Column | None = None, frac: Column | None = None) -> Column:
    txt = F.concat(y, F.lit("-"), _pad(mo), F.lit("-"), _pad(d))
    if h is not None:
        txt = F.concat(txt, F.lit(" "), _pad(h), F.lit(":"), _pad(mi), F.lit(":"), _pad(s))
        if frac is not None:
            txt = F.concat(txt, F.lit("."), frac)
    return txt.try_cast("timestamp_ntz")


def _g(s: Column, pat: str, i: int) -> Column:
    return F.regexp_extract(s, pat, i)


def parse_ts_z(s: Column) -> Column:
    """``2023-05-04T10:11:12.345Z`` (1-6 fraction digits, required)."""
    p = ISO_Z_RE
    val = _ts(*(_g(s, p, i) for i in range(1, 8)))
    return F.when(s.rlike(p), val)


def parse_ts_offset(s: Column) -> Column:
    """``2023-05-04T10:11:12-03:00``; the offset is dropped, 10:11:12 kept."""
    p = ISO_OFFSET_RE
    val = _ts(*(_g(s, p, i) for i in range(1, 7)))
    return F.when(s.rlike(p), val)


def parse_ymd(s: Column) -> Column:
    """``%Y-%m-%d`` as a midnight timestamp."""
    p = YMD_RE
    return F.when(s.rlike(p), _ts(_g(s, p, 1), _g(s, p, 2), _g(s, p, 3)))


def parse_dmy(s: Column) -> Column:
    """``%d-%m-%Y`` as a midnight timestamp."""
    p = DMY_RE
    return F.when(s.rlike(p), _ts(_g(s, p, 3), _g(s, p, 2), _g(s, p, 1)))


def parse_date10(s: Column) -> Column:
    """D3: the first ten characters as ``%Y-%m-%d``."""
    return parse_ymd(F.substring(s, 1, 10))


def parse_date_fallback(s: Column) -> Column:
    """``%Y-%m-%d``, else ``%d-%m-%Y``."""
    return F.coalesce(parse_ymd(s), parse_dmy(s))


def parse_date_parts(y: Column, m: Column, d: Column) -> Column:
    """Year, month and day attributes joined by ``-`` (any NULL -> NULL)."""
    return parse_ymd(F.concat(y, F.lit("-"), m, F.lit("-"), d))


def format_ts(ts: Column) -> Column:
    """``%Y-%m-%d %H:%M:%S``."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def ntz_literal(value: dt.datetime | str) -> Column:
    """A constant wall-clock timestamp (folded by the optimizer)."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast("timestamp_ntz")


def age_days(ts: Column, as_of: dt.datetime | str) -> Column:
    """``(as_of - ts).days``, floored (a one-second future age gives -1)."""
    diff = F.timestamp_diff("MICROSECOND", ts, ntz_literal(as_of))
    return F.floor(diff / F.lit(DAY_MICROS)).cast("bigint")


def fresh_bound(as_of: dt.datetime | str) -> str:
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    return (as_of - dt.timedelta(hours=FRESH_HOURS)).strftime("%Y-%m-%d %H:%M:%S.%f")


def is_fresh(ts: Column, as_of: dt.datetime | str) -> Column:
    """P5: kept iff younger than 48 h; future dates are kept.

    ``as_of`` is an argument, never ``now()`` in the plan, so reruns agree.
    A bare comparison with a constant reaches the Parquet scan when ``ts`` is
    a stored column.
    """
    return ts > ntz_literal(fresh_bound(as_of))
