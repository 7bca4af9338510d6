"""Text-to-type parsing that never fails a row (S1-S6) and row predicates
(S7, S11-S17).

Every parser returns NULL for a value it cannot read instead of raising, so
that ANSI mode can stay on. All of them are built-in Column expressions: they
stay inside whole-stage codegen and never call Python per row.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's semantics.
# Boolean spellings accepted by the reference platform's TRY_TO_BOOLEAN
# (compared after trim + lower-case).
TRUE_WORDS = ("true", "t", "yes", "y", "on", "1")
FALSE_WORDS = ("false", "f", "no", "n", "off", "0")
# Timestamp layouts of the transaction files, tried in this order.
TS_WITH_SECONDS = "DD-MM-YYYY HH24:MI:SS"
TS_WITHOUT_SECONDS = "DD-MM-YYYY HH24:MI"
DATE_DMY = "DD-MM-YYYY"
# CSV tokens read as NULL.
NULL_TOKENS = ("", "NULL", "null")
# ---------------------------------------------------------------------------

# Layout tokens -> (regex, ISO part name). Only fixed-width numeric fields,
# which is all the reference uses; a layout is matched against the whole
# value, so '1-6-2020' or trailing seconds are rejected.
_TOKENS = {
    "YYYY": (r"(\d{4})", "year"),
    "MM": (r"(\d{2})", "month"),
    "DD": (r"(\d{2})", "day"),
    "HH24": (r"(\d{2})", "hour"),
    "MI": (r"(\d{2})", "minute"),
    "SS": (r"(\d{2})", "second"),
}
_TOKEN_RE = re.compile("|".join(sorted(_TOKENS, key=len, reverse=True)))


def _layout_regex(layout: str) -> tuple[str, dict[str, int]]:
    pattern, groups, pos = "^", {}, 0
    for n, m in enumerate(_TOKEN_RE.finditer(layout), start=1):
        pattern += re.escape(layout[pos:m.start()]) + _TOKENS[m.group()][0]
        groups[_TOKENS[m.group()][1]] = n
        pos = m.end()
    pattern += re.escape(layout[pos:]) + r"\z"
    return pattern, groups


def _iso_text(c: Column, layout: str, with_time: bool) -> Column:
    """Rewrite a value in ``layout`` to ISO text, or NULL if it does not match:
    one anchored ``rlike`` guard and one ``regexp_replace`` with group
    references, so the expression stays small after Catalyst inlines it."""
    pattern, g = _layout_regex(layout)
    ref = lambda name, default: f"${g[name]}" if name in g else default
    template = f"{ref('year', '1970')}-{ref('month', '01')}-{ref('day', '01')}"
    if with_time:
        template += f" {ref('hour', '00')}:{ref('minute', '00')}:{ref('second', '00')}"
    return F.when(c.rlike(pattern), F.regexp_replace(c, pattern, template))


def try_timestamp(c: Column | str, layout: str) -> Column:
    """``TRY_TO_TIMESTAMP(s, layout)`` as a zone-free TIMESTAMP_NTZ.

    The value is matched against the whole layout, rewritten to ISO and
    ``try_cast``; impossible dates (31-02) and hours (25) give NULL, and a
    daylight-saving gap in any session zone cannot move the value."""
    c = F.col(c) if isinstance(c, str) else c
    return _iso_text(c, layout, with_time=True).try_cast("timestamp_ntz")


def parse_first(c: Column | str, layouts: Sequence[str]) -> Column:
    """The first layout that parses wins (``COALESCE`` of S1 calls)."""
    return F.coalesce(*[try_timestamp(c, fmt) for fmt in layouts])


def try_date(c: Column | str, layout: str = DATE_DMY) -> Column:
    """S3: ``TRY_TO_DATE(s, 'DD-MM-YYYY')``; strict two-digit day and month."""
    c = F.col(c) if isinstance(c, str) else c
    return _iso_text(c, layout, with_time=False).try_cast("date")


def try_boolean(c: Column | str) -> Column:
    """``TRY_TO_BOOLEAN``; accepts both spelling lists, any case, trimmed."""
    c = F.col(c) if isinstance(c, str) else c
    w = F.lower(F.trim(c))
    return (F.when(w.isin(*TRUE_WORDS), F.lit(True))
             .when(w.isin(*FALSE_WORDS), F.lit(False)))


def try_decimal(c: Column | str, precision: int, scale: int) -> Column:
    """``TRY_TO_DECIMAL(s, p, s)``; rounds half up, NULL on overflow or
    on text that is not a plain number (``abc``, ``1,234.50``, ``$5``, ``NaN``)."""
    c = F.col(c) if isinstance(c, str) else c
    t = F.trim(c)
    # NaN / Infinity are floating spellings, not decimals.
    return F.when(~F.lower(t).isin("nan", "inf", "infinity", "+infinity", "-infinity"),
                  t.try_cast(f"decimal({precision},{scale})"))


def null_if_tokens(c: Column | str, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """A1 post-read projection: several NULL tokens (the CSV reader takes one)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~c.isin(*tokens), c)


def first_failure(rules: Sequence[tuple[Column, str]], ok: str = "VALID") -> Column:
    """Label of the first failing rule, in the given order, else ``ok``.

    ``rules`` holds (failure condition, label). The result is never NULL, so
    ``status == ok`` and ``status != ok`` split the input exactly (S8/S9).
    A condition that evaluates to NULL falls through, as in SQL ``CASE``."""
    expr = None
    for cond, label in rules:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(ok) if expr is None else expr.otherwise(F.lit(ok))


def any_distinct(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """NULL-safe change test, ``a IS DISTINCT FROM b`` OR-ed over columns."""
    out = F.lit(False)
    for a, b in zip(left, right, strict=True):
        out = out | ~a.eqNullSafe(b)
    return out


def in_half_open(ts: Column, valid_from: Column, valid_to: Column) -> Column:
    """``ts >= from AND (ts < to OR to IS NULL)``; a NULL ts never matches."""
    return (ts >= valid_from) & ((ts < valid_to) | valid_to.isNull())


def lookback(as_of, hours: int) -> Column:
    """``DATEADD('hour', -hours, as_of)`` with an injected ``as_of``."""
    base = ntz(as_of)
    return F.timestamp_add("HOUR", F.lit(-hours), base)


def seconds_between(start: Column, end: Column) -> Column:
    """``DATEDIFF('second', a, b)``: second boundaries crossed, i.e. the
    difference of the values floored to whole seconds."""
    return F.timestamp_diff("SECOND", floor_ntz(start, "second"), floor_ntz(end, "second"))


def floor_ntz(c: Column | str, unit: str) -> Column:
    """Floor a TIMESTAMP_NTZ to second/minute/hour/day without any session
    zone (``date_trunc`` goes through the session zone and returns LTZ)."""
    c = F.col(c) if isinstance(c, str) else c
    unit = unit.lower()
    zero = F.lit(0)
    parts = {
        "day": (zero, zero, zero),
        "hour": (F.hour(c), zero, zero),
        "minute": (F.hour(c), F.minute(c), zero),
        "second": (F.hour(c), F.minute(c), F.second(c)),
    }[unit]
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), *parts)


def ntz(value) -> Column:
    """A TIMESTAMP_NTZ literal from a datetime, a date or ISO text.

    Built from ISO text, never from ``F.lit(datetime)``: a Python datetime
    becomes a zoned literal through the driver's local zone, which would
    shift it whenever that zone differs from the session's."""
    if isinstance(value, Column):
        return value
    if isinstance(value, (_dt.datetime, _dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else value.isoformat()
    return F.lit(value).cast("timestamp_ntz")
