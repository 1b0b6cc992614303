"""Scalar column functions: text clean-up, keys, dates, bytes.

All of them are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none of them calls Python per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellar.functions._util import as_col

# Fixed values that must match the source behaviour.
# Separator of the composite order key: <id>_MY_<orderid>.
ORDER_KEY_SEPARATOR = "_MY_"
# Characters removed from a phone number: the country prefix +86, '#', '+', '*'.
PHONE_STRIP_PATTERN = r"\+86|#|\+|\*"
# Characters trimmed by Java's String.trim(): every code point up to U+0020.
JAVA_TRIM_CHARS = "".join(chr(c) for c in range(0x21))
# Whole-string "digits only" test (empty text matches, like the source's [0-9]*).
DIGITS_ONLY_PATTERN = r"\A[0-9]*\z"
# Default date pattern of the date helpers.
DEFAULT_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"
MILLIS_PER_DAY = 86_400_000


# --- text ------------------------------------------------------------------------------------

def strip_double_quotes(c) -> Column:
    """Remove every double quote."""
    return F.replace(as_col(c), F.lit('"'), F.lit(""))


def split_keep_trailing(c, sep_regex: str) -> Column:
    """Split on a regex and keep trailing empty fields (Java ``split(re, -1)``)."""
    return F.split(as_col(c), sep_regex, -1)


def split_drop_trailing(c, sep_regex: str) -> Column:
    """Split on a regex and drop trailing empty fields (Java ``split(re)``).

    ``a_b__`` -> ``[a, b]``, ``__`` -> ``[]``, ``''`` -> ``['']``, ``_a`` -> ``['', a]``.
    The cut position is the 1-based index of the last non-empty part.
    """
    s = as_col(c)
    parts = F.split(s, sep_regex, -1)
    last_non_empty = F.coalesce(
        F.array_max(F.transform(parts, lambda x, i: F.when(F.length(x) > 0, i + 1).otherwise(F.lit(0)))),
        F.lit(0),
    )
    return F.when(F.length(s) == 0, F.array(F.lit(""))).otherwise(F.slice(parts, F.lit(1), last_non_empty))


def java_trim(c) -> Column:
    """Trim control characters and blanks at both ends (Java ``String.trim``).

    Plain SQL ``trim`` strips only spaces (a tab would survive), so the characters
    are named; ``trim`` with a character set is linear, unlike an anchored regex.
    """
    return F.trim(as_col(c), F.lit(JAVA_TRIM_CHARS))


def first_field_or_empty(fields) -> Column:
    """X4 (second half): first field of a split record, trimmed; ``''`` when absent or empty."""
    first = F.try_element_at(as_col(fields), F.lit(1))
    return F.coalesce(java_trim(first), F.lit(""))


def normalise_phone(c) -> Column:
    """Drop ``+86``, ``#``, ``+`` and ``*`` from a phone number."""
    return F.regexp_replace(as_col(c), PHONE_STRIP_PATTERN, "")


def is_numeric(c, allow_blank: bool = True) -> Column:
    """the whole text is digits. Empty text counts as numeric unless ``allow_blank=False``."""
    s = as_col(c)
    test = s.rlike(DIGITS_ONLY_PATTERN)
    if not allow_blank:
        test = test & (F.length(s) > 0)
    return test


def order_key(id_col, order_col) -> Column:
    """P5: composite row key ``<id>_MY_<orderid>``; NULL when either side is NULL (never ``concat_ws``)."""
    return F.concat(as_col(id_col), F.lit(ORDER_KEY_SEPARATOR), as_col(order_col))


def message_text(key, value) -> Column:
    """P13 + D11: ``key:value``; a NULL key is treated as ``''``."""
    return F.concat(F.coalesce(as_col(key), F.lit("")), F.lit(":"), as_col(value))


# --- bytes -----------------------------------------------------------------------------------

def to_utf8(c) -> Column:
    """Text -> UTF-8 bytes."""
    return F.encode(as_col(c), "UTF-8")


def from_utf8(c) -> Column:
    """UTF-8 bytes -> text."""
    return F.decode(as_col(c), "UTF-8")


# --- dates -----------------------------------------------------------------------------------

def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def parse_epoch_millis(text, fmt: str = DEFAULT_DATE_FORMAT, lenient: bool = False) -> Column:
    """Date text -> epoch milliseconds, read as UTC wall time; NULL when it does not parse.

    ``lenient=True`` reads as the JVM's old date format does: see :func:`lenient_epoch_millis`.

    The text gets an explicit UTC offset before it is parsed, so the session's time
    zone (and its daylight-saving gaps) has no part in the value.
    """
    if lenient:
        return lenient_epoch_millis(text, fmt)
    return F.unix_millis(F.try_to_timestamp(F.concat(as_col(text), F.lit(" +00:00")), F.lit(f"{fmt} XXX")))


# Pattern letters of the lenient reader and the digits a field of each may have.
_DATE_FIELDS = {"y": 6, "M": 6, "d": 8, "H": 8, "m": 8, "s": 8, "S": 8}


def lenient_epoch_millis(text, fmt: str = DEFAULT_DATE_FORMAT) -> Column:
    """Date text -> epoch milliseconds by fields that roll over: day 30 of February is in March, month 13 in
    the next year, hour 25 on the next day.

    Numbers may have fewer or more digits than the pattern (but for fields that follow each other
    without a separator), blanks may stand before them, and what follows the last field is ignored.
    ``fmt`` may hold the letters y, M, d, H, m, s and S and text in between; the calendar is the
    proleptic Gregorian one, in UTC. NULL when the text doesn't begin like that.
    """
    parts = [(m.group(0)[0], len(m.group(0))) if m.group(0)[0].isalpha() else (m.group(0), 0)
             for m in re.finditer(r"([A-Za-z])\1*|[^A-Za-z]", fmt)]
    names = [p for p, n in parts if n]
    if set(names) - _DATE_FIELDS.keys() or len(set(names)) != len(names):
        raise ValueError(f"a lenient date pattern holds y, M, d, H, m, s and S once each, not {fmt!r}")
    regex = "^"
    for i, (part, n) in enumerate(parts):
        next_is_field = i + 1 < len(parts) and parts[i + 1][1]
        digits = (f"{{{n}}}" if next_is_field else f"{{1,{_DATE_FIELDS[part]}}}") if n else ""
        regex += rf"[ \t]*(\d{digits})" if n else re.escape(part)
    c = as_col(text)

    def field(name: str, missing: int) -> Column:
        if name not in names:
            return F.lit(missing).cast("long")
        return F.regexp_extract(c, regex, names.index(name) + 1).cast("long")

    read = F.struct((field("y", 1970) * 12 + field("M", 1) - 3).alias("months"), field("d", 1).alias("d"),
                    (((field("H", 0) * 60 + field("m", 0)) * 60 + field("s", 0)) * 1000 + field("S", 0)).alias("clock"))

    def millis(r: Column) -> Column:
        # years begin in March, so that a leap day is a year's last
        year, month = _floor_div(r["months"], 12), F.pmod(r["months"], F.lit(12))
        days = (year * 365 + _floor_div(year, 4) - _floor_div(year, 100) + _floor_div(year, 400)
                + int_div(month * 153 + 2, 5) - 719469 + r["d"])
        return days * MILLIS_PER_DAY + r["clock"]

    return F.when(c.rlike(regex), F.get(F.transform(F.array(read), millis), 0))


def _floor_div(num: Column, den: int) -> Column:
    return int_div(num - F.pmod(num, F.lit(den)), den)


def ts_epoch_millis(ts) -> Column:
    """Epoch milliseconds of a ``timestamp_ntz`` (or ``timestamp``) column, read as UTC wall time."""
    return F.timestamp_diff("MILLISECOND", _epoch_ntz(), as_col(ts).cast("timestamp_ntz"))


def days_between(date_text, millis, fmt: str = DEFAULT_DATE_FORMAT, lenient: bool = False) -> Column:
    """Whole days from a date text to an epoch-ms value, toward zero; 0 on bad input."""
    return days_between_millis(parse_epoch_millis(date_text, fmt, lenient), millis)


def days_between_rev(date_text, millis, fmt: str = DEFAULT_DATE_FORMAT, lenient: bool = False) -> Column:
    """As X6 with the operands swapped (date text minus epoch value)."""
    return days_between_millis(millis, parse_epoch_millis(date_text, fmt, lenient))


def days_between_millis(from_millis, to_millis) -> Column:
    """Whole days from one epoch-ms value to another, toward zero; 0 when either is NULL.

    X6/X7 with the text already parsed - lets a plan parse a date once (say on
    the smaller side of a join) and compare it with many values.
    """
    diff = as_col(to_millis) - as_col(from_millis)
    return F.coalesce(int_div(diff, MILLIS_PER_DAY), F.lit(0)).cast("int")


def unix_seconds_text(date_text, fmt: str = DEFAULT_DATE_FORMAT, lenient: bool = False) -> Column:
    """Date text -> epoch seconds as text, toward zero; ``''`` on bad input."""
    secs = int_div(parse_epoch_millis(date_text, fmt, lenient), 1000)
    return F.coalesce(secs.cast("string"), F.lit(""))


def int_div(num, den: int) -> Column:
    """Integer division toward zero on longs (SQL ``div``), exact over their whole range."""
    return F.call_function("div", as_col(num).cast("long"), F.lit(den).cast("long"))
