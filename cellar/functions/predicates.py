"""Row filters of the wide table as Column predicates.

Plain comparisons are kept as they are so Catalyst can push them into the
Parquet scan (``StringStartsWith``, ``GreaterThanOrEqual``, ``EqualTo``).
Missing cells are NULL in the row form:

* F4/F5 (equal / at least): a missing cell fails the test (NULL drops the row);
* F6 (regex): a missing cell passes the test.

Where a predicate is negated (deletes, M5/M6) use :func:`is_true` so that an
unknown result keeps the row.
"""

from __future__ import annotations

import functools
import operator
import re
import re._constants as _code
import re._parser as _parser
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellar.functions._util import as_col

ROW_KEY = "row_key"


def key_prefix(prefix: str, key: str = ROW_KEY) -> Column:
    """row key starts with ``prefix`` (pushed to Parquet as ``StringStartsWith``)."""
    return F.col(key).startswith(prefix)


def key_from(start: str, key: str = ROW_KEY) -> Column:
    """row key at or after ``start`` (inclusive, byte order)."""
    return F.col(key) >= F.lit(start)


# A regex that begins with at most so many different strings is also pushed as prefixes.
MOST_PREFIXES = 32


def regex_prefixes(pattern: str) -> list[str] | None:
    """The strings of which every match of ``pattern`` begins a text with one; None if it isn't anchored or they are many."""
    try:
        tree = _parser.parse(pattern)
    except Exception:  # noqa: BLE001 - Java's syntax is wider than Python's
        return None
    if tree.state.flags & (re.IGNORECASE | re.MULTILINE | re.VERBOSE):
        return None
    items = list(tree)
    branches = items[0][1][1] if len(items) == 1 and items[0][0] is _code.BRANCH else [items]
    found: set[str] = set()
    for branch in map(list, branches):
        if not branch or branch[0][0] is not _code.AT or branch[0][1] not in (_code.AT_BEGINNING, _code.AT_BEGINNING_STRING):
            return None
        found |= _begins(branch[1:])[0]
    return None if "" in found or len(found) > MOST_PREFIXES else sorted(found)


def _begins(items) -> tuple[set[str], bool]:
    """Strings that a piece of a regex begins with, and whether they are all that it matches."""
    out = {""}
    for op, arg in items:
        whole = True
        if op is _code.LITERAL:
            more = {chr(arg)}
        elif op is _code.IN and all(o is _code.LITERAL for o, _ in arg):
            more = {chr(c) for _, c in arg}
        elif op is _code.SUBPATTERN and not arg[1] and not arg[2]:
            more, whole = _begins(arg[3])
        elif op is _code.BRANCH:
            parts = [_begins(b) for b in arg[1]]
            more, whole = set().union(*[p for p, _ in parts]), all(w for _, w in parts)
        elif op is _code.MAX_REPEAT and arg[0] >= 1:
            more, whole = _begins(arg[2])[0], arg[0] == arg[1] == 1 and _begins(arg[2])[1]
        else:
            return out, False
        if len(out) * len(more) > MOST_PREFIXES:
            return out, False
        out = {a + b for a in out for b in more}
        if not whole:
            return out, False
    return out, True


def _matches(column: Column, pattern: str) -> Column:
    """``rlike``, with the pattern's prefixes in front where it is anchored: those reach the Parquet scan."""
    prefixes = regex_prefixes(pattern)
    found = column.rlike(pattern)
    return any_of([column.startswith(p) for p in prefixes]) & found if prefixes else found


def key_regex(pattern: str, key: str = ROW_KEY) -> Column:
    """row key contains a match of ``pattern`` (find, not full match); a literal begin is pushed."""
    return _matches(F.col(key), pattern)


def column_equals(column, value: str) -> Column:
    """cell equals ``value``; a missing cell fails."""
    return as_col(column) == F.lit(value)


def column_at_least(column, value: str) -> Column:
    """cell >= ``value`` compared as text (bytes), never as numbers; a missing cell fails."""
    return as_col(column) >= F.lit(value)


def column_regex(column, pattern: str) -> Column:
    """cell contains a match of ``pattern``; a missing cell passes."""
    c = as_col(column)
    return c.isNull() | _matches(c, pattern)


def all_of(predicates: Iterable[Column]) -> Column:
    """every predicate holds (an empty list keeps every row)."""
    return functools.reduce(operator.and_, list(predicates), F.lit(True))


def any_of(predicates: Iterable[Column]) -> Column:
    """F8: at least one predicate holds (an empty list keeps no row)."""
    return functools.reduce(operator.or_, list(predicates), F.lit(False))


def is_true(predicate: Column) -> Column:
    """Two-valued form of a predicate: unknown (NULL) becomes false."""
    return F.coalesce(predicate, F.lit(False))


__all__ = ["ROW_KEY", "key_prefix", "key_from", "key_regex", "regex_prefixes", "column_equals", "column_at_least",
           "column_regex", "all_of", "any_of", "is_true"]
