"""Secret scans: trigram inverted index, in DataFrame functions only.

Each rule's regex gives a Boolean query over trigrams: strings that every match must
hold (of which at least one of some alternatives), cut into trigrams. The index
holds postings (trigram, document) of the trigrams that the rules ask for, in lower
case. Intersecting a document's postings by the rules' queries names the rules
that may match it; their regexes are then run on these documents only. A rule
without mandatory trigrams is run on every document.

The index isn't a table of all trigrams: that would be several times the corpus,
and nothing here asks for the others. :func:`postings` takes any rules.

Spans are code points, end exclusive, leftmost and not overlapping within a rule. They
come from the matches and the text between them (``split`` and
``regexp_extract_all`` of one regex).

Defined results: a null text is empty and has no spans; repeated rows (and rows of
one doc_id and text) have the same result; an empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import re._constants as rc
import re._parser as parser
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellar.llm._common import prepare, text_of, written

#: Matches whose spans are added up at a time.
SPAN_BLOCK = 512
#: Documents that are looked up by broadcast at most (16 bytes each); more are joined by shuffle.
BROADCAST_IDS = 2_000_000
#: Alternatives of a string, and characters of a class, that a query spells out.
MOST_STRINGS, MOST_CHARS = 64, 8


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its regex (Java and Python agree on it), and the group that has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base kinds, then the kinds that the method adds.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
ADDED = (
    Rule("private", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

#: A query: all of these; each is a set of alternatives; each alternative is the set of trigrams it needs.
Query = tuple[frozenset[frozenset[str]], ...]


def _characters(items) -> set[str] | None:
    """The characters of a class in lower case; None if they are many."""
    out: set[str] = set()
    for op, arg in items:
        if op is rc.LITERAL:
            out.add(chr(arg).lower())
        elif op is rc.RANGE and arg[1] - arg[0] < MOST_CHARS:
            out |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out if len(out) <= MOST_CHARS else None


def _strings(items) -> set[str] | None:
    """All strings (in lower case) that a piece of a regex matches; None if they are many."""
    out = {""}
    for op, arg in items:
        if op is rc.LITERAL:
            more: set[str] | None = {chr(arg).lower()}
        elif op is rc.IN:
            more = _characters(arg)
        elif op is rc.SUBPATTERN:
            more = _strings(arg[3])
        elif op is rc.BRANCH:
            parts = [_strings(p) for p in arg[1]]
            more = None if None in parts else set().union(*parts)
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[1] == 1:
            inner = _strings(arg[2])
            more = None if inner is None else inner | ({""} if arg[0] == 0 else set())
        else:
            more = None
        if more is None or len(out) * len(more) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in more}
    return out


def _clause(strings: set[str]) -> frozenset[frozenset[str]] | None:
    """One of these strings must be there; None if one is too short to say anything."""
    sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
    if frozenset() in sets:
        return None
    return frozenset(s for s in sets if not any(other < s for other in sets))


def _clauses(items) -> list:
    found, run = [], {""}

    def close() -> None:
        nonlocal run
        found.append(_clause(run))
        run = {""}

    for item in items:
        strings = _strings([item])
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = {a + b for a in run for b in strings}
            continue
        close()
        op, arg = item
        if strings is not None:
            run = strings
        elif op is rc.SUBPATTERN:
            found += _clauses(arg[3])
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[0] >= 1:
            found += _clauses(arg[2])
    close()
    return found


def trigram_query(pattern: str) -> Query:
    """What a text must hold, in lower case, to match; empty: the regex has no mandatory trigrams."""
    return tuple(dict.fromkeys(c for c in _clauses(list(parser.parse(pattern))) if c))


def postings(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(trigram, id, print) for the trigrams that the rules ask for."""
    wanted = sorted({t for r in rules for clause in trigram_query(r.pattern) for alternative in clause for t in alternative})
    low = texts.select("id", "print", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in wanted]))
    return low.select(F.explode(held).alias("trigram"), "id", "print")


def _holds(query: Query, trigrams: Column) -> Column:
    def every(parts: list[Column]) -> Column:
        return reduce(lambda a, b: a & b, parts)

    return every([reduce(lambda a, b: a | b, [every([F.array_contains(trigrams, t) for t in sorted(alternative)])
                                              for alternative in sorted(clause, key=sorted)]) for clause in query])


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(id, print, kinds) of documents whose postings satisfy a rule's query."""
    indexed = [r for r in rules if trigram_query(r.pattern)]
    held = index.groupBy("id", "print").agg(F.collect_set("trigram").alias("trigrams"))  # no more than the rules ask for
    kinds = F.array_compact(F.array(*[F.when(_holds(trigram_query(r.pattern), F.col("trigrams")), F.lit(r.kind))
                                      for r in indexed]))
    return held.select("id", "print", kinds.alias("kinds")).filter(F.size("kinds") > 0)


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """Array of (start, kind number, end) of a rule's matches.

    An append copies its array, so matches are added up in blocks of ``SPAN_BLOCK``, each from its own
    begin, and the blocks are then moved to their places: a text of very many matches costs little more than its length.
    """
    regex = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, regex, F.lit(0))
    gaps = F.split(text, rule.pattern, -1)
    tested = F.regexp_extract_all(text, regex, F.lit(rule.group))
    rows = F.arrays_zip(F.slice(gaps, 1, F.size(matches)).alias("gap"), matches.alias("hit"), tested.alias("test"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def add(acc: Column, row: Column) -> Column:
        start = acc["at"] + F.length(row["gap"])
        end = start + F.length(row["hit"])
        span = F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(F.length(row["test"]) >= rule.least, F.concat(acc["spans"], F.array(span)))
                        .otherwise(acc["spans"]).alias("spans"))

    def blocks(all_: Column) -> Column:
        begins = F.sequence(F.lit(0), F.greatest(F.size(all_) - 1, F.lit(0)), F.lit(SPAN_BLOCK))
        return F.transform(begins, lambda i: F.aggregate(
            F.slice(all_, i + 1, SPAN_BLOCK), F.struct(F.lit(0).alias("at"), none.alias("spans")), add))

    def moved(found: Column) -> Column:
        offsets = F.aggregate(
            found, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("before")),
            lambda acc, b: F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["before"], F.array(acc["at"])).alias("before")),
            lambda acc: acc["before"])
        return F.flatten(F.zip_with(found, offsets, lambda b, off: F.transform(b["spans"], lambda s: F.struct(
            (s["start"] + off).alias("start"), s["kind"].alias("kind"), (s["end"] + off).alias("end")))))

    return _let(rows, lambda all_: _let(blocks(all_), moved))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def scan(docs: DataFrame, base: tuple[Rule, ...] = BASE, added: tuple[Rule, ...] = ADDED) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_<kind> of the base kinds, base_sha256, spans."""
    prepare(docs.sparkSession)
    rules = (*base, *added)
    text = text_of(docs)
    texts = docs.select(docs["doc_id"].cast("long").alias("id"), F.xxhash64(text).alias("print"), text.alias("text"))
    index = written(postings(texts, rules), "postings")
    named = written(candidates(index, rules), "candidates").select(
        F.col("id").alias("id_c"), F.col("print").alias("print_c"), "kinds")
    side = F.broadcast(named) if named.count() <= BROADCAST_IDS else named
    rows = texts.join(side, F.col("id").eqNullSafe(F.col("id_c")) & (F.col("print") == F.col("print_c")), "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    columns = []
    for number, rule in enumerate(rules):
        if trigram_query(rule.pattern):
            due = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
        else:
            due = F.col("text").rlike(rule.pattern)
        columns.append(F.when(due, _spans(F.col("text"), rule, number)).otherwise(none).alias(f"_{number}"))
    found = rows.select("id", *columns)
    names = F.array(*[F.lit(r.kind) for r in rules])

    def shown(spans: Column) -> Column:
        return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    base_spans = F.concat(*[F.col(f"_{i}") for i in range(len(base))])
    return found.select(F.col("id").alias("doc_id"),
                        *[F.size(f"_{i}").cast("long").alias(f"n_{r.kind}") for i, r in enumerate(base)],
                        F.sha2(shown(base_spans), 256).alias("base_sha256"),
                        shown(F.concat(*[F.col(f"_{i}") for i in range(len(rules))])).alias("spans"))
