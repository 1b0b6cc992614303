"""Filter interaction audit: Gray-code subset walk.

Every document fails some of the five filters; which ones is its mask. Documents
are counted by part and mask with one aggregate (at most 32 cells a part, however
many documents). A part's cells are then walked through all 32 subsets of active
filters in Gray-code order: each step toggles one filter, moves the active-failure
counter of the cells that fail it by one, and adds or takes away the cells whose
counter leaves or reaches zero. The running survivors are stored for each of the
32 states, and every step of every filter order is a difference of two states.

Filters (``words``: maximal runs of anything but ASCII white space, case-sensitive):
A: fewer than 200 words; B: 100 * distinct words < 50 * words; C: 100 * letters A-Z
> 2 * code points; D: holds any of ``#$%&*|``; E: the text of a smaller doc_id,
whether that document was removed or not.

Equal texts are found by SHA-256: the smallest doc_id of each digest is one
aggregate, and a document passes E if it is that doc_id. The join back is on
(digest, doc_id), so a group of copies that holds a third of all rows is spread
by its doc_ids.

Defined results: a null text counts as empty (it fails A only, and E if an earlier
document is empty); a null source is the part ``""``, as an empty one; a null doc_id
counts as larger than any number, and rows with one doc_id are never smaller than
each other; a document with several label rows is good (toxic) if any of them
says so, one without labels is neither; an empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellar.llm._common import WORD_PATTERN, prepare, text_of, written

FILTERS = "ABCDE"
STATES = 1 << len(FILTERS)
ORDERS = ["".join(p) for p in permutations(FILTERS)]
MIN_WORDS = 200
SYMBOLS = "[#$%&*|]"
_LAST_ID = (1 << 63) - 1

AUDIT_SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
                "unique_fails long, good_lost long, toxic_lost long, shapley long")


def _bit(name: str, fails: Column) -> Column:
    return F.when(fails, F.lit(1 << FILTERS.index(name))).otherwise(F.lit(0))


def text_failures(text: Column, words: Column) -> Column:
    """Mask of the filters A to D that a text fails."""
    n_words, n_chars = F.size(words), F.length(text)
    capitals = n_chars - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return (_bit("A", n_words < MIN_WORDS)
            + _bit("B", F.size(F.array_distinct(words)).cast("long") * 100 < n_words.cast("long") * 50)
            + _bit("C", capitals.cast("long") * 100 > n_chars.cast("long") * 2)
            + _bit("D", text.rlike(SYMBOLS)))


def failures(docs: DataFrame) -> DataFrame:
    """(id, part, mask) of every row, the mask with all five filters; id: null as the largest number."""
    texts = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(_LAST_ID)).alias("id"),
                        F.coalesce(docs["source"].cast("string"), F.lit("")).alias("part"), text_of(docs).alias("text"))
    read = texts.select("id", "part", "text", F.regexp_extract_all("text", F.lit(WORD_PATTERN), 0).alias("words"))
    facts = written(read.select("id", "part", text_failures(F.col("text"), F.col("words")).alias("mask"),
                                F.unhex(F.sha2("text", 256)).alias("digest")), "facts")
    first = facts.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    again = _bit("E", F.col("first").isNull())
    return facts.join(first, ["digest", "id"], "left").select("id", "part", (F.col("mask") + again).alias("mask"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and by the filters that they fail."""
    def marked(column: str) -> Column:
        return F.max(F.coalesce(labels[column] == 1, F.lit(False)).cast("long")).alias(column)

    marks = (labels.filter(labels["doc_id"].isNotNull()).groupBy(labels["doc_id"].cast("long").alias("id"))
             .agg(marked("quality"), marked("toxic")).filter("quality + toxic > 0"))
    rows = failures(docs).join(marks, "id", "left")
    return rows.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("quality"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def survivors(masks: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``counts`` whose mask shares no filter with each of the 32 sets of active filters."""
    active = np.zeros(len(masks), dtype=np.int64)
    running = counts.sum(axis=0)
    stored = np.zeros((STATES, counts.shape[1]), dtype=np.int64)
    stored[0] = running
    state = 0
    for step in range(1, STATES):
        toggled = step & -step  # the bit in which neighbouring Gray codes differ
        state ^= toggled
        hit = np.flatnonzero(masks & toggled)
        if state & toggled:
            running = running - counts[hit[active[hit] == 0]].sum(axis=0)
            active[hit] += 1
        else:
            active[hit] -= 1
            running = running + counts[hit[active[hit] == 0]].sum(axis=0)
        stored[state] = running
    return stored


def _walk(pdf: pd.DataFrame) -> pd.DataFrame:
    """All steps of all orders for one part's cells (32 rows at most)."""
    stored = survivors(pdf["mask"].to_numpy(dtype=np.int64), pdf[["n", "good", "toxic"]].to_numpy(dtype=np.int64))
    everything = STATES - 1
    out, removed_of = [], dict.fromkeys(FILTERS, 0)
    for order in ORDERS:
        state = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            lost = stored[state] - stored[state | bit]
            state |= bit
            fails = stored[0, 0] - stored[bit, 0]
            alone = stored[everything ^ bit, 0] - stored[everything, 0]
            removed_of[name] += int(lost[0])
            out.append((order, step, stored[state, 0], lost[0], fails - lost[0], alone, lost[1], lost[2]))
    audit = pd.DataFrame(out, columns=["filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                                       "good_lost", "toxic_lost"])
    audit["shapley"] = [removed_of[name] for order in ORDERS for name in order]
    audit.insert(0, "part", pdf["part"].iloc[0])
    return audit


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter order and step; ``labels``: doc_id, quality, toxic."""
    prepare(docs.sparkSession)
    counted = written(cells(docs, labels), "cells")
    return counted.groupBy("part").applyInPandas(_walk, AUDIT_SCHEMA)
