"""Mixing sources to target weights: cube-method balanced sampling.

Each source gets a target number of words. A document is taken ``floor(target /
source size)`` times for certain and once more with the fraction left as its
inclusion probability. The cube method decides these fractional inclusions: its
flight phase moves the vector of probabilities through the null space of two
constraints (words taken and documents taken stay what they are) until a
coordinate reaches 0 or 1, and goes on until at most two per block are left.

Blocks of about ``BLOCK_ROWS`` documents of one source fly in parallel. What
stays fractional (two documents a block) forms new blocks, round after round,
until one block per source is left; its last one or two documents are the
landing problem, solved by the rounding that is nearest to the word total. The
number of rounds is log of the documents to the base BLOCK_ROWS / 2. Each round
is written to the shared folder. The random steps are seeded by source, block
and round, and blocks are sorted, so reruns agree.

Targets: weights go round the sources in code point order (null last); the
budget is ``share`` of all words; no target exceeds ``max_repeat`` times its
source's size, the excess being shared again by weight. That is
``min(cap, level * weight)`` for the one level at which the targets fill the
budget, found by aggregates over the table of sources.

Defined results: a null text has no words; a document without words takes 0
words; a source without words has target 0; a null source is a source of its
own; repeated rows are documents of their own; an empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.llm._common import WORD_PATTERN, prepare, text_of, written
from cellar.operators.enrich import global_index

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_REPEAT = 2.0
BLOCK_ROWS = 1024
#: Closer than this to 0 or 1, a probability is settled.
EPSILON = 1e-9

_STATE = "doc_id long, source string, size long, base int, p double, blocks long, block long"


def flight(p: np.ndarray, sizes: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Probabilities moved until at most two are fractional; sums of p and of p * size don't change.

    Three fractional units always have a direction in the null space of the two
    constraints (1, 1, 1) and (sizes): the cross product of the two.
    """
    x = p.astype(float).copy()
    waiting = [int(i) for i in np.flatnonzero((x > EPSILON) & (x < 1 - EPSILON))][::-1]
    draws = rng.random(len(waiting) + 1)
    unit: list[int] = []
    step = 0
    while True:
        while len(unit) < 3 and waiting:
            unit.append(waiting.pop())
        if len(unit) < 3:
            return x
        a, b, c = unit
        sa, sb, sc = float(sizes[a]), float(sizes[b]), float(sizes[c])
        move = (sb - sc, sc - sa, sa - sb)
        if move == (0.0, 0.0, 0.0):
            move = (1.0, -1.0, 0.0)
        up = down = np.inf
        for i, m in zip(unit, move):
            if m > 0:
                up, down = min(up, (1 - x[i]) / m), min(down, x[i] / m)
            elif m < 0:
                up, down = min(up, x[i] / -m), min(down, (1 - x[i]) / -m)
        go = up if draws[step] * (up + down) < down else -down
        step += 1
        for i, m in zip(unit, move):
            v = x[i] + go * m
            x[i] = 0.0 if v < EPSILON else 1.0 if v > 1 - EPSILON else v
        left = [i for i in unit if 0.0 < x[i] < 1.0]
        if len(left) == 3:  # rounding kept all three inside: settle the nearest
            i = min(left, key=lambda j: min(x[j], 1 - x[j]))
            x[i] = round(x[i])
            left.remove(i)
        unit = left


def land(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The last fractional units rounded so that the words taken change least (then the documents)."""
    left = np.flatnonzero((x > 0) & (x < 1))
    best = None
    for bits in range(1 << len(left)):
        pick = np.array([(bits >> i) & 1 for i in range(len(left))], dtype=float)
        off = pick - x[left]
        cost = (abs(float((off * sizes[left]).sum())), abs(float(off.sum())), bits)
        best = min(best, (cost, tuple(pick))) if best else (cost, tuple(pick))
    out = x.copy()
    if len(left):
        out[left] = best[1]
    return out


def _fly(seed: int, round_no: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "size"], kind="stable").reset_index(drop=True)
        key = f"{seed}|{round_no}|{pdf['source'].iloc[0]}|{pdf['block'].iloc[0]}"
        sizes = pdf["size"].to_numpy(dtype=float)
        x = flight(pdf["p"].to_numpy(dtype=float), sizes, np.random.default_rng(zlib.crc32(key.encode())))
        if int(pdf["blocks"].iloc[0]) == 1:
            x = land(x, sizes)
        return pdf.assign(p=x)
    return run


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   max_repeat: float = MAX_REPEAT) -> DataFrame:
    """(source, source_size, documents, target) for rows of (source, size)."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    ranked = global_index(totals.withColumn("nulls_last", F.col("source").isNull()), ["nulls_last", "source"], "rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = written(ranked.select("source", "source_size", "documents", weight.alias("weight")), "sources")
    size, w = F.col("source_size"), F.col("weight")
    cap = size * F.lit(max_repeat)
    budget = (table.agg(F.sum("source_size")).first()[0] or 0) * share
    level, full = 0.0, -1
    while True:  # sources that reach their cap leave the sharing; at most one pass for each that does, few in practice
        capped = cap <= w * F.lit(level)
        row = table.agg(F.sum(F.when(capped, cap).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(w)),
                        F.count(F.when(capped, 1))).first()
        if row[2] == full or not row[1]:
            break
        full, level = row[2], (budget - row[0]) / row[1]
    target = F.least(cap, w * F.lit(float(level))) if budget else F.lit(0.0)
    return table.select("source", "source_size", "documents", target.cast("double").alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: float = MAX_REPEAT,
        block_rows: int = BLOCK_ROWS, seed: int = 7) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken."""
    spark = docs.sparkSession
    prepare(spark)
    sized = written(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"),
                                F.regexp_count(text_of(docs), F.lit(WORD_PATTERN)).cast("long").alias("size")), "sizes")
    targets = written(source_targets(sized, weights, share, max_repeat), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    base = F.floor(rate + F.lit(EPSILON))
    per_source = targets.select(F.col("source").alias("of"), base.cast("int").alias("base"),
                                F.greatest(F.lit(0.0), rate - base).alias("p"), F.col("documents").alias("rows"))
    state = sized.join(per_source, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    fractional = F.col("p").between(EPSILON, 1 - EPSILON)
    settled = [state.filter(~fractional).select("doc_id", "source", "size", "base", F.round("p").cast("int").alias("extra"))]
    state, round_no = state.filter(fractional), 0
    while True:
        blocks = F.ceil(F.col("rows") / F.lit(block_rows))
        flying = (state.withColumn("blocks", blocks.cast("long"))
                  .withColumn("block", F.pmod(F.xxhash64("doc_id", "size", F.lit(round_no)), F.col("blocks")))
                  .select("doc_id", "source", "size", "base", "p", "blocks", "block"))
        done = written(flying.groupBy("source", "block").applyInPandas(_fly(seed, round_no), _STATE), f"round{round_no}")
        inside = (F.col("p") > 0) & (F.col("p") < 1)
        settled.append(done.filter(~inside).select("doc_id", "source", "size", "base", F.col("p").cast("int").alias("extra")))
        left = done.filter(inside)
        counts = written(left.groupBy("source").agg(F.count(F.lit(1)).alias("rows")), "left")
        if counts.isEmpty():
            break
        counts = counts.withColumnRenamed("source", "of")
        state = left.select("doc_id", "source", "size", "base", "p").join(
            counts, F.col("source").eqNullSafe(F.col("of"))).drop("of")
        round_no += 1
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    copies = F.col("base") + F.col("extra")
    goal = targets.select(F.col("source").alias("of"), "source_size", "target")
    return (out.join(goal, F.col("source").eqNullSafe(F.col("of")))
            .select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                    (copies * F.col("size")).cast("long").alias("taken")))
