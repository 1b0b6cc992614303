import re

import numpy as np
import pytest

from cellar.llm import mixing as M
from tests.llm.common import SCHEMA, SMALL, frame, odd_rows, rows_of, words


def brute_targets(sizes, weights=M.WEIGHTS, share=M.SHARE, cap=M.MAX_REPEAT):
    """Targets by repeated sharing of what is above the caps."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, budget = dict.fromkeys(names, 0.0), share * sum(sizes.values())
    free = set(names)
    while budget > 1e-9 and free:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += budget * weight[s] / total
        budget = sum(max(0.0, target[s] - cap * sizes[s]) for s in free)
        for s in list(free):
            if target[s] >= cap * sizes[s]:
                target[s] = cap * sizes[s]
                free.discard(s)
    return target


def check(rows, got):
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    target = brute_targets(sizes)
    assert len(got) == len(rows)
    taken, biggest = {}, {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]], rel=1e-9, abs=1e-6)
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        biggest[r["source"]] = max(biggest.get(r["source"], 0), r["size"])
    for s, t in target.items():
        assert abs(taken[s] - t) <= biggest[s]


def test_odd_rows(spark):
    rows = odd_rows()
    check(rows, M.mix(frame(spark, rows)).collect())


def test_many_blocks_and_reruns(spark):
    rows = [r for i, s in enumerate(["b", "a", "ü", None, "c"]) for r in
            rows_of([words(3 + (j * j) % 90, j) for j in range(700 if i == 1 else 90)], first=1000 * i, source=s)]
    first = M.mix(frame(spark, rows), block_rows=32).collect()
    check(rows, first)
    again = M.mix(frame(spark, rows).repartition(7), block_rows=32).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in first) == sorted((r["doc_id"], r["taken"]) for r in again)


def test_real_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    check([tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()], M.mix(docs).collect())


def test_empty_table(spark):
    assert M.mix(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 500, 800).astype(float)
    p = np.full(800, 0.37)
    x = M.flight(p, sizes, rng)
    assert ((x > 0) & (x < 1)).sum() <= 2
    assert x.sum() == pytest.approx(p.sum()) and (x * sizes).sum() == pytest.approx((p * sizes).sum())
    assert set(M.land(x, sizes)) <= {0.0, 1.0}


def test_flight_keeps_inclusion_probabilities():
    sizes = np.array([5.0, 1, 9, 4, 4, 7])
    total = sum(M.land(M.flight(np.full(6, 0.5), sizes, np.random.default_rng(i)), sizes) for i in range(2000))
    assert abs(total / 2000 - 0.5).max() < 0.25  # the landing rounds to the nearest total, so only about
