import random

import numpy as np
import pytest

from cellar.llm import near_dedup as N
from cellar.llm.components import connected_components
from tests.llm.common import SCHEMA, SMALL, frame, odd_rows, rows_of, words


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs."""
    sets = [shingles(r[1]) for r in rows]
    at = list(range(len(rows)))

    def find(i):
        while at[i] != i:
            i = at[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both * 100 >= 75 * (len(sets[i]) + len(sets[j]) - both):
                at[find(i)] = find(j)
    big = 1 << 62
    ids = [big if r[0] is None else r[0] for r in rows]
    smallest = {}
    for i, x in enumerate(ids):
        smallest[find(i)] = min(smallest.get(find(i), big), x)
    out = []
    for i, x in enumerate(ids):
        c = smallest[find(i)]
        out.append((rows[i][0], len(sets[i]), None if c == big else c, x == c))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in N.near_duplicates(df).collect()), key=str)


def edited(text, n, seed):
    rng = random.Random(seed)
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def test_odd_rows(spark):
    rows = odd_rows()
    assert got(frame(spark, rows)) == brute(rows)


def test_groups_of_near_copies(spark):
    """Chains, a large group around one text, texts near the threshold, and a passage shared by otherwise different texts."""
    base, other = words(150, 5, 5000), words(200, 6, 5000)
    texts = [edited(base, i % 4, i) for i in range(60)]
    texts += [edited(other, 5 * i, i) for i in range(12)]
    passage = words(40, 7, 5000)
    texts += [words(60, 100 + i, 5000) + " " + passage for i in range(30)]
    chain = words(120, 8, 5000).split()
    texts += [" ".join(chain[8 * i:] + [f"c{i}x{j}" for j in range(8 * i)]) for i in range(10)]
    rows = rows_of(texts)
    assert got(frame(spark, rows)) == brute(rows)


def test_real_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(docs) == brute(rows)


def test_empty_table(spark):
    assert N.near_duplicates(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64))
    b = np.unique(np.concatenate((a[:300], rng.integers(0, 1 << 63, 100, dtype=np.uint64))))
    sign = N.signatures([a, b])
    assert abs((sign[0] == sign[1]).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.15
    assert (N.signatures([a])[0] == sign[0]).all()


def test_pruning_misses_no_more_than_chosen():
    needed = N.needed_matches(0.75, 1e-5)
    assert (np.diff(needed) > 0).all()
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 32, (4000, N.SIGNATURE), dtype=np.uint32)
    alike = np.where(rng.random(a.shape) < 0.75, a, a + 1).astype(np.uint32)
    apart = np.where(rng.random(a.shape) < 0.3, a, a + 1).astype(np.uint32)
    assert N.may_reach(a, alike, needed).mean() > 0.999 and N.may_reach(a, apart, needed).mean() < 0.01


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(i, i + 1) for i in range(300, 340)]
    edges += [(500, i) for i in range(501, 560)]
    at = {n: n for e in edges for n in e}

    def find(i):
        while at[i] != i:
            i = at[i]
        return i

    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        at[b] = a
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    linked = {n for u, v in edges if u != v for n in (u, v)}
    assert found == {n: find(n) for n in linked}


@pytest.mark.parametrize("small, block", [(1, 3), (2, 64), (1000, 512)])
def test_blocks_and_pairs_agree(spark, monkeypatch, small, block):
    """A large bucket with several components, compared as pairs or in blocks of any size."""
    monkeypatch.setattr(N, "SMALL", small)
    monkeypatch.setattr(N, "BLOCK_NODES", block)
    base = words(150, 9, 5000)
    rows = rows_of([edited(base, 2 + i % 14, i) for i in range(70)] + [edited(words(150, 10, 5000), i, i) for i in range(9)])
    assert got(frame(spark, rows)) == brute(rows)
