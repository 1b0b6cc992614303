import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from cellar.llm import vector_codes as V
from tests.llm.common import SMALL

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()),
    # names that the operator uses inside
    T.StructField("vector", T.StringType()), T.StructField("code", T.StringType()), T.StructField("of", T.StringType()),
    T.StructField("points", T.StringType()),
])


def brute_force(rows):
    """Plain Lloyd rounds with Python integers; rows: (vec_id, embedding, label)."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not rows:
        return []
    width = max(1, -(-max(len(r[1]) for r in rows) // 16)) * 16
    ints = [[math.floor(256 * x) for x in r[1]] + [0] * (width - len(r[1])) for r in rows]
    d = width // 16
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))
    cut = [[v[p * d:(p + 1) * d] for v in ints] for p in range(16)]
    books = [[cut[p][i] for i in order[:64]] for p in range(16)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(2):
        for p in range(16):
            owners = [nearest(x, books[p])[1] for x in cut[p]]
            for e in range(len(books[p])):
                mine = [x for x, o in zip(cut[p], owners) if o == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [[nearest(cut[p][i], books[p]) for p in range(16)] for i in range(len(rows))]
    errors = [sum(f[0] for f in x) for x in found]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(r[0], "".join(f"{f[1]:02x}" for f in x), e, sum(o for o, s in zip(errors, rows) if s[2] == r[2]), digest)
            for r, x, e in zip(rows, found, errors)]


def check(df, rows):
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(brute_force(rows), key=str)


def vectors(n, width, seed, spread=0.4):
    rng = random.Random(seed)
    return [[rng.gauss(0, spread) for _ in range(width)] for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "p") for r in rows], SCHEMA).repartition(3)


def as_float(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], c) for i, v, c in rows]


@pytest.mark.parametrize("block", [V.BLOCK_COMPONENTS, 640])
def test_odd_rows_against_brute_force(spark, block):
    rows = [(i, v, i % 3 if i % 7 else None) for i, v in enumerate(vectors(150, 32, 1))]
    same = rows[5][1]
    rows += [(200 + i, same, 1) for i in range(80)] + [rows[3], rows[3]]
    rows += [(300, None, 1), (301, [None] * 32, 1), (302, [float("nan")] * 32, 1), (303, same[:-1] + [float("inf")], 1),
             (304, [], 2), (305, same[:20], 2), (306, [-1e-9] * 32, 2), (307, [0.0] * 32, 9), (None, same[::-1], None),
             (308, [1e5, -7e5] * 16, 4), (-5, vectors(1, 32, 3)[0], 4), (-5, vectors(1, 32, 4)[0], 4)]
    rows = as_float(rows)
    check(V.compress(frame(spark, rows), block), rows)


def test_embeddings_against_brute_force(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [tuple(r) for r in table.select("vec_id", "embedding", "label").collect()]
    check(V.compress(table), rows)


@pytest.mark.parametrize("rows", [
    [],
    [(1, None, 1), (2, [None], None)],
    [(7, [0.5, -0.25], None)],
    [(i, [], 1) for i in range(3)],
    [(i, [0.25] * 17, i % 2) for i in range(70)],
])
def test_small_tables(spark, rows):
    check(V.compress(frame(spark, rows)), rows)


def test_values_beyond_the_limit_do_not_overflow(spark):
    rows = [(i, [3.4e38 if i % 2 else -3.4e38] * 16, 1) for i in range(6)] + [(9, [0.0] * 16, 1)]
    got = {r["vec_id"]: r["error"] for r in V.compress(frame(spark, rows)).collect()}
    assert len(got) == 7 and set(got.values()) == {0}


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 120), st.integers(1, 70), st.integers(1, 4), st.integers(0, 6), st.integers(0, 2**32))
def test_assignment_equals_all_comparisons(n, k, d, spread, seed):
    rng = np.random.default_rng(seed)
    points = rng.integers(-spread, spread + 1, (n, d))
    entries = rng.integers(-spread, spread + 1, (k, d))
    depth = V.depth_for(n, V.LEAF)
    tree = V.Tree(points[V.tree_order(points, depth)], depth)
    codes, sums, counts, _ = V.assign(tree, V.Codebook(entries))
    away = ((tree.points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (codes == away.argmin(axis=1)).all()
    assert (counts == np.bincount(codes, minlength=k)).all()
    assert all((sums[e] == tree.points[codes == e].sum(axis=0)).all() for e in range(k))


def test_bounds_spare_most_comparisons():
    rng = np.random.default_rng(5)
    centres = rng.integers(-200, 200, (64, 4))
    points = centres[rng.integers(0, 64, 4096)] + rng.integers(-4, 5, (4096, 4))
    depth = V.depth_for(len(points), V.LEAF)
    *_, compared = V.assign(V.Tree(points[V.tree_order(points, depth)], depth), V.Codebook(centres))
    assert compared < 0.1 * 4096 * 64


def test_tree_nodes_hold_their_rows():
    points = np.random.default_rng(3).integers(-50, 50, (300, 3))
    depth = V.depth_for(300, 8)
    tree = V.Tree(points[V.tree_order(points, depth)], depth)
    for level in range(depth + 1):
        for i, (a, b) in enumerate(zip(tree.starts[level], tree.starts[level][1:])):
            part = tree.points[a:b]
            assert (tree.lo[level][i] == part.min(axis=0)).all() and (tree.hi[level][i] == part.max(axis=0)).all()
            assert (tree.sums[level][i] == part.sum(axis=0)).all()
