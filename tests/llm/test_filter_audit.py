import re
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cellar.llm import filter_audit as A
from tests.llm.common import SCHEMA, SMALL, frame, odd_rows, words

LABELS = "doc_id long, quality int, toxic int, part string, mask int"


def failed(rows):
    """The failed filters of each (doc_id, text), straight from their definitions."""
    out = []
    for doc_id, text in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        smaller = [d for d, x in rows if (x or "") == t and d is not None and (doc_id is None or d < doc_id)]
        names = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": bool(smaller)}
        out.append({n for n, yes in names.items() if yes})
    return out


def brute_force(rows, labels):
    """Each order applied document by document; rows: (doc_id, text, source)."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    fails = failed([r[:2] for r in rows])
    out = {}
    for part in {r[2] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, fails) if (r[2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [x for x in left if name in x[1]]
                left = [x for x in left if name not in x[1]]
                shapley[name] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(name in f for _, f in mine) - len(gone),
                    sum(f == {name} for _, f in mine), sum(d in good for d, _ in gone),
                    sum(d in toxic for d, _ in gone), name]
        for (p, *_), row in out.items():
            if p == part:
                row[6] = shapley[row[6]] if isinstance(row[6], str) else row[6]
    return out


def collected(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = {(r["part"], r["filter_order"], r["step"]): [r[n] for n in names] for r in df.collect()}
    assert df.count() == len(got)
    return got


def cases():
    rows = odd_rows()
    loud = " ".join(f"Word{i}" for i in range(250))
    plain = " ".join(f"word{i}" for i in range(199))
    texts = [loud, loud.lower(), loud.lower(), loud.lower() + " #", plain, plain + " x", "a b " * 100, "a b " * 99 + "c",
             "A" + "b" * 49, "A" + "b" * 48, "$", words(400, 7, 5000) + " AT&T"]
    rows += [(300 + i, t, "en", ["a", "b", None, ""][i % 4], 1, *["x"] * 8) for i, t in enumerate(texts)]
    rows += [(400 + i, loud.lower(), "en", "hot", 1, *["x"] * 8) for i in range(40)]  # copies of 301 in another part
    rows += [(None, loud.lower(), None, "hot", None, *[None] * 8)] * 2
    rows += [(500, "equal ids", None, "c", None, *[None] * 8)] * 2
    labels = [(r[0], (r[0] or 0) % 2, (r[0] or 0) % 3, "x", 1) for r in rows[::2]]
    labels += [(300, 1, 1, "x", 1), (300, 0, None, "x", 1), (None, 1, 1, None, None), (10**9, 1, 1, "x", 1), (4, None, 1, "x", 1)]
    return rows, labels


def test_odd_rows_against_brute_force(spark):
    rows, labels = cases()
    got = collected(A.audit(frame(spark, rows), spark.createDataFrame(labels, LABELS)))
    assert got == brute_force([(r[0], r[1], r[3]) for r in rows], [x[:3] for x in labels])


def test_documents_against_brute_force(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    got = collected(A.audit(docs, labels))
    assert got == brute_force(rows, [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])


@pytest.mark.parametrize("with_labels", [False, True])
def test_empty_tables(spark, with_labels):
    labels = spark.createDataFrame([(1, 1, 1, "x", 1)] if with_labels else [], LABELS)
    got = A.audit(spark.createDataFrame([], SCHEMA), labels)
    assert got.isEmpty() and got.columns[:3] == ["part", "filter_order", "step"]
    rows = odd_rows()
    some = collected(A.audit(frame(spark, rows), spark.createDataFrame([], LABELS)))
    assert some == brute_force([(r[0], r[1], r[3]) for r in rows], [])


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 31), st.integers(1, 9), max_size=32))
def test_walk_equals_sums_over_subsets(cell):
    masks = np.array(list(cell), dtype=np.int64)
    counts = np.array([[n, n // 2] for n in cell.values()], dtype=np.int64).reshape(-1, 2)
    for state, row in enumerate(A.survivors(masks, counts)):
        assert row.tolist() == counts[(masks & state) == 0].sum(axis=0).tolist()


def test_copies_share_one_cell_before_the_walk(spark):
    rows = [(i, "one text for a third of all rows", "en", "a", 1, *["x"] * 8) for i in range(500)]
    got = A.cells(frame(spark, rows), spark.createDataFrame([], LABELS)).collect()
    assert sorted((r["mask"], r["n"]) for r in got) == [(1, 1), (17, 499)]
