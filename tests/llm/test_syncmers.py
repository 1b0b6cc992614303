import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from cellar.llm import syncmers as S
from tests.llm.common import SCHEMA, SMALL, frame, odd_rows, words

M = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def hash_text(w):
    return signed(xxhash.xxh64_intdigest(w.encode(), seed=42))


def hash_longs(*xs):
    h = 42
    for x in xs:
        h = xxhash.xxh64_intdigest((x & M).to_bytes(8, "little"), seed=h)
    return signed(h)


def anchors(text):
    h = [hash_text(w) for w in re.findall(S.WORDS, text)]
    if not h:
        return []
    if len(h) < S.K:
        return [(0, (hash_longs(*h) & M) >> (64 - S.ANCHOR_BITS))]
    out = []
    for i in range(len(h) - S.K + 1):
        w = h[i:i + S.K]
        pairs = [hash_longs(a, b) for a, b in zip(w, w[1:])]
        if min(pairs) in (pairs[0], pairs[-1]):
            four = [hash_longs(pairs[j], pairs[j + 2]) for j in (0, 3)]
            out.append((i, (hash_longs(*four) & M) >> (64 - S.ANCHOR_BITS)))
    return out


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hash_text(r[1] or "")))
    sets = [sorted({a for _, a in anchors(r[1] or "")}) for r in order]

    def alike(a, b):
        return 2.0 * len(set(a) & set(b)) / (len(a) + len(b)) if a or b else 1.0

    out = []
    for i, r in enumerate(order):
        text, after = r[1] or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        new_text = text[:len(text) - half] + after[:half]
        new = sorted({a for _, a in anchors(new_text)})
        out.append((r[0], len(text), hashlib.sha256(new_text.encode()).hexdigest(), " ".join(map(str, sets[i])),
                    " ".join(map(str, new)), alike(sets[i], new), alike(sets[i], sets[(i + 1) % len(order)])))
    return sorted(out, key=str)


@pytest.mark.parametrize("bucket_rows", [2, 5, 2000])
def test_odd_rows(spark, bucket_rows):
    rows = [(r[0], (r[1] or "")[:4000] if r[1] else r[1], *r[2:]) for r in odd_rows()]
    got = S.fingerprints(frame(spark, rows), bucket_rows).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)


def test_real_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r["doc_id"] * 7 - 300, r["text"]) for r in docs.collect()]
    got = S.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 13).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)


def test_one_row_and_empty_table(spark):
    got = S.fingerprints(frame(spark, odd_rows()[5:6])).first()
    assert got["near_next"] == 1.0  # the only document follows itself
    assert S.fingerprints(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_anchors_are_free_of_context(spark):
    passage = words(60, 3)
    df = spark.createDataFrame([(f"{words(9, 4)} {passage} {words(5, 5)}", f"{words(31, 6)} {passage}")], "a string, b string")
    row = S.with_syncmers(S.with_syncmers(df, "a", "x"), "b", "y").select(
        "x", "y", S.shared_positions(F.col("x"), F.col("y")).alias("shared")).first()
    inside = {r["anchor"]: r["at"] - 9 for r in row["x"] if 9 <= r["at"] <= 9 + 60 - S.K}
    assert inside == {r["anchor"]: r["at"] - 31 for r in row["y"] if r["at"] >= 31}
    assert {(m["a"] - 9, m["b"] - 31) for m in row["shared"]} >= {(i, i) for i in inside.values()}
    assert 0.2 < len(inside) / 54 < 0.55
