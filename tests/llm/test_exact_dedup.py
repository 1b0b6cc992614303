import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cellar.llm import exact_dedup as X
from tests.llm.common import SCHEMA, SMALL, frame, odd_rows


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**40), max_size=300), st.integers(0, 30))
def test_rice_round_trip(values, bits):
    bits = max(bits, 24)  # smaller divisors only make longer codes
    found = np.array(sorted(values), dtype=np.uint64)
    assert (X.rice_decode(X.rice_encode(found, bits), len(found), bits) == found).all()


def test_rice_codes_near_the_entropy():
    rng = np.random.default_rng(1)
    found = np.unique(rng.integers(0, 1 << 30, 20_000, dtype=np.uint64))
    assert len(X.rice_encode(found, 15)) * 8 / len(found) < 18


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    out = []
    for r in rows:
        ids = groups[r[1] or ""]
        numbers = [i for i in ids if i is not None]
        keep = max(numbers) if numbers else None
        out.append((r[0], keep, len(ids), r[0] == keep, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("part_rows", [2, 20_000])
@pytest.mark.parametrize("prints", [1, 64])
def test_odd_rows_and_copies(spark, monkeypatch, part_rows, prints):
    monkeypatch.setattr(X, "MESSAGE_PRINTS", prints)
    rows = odd_rows() + [(200 + i, "one text for a third of all rows", "en", "a", 1, *["x"] * 8) for i in range(40)]
    got = X.exact_duplicates(frame(spark, rows), part_rows).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)


def test_empty_table(spark):
    got = X.exact_duplicates(spark.createDataFrame([], SCHEMA))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and got.isEmpty()


def test_suspects_hold_every_copy_and_little_else(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    from pyspark.sql import functions as F
    table = docs.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"))
    got = {r["doc_id"] for r in X.exchange_suspects(table, table.count(), 30).collect()}
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["text"], []).append(r["doc_id"])
    copies = {i for ids in texts.values() if len(ids) > 1 for i in ids}
    assert copies <= got and len(got - copies) <= 2


def test_messages_grow_with_the_documents():
    """Parts times owners stay below a message for MESSAGE_PRINTS documents, and small tables keep parts of PART_ROWS."""
    for rows in (0, 1, 5_000, 256_410, 5 * 10**7, 4 * 10**8, 5 * 10**9):
        parts = X.parts_for(rows)
        assert 1 <= parts <= max(1, -(-rows // X.PART_ROWS))
        assert (parts - 1) ** 2 * X.MESSAGE_PRINTS <= rows
    assert X.parts_for(256_410) == 13 and X.parts_for(5 * 10**9) > 8_000
