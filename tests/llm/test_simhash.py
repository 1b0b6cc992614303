import random
import re

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from cellar.llm import simhash as S
from tests.llm.common import SCHEMA, SMALL, frame, odd_rows, words


def simple_print(text):
    """The fingerprint from its definition."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64(s.encode("utf-8", "surrogatepass"), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints):
    """The smallest number reachable for each (number, fingerprint), by all comparisons."""
    last = float("inf")
    distinct = sorted({f for _, f in prints})
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                root[find(b)] = find(a)
    least = {}
    for d, f in prints:
        least[find(f)] = min(least.get(find(f), last), last if d is None else d)
    return [(d, f"{f:016x}", None if least[find(f)] == last else least[find(f)]) for d, f in prints]


def check(df, rows):
    assert df.columns == ["doc_id", "fingerprint", "component_id"]
    expected = components([(r[0], simple_print(r[1])) for r in rows])
    assert sorted(map(tuple, df.collect()), key=str) == sorted(expected, key=str)


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="aAbB éÉ\t\n\x0b\x1c\xa0 😀", max_size=60))
def test_fingerprint_equals_its_definition(text):
    assert S.fingerprint(text.encode()) == simple_print(text)


def test_fingerprint_of_a_text_of_several_chunks():
    text = words(2 * S.CHUNK + 300, 3, 5000)
    assert S.fingerprint(text.encode()) == simple_print(text)


def test_hash_is_the_engines_own(spark):
    from pyspark.sql import functions as F
    text = "one two three"
    got = spark.range(1).select(F.xxhash64(F.lit(text)).alias("h")).first()["h"]
    assert got % 2**64 == next(S.shingle_hashes(text.encode()))[0]


@pytest.mark.parametrize("crowd", [S.CROWD, 1])
def test_odd_rows_and_near_copies(spark, crowd):
    base = words(300, 9).split()
    rng = random.Random(4)
    texts = []
    for _ in range(120):  # near copies: a few words changed
        w = list(base)
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(1000)}"
        texts.append(" ".join(w))
    rows = odd_rows() + [(1000 + i, t, "en", "a", 1, *["x"] * 8) for i, t in enumerate(texts)]
    rows += [(2000 + i, "one text for a third of all rows", "en", "a", 1, *["x"] * 8) for i in range(60)]
    check(S.near_duplicates(frame(spark, rows), crowd), rows)


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    check(S.near_duplicates(docs), [tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_empty_table(spark):
    got = S.near_duplicates(spark.createDataFrame([], SCHEMA))
    assert got.columns == ["doc_id", "fingerprint", "component_id"] and got.isEmpty()


@pytest.mark.parametrize("crowd", [S.CROWD, 2])
def test_no_link_is_lost(spark, crowd):
    """Fingerprints around few centres: full balls, crowded halves, differences in one half and in both."""
    rng = random.Random(crowd)
    prints = {0, 2**64 - 1, 1 << 63}
    for centre in (rng.getrandbits(64), rng.getrandbits(64) | 1 << 63):
        prints |= {centre, *(centre ^ 1 << b for b in range(64))}
        prints |= {centre ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for _ in range(150)}
        prints |= {centre ^ rng.getrandbits(8) for _ in range(60)}  # crowds that share 56 bits
        prints |= {centre ^ rng.getrandbits(8) << 40 for _ in range(60)}
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    got = {frozenset((r["u"] % 2**64, r["v"] % 2**64))
           for r in S.links(spark.createDataFrame([(p,) for p in signed], "print long"), crowd).collect()}
    some = sorted(prints)
    assert got == {frozenset((a, b)) for i, a in enumerate(some) for b in some[i + 1:] if (a ^ b).bit_count() <= 2}
