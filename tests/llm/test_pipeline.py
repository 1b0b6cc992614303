import hashlib
import re
import tempfile
from collections import Counter

import pytest

import corpus_pipeline as P
from cellar.llm import mixing, pieces
from cellar.llm.queries import tokenizer_path
from tests.llm import test_mixing as mixing_cases
from tests.llm import test_near_dedup as near_cases
from tests.llm.common import SCHEMA, odd_rows, rows_of
from tests.llm.test_quality import prose


@pytest.fixture(scope="module")
def folder(spark):
    """A folder of tables: prose, junk, exact and near copies, and every odd row."""
    texts = [prose(40, i) for i in range(120)] + ["!!".join(prose(30, i).upper().split()) for i in range(8)]
    texts += texts[:20] + [t + " extra words" for t in texts[20:40]] + [texts[0]] * 30
    rows = odd_rows() + [r for i, s in enumerate("abc") for r in rows_of(texts[i::3], first=1000 * (i + 1), source=s)]
    rows += [rows[40], rows[40]]
    out = tempfile.mkdtemp(prefix="cellar-pipeline-")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{out}/documents.parquet")
    good = [(r[0], 1) for r in rows if r[0] and r[0] >= 1000 and "!!" not in r[1]]
    spark.createDataFrame(good[::2], "doc_id long, quality int").write.parquet(f"{out}/labels.parquet")
    return out


@pytest.fixture(scope="module")
def steps(spark, folder):
    """Each stage's input and output rows."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in P.STAGES:
        after = P.written(stage(spark, docs, folder), name)
        out[name] = (docs, after)
        docs = after
    return out


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_stages():
    assert [name for name, _ in P.STAGES] == ["quality", "exact_dedup", "near_dedup", "mix", "encode"]


def test_columns(steps):
    for name, (before, after) in steps.items():
        if name != "encode":
            assert before.columns == after.columns and before.schema == after.schema


def test_quality_drops_junk_only(steps):
    before, after = (rows(x) for x in steps["quality"])
    gone = Counter(before) - Counter(after)
    assert not Counter(after) - Counter(before)
    junk = {r for r in before if r[1] and "!!" in r[1]}
    assert junk and junk <= set(gone)
    assert not any(r[0] is not None and r[0] >= 1000 and r not in junk for r in gone)


def test_exact_dedup(steps):
    before, after = (rows(x) for x in steps["exact_dedup"])
    keep = {}
    for r in before:
        keep.setdefault(r[1] or "", []).append(r[0])
    kept = {max((i for i in ids if i is not None), default=None) for ids in keep.values()}
    assert Counter(after) == Counter({r for r in before if r[0] in kept})
    assert len({(r[0], r[1]) for r in after}) == len(after)


def test_near_dedup(steps):
    before, after = (rows(x) for x in steps["near_dedup"])
    kept = {r[0] for r in near_cases.brute(before) if r[3]} | {None}
    assert Counter(after) == Counter(r for r in before if r[0] in kept)


def test_mix(steps):
    before, after = (rows(x) for x in steps["mix"])
    count = Counter(after)
    assert set(count) <= set(before) and max(count.values()) <= 2
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    sizes = Counter()
    for r in before:
        sizes[r[3]] += size(r)
    for source, target in mixing_cases.brute_targets(dict(sizes)).items():
        assert abs(sum(size(r) for r in after if r[3] == source) - target) <= max(size(r) for r in before if r[3] == source)


def test_encode(steps):
    before, after = steps["encode"]
    texts = {r[0]: r[1] or "" for r in rows(before)}
    assert after.count() == before.count()
    path = tokenizer_path()
    for r in after.collect():
        if r["doc_id"] is not None:
            (ids,) = pieces.encode([texts[r["doc_id"]]], path)
            assert r["ids"] == ids and r["n_tokens"] == len(ids)
            assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_run(spark, folder, steps):
    assert sorted(rows(P.run(spark, folder)), key=str) == sorted(rows(steps["encode"][1]), key=str)


def test_empty_tables(spark):
    out = tempfile.mkdtemp(prefix="cellar-pipeline-")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{out}/labels.parquet")
    assert P.run(spark, out).isEmpty() and mixing.MAX_REPEAT == 2.0
