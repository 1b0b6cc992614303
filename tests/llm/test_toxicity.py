import random
import zlib

import numpy as np

from cellar.llm import toxicity as T
from tests.llm.common import SCHEMA, frame, odd_rows, rows_of, words

LETTERS = str.maketrans("0123456789", "abcdefghij")  # words of letters only
INSULTS = ["grobian", "flegel", "lump"]


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w = words(40, 1000 + i, 3000).translate(LETTERS).split()
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(INSULTS))
        rows.append((i, " ".join(w), "en", "a", 1, *["x"] * 8))
        if rng.random() < 0.5:
            labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_rows(spark):
    rows, labels = corpus()
    out = T.toxicity(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(out) == len(rows)
    truth = {r[0]: any(w in r[1] for w in INSULTS) for r in rows}
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [r for r in out if r["held_out"]]
    called = [truth[r["doc_id"]] for r in held if r["predicted"]]
    assert np.mean(called) > 0.95 and sum(called) > 0.95 * sum(truth[r["doc_id"]] for r in held)


def test_labels_of_held_out_rows_change_nothing(spark):
    rows, labels = corpus(400)
    fold = lambda i: zlib.crc32(str(i).encode()) % 3
    swapped = [(i, 1 - t if fold(i) == 1 else t) for i, t in labels]
    a, b = (sorted((r["doc_id"], r["score"]) for r in
                   T.toxicity(frame(spark, rows), spark.createDataFrame(x, "doc_id long, toxic int")).collect())
            for x in (labels, swapped))
    assert a == b


def test_odd_rows(spark):
    rows, labels = corpus(300)
    odd = [(r[0] + 5000 if r[0] is not None else None, *r[1:]) for r in odd_rows()]
    labels = labels + [(None, 1), (5000, None), (labels[0][0], labels[0][1])]
    out = T.toxicity(frame(spark, rows + odd), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(out) == len(rows) + len(odd) and all(0 <= r["score"] <= 1 for r in out)
    assert not any(r["held_out"] for r in out if r["doc_id"] is None)


def test_no_toxic_examples_and_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in T.toxicity(frame(spark, odd_rows()), none).collect()} == {0.0}
    assert T.toxicity(spark.createDataFrame([], SCHEMA), none).isEmpty()


def test_cut_is_between_separated_outputs():
    cut = T.best_cut(np.array([5.0, 6.0, 7.0]), np.array([-3.0] * 9 + [6.0]), 0.1)
    assert -3 < cut < 5


def test_prior_is_of_all_labels(spark, monkeypatch):
    """Labels that the sample of unlabelled text doesn't hit count all the same."""
    rows, labels = corpus(300)
    free = [(i, t) for i, t in labels if zlib.crc32(str(i).encode()) % 3 != 1]
    few = [x for x in free if x[1]][:3] + [x for x in free if not x[1]][:9]
    priors = []
    monkeypatch.setattr(T, "MAX_UNLABELLED", 4)
    monkeypatch.setattr(T, "train", lambda positive, unlabelled, prior: priors.append(prior))
    for some in (few, free):
        T.fit(frame(spark, rows), spark.createDataFrame(some, "doc_id long, toxic int"))
    assert priors == [0.25, sum(t for _, t in free) / len(free)]


def test_labels_of_other_documents_change_nothing(spark):
    """A label table shared by several corpora: ids that aren't in these documents."""
    rows, labels = corpus(400)
    more = [(10_000_000 + i, int(i % 3 > 0)) for i in range(20_000)]
    a, b = (sorted((r["doc_id"], r["score"]) for r in
                   T.toxicity(frame(spark, rows), spark.createDataFrame(x, "doc_id long, toxic int")).collect())
            for x in (labels, labels + more))
    assert a == b
