import hashlib
import random
import tracemalloc

import pytest

import cellar.llm.pieces as X
from tests.llm.common import SCHEMA, SMALL, frame, odd_rows, words

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def cases():
    rng = random.Random(1)
    letters = list("abcdefghinorstuaeiou   \n▁.,é中😀\tTHE")
    out = ["", " ", "  a", "a  b\tc\nd ", "▁a", "\n\n", " " * 50 + "x", " " * 6000 + "y", "a" * 5000, "ab" * 3000, "the" * 2000,
           "😀é́ﬁ①\x00\x01", "<s>hi</s><0x41>", "  the  the   ▁▁▁the", "\r\n\t x", "�﻿ x y"]
    return out + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 200))) for _ in range(600)]


def test_same_ids_and_text_as_the_library(library):
    texts = cases()
    for text, ids in zip(texts, X.encode(texts, PATH)):
        assert ids == library.encode(text), repr(text[:60])
        assert X.decode(ids, PATH) == library.decode(ids), repr(text[:60])


def test_queue_and_rounds_agree(library, monkeypatch):
    texts = cases()[:200]
    monkeypatch.setattr(X, "LONG_WORD", 3)
    assert X.encode(texts, PATH) == library.encode(texts)


def test_small_cache_and_chunks(library, monkeypatch):
    monkeypatch.setattr(X, "CACHE_WORDS", 10)
    codec = X.Codec(PATH)
    texts = [words(40, i) for i in range(30)]
    for _ in range(2):
        got = [r[1] for part in X.chunks_of(texts, 500) for r in codec.rows(texts[part])]
        assert got == [",".join(map(str, library.encode(t))) for t in texts]


def expect(library, rows):
    out = []
    for i, text in rows:
        ids = library.encode(text or "")
        out.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    return sorted(out, key=str)


def test_documents(spark, library):
    rows = odd_rows()
    got = X.encoded(frame(spark, rows), PATH).collect()
    assert sorted((tuple(r) for r in got), key=str) == expect(library, [(r[0], r[1]) for r in rows])
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = X.encoded(docs, PATH).collect()
    assert sorted((tuple(r) for r in got), key=str) == expect(library, [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_ids_on_request_and_empty_table(spark, library):
    row = X.encoded(frame(spark, odd_rows()[3:4]), PATH, keep_ids=True).first()
    assert row["ids"] == library.encode("one") and row["decoded"] == "one"
    assert X.encoded(spark.createDataFrame([], SCHEMA), PATH).isEmpty()


def test_memory_with_many_different_words(library):
    """What a worker holds is bounded by its cache and chunk sizes, not by the words of a batch."""
    texts = [" ".join(f"{a:x}{b:x}" for b in range(1000, 1400)) for a in range(500)]
    codec = X.Codec(PATH)
    tracemalloc.start()
    got = [row[1] for part in X.chunks_of(texts, X.BATCH_CHARS) for row in codec.rows(texts[part])]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[::100] == [",".join(map(str, library.encode(t))) for t in texts[::100]]
    assert peak < 130e6


def test_words_come_back_from_the_older_generation(library, monkeypatch):
    monkeypatch.setattr(X, "CACHE_WORDS", 60)
    codec = X.Codec(PATH)
    texts = ["é☃ the"] + [words(20, i) + " é☃ the" for i in range(12)] + ["", "▁x"]
    for text in texts * 2:
        assert [(r[1], r[2]) for r in codec.rows([text])] == [
            (",".join(map(str, library.encode(text))), library.decode(library.encode(text)))]
        assert len(codec._known) <= 60 and len(codec._older) <= 60


def test_ids_without_the_text(spark):
    rows = X.encoded(frame(spark, odd_rows()), PATH, keep_ids=True, keep_text=False)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert all(len(r["ids"]) == r["n_tokens"] for r in rows.collect())
