"""Small documents with the cases that every operator must handle."""

import random

from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    T.StructField("id", T.StringType()), T.StructField("digest", T.StringType()), T.StructField("part", T.StringType()),
    T.StructField("print", T.StringType()), T.StructField("key", T.StringType()), T.StructField("node", T.StringType()),
    T.StructField("size", T.StringType()), T.StructField("bucket", T.StringType()),
])


def rows_of(texts, first=0, lang="en", source="a"):
    return [(first + i, t, lang, source, len(t or ""), *["x"] * 8) for i, t in enumerate(texts)]


def words(n, seed, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_rows():
    """Null, empty, blank, short, repeated, very long and non-ASCII texts; null columns; a repeated row."""
    base = words(60, 1)
    texts = [None, "", " \t\n", "one", "One", base, base, base.upper(), base + " tail", words(30_000, 2), "é́ ﬁ① 😀\r\n x",
             "a" * 5000, " lead", "token = 'abcdefgh12345678'", "All rights reserved.", base.replace("w1", "W1")]
    rows = rows_of(texts)
    rows.append(rows[5])  # a row repeated in full
    rows.append((None, base, None, None, None, *[None] * 8))
    rows.append((None, None, None, None, None, *[None] * 8))
    rows.append((100, "a text without source", None, None, 3, *["y"] * 8))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)
