"""Document fingerprints: closed syncmers, in DataFrame functions only.

A text is a row of words (runs of anything but white space; a longer run counts
as several of ``WORD_CHARS`` characters). A k-mer is ``K`` words, its inner
substrings are the pairs of neighbouring words in it. A k-mer is a closed syncmer
if the smallest hash among its pairs stands at its first or last pair. Whether it
is chosen depends on its own words only, so that a passage has the same anchors
wherever it stands. A third of the k-mers are chosen.

The minimum over a window of six pairs comes from minima over two and four
(``zip_with`` of an array and its shifted self), and so does a k-mer's hash: each
step is one pass over an array, and no lambda looks into another array.

The fingerprint is the sorted distinct anchors. Two texts are alike by twice their
common anchors over the sum of both numbers (1 for two empty fingerprints).

Each document is compared with the next one in doc_id order. Rows go to buckets of
doc_id ranges; the first row of each bucket is sent to the one before as well, so
that each bucket knows the text after its last; a bucket holds about
``BUCKET_ROWS`` rows, and no order over all rows in one task is needed.

Defined results: a null text is empty; an empty or blank text has no anchors; a
text of fewer than K words has one anchor, the hash of them all; rows of one
doc_id follow each other by a hash of their text, and identical rows are each
other's next; a null doc_id stands before all numbers; an empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellar.llm._common import groups_for, prepare, text_of

K = 7
WORD_CHARS = 24
WORDS = rf"[^\x20\x09-\x0D]{{1,{WORD_CHARS}}}"
#: Bits of an anchor.
ANCHOR_BITS = 40
BUCKET_ROWS = 2000
#: Bucket bounds are kept in the plan, so there are so many at most; buckets grow beyond (and spill).
MAX_BUCKETS = 1 << 16
_NO_ID = -(1 << 63)


def _smaller(x: Column, y: Column) -> Column:
    return F.least(x, y)


def _zip(df: DataFrame, name: str, left: str, right: str, by: int, combine) -> DataFrame:
    """Column ``name``: element i of ``left`` combined with element i + by of ``right``, as far as both go."""
    n = F.greatest(F.least(F.size(left), F.size(right) - by), F.lit(0))
    return df.withColumn(name, F.zip_with(F.slice(F.col(left), 1, n), F.slice(F.col(right), by + 1, n), combine))


def with_syncmers(df: DataFrame, text: str, name: str) -> DataFrame:
    """Column ``name``: array of (at: number of the k-mer's first word, anchor) of the text's closed syncmers."""
    h, s, a, b, c, d = (f"_{name}_{x}" for x in "hsabcd")
    df = df.withColumn(h, F.transform(F.regexp_extract_all(F.col(text), F.lit(WORDS), F.lit(0)), lambda w: F.xxhash64(w)))
    df = _zip(df, s, h, h, 1, lambda x, y: F.xxhash64(x, y))            # pairs of words
    df = _zip(df, a, s, s, 1, _smaller)                                   # minima over 2 pairs
    df = _zip(df, a, a, a, 2, _smaller)                                   # over 4
    df = _zip(df, a, a, a, 2, _smaller)                                   # over 6: the pairs of a k-mer
    df = _zip(df, b, s, s, 5, _smaller)                                   # the smaller of its edges
    df = _zip(df, c, s, s, 2, lambda x, y: F.xxhash64(x, y))             # hash of 4 words
    df = _zip(df, c, c, c, 3, lambda x, y: F.shiftrightunsigned(F.xxhash64(x, y), 64 - ANCHOR_BITS))  # of 7
    df = _zip(df, d, a, b, 0, lambda x, y: x == y)
    df = _zip(df, d, d, c, 0, lambda chosen, x: F.when(chosen, x))
    whole = F.shiftrightunsigned(F.xxhash64(F.col(h)), 64 - ANCHOR_BITS)
    few = F.size(h) < K
    df = df.withColumn(d, F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
                       .when(few, F.array(whole)).otherwise(F.col(d)))
    found = F.filter(F.transform(F.col(d), lambda x, i: F.struct(i.alias("at"), x.alias("anchor"))),
                     lambda x: x["anchor"].isNotNull())
    return df.withColumn(name, found).drop(h, s, a, b, c, d)


def anchor_set(found: Column) -> Column:
    """Sorted distinct anchors of syncmers."""
    return F.sort_array(F.array_distinct(found["anchor"]))


def likeness(a: Column, b: Column) -> Column:
    """Likeness (0 to 1) of two anchor sets."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / total)


def shared_positions(a: Column, b: Column) -> Column:
    """Where two texts match: (at of the first, at of the second) of each common anchor's first places."""
    first = F.map_from_entries(F.transform(
        F.array_distinct(b["anchor"]), lambda x: F.struct(x, F.get(b["at"], F.array_position(b["anchor"], x) - 1))))
    hits = F.filter(a, lambda x: F.map_contains_key(first, x["anchor"]))
    return F.transform(hits, lambda x: F.struct(x["at"].alias("a"), F.element_at(first, x["anchor"]).alias("b")))


def _bucket(key: Column, bounds: list[int]) -> Column:
    """The number of bounds (ascending) at or below ``key``, less one: a binary search over a constant array."""
    known = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    count = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, step: F.when(
        (at + step <= len(bounds)) & (F.coalesce(F.get(known, at + step - 1), F.lit(_NO_ID)) <= key), at + step
    ).otherwise(at))
    return count - 1


def with_next(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, Window]:
    """Rows (key, text, bucket, ghost) and the window in which each row's next one follows it.

    ``ghost`` rows are copies of the rows that open the next bucket; drop them after looking ahead.
    """
    rows = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(_NO_ID)).alias("key"), text_of(docs).alias("text"))
    n, least = rows.agg(F.count(F.lit(1)), F.min("key")).first()
    buckets = min(groups_for(n, bucket_rows), MAX_BUCKETS)
    bounds = [least if n else 0]
    if buckets > 1:
        cuts = F.percentile_approx("key", [i / buckets for i in range(1, buckets)], max(10_000, 20 * buckets))
        bounds = sorted(set(bounds) | set(rows.agg(cuts).first()[0]))
    bucket = _bucket(F.col("key"), bounds)
    places = F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("ghost")))
    before = F.pmod(F.col("bucket") - 1, F.lit(len(bounds))).cast("int")
    opens = F.get(F.array(*[F.lit(b).cast("long") for b in bounds]), F.col("bucket")) == F.col("key")
    both = F.concat(places, F.array(F.struct(before.alias("bucket"), F.lit(True).alias("ghost"))))
    placed = (rows.withColumn("bucket", bucket)
              .withColumn("place", F.explode(F.when(opens, both).otherwise(places)))
              .select("key", "text", "place.bucket", "place.ghost"))
    ahead = Window.partitionBy("bucket").orderBy("ghost", "key", F.xxhash64("text"))
    return placed, ahead


def fingerprints(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per row of ``docs``: its fingerprint, that of its edited text, and how alike they and the next one are.

    The edited text is the text with its last floor(n / 2) code points replaced
    by the first as many (or all) of the next document's.
    """
    prepare(docs.sparkSession)
    placed, ahead = with_next(docs, bucket_rows)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = (placed.withColumn("next_text", F.lead("text").over(ahead))
            .withColumn("edited", F.concat(F.left("text", n - half), F.left(F.coalesce("next_text", F.lit("")), half)))
            .select("key", "bucket", "ghost", "text", "edited", n.cast("long").alias("n_chars"),
                    F.sha2("edited", 256).alias("edited_sha256")))
    rows = with_syncmers(rows, "text", "own").withColumn("own", anchor_set(F.col("own")))
    rows = rows.withColumn("following", F.lead("own").over(ahead)).filter(~F.col("ghost"))
    rows = with_syncmers(rows, "edited", "new").withColumn("new", anchor_set(F.col("new")))
    shown = F.when(F.col("key") != _NO_ID, F.col("key"))
    return rows.select(shown.alias("doc_id"), "n_chars", "edited_sha256",
                       F.array_join(F.col("own").cast("array<string>"), " ").alias("fingerprint"),
                       F.array_join(F.col("new").cast("array<string>"), " ").alias("edited_fingerprint"),
                       likeness(F.col("own"), F.col("new")).alias("near_edited"),
                       likeness(F.col("own"), F.col("following")).alias("near_next"))
