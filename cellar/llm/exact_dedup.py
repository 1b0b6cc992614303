"""Exact dedup: Golomb-coded fingerprint exchange.

Parts of the corpus send their sorted, Rice-coded fingerprints to owners of
fingerprint ranges. An owner answers each part with one bit per fingerprint:
seen by another part too, or not. Only documents whose bit is set (or which
repeat within their own part) are suspects; only their texts are shuffled, and
they are compared byte by byte by grouping on the text itself.

Parts and owners are about the square root of the documents in number, so a message
holds ``MESSAGE_PRINTS`` fingerprints or more however many documents there are.

What moves: 40 bytes a document for the digest table, about
``SPARE_BITS + log2(parts) + 2`` bits a fingerprint for the exchange, and the
suspects' texts. Copies collapse before every shuffle (a part sends a
fingerprint once; the byte comparison aggregates map-side), so a text that
holds a third of all rows costs one row per task.

Defined results: a null text counts as empty, empty texts are copies of each
other, a null doc_id is kept apart from every number (it stays only where its
whole group has no number), rows repeated with one doc_id share one decision,
and an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.llm._common import groups_for, prepare, text_of, written

#: Bits of a fingerprint beyond log2 of the documents: one false suspect in about 2**SPARE_BITS documents.
SPARE_BITS = 10
#: Documents of a part and fingerprints of an owner, at least (the size of a task's arrays, not a cap).
PART_ROWS = 20_000
#: Fingerprints of a message, about: parts and owners grow with the square root of the documents, so that
#: messages (parts times owners) grow with the documents and stay long enough to be worth coding.
MESSAGE_PRINTS = 64


def parts_for(rows: int, part_rows: int = PART_ROWS) -> int:
    """How many parts the documents are dealt to, and how many owners the fingerprints."""
    return min(groups_for(rows, part_rows), math.isqrt(max(0, rows) // MESSAGE_PRINTS) + 1)


def rice_encode(values: np.ndarray, bits: int) -> bytes:
    """Sorted distinct non-negative integers as Golomb-Rice coded gaps (divisor ``2**bits``).

    Layout: the unary quotients (q ones and a zero each), padded to a byte, then
    the remainders of ``bits`` bits each. The counts travel beside it.
    """
    if len(values) == 0:
        return b""
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    quotients = (gaps >> np.uint64(bits)).astype(np.int64)
    ends = np.cumsum(quotients + 1)
    unary = np.ones(int(ends[-1]), dtype=np.uint8)
    unary[ends - 1] = 0
    shifts = np.arange(bits, dtype=np.uint64)[::-1]
    rest = ((gaps[:, None] >> shifts[None, :]) & np.uint64(1)).astype(np.uint8) if bits else np.zeros((0, 0), np.uint8)
    return np.packbits(unary).tobytes() + np.packbits(rest.ravel()).tobytes()


def rice_decode(data: bytes, count: int, bits: int) -> np.ndarray:
    """The integers that :func:`rice_encode` coded."""
    if count == 0:
        return np.zeros(0, dtype=np.uint64)
    raw = np.frombuffer(data, dtype=np.uint8)
    tail = (count * bits + 7) // 8
    unary = np.unpackbits(raw[: len(raw) - tail])
    ends = np.flatnonzero(unary == 0)[:count]
    quotients = np.diff(ends, prepend=-1) - 1
    gaps = quotients.astype(np.uint64) << np.uint64(bits)
    if bits:
        rest = np.unpackbits(raw[len(raw) - tail:])[: count * bits].reshape(count, bits)
        weights = np.uint64(1) << np.arange(bits, dtype=np.uint64)[::-1]
        gaps += (rest * weights).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


def _fingerprints(digests: pd.Series, width: int) -> np.ndarray:
    """The first ``width`` bits of each 32-byte digest."""
    joined = np.frombuffer(b"".join(bytes(d)[:8] for d in digests), dtype=">u8").astype(np.uint64)
    return joined >> np.uint64(64 - width)


def exchange_suspects(table: DataFrame, rows: int, part_rows: int = PART_ROWS) -> DataFrame:
    """(doc_id, digest) of the rows of ``table`` whose fingerprint occurs more than once anywhere."""
    parts = parts_for(rows, part_rows)
    width = min(60, max(1, int(rows).bit_length() + SPARE_BITS))
    owner_bits = min(width, (parts - 1).bit_length())
    rice_bits = max(0, width - max(1, (groups_for(rows, parts)).bit_length()))
    cut = np.uint64(width - owner_bits)
    tagged = table.withColumn("part", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(parts)).cast("int"))

    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        prints = np.unique(_fingerprints(pdf["digest"], width))
        owners = (prints >> cut).astype(np.int64)
        starts = np.flatnonzero(np.diff(owners, prepend=-1))
        out = []
        for chunk in np.split(prints, starts[1:]):
            owner = int(chunk[0] >> cut)
            local = chunk - (np.uint64(owner) << cut)
            out.append((owner, int(pdf["part"].iloc[0]), len(chunk), rice_encode(local, rice_bits)))
        return pd.DataFrame(out, columns=["owner", "part", "n", "coded"])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        lists = [rice_decode(c, n, rice_bits) for c, n in zip(pdf["coded"], pdf["n"])]
        values, counts = np.unique(np.concatenate(lists), return_counts=True)
        repeated = values[counts > 1]
        marks = [np.packbits(np.isin(x, repeated, assume_unique=True)).tobytes() for x in lists]
        return pd.DataFrame({"owner": pdf["owner"], "part": pdf["part"], "marks": marks, "n": pdf["n"]})

    def flag(docs: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        prints, inverse, counts = np.unique(_fingerprints(docs["digest"], width), return_inverse=True,
                                            return_counts=True)
        ordered = marks.sort_values("owner")
        bits = [np.unpackbits(np.frombuffer(m, dtype=np.uint8))[:n] for m, n in zip(ordered["marks"], ordered["n"])]
        seen = np.concatenate(bits).astype(bool) | (counts > 1)
        return docs.loc[seen[inverse], ["doc_id", "digest"]]

    messages = tagged.groupBy("part").applyInPandas(send, "owner long, part int, n long, coded binary")
    marks = messages.groupBy("owner").applyInPandas(answer, "owner long, part int, marks binary, n long")
    return (tagged.groupBy("part").cogroup(marks.groupBy("part"))
            .applyInPandas(flag, "doc_id long, digest binary"))


def exact_duplicates(docs: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    digest = F.unhex(F.sha2("text", 256))
    table = written(texts.select("doc_id", digest.alias("digest")), "digests")
    rows = table.count()
    suspects = exchange_suspects(table, rows, part_rows).select(F.col("doc_id").alias("id")).distinct()
    groups = (texts.join(suspects, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
              .groupBy(digest.alias("digest"), "text")
              .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
              .filter("group_size > 1")
              .select("digest", "keep_id", "group_size"))
    groups = written(groups, "groups")
    if not groups.groupBy("digest").count().filter("count > 1").isEmpty():
        raise ValueError("two different texts share a SHA-256 digest")
    out = table.join(groups, "digest", "left")
    keep_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select("doc_id", keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"),
                      F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"))
