"""SimHash near-dedup: multi-index hashing.

A document's fingerprint has 64 bits: bit i is set if it is set in more than half of
the XXH64 hashes of the document's three-word shingles, repeats included.
Documents with one fingerprint are a node. Nodes are linked if their fingerprints
differ in at most two bits, and a document's class is its connected component.

The index has a table for each half of the fingerprint. If two fingerprints differ
in at most two bits, one half differs in at most one, so the Hamming ball of radius 1
around one's half holds the other's: each node looks up every value of the ball
in the half's table and the complete distance of what it meets is verified
inside the join. Of two halves that differ in one bit one has a zero there, so balls
go upwards only (half the rows) and still meet.

A table entry that more than ``CROWD`` nodes share is not paired. Its rows agree in that
half (or differ in the one bit that was spent), so what is left of their fingerprints
is indexed in the same way: by halves of 16 bits, then of 8. After that 56 bits are
fixed and at most 256 different fingerprints can share an entry. The work thus
grows with the nodes, not with the square of a group of near copies, and no link is lost.

Words: lower case of A-Z, runs of anything but ASCII white space; a text of fewer than
three words is one shingle. Defined results: null, empty and blank texts have the
fingerprint zero, which is linked like any other; a null doc_id counts as larger
than any number (a component of such rows only has a null component_id); repeated rows have the
same result; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellar.llm._common import prepare, text_of, written
from cellar.llm.components import connected_components

SHINGLE, BITS, DISTANCE, SEED = 3, 64, 2, 42
#: Nodes that share a table entry and are paired as rows; entries of more are indexed further.
CROWD = 32
#: Bits that are left when entries are paired whatever their size (2**8 nodes at most).
LAST_BITS = 8
#: Shingles hashed at a time.
CHUNK = 1 << 16
_LAST_ID = (1 << 63) - 1


def shingle_hashes(text: bytes) -> Iterator[np.ndarray]:
    """The hashes of a text's shingles (UTF-8), some at a time; bytes methods know ASCII only."""
    words = b" ".join(text.lower().split())
    if not words:
        return
    gaps = np.flatnonzero(np.frombuffer(words, dtype=np.uint8) == 0x20)
    n = max(1, len(gaps) + 2 - SHINGLE)
    starts = np.concatenate(([0], gaps + 1))[:n]
    ends = np.concatenate((gaps, [len(words)]))[-n:]
    for at in range(0, n, CHUNK):
        yield np.array([xxhash.xxh64_intdigest(words[a:b], SEED)
                        for a, b in zip(starts[at:at + CHUNK].tolist(), ends[at:at + CHUNK].tolist())], dtype=np.uint64)


def fingerprint(text: bytes) -> int:
    """The SimHash of a text, as an unsigned number."""
    ones, n = np.zeros(BITS, dtype=np.int64), 0
    for hashes in shingle_hashes(text):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        full = len(bits) // 255 * 255  # so many bits add up in a byte
        ones += bits[:full].reshape(-1, 255, BITS).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        ones += bits[full:].sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(texts: DataFrame) -> DataFrame:
    """(id, print): fingerprints as signed 64-bit numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_buffer().to_pybytes()) for t in batch.column("text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints.view(np.int64))], names=["id", "print"])

    return texts.select("id", "text").mapInArrow(run, "id long, print long")


def _ball(value: Column, bits: int) -> Column:
    """The values that differ from ``value`` in one bit, which is zero in it."""
    flipped = F.transform(F.sequence(F.lit(0), F.lit(bits - 1)), lambda i: value.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    return F.filter(flipped, lambda x: x != value)


def entries(items: DataFrame, bits: int) -> DataFrame:
    """(bucket, print, rest, stored): table entries (stored) and lookups of items, by both halves of ``rest``.

    ``items``: within, print, rest (the low ``bits`` bits are open), stored. An item that isn't
    stored has spent one bit already and looks up its own value only.
    """
    half = bits // 2
    low = F.col("rest").bitwiseAND(F.lit((1 << half) - 1))
    high = F.shiftrightunsigned("rest", half).bitwiseAND(F.lit((1 << half) - 1))
    found = []
    for number, (value, other) in enumerate(((low, high), (high, low))):
        def one(key: Column, stored: Column) -> Column:
            return F.struct(F.lit(number).alias("half"), key.alias("key"), other.alias("rest"), stored.alias("stored"))

        found.append(F.array(one(value, F.col("stored"))))
        found.append(F.when(F.col("stored"), F.transform(_ball(value, half), lambda x: one(x, F.lit(False))))
                     .otherwise(F.array()))
    row = F.col("row")
    return (items.select("within", "print", F.explode(F.concat(*found)).alias("row"))
            .select(F.xxhash64("within", row["half"], row["key"]).alias("bucket"), "print", row["rest"].alias("rest"),
                    row["stored"].alias("stored")))


def _links(rows: DataFrame) -> DataFrame:
    """Pairs (u, v) of a bucket's rows and its stored ones, at a complete distance of ``DISTANCE`` at most."""
    asking = rows.select("bucket", F.col("print").alias("u"), F.col("stored").alias("twice"))
    stored = rows.filter("stored").select(F.col("bucket").alias("at"), F.col("print").alias("v"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= DISTANCE
    # two stored rows meet from both sides: once is enough
    return (asking.join(stored, (F.col("bucket") == F.col("at")) & near & (F.col("u") != F.col("v"))
                        & (~F.col("twice") | (F.col("u") < F.col("v")))).select("u", "v"))


def links(nodes: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Pairs (u, v) of the distinct fingerprints in ``nodes`` (print) that differ in at most ``DISTANCE`` bits."""
    items = nodes.select(F.lit(0).cast("long").alias("within"), "print", F.col("print").alias("rest"),
                         F.lit(True).alias("stored"))
    found, bits = None, BITS
    while True:
        rows = entries(items, bits)
        last = bits // 2 <= LAST_BITS
        if not last:
            crowded = written(rows.filter("stored").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
                              .filter(F.col("n") > crowd).select("bucket"), "crowded")
            last = crowded.isEmpty()
        if last:
            some = _links(rows)
            return written(found.unionByName(some) if found is not None else some, "links")
        some = written(_links(rows.join(crowded, "bucket", "left_anti")), "links")
        found = some if found is None else found.unionByName(some)
        items = written(rows.join(crowded, "bucket", "left_semi").withColumnRenamed("bucket", "within"), "crowds")
        bits //= 2


def near_duplicates(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint, component_id."""
    prepare(docs.sparkSession)
    texts = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(_LAST_ID)).alias("id"), text_of(docs).alias("text"))
    prints = written(_fingerprints(texts), "prints")
    nodes = written(prints.groupBy("print").agg(F.min("id").alias("id")), "nodes")
    parts = written(connected_components(links(nodes, crowd)), "parts")
    labelled = nodes.join(parts, F.col("print") == F.col("node"), "left").select(
        "print", "id", F.coalesce("component", "print").alias("part"))
    least = written(labelled.groupBy("part").agg(F.min("id").alias("least")), "least")
    classes = written(labelled.join(least, "part").select(F.col("print").alias("of"), "least"), "classes")
    return (prints.join(classes, F.col("print") == F.col("of"))
            .select(F.nullif("id", F.lit(_LAST_ID)).alias("doc_id"), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
                    F.nullif("least", F.lit(_LAST_ID)).alias("component_id")))
