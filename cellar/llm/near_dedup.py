"""MinHash near-dedup: sequential Bayesian verification.

A document's set is its distinct five-word shingles. Documents with one set
collapse to a node. Bands of the MinHash signature name buckets; documents of a
bucket are candidates. A candidate pair's signatures are compared batch by batch,
and the pair is pruned as soon as the posterior probability that its similarity
reaches the threshold falls to ``miss``. Survivors are verified on their full sets.

Pairs inside a bucket are not all made. First each member meets its bucket's centre only,
the node that has most company over all its buckets: in a group of near copies that is
the one least changed, so the group falls into one component at the cost of a pair a
member. Links inside a component need no proof, so what is left are members of one
bucket in different components. In a bucket of at most ``SMALL`` members their pairs
are made. A larger one is cut into blocks: those outside its largest component meet all
others block by block, inside a task that compares signatures, verifies sets and
returns links only; a pair that shares several buckets is compared in the first.
The components are those of all pairs.

With 32 bands of 4 values a pair at the threshold of 0.75 shares no bucket with
probability (1 - 0.75**4)**32 = 5e-6; more similar pairs are missed less.

Defined results: a null, empty or blank text has an empty set, n_shingles 0 and is
linked with nothing; a text of fewer than five words is one shingle; rows with a
null doc_id count as larger than any number; rows repeated with one doc_id share
the same result if their texts are equal; an empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.llm._common import bound_batches, prepare, text_of, tidied, written
from cellar.llm.components import connected_components

SHINGLE = 5
BANDS, BAND_VALUES = 32, 4
SIGNATURE = BANDS * BAND_VALUES
THRESHOLD = (75, 100)
MISS = 1e-5
#: Hashes compared before the posterior is looked at again.
COMPARE = 16
#: Members of a bucket whose pairs are made as rows, at most; and members of a block of a larger one.
SMALL, BLOCK_NODES = 16, 512
#: Ids that are looked up by broadcast at most (8 bytes each); more are joined by shuffle.
BROADCAST_IDS = 2_000_000
#: Shingles hashed at a time.
BLOCK = 1 << 16
CACHE_WORDS = 200_000

_MAX_ID = (1 << 63) - 1
_rng = np.random.default_rng(20240)
_MULT = _rng.integers(1, 1 << 63, SIGNATURE, dtype=np.uint64) | np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, SIGNATURE, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def normal_words(text: str) -> list[bytes]:
    """Words of a text, A-Z in lower case (bytes methods know ASCII only)."""
    return text.encode("utf-8", "surrogatepass").lower().split()


class Shingler:
    """Hashes the shingles of documents; remembers the hashes of words."""

    def __init__(self, length: int = SHINGLE):
        self.length = length
        self._words: dict[bytes, int] = {}

    def hashes(self, words: list[bytes]) -> np.ndarray:
        """One 64-bit hash for each run of ``length`` words (one for a shorter text, none for an empty one)."""
        if not words:
            return np.zeros(0, dtype=np.uint64)
        known = self._words
        if len(known) > CACHE_WORDS:
            known.clear()
        try:
            codes = [known[w] for w in words]
        except KeyError:
            for w in set(words):
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w)
            codes = [known[w] for w in words]
        w = np.array(codes, dtype=np.uint64)
        n = min(self.length, len(w))
        runs = len(w) - n + 1
        out = np.full(runs, n, dtype=np.uint64)
        for k in range(n):
            out = _mix(out * _STEP + w[k:k + runs])
        return out

    def set_of(self, words: list[bytes]) -> np.ndarray:
        return np.unique(self.hashes(words))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash signatures (rows of uint32) of non-empty sets."""
    out = np.empty((len(sets), SIGNATURE), dtype=np.uint32)
    lengths = np.array([len(s) for s in sets])
    begin = 0
    while begin < len(sets):
        end = begin + max(1, int(np.searchsorted(np.cumsum(lengths[begin:]), BLOCK, side="right")))
        flat = np.concatenate(sets[begin:end])
        starts = np.concatenate(([0], np.cumsum(lengths[begin:end])[:-1]))
        for i in range(SIGNATURE):
            out[begin:end, i] = np.minimum.reduceat(flat * _MULT[i] + _ADD[i], starts) >> np.uint64(32)
        begin = end
    return out


def needed_matches(threshold: float, miss: float) -> np.ndarray:
    """Matches needed after each batch of COMPARE hashes to stay a candidate.

    With a uniform prior, P(similarity >= t | m of n match) = P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(COMPARE, SIGNATURE + 1, COMPARE):
        below, m = 0.0, 0
        while m <= n:
            below += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if below > miss:
                break
            m += 1
        out.append(m)
    return np.array(out)


def may_reach(a: np.ndarray, b: np.ndarray, needed: np.ndarray) -> np.ndarray:
    """Which rows of signatures stay candidates through all batches."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), dtype=np.int64)
    for step, least in enumerate(needed):
        cols = slice(step * COMPARE, (step + 1) * COMPARE)
        matches[alive] += (a[alive, cols] == b[alive, cols]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    out = np.zeros(len(a), dtype=bool)
    out[alive] = True
    return out


def _prints(docs: DataFrame) -> DataFrame:
    """(id, n_shingles, digest of the set, signature) of every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for pdf in batches:
            sets = [shingler.set_of(normal_words(t)) for t in pdf["text"]]
            full = [i for i, s in enumerate(sets) if len(s)]
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            signs: list = [None] * len(sets)
            if full:
                for i, row in zip(full, signatures([sets[i] for i in full])):
                    signs[i] = row.tobytes()
            yield pd.DataFrame({"id": pdf["id"], "n_shingles": [len(s) for s in sets], "digest": digests,
                                "sign": signs})

    return docs.mapInPandas(tidied(run), "id long, n_shingles long, digest binary, sign binary")


def _band_rows(nodes: DataFrame) -> DataFrame:
    """(bucket, band, node): a row for each band of each node."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            sign = np.frombuffer(b"".join(pdf["sign"]), dtype=np.uint32).reshape(len(pdf), BANDS, BAND_VALUES)
            band = np.tile(np.arange(BANDS), (len(pdf), 1))
            key = band.astype(np.uint64)
            for k in range(BAND_VALUES):
                key = _mix(key * _STEP + sign[:, :, k].astype(np.uint64))
            yield pd.DataFrame({"bucket": key.astype(np.int64).ravel(), "band": band.ravel(),
                                "node": np.repeat(pdf["node"].to_numpy(), BANDS)})

    return nodes.select("node", "sign").mapInPandas(tidied(run), "bucket long, band int, node long")


def _surviving(pairs: DataFrame, nodes: DataFrame, threshold: float, miss: float) -> DataFrame:
    """The pairs (u, v) whose signatures don't rule them out; lengths that do are dropped before."""
    needed = needed_matches(threshold, miss)
    left = nodes.select(F.col("node").alias("u"), F.col("sign").alias("sign_u"), F.col("n_shingles").alias("n_u"))
    right = nodes.select(F.col("node").alias("v"), F.col("sign").alias("sign_v"), F.col("n_shingles").alias("n_v"))
    joined = pairs.join(left, "u").join(right, "v").filter(
        F.least("n_u", "n_v") * THRESHOLD[1] >= F.greatest("n_u", "n_v") * THRESHOLD[0])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            a, b = (np.frombuffer(b"".join(pdf[c]), dtype=np.uint32).reshape(len(pdf), SIGNATURE)
                    for c in ("sign_u", "sign_v"))
            yield pdf.loc[may_reach(a, b, needed), ["u", "v"]]

    return joined.select("u", "v", "sign_u", "sign_v").mapInPandas(tidied(run), "u long, v long")


def _packed(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, packed) of the wanted nodes: their words, compressed."""
    wanted = written(wanted.join(nodes.select("node", "id", "digest"), "node"), "wanted", nodes.count())
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for pdf in batches:
            words = [normal_words(t) for t in pdf["text"]]
            same = [hashlib.blake2b(shingler.set_of(w).tobytes(), digest_size=16).digest() == bytes(d)
                    for w, d in zip(words, pdf["digest"])]  # rows of one doc_id may differ
            yield pd.DataFrame({"node": pdf["node"], "packed": [zlib.compress(b" ".join(w), 1) for w in words]})[same]

    return written(docs.join(side, "id").select("node", "text", "digest")
                   .mapInPandas(tidied(pack), "node long, packed binary").dropDuplicates(["node"]), "packed")


def _unpacked(shingler: Shingler, packed: bytes) -> np.ndarray:
    return shingler.set_of(zlib.decompress(packed).split())


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two full sets reach the threshold."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * THRESHOLD[1] >= (len(a) + len(b) - both) * THRESHOLD[0]


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (u, v) whose full sets reach the threshold."""
    wanted = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    packed = _packed(wanted, nodes, docs)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for pdf in batches:
            keep, last, held = [], None, np.zeros(0, dtype=np.uint64)
            for v, pu, pv in zip(pdf["v"], pdf["pu"], pdf["pv"]):
                if v != last:
                    last, held = v, _unpacked(shingler, pv)
                keep.append(_linked(_unpacked(shingler, pu), held))
            yield pdf.loc[np.array(keep, dtype=bool), ["u", "v"]]

    joined = (pairs.join(packed.select(F.col("node").alias("u"), F.col("packed").alias("pu")), "u")
              .join(packed.select(F.col("node").alias("v"), F.col("packed").alias("pv")), "v"))
    return joined.select("u", "v", "pu", "pv").mapInPandas(tidied(compare), "u long, v long")


def _block_links(needed: np.ndarray):
    """Links between the two sides of a block, of nodes in different components."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"u": [], "v": []}).astype("int64")
        left, right = pdf[pdf["side"] == 0].reset_index(drop=True), pdf[pdf["side"] == 1].reset_index(drop=True)
        if not len(left) or not len(right):
            return none
        signs, others = (np.frombuffer(b"".join(x["sign"]), dtype=np.uint32).reshape(len(x), SIGNATURE)
                         for x in (left, right))
        band, shingler = int(pdf["band"].iloc[0]), Shingler()
        node, part, size = (left[c].to_numpy() for c in ("node", "part", "n_shingles"))
        sets: dict[int, np.ndarray] = {}

        def set_of(row: int, frame: pd.DataFrame) -> np.ndarray:
            key = int(frame["node"].iloc[row])
            if key not in sets:
                sets[key] = _unpacked(shingler, frame["packed"].iloc[row])
            return sets[key]

        out = []
        for r in range(len(right)):
            n = int(right["n_shingles"].iloc[r])
            fits = np.minimum(size, n) * THRESHOLD[1] >= np.maximum(size, n) * THRESHOLD[0]
            # of two nodes outside the largest component both stand on either side: once is enough
            twice = left["rest"].to_numpy(dtype=bool) & (node > int(right["node"].iloc[r]))
            at = np.flatnonzero(fits & ~twice & (part != int(right["part"].iloc[r])))
            if len(at):
                agree = (signs[at] == others[r]).reshape(len(at), BANDS, BAND_VALUES).all(axis=2)
                at = at[agree.argmax(axis=1) == band]  # this bucket is the first that the two share
            if len(at):
                at = at[may_reach(signs[at], np.broadcast_to(others[r], (len(at), SIGNATURE)), needed)]
            out += [(int(node[a]), int(right["node"].iloc[r])) for a in at if _linked(set_of(a, left), set_of(r, right))]
        return pd.DataFrame(out, columns=["u", "v"]).astype("int64") if out else none

    return run


def _remaining(members: DataFrame, parts: DataFrame, nodes: DataFrame, docs: DataFrame, miss: float,
               n_members: int) -> DataFrame:
    """Links between members of one bucket that are in different components."""
    threshold = THRESHOLD[0] / THRESHOLD[1]
    labelled = members.join(parts, "node", "left").withColumn("part", F.coalesce("component", "node"))
    labelled = written(labelled.select("bucket", "band", "node", "part"), "labelled", n_members)
    counts = labelled.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("n"))
    torn = counts.groupBy("bucket").agg(F.sum("n").alias("n"), F.max(F.struct("n", "part")).alias("most"))
    torn = written(torn.filter("n > most.n").select("bucket", "n", F.col("most.n").alias("n_most"),
                                                    F.col("most.part").alias("part_most")), "torn", n_members)
    open_ = written(labelled.join(torn, "bucket"), "open", n_members)

    few = open_.filter(F.col("n") <= SMALL)
    mine = few.select("bucket", F.col("node").alias("u"), F.col("part").alias("part_u"))
    theirs = few.select("bucket", F.col("node").alias("v"), F.col("part").alias("part_v"))
    pairs = mine.join(theirs, "bucket").filter("u < v and part_u <> part_v").select("u", "v").distinct()
    found = _verified(written(_surviving(pairs, nodes, threshold, miss), "survivors"), nodes, docs)

    many = open_.filter(F.col("n") > SMALL)
    if many.isEmpty():
        return found
    rest = F.col("part") != F.col("part_most")
    blocks, rest_blocks = (F.ceil(x / F.lit(BLOCK_NODES)).cast("int") for x in (F.col("n"), F.col("n") - F.col("n_most")))
    many = many.select("bucket", "band", "node", "part", rest.alias("rest"), blocks.alias("blocks"),
                       rest_blocks.alias("rest_blocks"))
    dealt = F.xxhash64("node")
    left = many.select("*", F.pmod(dealt, F.col("blocks")).cast("int").alias("i"),
                       F.explode(F.sequence(F.lit(0), F.col("rest_blocks") - 1)).alias("j"), F.lit(0).alias("side"))
    right = many.filter("rest").select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"),
                                       F.pmod(dealt, F.col("rest_blocks")).cast("int").alias("j"), F.lit(1).alias("side"))
    packed = _packed(many.select("node").distinct(), nodes, docs)
    held = written(nodes.select("node", "n_shingles", "sign").join(packed, "node"), "held")
    rows = left.unionByName(right).drop("blocks", "rest_blocks").join(held, "node")
    linked = (rows.groupBy("bucket", "i", "j").applyInPandas(_block_links(needed_matches(threshold, miss)), "u long, v long"))
    return found.unionByName(linked)


def near_duplicates(docs: DataFrame, miss: float = MISS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    prepare(docs.sparkSession)
    bound_batches(docs.sparkSession)
    threshold = THRESHOLD[0] / THRESHOLD[1]
    texts = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(_MAX_ID)).alias("id"), text_of(docs).alias("text"))
    prints = written(_prints(texts), "prints")
    nodes = (prints.filter("digest is not null").groupBy("digest", "n_shingles", "sign").agg(F.min("id").alias("id"))
             .withColumn("node", F.monotonically_increasing_id()))
    nodes = written(nodes.select("node", "id", "digest", "n_shingles", "sign"), "nodes")
    n_nodes = nodes.count()
    n_members = n_nodes * BANDS

    # only buckets of more than one node matter
    bands = _band_rows(nodes)
    shared = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("company")).filter("company > 1")
    members = written(bands.join(written(shared, "buckets", n_members), "bucket"), "members", n_members)
    weights = written(members.groupBy("node").agg(F.sum("company").alias("weight")), "weights", n_nodes)
    centres = written(members.select("bucket", "node").join(weights, "node").groupBy("bucket")
                      .agg(F.max(F.struct("weight", "node")).getField("node").alias("centre")), "centres", n_members)
    pairs = (members.select("bucket", "node").join(centres, "bucket").filter("node <> centre")
             .select(F.col("node").alias("u"), F.col("centre").alias("v")).distinct())
    survivors = written(_surviving(pairs, nodes, threshold, miss), "survivors")
    links = written(_verified(survivors, nodes, texts), "links")
    parts = written(connected_components(links), "parts", n_nodes)
    more = written(_remaining(members, parts, nodes, texts, miss, n_members), "more")
    if not more.isEmpty():
        parts = written(connected_components(links.unionByName(more)), "parts", n_nodes)

    labelled = nodes.select("node", "id", "digest").join(parts, "node", "left").withColumn(
        "part", F.coalesce("component", "node"))
    smallest = written(labelled.groupBy("part").agg(F.min("id").alias("component_id")), "smallest", n_nodes)
    classes = written(labelled.join(smallest, "part").select("digest", "component_id"), "classes", n_nodes)
    out = prints.select("id", "n_shingles", "digest").join(classes, "digest", "left")
    component = F.coalesce("component_id", "id")
    shown = F.nullif(F.col("id"), F.lit(_MAX_ID))
    return out.select(shown.alias("doc_id"), "n_shingles", F.nullif(component, F.lit(_MAX_ID)).alias("component_id"),
                      (F.col("id") == component).alias("kept"))
