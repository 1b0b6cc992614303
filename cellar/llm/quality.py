"""Quality classifier: interpolated modified Kneser-Ney n-gram model of trusted text.

The model counts character 4-grams (a character is a UTF-16 code unit, so an
n-gram is one 64-bit integer; a model of words has not been measured). All
trusted texts are counted, except one fold that sets the thresholds. Every table of the
model - counts, continuation counts, discounted probabilities, back-off weights -
is a DataFrame keyed by n-gram or context, whatever its size.

Scoring joins counts with the model, shard by shard. Tasks send each shard, for a
chunk of documents, the chunk's distinct n-grams and each document's counts of
them, compressed; the shard's part of the model meets them in sorted order and gives
each document a partial log probability; the partial sums of a document are added.
Shards are sized by the model, and each is split by salts sized by the text, with
the shard's model copied to each salt. A task holds ``SHARD_GRAMS`` n-grams and the
counts of one chunk of ``CHUNK`` characters at a time, whatever it is dealt.

A document is kept if its perplexity is at most its language's threshold: the
``QUANTILE`` of held-out trusted documents of that language. Log perplexities of short
texts scatter more, so distances from the language's median are taken in units of
``sqrt(1 + NOISE / symbols)``: a few short texts don't lift the threshold of long ones.
Where too few texts fix the tail, the quantile's distance from the median is shrunk
to that of all languages, and this to the one of a normal distribution as wide as
their median distance (each counts as ``PRIOR`` texts). A language with fewer
than ``LEAST_HELD`` held-out texts uses the median and quantile of all together.

Defined results: an empty or null text has no perplexity and no threshold and is rejected; a null
language is a language of its own; rows with one doc_id and text have the same
result; without trusted text (an empty table, no labels) there is no perplexity
and every text that isn't empty is kept. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellar.llm._common import bound_batches, groups_for, prepare, text_of, tidied, written

ORDER = 4
#: Code units that stand for the begin and end of a text.
BEGIN, END = b"\x02\x00", b"\x03\x00"
UNIT = 16
#: Code units worked on at a time: of a chunk's requests (each n-gram is sent once a chunk), of counting.
CHUNK, COUNT_CHUNK = 1_000_000, 250_000
#: n-grams that a worker adds up before it passes them on.
HELD_GRAMS = 1_000_000
SHARD_GRAMS = 1_000_000
#: Characters whose counts one group of requests holds: the copies of the model stay a small part of the text.
SALT_CHARS = 16_000_000
#: One fold of trusted documents in so many sets the thresholds instead of training.
FOLDS = 5
QUANTILE = 0.99
#: Symbols at which a text's log perplexity scatters sqrt(2) times as far as a very long one's.
NOISE = 1000
#: Held-out texts of which one lies beyond the quantile: the weight of what quantiles are shrunk to.
PRIOR = 100
#: The median of so many held-out texts withstands an odd one.
LEAST_HELD = 3
#: Ids that are looked up by broadcast at most (8 bytes each); more are joined by shuffle.
BROADCAST_IDS = 4_000_000


def _pieces(texts: list[str], chunk: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks of texts as (n-grams, the text that each belongs to); a long text is cut into several."""
    grams, owners, held = [], [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        units = np.frombuffer(BEGIN * (ORDER - 1) + text.encode("utf-16-le", "surrogatepass") + END, dtype="<u2")
        for at in range(0, len(units) - ORDER + 1, chunk):
            part = units[at:at + chunk + ORDER - 1].astype(np.uint64)
            n = len(part) - ORDER + 1
            key = np.zeros(n, dtype=np.uint64)
            for k in range(ORDER):
                key = (key << np.uint64(UNIT)) | part[k:k + n]
            grams.append(key)
            owners.append((i, n))
            held += n
            if held >= chunk:
                out, grams, owners, held = _joined(grams, owners), [], [], 0
                yield out
                del out
    if held:
        yield _joined(grams, owners)


def _joined(grams: list[np.ndarray], owners: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(grams), np.repeat(np.array([o for o, _ in owners], dtype=np.int32), [n for _, n in owners])


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(inverse, weights=np.concatenate([c for _, c in parts])).astype(np.int64)


def gram_counts(texts: DataFrame) -> DataFrame:
    """(gram, n) of all texts; each task adds up its own n-grams first."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for pdf in batches:
            for grams, _ in _pieces(pdf["text"].tolist(), COUNT_CHUNK):
                held.append(np.unique(grams, return_counts=True))
                if len(held) == 8:
                    held = [_merged(held)]
                if len(held[0][0]) > HELD_GRAMS:
                    yield pd.DataFrame({"gram": held[0][0].astype(np.int64), "n": held[0][1]})
                    held = held[1:]
        if held:
            keys, n = _merged(held)
            yield pd.DataFrame({"gram": keys.astype(np.int64), "n": n})

    return texts.select("text").mapInPandas(tidied(run), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _low(gram: str, units: int) -> Column:
    return F.col(gram).bitwiseAND(F.lit((1 << (UNIT * units)) - 1))


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of n-grams seen once, twice and more often."""
    seen = dict(counts.filter("n <= 4").groupBy("n").count().collect())
    n1, n2, n3, n4 = (seen.get(i, 0) for i in (1, 2, 3, 4))
    if not (n1 and n2 and n3):
        return 0.5, 0.75, 0.9  # too few n-grams to estimate from
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.1), i + 0.9) for i, d in enumerate(raw))


class KneserNey:
    """The model's tables: for each order, probabilities by n-gram and back-off weights by context."""

    def __init__(self, texts: DataFrame):
        counts = written(gram_counts(texts), "grams")
        self.levels: dict[int, tuple[DataFrame, DataFrame]] = {}
        for order in range(ORDER, 0, -1):
            d1, d2, d3 = discounts(counts)
            off = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
            table = counts.withColumn("context", F.shiftrightunsigned("gram", UNIT)).withColumn("off", off)
            contexts = written(table.groupBy("context").agg(F.sum("n").alias("total"), F.sum("off").alias("off_all"))
                               .select("context", "total", (F.col("off_all") / F.col("total")).alias("backoff")),
                               "contexts")
            own = (table.join(contexts.select("context", "total"), "context")
                   .select("gram", ((F.col("n") - F.col("off")) / F.col("total")).alias("own")))
            self.levels[order] = (written(own, "own"), contexts.select("context", "backoff"))
            # of the next lower order counts how many different n-grams end in it
            counts = written(counts.groupBy(_low("gram", order - 1).alias("gram")).agg(F.count(F.lit(1)).alias("n")),
                             "continued") if order > 1 else counts
        self.symbols = counts.count() + 1  # one for all that are unseen

    def log_probabilities(self, grams: DataFrame) -> DataFrame:
        """(gram, logp) of distinct n-grams: order by order, each joined with the next lower one."""
        below = None
        for order in range(1, ORDER + 1):
            wanted = (grams if order == ORDER else grams.select(_low("gram", order).alias("gram")).distinct())
            own, contexts = self.levels[order]
            rows = (wanted.join(own, "gram", "left")
                    .withColumn("context", F.shiftrightunsigned("gram", UNIT)).join(contexts, "context", "left"))
            if below is None:
                lower = F.lit(1.0 / self.symbols)
            else:
                rows = rows.withColumn("tail", _low("gram", order - 1)).join(
                    below.select(F.col("gram").alias("tail"), F.col("p").alias("lower")), "tail")
                lower = F.col("lower")
            p = F.coalesce("own", F.lit(0.0)) + F.coalesce("backoff", F.lit(1.0)) * lower
            below = written(rows.select("gram", p.alias("p")), "probabilities")
        return below.select("gram", F.ln("p").alias("logp"))


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % shards


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of integers, each in the narrowest type that holds it, in one compressed block."""
    out = bytearray()
    for a in arrays:
        a = a.astype(np.min_scalar_type(int(a.max())) if len(a) else np.uint8)
        out += np.array([a.itemsize, a.nbytes], dtype="<u8").tobytes() + a.tobytes()
    return zlib.compress(bytes(out), 1)


def _unpack(block: bytes) -> list[np.ndarray]:
    raw, out, at = zlib.decompress(block), [], 0
    while at < len(raw):
        width, size = np.frombuffer(raw, dtype="<u8", count=2, offset=at)
        out.append(np.frombuffer(raw, dtype=f"<u{width}", count=int(size // width), offset=at + 16).astype(np.uint64))
        at += 16 + int(size)
    return out


def _counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, n = np.unique(grams, return_counts=True)
    return keys, n.astype(np.int32)


def _lanes(spark: SparkSession) -> np.ndarray:
    """For each shuffle partition a number that Spark's hash partitioning sends there (8 bytes a partition)."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lanes = np.arange(n)
    for r in spark.range(16 * n).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("lane")).agg(F.min("id").alias("id")).collect():
        lanes[r["lane"]] = r["id"]
    return lanes


def _requests(texts: DataFrame, shards: int, salts: int, lanes: np.ndarray) -> DataFrame:
    """(lane, shard, salt, documents, block): what a chunk of documents asks of a shard."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, prints = pdf["id"].to_numpy(dtype=np.int64), pdf["print"].to_numpy(dtype=np.int64)
            for grams, owners in _pieces(pdf["text"].tolist(), CHUNK):
                cuts = np.flatnonzero(np.diff(owners, prepend=-1))
                salt, first_rows = int(prints[owners[0]] % salts), owners[cuts]
                found = [_counted(part) for part in np.split(grams, cuts[1:])]
                del grams, owners
                doc = np.repeat(first_rows, [len(k) for k, _ in found])
                n = np.concatenate([c for _, c in found])
                found = np.concatenate([k for k, _ in found])
                keys, code = np.unique(found, return_inverse=True)
                code = code.astype(np.int32)
                del found
                # keys and rows in the order of their shards; each shard's then lie together, ascending
                where = _shard(keys, shards)
                by_shard = np.argsort(where, kind="stable")
                key_ends = np.cumsum(np.bincount(where, minlength=shards))
                rank = np.empty(len(keys), dtype=np.int32)
                rank[by_shard] = np.arange(len(keys)) - np.repeat(key_ends - np.diff(key_ends, prepend=0),
                                                                  np.diff(key_ends, prepend=0))
                row_shard = where.astype(np.int32)[code]
                rows_by_shard = np.argsort(row_shard, kind="stable").astype(np.int32)
                row_ends = np.cumsum(np.bincount(row_shard, minlength=shards))
                del row_shard
                out = []
                for shard in range(shards):
                    rows = rows_by_shard[row_ends[shard - 1] if shard else 0:row_ends[shard]]
                    if not len(rows):
                        continue
                    mine = by_shard[key_ends[shard - 1] if shard else 0:key_ends[shard]]
                    docs, sizes = np.unique(doc[rows], return_counts=True)
                    codes = rank[code[rows]]  # ascending within a document: stored as steps
                    steps = np.diff(codes, prepend=0)
                    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
                    steps[first] = codes[first]
                    who = np.stack([ids[docs], prints[docs]]).astype("<i8").tobytes()
                    gaps = np.diff(keys[mine], prepend=np.uint64(0))
                    lane = int(lanes[(shard * salts + salt) % len(lanes)])
                    out.append((lane, shard, salt, who, _pack(gaps, sizes, steps, n[rows])))
                yield pd.DataFrame(out, columns=["lane", "shard", "salt", "documents", "block"])

    return texts.select("id", "print", "text").mapInPandas(
        tidied(run), "lane long, shard long, salt long, documents binary, block binary")


def _model_blocks(logp: DataFrame, shards: int) -> DataFrame:
    """(shard, documents, block): the model dealt to its shards, one sorted block each."""
    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(shard=_shard(pdf["gram"].to_numpy(dtype=np.int64).astype(np.uint64), shards))

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = pdf["gram"].to_numpy(dtype=np.int64).astype(np.uint64)
        order = np.argsort(keys)
        values = pdf["logp"].to_numpy()[order]
        return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "documents": [keys[order].astype("<u8").tobytes()],
                             "block": [values.astype("<f8").tobytes()]})

    dealt = logp.mapInPandas(tidied(deal), "gram long, logp double, shard long")
    return dealt.groupBy("shard").applyInPandas(block, "shard long, documents binary, block binary")


def _answer(who: bytes, block: bytes, keys: np.ndarray, logp: np.ndarray) -> list[np.ndarray]:
    """Ids, prints, partial log probabilities and numbers of n-grams of one request's documents."""
    ids, prints = np.frombuffer(who, dtype="<i8").reshape(2, -1)
    gaps, sizes, steps, n = _unpack(block)
    value = logp[np.searchsorted(keys, np.cumsum(gaps, dtype=np.uint64))]
    first = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
    run = np.cumsum(steps.astype(np.int64))
    base = np.repeat(run[first] - steps[first].astype(np.int64), sizes.astype(np.int64))
    terms = value[run - base] * n
    return [ids, prints, np.add.reduceat(terms, first), np.add.reduceat(n, first).astype(np.int64)]


def _answers(asked: DataFrame, model: DataFrame, salts: int, lanes: np.ndarray) -> DataFrame:
    """(id, print, logp, n): every request meets its shard of the model.

    Groups (shard, salt) are dealt to the shuffle partitions in turn. A group's model block
    comes first, its requests follow one by one: a task holds one block and one request at a
    time, however many groups it is dealt.
    """
    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for salt in range(salts):
                yield pdf.assign(salt=salt, lane=lanes[(pdf["shard"].to_numpy() * salts + salt) % len(lanes)])

    copies = model.mapInPandas(tidied(copy), "lane long, shard long, salt long, documents binary, block binary")
    met = (asked.withColumn("kind", F.lit(1)).unionByName(copies.withColumn("kind", F.lit(0)))
           .repartition(len(lanes), "lane").sortWithinPartitions("shard", "salt", "kind"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, logp = np.zeros(0, dtype=np.uint64), np.zeros(0)
        for batch in batches:
            out = []
            for kind, who, block in zip(*(batch.column(c) for c in ("kind", "documents", "block"))):
                if kind.as_py() == 0:
                    keys = np.frombuffer(who.as_py(), dtype="<u8")
                    logp = np.frombuffer(block.as_py(), dtype="<f8")
                else:
                    out.append(_answer(who.as_py(), block.as_py(), keys, logp))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)],
                                                 names=["id", "print", "logp", "n"])

    return met.select("kind", "documents", "block").mapInArrow(tidied(run), "id long, print long, logp double, n long")


def _with_print(texts: DataFrame) -> DataFrame:
    return texts.withColumn("print", F.shiftrightunsigned(F.xxhash64("text"), 1))


def score(texts: DataFrame, model: KneserNey) -> DataFrame:
    """(id, print, n_symbols, perplexity) of texts that aren't empty; print: a hash of the text."""
    texts = texts.filter("text <> ''")
    size = texts.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    wanted = gram_counts(texts).select("gram")
    logp = written(model.log_probabilities(written(wanted, "wanted")), "logp")
    shards = groups_for(logp.count(), SHARD_GRAMS)
    salts = groups_for(size, SALT_CHARS * shards)
    model_blocks = written(_model_blocks(logp, shards), "model_blocks")
    lanes = _lanes(texts.sparkSession)
    answers = _answers(_requests(_with_print(texts), shards, salts, lanes), model_blocks, salts, lanes)
    return (answers.groupBy("id", "print").agg(F.sum("logp").alias("logp"), F.sum("n").alias("n_symbols"))
            .select("id", "print", "n_symbols", F.exp(-F.col("logp") / F.col("n_symbols")).alias("perplexity")))


def _wide() -> Column:
    """How far log perplexities of texts of that length scatter, as a multiple of a very long text's."""
    return F.sqrt(1 + NOISE / F.col("n_symbols"))


def _shrunk(quantile: Column, held: Column, to: Column) -> Column:
    return (held * quantile + PRIOR * to) / (held + PRIOR)


def thresholds(scored: DataFrame) -> tuple[DataFrame, tuple[float | None, float | None]]:
    """(lang, middle, distance) for rows of (lang, n_symbols, perplexity) of held-out trusted documents.

    A text's threshold is ``exp(middle + distance * wide)``. With them the pair (middle,
    distance) of all texts, for other languages.
    """
    def at(x: Column | str, q: float) -> Column:
        return F.percentile_approx(x, q, 10000)

    held = scored.select(F.coalesce("lang", F.lit("")).alias("lang"), F.ln("perplexity").alias("x"), _wide().alias("wide"))
    middle = held.agg(at("x", 0.5)).first()[0]
    distance = held.agg(at((F.col("x") - F.lit(middle)) / F.col("wide"), QUANTILE)).first()[0]
    middles = held.groupBy("lang").agg(at("x", 0.5).alias("middle"), F.count(F.lit(1)).alias("held"))
    middles = written(middles.filter(F.col("held") >= LEAST_HELD), "middles")
    far = written(held.join(middles, "lang").select("lang", "middle", "held",
                                                    ((F.col("x") - F.col("middle")) / F.col("wide")).alias("far")), "far")
    normal = NormalDist()
    width = at(F.abs("far"), 0.5) * (normal.inv_cdf(QUANTILE) / normal.inv_cdf(0.75))
    pooled = far.agg(_shrunk(at("far", QUANTILE), F.count(F.lit(1)), width)).first()[0]
    own = far.groupBy("lang", "middle", "held").agg(at("far", QUANTILE).alias("q"))
    cuts = own.select("lang", "middle", _shrunk(F.col("q"), F.col("held"), F.lit(pooled).cast("double")).alias("distance"))
    return written(cuts, "cuts"), (middle, distance)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, n_symbols, perplexity, threshold, kept.

    ``labels`` (doc_id, quality): documents of quality 1 are trusted.
    """
    prepare(docs.sparkSession)
    bound_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit((1 << 63) - 1)).alias("id"),
                        docs["lang"].cast("string").alias("lang"), text_of(docs).alias("text"))
    trusted = written(labels.filter(labels["quality"] == 1).select(labels["doc_id"].cast("long").alias("id"))
                      .filter("id is not null").distinct(), "trusted")
    fold = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(FOLDS))
    training = trusted.filter(fold != 0)
    side = F.broadcast(training) if training.count() <= BROADCAST_IDS else training
    model = KneserNey(texts.join(side, "id", "left_semi"))
    index = written(_with_print(texts).select("id", "lang", "print", (F.col("text") != "").alias("some")), "index")
    if model.symbols == 1:
        scored = index.withColumn("n_symbols", F.lit(None).cast("long")).withColumn("perplexity", F.lit(None).cast("double"))
    else:
        scores = written(score(texts, model), "scores")
        # scores add up all rows of one id and text
        rows = index.groupBy("id", "print").agg(F.count(F.lit(1)).alias("rows"))
        once = rows.join(scores, ["id", "print"]).select(
            "id", "print", F.expr("n_symbols div rows").alias("n_symbols"), "perplexity")
        scored = written(index.join(once, ["id", "print"], "left"), "scored")
    held = scored.join(trusted.filter(fold == 0), "id", "left_semi").filter("perplexity is not null")
    cuts, (middle, distance) = thresholds(held)
    own = cuts.withColumnRenamed("lang", "of")
    out = scored.join(own, F.coalesce("lang", F.lit("")) == F.col("of"), "left")
    limit = F.exp(F.coalesce("middle", F.lit(middle).cast("double"))
                  + F.coalesce("distance", F.lit(distance).cast("double")) * _wide())
    kept = F.col("some") & F.coalesce(F.col("perplexity") <= limit, F.lit(True))
    return out.select(F.nullif(F.col("id"), F.lit((1 << 63) - 1)).alias("doc_id"), "lang", "n_symbols", "perplexity",
                      limit.alias("threshold"), kept.alias("kept"))
