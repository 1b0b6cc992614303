"""Vector code compression: product codes trained by dual-tree Lloyd rounds.

Each component x becomes the integer ``floor(256 * x)``, each vector is cut into
``PARTS`` equal parts, and every part position has a codebook of up to ``ENTRIES``
entries, at first the parts of the smallest vec_ids. A round gives each part to
its nearest entry (squared Euclidean distance, ties to the lower index) and
replaces an entry by the componentwise ``floor(sum / count)`` of its parts; unused
entries stay. After the rounds the parts are assigned once more.

A block of vectors carries, for each part position, a tree over its parts: parts in
tree order, each node a run of them with its bounding box, sum and count. The trees
are built once and written; every round reads them. An assignment also builds a tree
over the codebook's entries and walks both from the roots, level by level:

* a pair of nodes is dropped if no point of the part node can be as near to the entry
  node as every point is to another entry node (bounds between the two boxes);
* at single entries, one is dropped if another is nearer to every point of the box
  (the difference of two squared distances is linear, so a corner decides);
* a part node with one entry left is assigned whole: its cached sum and count go to the entry;
* leaves that are still uncertain compare their integers with the entries left.

All arithmetic is on integers, so the result is that of comparing every part with
every entry. A task adds up its blocks and sends one row per entry component;
codebooks (``ENTRIES`` times the vector's length) are all that reaches the driver.

Defined results: vectors that are null or hold a null or non-finite component are
dropped; shorter vectors, and lengths that don't divide by ``PARTS``, are filled up with zeros
to the longest length, rounded up; equal vec_ids are ordered by their vectors for the first
codebook, a null vec_id comes last; components are limited to the integers with which a
vector's error always fits a long (at 64 components, 1.9e8 or x = 741,455); repeated rows are
rows of their own; ``label_error`` is null where a sum doesn't fit a long; an empty table gives
an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.llm._common import prepare, written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Parts in a leaf of their tree, about.
LEAF = 16
#: Components of a block's vectors, about.
BLOCK_COMPONENTS = 1 << 18


class Tree:
    """A balanced tree over the rows of ``points``, which lie in tree order.

    Node ``i`` of level ``l`` holds rows ``i * n >> l`` to ``(i + 1) * n >> l``; its box and
    sum are those of its rows.
    """

    def __init__(self, points: np.ndarray, depth: int):
        self.points, self.depth, n = points, depth, len(points)
        self.starts = [np.arange((1 << level) + 1) * n >> level for level in range(depth + 1)]
        at = self.starts[depth][:-1]
        lo, hi, sums = (f.reduceat(points, at, axis=0) for f in (np.minimum, np.maximum, np.add))
        self.lo, self.hi, self.sums = [lo], [hi], [sums]
        for _ in range(depth):
            lo, hi = np.minimum(lo[::2], lo[1::2]), np.maximum(hi[::2], hi[1::2])
            sums = sums[::2] + sums[1::2]
            self.lo.insert(0, lo)
            self.hi.insert(0, hi)
            self.sums.insert(0, sums)


def depth_for(n: int, leaf: int) -> int:
    """Levels below the root, so that leaves hold about ``leaf`` rows and none is empty."""
    return max(0, (max(1, n) // leaf).bit_length() - 1)


def tree_order(points: np.ndarray, depth: int) -> np.ndarray:
    """The rows' order in a tree: each node is halved across its widest component."""
    n = len(points)
    order = np.arange(n)
    for level in range(depth):
        starts = np.arange((1 << level) + 1) * n >> level
        now = points[order]
        spread = np.maximum.reduceat(now, starts[:-1], axis=0) - np.minimum.reduceat(now, starts[:-1], axis=0)
        node = np.repeat(np.arange(1 << level), np.diff(starts))
        value = now[np.arange(n), spread.argmax(axis=1)[node]]
        order = order[np.lexsort((value, node))]
    return order


class Codebook:
    """The entries of one part position and the tree over them."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        depth = depth_for(len(entries), 1)
        self.order = tree_order(entries, depth)
        self.tree = Tree(entries[self.order], depth)


def _first_of(rows: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(rows, prepend=-1))


def _near_boxes(lo, hi, book: Tree, level: int, maybe: np.ndarray) -> np.ndarray:
    """Which entry nodes stay candidates of each part node (boxes ``lo`` to ``hi``)."""
    rows, cols = np.nonzero(maybe)
    elo, ehi = book.lo[level][cols], book.hi[level][cols]
    plo, phi = lo[rows], hi[rows]
    gap = np.maximum(np.maximum(elo - phi, plo - ehi), 0)
    reach = np.maximum(phi - elo, ehi - plo)
    least, most = (gap * gap).sum(axis=1), (reach * reach).sum(axis=1)
    bound = np.minimum.reduceat(most, _first_of(rows))
    out = np.zeros_like(maybe)
    keep = least <= bound[rows]
    out[rows[keep], cols[keep]] = True
    return out


def _near_entries(lo, hi, entries: np.ndarray, maybe: np.ndarray) -> np.ndarray:
    """Which entries may be a point's nearest one: not those that the one nearest to the box's centre beats everywhere."""
    rows, cols = np.nonzero(maybe)
    centre = (lo + hi) >> 1
    away = ((entries[cols] - centre[rows]) ** 2).sum(axis=1)
    first = _first_of(rows)
    nearest = np.minimum.reduceat(away, first)
    best = np.minimum.reduceat(np.where(away == nearest[rows], cols, len(entries)), first)
    rival = best[rows]
    step = entries[cols] - entries[rival]
    corner = np.where(step > 0, hi[rows], lo[rows])
    # |x - rival|^2 - |x - entry|^2 at the corner that favours the entry most
    gain = (step * (2 * corner - entries[cols] - entries[rival])).sum(axis=1)
    keep = (gain > 0) | ((gain == 0) & (cols <= rival))
    out = np.zeros_like(maybe)
    out[rows[keep], cols[keep]] = True
    return out


def assign(tree: Tree, book: Codebook) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Entries of the parts (in tree order), their sums and counts by entry, and the distances that were computed."""
    entries, k = book.entries, len(book.entries)
    codes = np.zeros(len(tree.points), dtype=np.int64)
    sums, counts, compared = np.zeros_like(entries), np.zeros(k, dtype=np.int64), 0
    nodes, level, book_level, at_entries = np.zeros(1, dtype=np.int64), 0, 0, False
    maybe = np.ones((1, 1), dtype=bool)
    while len(nodes):
        lo, hi, starts = tree.lo[level][nodes], tree.hi[level][nodes], tree.starts[level]
        if not at_entries and book_level == book.tree.depth:
            # from the leaves of the entries' tree to the entries, in index order
            leaf = np.empty(k, dtype=np.int64)
            leaf[book.order] = np.repeat(np.arange(1 << book_level), np.diff(book.tree.starts[book_level]))
            maybe, at_entries = maybe[:, leaf], True
        if at_entries:
            maybe = _near_entries(lo, hi, entries, maybe)
            whole = maybe.sum(axis=1) == 1
            if whole.any():
                entry, done = maybe[whole].argmax(axis=1), nodes[whole]
                sizes = starts[done + 1] - starts[done]
                np.add.at(sums, entry, tree.sums[level][done])
                np.add.at(counts, entry, sizes)
                within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                codes[np.repeat(starts[done], sizes) + within] = np.repeat(entry, sizes)
                nodes, maybe = nodes[~whole], maybe[~whole]
        else:
            maybe = _near_boxes(lo, hi, book.tree, book_level, maybe)
        if level == tree.depth and at_entries:
            break
        if level < tree.depth:
            nodes = (2 * nodes[:, None] + np.arange(2)).ravel()
            maybe, level = np.repeat(maybe, 2, axis=0), level + 1
        if not at_entries and book_level < book.tree.depth:
            maybe, book_level = np.repeat(maybe, 2, axis=1), book_level + 1
    if len(nodes):
        # uncertain leaves: their points against the entries left
        starts = tree.starts[level]
        begin, end = starts[nodes], starts[nodes + 1]
        size = int((end - begin).max())
        at = np.minimum(begin[:, None] + np.arange(size), end[:, None] - 1)  # a short leaf repeats its last point
        rows, cols = np.nonzero(maybe)
        away = tree.points[at[rows]] - entries[cols][:, None, :]
        away = (away * away).sum(axis=2)
        first = _first_of(rows)
        nearest = np.minimum.reduceat(away, first, axis=0)
        entry = np.minimum.reduceat(np.where(away == nearest[rows], cols[:, None], k), first, axis=0)
        codes[at] = entry
        points = np.unique(at)
        np.add.at(sums, codes[points], tree.points[points])
        counts += np.bincount(codes[points], minlength=k)
        compared = away.size
    return codes, sums, counts, compared


def limit_for(width: int) -> int:
    """The largest integer component with which the error of ``width`` components fits a long."""
    return math.isqrt((2 ** 63 - 1) // width) // 2 - 1


def to_integers(values: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``width`` integers from vectors laid end to end."""
    limit = limit_for(width)
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(values * SCALE), -limit, limit).astype(np.int64)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = whole
    return out


def _narrow(a: np.ndarray) -> bytes:
    """Integers in the narrowest signed type that holds them, after one byte with its width."""
    for kind in ("<i1", "<i2", "<i4"):
        if not a.size or (a.min() >= np.iinfo(kind).min and a.max() <= np.iinfo(kind).max):
            break
    else:
        kind = "<i8"
    return kind[-1].encode() + a.astype(kind).tobytes()


def _wide(block: bytes) -> np.ndarray:
    return np.frombuffer(block, dtype=f"<i{block[:1].decode()}", offset=1).astype(np.int64)


def _blocks(kept: DataFrame, width: int, block_rows: int) -> DataFrame:
    """(vec_ids, labels, orders, points): blocks of vectors with the trees over their parts."""
    d = width // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                part = batch.slice(at, block_rows)
                n, vectors = part.num_rows, part.column("vector")
                ints = to_integers(vectors.flatten().to_numpy(), np.diff(vectors.offsets.to_numpy()), width)
                depth = depth_for(n, LEAF)
                cut = [ints[:, p * d:(p + 1) * d] for p in range(PARTS)]
                orders = [tree_order(c, depth) for c in cut]
                one = pa.array([0, n], type=pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(one, part.column(c)) for c in ("vec_id", "label")]
                    + [pa.array([_narrow(np.concatenate(x))], type=pa.binary())
                       for x in (orders, [c[o] for c, o in zip(cut, orders)])],
                    names=["vec_ids", "labels", "orders", "points"])

    return kept.mapInArrow(run, "vec_ids array<bigint>, labels array<string>, orders binary, points binary")


def _trees(points: bytes, n: int) -> list[Tree]:
    cut = _wide(points).reshape(PARTS, n, -1)
    return [Tree(c, depth_for(n, LEAF)) for c in cut]


def _sums(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(slot, value): sums and counts of the parts of each entry; a task sends each slot once."""
    parts, k, d = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Codebook(b) for b in books]
        total = np.zeros((parts, k, d + 1), dtype=np.int64)
        for batch in batches:
            for points, ids in zip(batch.column("points"), batch.column("vec_ids")):
                for p, tree in enumerate(_trees(points.as_py(), len(ids.values))):
                    _, sums, counts, _ = assign(tree, held[p])
                    total[p, :, :d] += sums
                    total[p, :, d] += counts
        flat = total.ravel()
        slots = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(flat[slots])], names=["slot", "value"])

    return blocks.mapInArrow(run, "slot long, value long").groupBy("slot").agg(F.sum("value").alias("value"))


def _codes(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Codebook(b) for b in books]
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels = batch.column("vec_ids")[i].values, batch.column("labels")[i].values
                n = len(ids)
                orders = _wide(batch.column("orders")[i].as_py()).reshape(PARTS, n)
                codes, error = np.zeros((n, PARTS), dtype=np.uint8), np.zeros(n, dtype=np.int64)
                for p, tree in enumerate(_trees(batch.column("points")[i].as_py(), n)):
                    found = assign(tree, held[p])[0]
                    codes[orders[p], p] = found
                    error[orders[p]] += ((tree.points - books[p][found]) ** 2).sum(axis=1)
                text = codes.tobytes().hex()
                cut = [text[j:j + 2 * PARTS] for j in range(0, len(text), 2 * PARTS)]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(cut, type=pa.string()), pa.array(error)],
                                                 names=["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(run, "vec_id long, label string, code string, error long")


def codebooks_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and position, in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def finite_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, label, vector) of the vectors without null or non-finite components."""
    vector = table["embedding"].cast("array<double>")
    kept = table.select(table["vec_id"].cast("long").alias("vec_id"), table["label"].cast("string").alias("label"),
                        vector.alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return kept.filter(F.col("vector").isNotNull() & ~odd)


def train(kept: DataFrame, blocks: DataFrame, width: int) -> np.ndarray:
    """Codebooks (part, entry, component) after all rounds."""
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(ENTRIES).select("vector").collect()
    flat = np.array([x for r in first for x in r["vector"]], dtype=np.float64)
    ints = to_integers(flat, np.array([len(r["vector"]) for r in first]), width)
    books = np.ascontiguousarray(ints.reshape(len(ints), PARTS, -1).transpose(1, 0, 2))
    parts, k, d = books.shape
    for _ in range(ROUNDS):
        total = np.zeros(parts * k * (d + 1), dtype=np.int64)
        for row in _sums(blocks, books).collect():
            total[row["slot"]] = row["value"]
        total = total.reshape(parts, k, d + 1)
        counts = total[:, :, d:]
        books = np.where(counts > 0, total[:, :, :d] // np.maximum(counts, 1), books)
    return books


def compress(table: DataFrame, block_components: int = BLOCK_COMPONENTS) -> DataFrame:
    """One row per kept vector of ``table`` (vec_id, embedding, label): vec_id, code, error, label_error, codebooks_sha256."""
    prepare(table.sparkSession)
    kept = finite_vectors(table)
    longest = kept.agg(F.max(F.size("vector"))).first()[0]
    if longest is None:
        return kept.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    width = max(1, -(-longest // PARTS)) * PARTS
    blocks = written(_blocks(kept, width, max(1, block_components // width)), "blocks")
    books = train(kept, blocks, width)
    coded = written(_codes(blocks, books), "codes")
    by_label = written(coded.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error")), "label_errors")
    return (coded.join(by_label, F.col("label").eqNullSafe(F.col("of")), "left")
            .select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")))
