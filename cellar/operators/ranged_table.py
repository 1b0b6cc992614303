"""A stored wide table split into key ranges, with a manifest of its files.

::

    <table>/data/<write>/...parquet      rows sorted by key; a file holds one range of keys
    <table>/manifest/<version>.json      a head line (schema, keys) and one line a file: least and greatest key, rows

A version is a manifest: a write adds data files and then puts the next manifest in
place by one rename, so readers see the table before or after it, and a write that
fails leaves the table as it was. Files of older versions stay until :meth:`RangedTable.vacuum`.

What the manifest is for:

* a change (:meth:`~RangedTable.upsert`, :meth:`~RangedTable.delete`) reads and rewrites only the ranges its keys fall in;
* a scan by start key or prefix reads only the files that can hold such keys;
* :meth:`~RangedTable.first_n` visits ranges in key order and stops when it has its rows;
* many lookups (:meth:`~RangedTable.get_many`) read only the ranges of the requested keys, and a
  Bloom filter in each row group tells most absent keys without reading it.

Keys are one or more text columns, compared in order: ``(row_key, family, qualifier)`` for a cell
table, so that a hot row key spreads over ranges and a put touches few of its cells. Files that share a key
(a cell with very many versions) count as one range. The manifest, one line a file, is held by the
driver; the rows never are. One writer at a time: a second one that finds its version taken fails.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_right
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.functions.predicates import ROW_KEY
from cellar.operators import mutate
from cellar.operators import widetable as W
from cellar.session import file_system, run_path

#: Rows of a file, about (a range that grows beyond is split when it is rewritten).
FILE_ROWS = 2_000_000
#: Requested keys that are pushed into the scan as a list; more are joined only.
PUSHED_KEYS = 1_000

Key = tuple[str, ...]


@dataclass(frozen=True)
class RangeFile:
    """A data file and the least and greatest key in it."""

    file: str
    least: Key
    greatest: Key
    rows: int


def logical_ranges(files: Iterable[RangeFile]) -> list[list[RangeFile]]:
    """Files in key order; those whose keys overlap are one range."""
    out: list[list[RangeFile]] = []
    top: Key = ()
    for f in sorted(files, key=lambda x: (x.least, x.greatest)):
        if out and f.least <= top:
            out[-1].append(f)
            top = max(top, f.greatest)
        else:
            out.append([f])
            top = f.greatest
    return out


def _between(bounds: list[Key], key: Key, width: int) -> range:
    """The ranges (by their least keys) that may hold ``key``, which may be a prefix of whole keys."""
    first = max(0, bisect_right(bounds, key) - 1)
    if len(key) == width:
        return range(first, first + 1)
    last = first
    while last + 1 < len(bounds) and bounds[last + 1][:len(key)] <= key:
        last += 1
    return range(first, last + 1)


class RangedTable:
    """A table at ``path`` whose rows are ordered by ``keys`` (text columns)."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (ROW_KEY,)):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), tuple(keys)
        self.fs, _ = file_system(spark, self.path)

    # --- the manifest ----------------------------------------------------------------------

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def version(self) -> int:
        """The newest version; 0 if the table doesn't exist."""
        folder = self._path("manifest")
        if not self.fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in self.fs.listStatus(folder)]
        return max((int(n[:-5]) for n in names if n.endswith(".json")), default=0)

    def _manifest(self) -> tuple[dict, list[RangeFile]]:
        version = self.version()
        if not version:
            raise ValueError(f"no table at {self.path}")
        lines = self.spark.read.text(f"{self.path}/manifest/{version:020d}.json").collect()
        entries = [json.loads(r["value"]) for r in lines]
        head = next(e for e in entries if "schema" in e)
        return head, [RangeFile(e["file"], tuple(e["least"]), tuple(e["greatest"]), e["rows"]) for e in entries if "file" in e]

    def ranges(self) -> list[list[RangeFile]]:
        return logical_ranges(self._manifest()[1])

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self._manifest()[0]["schema"])

    def _commit(self, version: int, schema: T.StructType, files: Iterable[RangeFile], **head) -> None:
        lines = [json.dumps({"schema": schema.jsonValue(), "keys": self.keys, **head})]
        lines += [json.dumps({"file": f.file, "least": f.least, "greatest": f.greatest, "rows": f.rows})
                  for f in sorted(files, key=lambda x: (x.least, x.greatest))]
        staged, target = self._path(f"staged/{uuid.uuid4().hex}"), self._path(f"manifest/{version:020d}.json")
        out = self.fs.create(staged)
        out.write(bytearray("\n".join(lines).encode("utf-8")))
        out.close()
        self.fs.mkdirs(self._path("manifest"))
        if self.fs.exists(target) or not self.fs.rename(staged, target):
            raise RuntimeError(f"another writer has made version {version} of {self.path}")

    def _written(self, rows: DataFrame, by: str | None = None) -> list[RangeFile]:
        """Write sorted rows as data files (with Bloom filters on the first key) and list them."""
        name = f"data/{uuid.uuid4().hex}"
        writer = (rows.write.option("maxRecordsPerFile", FILE_ROWS)
                  .option(f"parquet.bloom.filter.enabled#{self.keys[0]}", "true")
                  .option(f"parquet.bloom.filter.expected.ndv#{self.keys[0]}", str(FILE_ROWS // 8)))
        (writer.partitionBy(by) if by else writer).parquet(f"{self.path}/{name}")
        key = F.struct(*self.keys)
        found = (self.spark.read.schema(T.StructType([f for f in rows.schema.fields if f.name in self.keys]))
                 .option("recursiveFileLookup", "true").parquet(f"{self.path}/{name}")
                 .groupBy(F.col("_metadata.file_path").alias("file"))
                 .agg(F.min(key).alias("least"), F.max(key).alias("greatest"), F.count(F.lit(1)).alias("n")))
        return [RangeFile(name + r["file"].split(name)[-1], tuple(r["least"]), tuple(r["greatest"]), r["n"])
                for r in found.collect()]

    def _layout(self, rows: DataFrame, *first: str, n_ranges: int | None = None) -> DataFrame:
        """Rows range-split and sorted by key; written before, as a range split samples its input."""
        path = run_path(self.spark, "ranged")
        checked = _keyed(rows, self.keys)
        checked.write.parquet(path)
        stored = self.spark.read.schema(checked.schema).parquet(path)
        order = [*first, *self.keys]
        ranged = stored.repartitionByRange(n_ranges, *order) if n_ranges else stored.repartitionByRange(*order)
        return ranged.sortWithinPartitions(*order)

    # --- writes ----------------------------------------------------------------------------

    def create(self, rows: DataFrame, n_ranges: int | None = None, **head) -> "RangedTable":
        """K1, K2: the table's next version holds ``rows`` only, in ``n_ranges`` key ranges (or as many as the
        session's shuffle partitions, merged by size)."""
        version = self.version()
        files = self._written(self._layout(rows, n_ranges=n_ranges))
        self._commit(version + 1, rows.schema, files, **head)
        return self

    def _range_ids(self, df: DataFrame, keys: Sequence[str], bounds: list[Key]) -> Column:
        """The numbers of the ranges that may hold a row's key."""
        width = len(self.keys)

        @F.pandas_udf("array<int>")
        def of(found: pd.DataFrame) -> pd.Series:
            return pd.Series([list(_between(bounds, tuple(k), width)) for k in found.itertuples(index=False)], dtype=object)

        return of(F.struct(*[df[k] for k in keys]))

    def touched(self, keys: DataFrame) -> list[int]:
        """The ranges that the keys in ``keys`` (all key columns, or the first ones) fall in."""
        named = [k for k in self.keys if k in keys.columns]
        bounds = [g[0].least for g in self.ranges()]
        ids = _keyed(keys.select(*named), named).distinct()
        found = ids.select(F.explode(self._range_ids(ids, named, bounds)).alias("range")).distinct().collect()
        return sorted(r["range"] for r in found)

    def rewrite(self, keys: DataFrame, change: Callable[[DataFrame], DataFrame]) -> int:
        """Apply ``change`` to the ranges that ``keys`` fall in; the number of files that were replaced.

        ``change`` gets the ranges' rows and returns what they become; keys of new rows must be among ``keys``.
        """
        version = self.version()
        head, files = self._manifest()
        ranges = logical_ranges(files)
        schema = T.StructType.fromJson(head["schema"])
        extra = {k: v for k, v in head.items() if k not in ("schema", "keys")}
        if not ranges:
            self._commit(version + 1, schema, self._written(self._layout(change(self._read(schema, [])))), **extra)
            return 0
        bounds = [g[0].least for g in ranges]
        numbers = self.touched(keys)
        if not numbers:
            return 0
        old = [f for n in numbers for f in ranges[n]]
        new = change(self._read(schema, old)).select(*schema.names)
        tagged = new.withColumn("_range", F.element_at(self._range_ids(new, self.keys, bounds), 1))
        fresh = self._written(self._layout(tagged, "_range"), by="_range")
        kept = set(files) - set(old)
        self._commit(version + 1, schema, [*kept, *fresh], **extra)
        return len(old)

    def upsert(self, changes: DataFrame, keep_versions: bool = False) -> int:
        """M1, M2: put cells (:func:`mutate.upsert`) or, in a table of rows, whole rows; the number of replaced files."""
        if W.FAMILY in self.keys:
            return self.rewrite(changes, lambda old: mutate.upsert(old, changes, keep_versions=keep_versions))
        names = self.schema().names
        side = F.struct("_side", F.struct(*names).alias("row"))

        def newest(old: DataFrame) -> DataFrame:
            both = (old.withColumn("_side", F.lit(0)).unionByName(changes.select(*names).withColumn("_side", F.lit(1))))
            won = both.groupBy(*self.keys).agg(F.max(side).alias("won"))
            return won.select("won.row.*")

        return self.rewrite(changes, newest)

    def delete(self, keys: DataFrame) -> int:
        """M3: drop the rows of the keys in ``keys`` (all key columns or the first ones); the number of replaced files."""
        named = [k for k in self.keys if k in keys.columns]
        gone = keys.select(*named).dropna().distinct()
        return self.rewrite(gone, lambda old: old.join(gone, named, "left_anti"))

    def delete_where(self, condition: Column, start: str | None = None, prefix: str | None = None) -> int:
        """M5: drop matching rows of a start key or prefix; only files that hold one are replaced (NULL keeps a row)."""
        hit = self.scan(condition, start, prefix)
        keys = hit.select(*self.keys).distinct()
        within = F.lit(True)
        if start is not None:
            within = within & (F.col(self.keys[0]) >= start)
        if prefix is not None:
            within = within & F.col(self.keys[0]).startswith(prefix)
        return self.rewrite(keys, lambda old: mutate.delete_where(old, condition & within))

    def vacuum(self) -> int:
        """Remove data files that the newest version doesn't list (no reader may be on an older one); how many."""
        listed = {f.file for f in self._manifest()[1]}
        found = self.fs.listFiles(self._path("data"), True)
        old = []
        while found.hasNext():
            at = found.next().getPath()
            name = "data/" + at.toString().split(f"{self.path.split(':')[-1]}/data/")[-1]
            if name.endswith(".parquet") and name not in listed:
                old.append(at)
        for at in old:
            self.fs.delete(at, False)
        return len(old)

    # --- reads -----------------------------------------------------------------------------

    def _read(self, schema: T.StructType, files: Iterable[RangeFile]) -> DataFrame:
        paths = [f"{self.path}/{f.file}" for f in files]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def files_for(self, start: str | None = None, prefix: str | None = None) -> list[RangeFile]:
        """The files that can hold keys from ``start`` on, or with ``prefix``, in key order."""
        return _pruned([f for g in self.ranges() for f in g], start, prefix)

    def read(self) -> DataFrame:
        head, files = self._manifest()
        return self._read(T.StructType.fromJson(head["schema"]), files)

    def scan(self, condition: Column | None = None, start: str | None = None, prefix: str | None = None,
             columns: Sequence[str] | None = None) -> DataFrame:
        """:func:`widetable.scan` over the files that can match."""
        return W.scan(self._read(self.schema(), self.files_for(start, prefix)), condition, start, prefix, columns, self.keys[0])

    def first_n(self, n: int, condition: Column | None = None, start: str | None = None,
                prefix: str | None = None) -> tuple[DataFrame, int]:
        """O1, O2: the first ``n`` matching rows in key order, and how many ranges were visited.

        Ranges are visited in key order, twice as many at each step, until they hold ``n`` matching rows.
        """
        schema, wanted = self.schema(), set(self.files_for(start, prefix))
        ranges = [[f for f in g if f in wanted] for g in self.ranges()]
        ranges = [g for g in ranges if g]
        held, seen, step = 0, 0, 1
        while seen < len(ranges) and held < n:
            files = [f for g in ranges[seen:seen + step] for f in g]
            held += W.scan(self._read(schema, files), condition, start, prefix, key=self.keys[0]).limit(n - held).count()
            seen, step = min(seen + step, len(ranges)), 2 * step
        some = W.scan(self._read(schema, [f for g in ranges[:seen] for f in g]), condition, start, prefix, key=self.keys[0])
        return some.orderBy(*self.keys).limit(n), seen

    def get_many(self, requests: DataFrame) -> DataFrame:
        """The rows of the requested keys (``requests``: the first key column; repeats count once).

        Only the ranges of the keys are read; up to ``PUSHED_KEYS`` keys are pushed into the scan too.
        """
        key = self.keys[0]
        keys = requests.select(key).where(F.col(key).isNotNull()).distinct()
        ranges = self.ranges()
        rows = self._read(self.schema(), [f for n in (self.touched(keys) if ranges else []) for f in ranges[n]])
        some = [r[0] for r in keys.limit(PUSHED_KEYS + 1).collect()]
        if len(some) <= PUSHED_KEYS:
            return rows.where(F.col(key).isin(some))
        return rows.join(keys, key, "left_semi")


def _keyed(rows: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows that fail the job where a key column is NULL."""
    for k in keys:
        missing = F.raise_error(F.lit(f"a row without {k}")).cast("string")
        rows = rows.withColumn(k, F.coalesce(F.col(k), missing))
    return rows


def _pruned(files: Iterable[RangeFile], start: str | None, prefix: str | None) -> list[RangeFile]:
    """The files whose first key column can be at least ``start``, or start with ``prefix``."""
    return [f for f in files if (start is None or f.greatest[0] >= start)
            and (prefix is None or f.least[0][:len(prefix)] <= prefix <= f.greatest[0])]


__all__ = ["RangeFile", "RangedTable", "logical_ranges", "FILE_ROWS"]
