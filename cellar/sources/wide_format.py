"""The wide table as a Spark format: ``wide_table``.

``df.write.format("wide_table").mode("overwrite").options(path=..., catalog=...)`` writes a table through its
JSON column mapping, ``spark.read.format("wide_table").options(path=..., catalog=...)`` reads it. The files
and the manifest are those of :mod:`cellar.operators.ranged_table`, so a table written
here can be changed and scanned there, and the other way round.

A write has two phases: each task writes its file and reports its key range; when all
have, the driver puts the next version's manifest in place. A write that fails leaves the
table as it was. A read is a scan (F1, F2): with the options ``startKey`` and ``keyPrefix`` it lists only the
manifest's files whose key range can match and returns the rows that do, a task per file. The
writer can't move rows: :func:`write_wide` splits them into key ranges first (K2).

Key ranges are options rather than filters pushed by the optimizer: Spark 4.1 keeps the filters that it pushes
into a Python source once per loaded table, so two filters on one DataFrame (a union, a self-join)
would both get the last one's files. Spark hands such a source neither the columns nor the limit of a
query either: all mapped columns are read. For large scans with few columns use
``RangedTable(...).scan``, which is Spark's own Parquet reader.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)

from cellar.operators.mutate import range_layout
from cellar.operators.widetable import Catalog
from cellar.sources._store import open_store

FORMAT = "wide_table"


def use_wide_tables(spark: SparkSession) -> None:
    """Register the format in a session."""
    spark.dataSource.register(WideTableSource)


def write_wide(df: DataFrame, path: str, catalog: str, n_ranges: int | None = None) -> None:
    """K1 + K2: write rows through the mapping in ``catalog`` (JSON), in ``n_ranges`` key ranges (None: sized by the data)."""
    use_wide_tables(df.sparkSession)
    schema = Catalog.from_json(catalog).schema()
    rows = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    ranged = range_layout(rows, n_ranges, schema.names[0])
    ranged.write.format(FORMAT).mode("overwrite").options(path=path, catalog=catalog).save()


def read_wide(spark: SparkSession, path: str, catalog: str, start: str | None = None, prefix: str | None = None) -> DataFrame:
    """S3, F1, F2: the table at ``path`` with the columns of ``catalog`` (JSON), from a start key on or of a key prefix."""
    use_wide_tables(spark)
    keys = {name: value for name, value in (("startKey", start), ("keyPrefix", prefix)) if value is not None}
    return spark.read.format(FORMAT).options(path=path, catalog=catalog, **keys).load()


class WideTableSource(DataSource):
    """The ``wide_table`` format."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return Catalog.from_json(self.options["catalog"]).schema()

    def reader(self, schema: T.StructType) -> "WideReader":
        return WideReader(self.options["path"], schema, self.options.get("startKey"), self.options.get("keyPrefix"))

    def writer(self, schema: T.StructType, overwrite: bool) -> "WideWriter":
        if not overwrite:
            raise ValueError("a write replaces the table (mode overwrite); put rows into one with RangedTable.upsert")
        return WideWriter(self.options["path"], self.options["catalog"], schema)


class Manifest:
    """The newest version of a table's manifest, from a Python process."""

    def __init__(self, path: str):
        self.fs, self.root = open_store(path)

    def at(self, *names: str) -> str:
        return posixpath.join(self.root, *names)

    def version(self) -> int:
        from pyarrow import fs
        listed = self.fs.get_file_info(fs.FileSelector(self.at("manifest"), allow_not_found=True))
        return max((int(i.base_name[:-5]) for i in listed if i.base_name.endswith(".json")), default=0)

    def files(self) -> list[dict]:
        version = self.version()
        if not version:
            raise ValueError(f"no table at {self.root}")
        with self.fs.open_input_stream(self.at("manifest", f"{version:020d}.json")) as f:
            entries = [json.loads(line) for line in f.read().decode("utf-8").splitlines()]
        return [e for e in entries if "file" in e]

    def put(self, version: int, entries: list[dict]) -> None:
        from pyarrow import fs
        target, staged = self.at("manifest", f"{version:020d}.json"), self.at("staged", uuid.uuid4().hex)
        for folder in ("manifest", "staged"):
            self.fs.create_dir(self.at(folder))
        with self.fs.open_output_stream(staged) as f:
            f.write("\n".join(json.dumps(e) for e in entries).encode("utf-8"))
        if self.fs.get_file_info(target).type != fs.FileType.NotFound:
            raise RuntimeError(f"another writer has made version {version} of {self.root}")
        self.fs.move(staged, target)


@dataclass
class DataFile(InputPartition):
    file: str


def may_match(least: str, greatest: str, start: str | None, prefix: str | None) -> bool:
    """Can a file with keys from ``least`` to ``greatest`` hold one from ``start`` on that begins with ``prefix``?"""
    return ((start is None or greatest >= start)
            and (prefix is None or least[:len(prefix)] <= prefix <= greatest))


class WideReader(DataSourceReader):
    """Files of the newest version that a scan's key range doesn't rule out."""

    def __init__(self, path: str, schema: T.StructType, start: str | None, prefix: str | None):
        self.path, self.columns, self.start, self.prefix = path, schema, start, prefix

    def partitions(self) -> list[DataFile]:
        return [DataFile(e["file"]) for e in Manifest(self.path).files()
                if may_match(e["least"][0], e["greatest"][0], self.start, self.prefix)]

    def read(self, partition: DataFile) -> Iterator:
        import pyarrow.compute as pc
        import pyarrow.dataset as ds
        from pyspark.sql.pandas.types import to_arrow_schema
        if partition is None:  # no file at all
            return
        store, key = Manifest(self.path), ds.field(self.columns.names[0])
        wanted = None if self.start is None else key >= self.start
        if self.prefix is not None:
            begins = pc.starts_with(key, self.prefix)
            wanted = begins if wanted is None else wanted & begins
        data = ds.dataset(store.at(partition.file), filesystem=store.fs, format="parquet")
        schema = to_arrow_schema(self.columns)
        for batch in data.to_batches(columns=self.columns.names, filter=wanted):
            if batch.num_rows:
                yield batch.cast(schema)


@dataclass
class Written(WriterCommitMessage):
    """A task's file and its key range (no file where it had no rows)."""

    file: str | None
    least: str = ""
    greatest: str = ""
    rows: int = 0


class WideWriter(DataSourceArrowWriter):
    """Phase one in the tasks (:meth:`write`), phase two in the driver (:meth:`commit`)."""

    def __init__(self, path: str, catalog: str, schema: T.StructType):
        mapped = Catalog.from_json(catalog).schema()
        if mapped.names != schema.names:
            raise ValueError(f"the mapping has the columns {mapped.names}, the rows {schema.names}")
        self.path, self.catalog, self.columns = path, catalog, schema
        self.name = f"data/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> Written:
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        store, key, out = Manifest(self.path), self.columns.names[0], None
        message = Written(f"{self.name}/part-{uuid.uuid4().hex}.parquet")
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                keys = batch.column(key)
                if keys.null_count:
                    raise ValueError(f"a row without {key}")
                least, greatest = (pc.min_max(keys)[x].as_py() for x in ("min", "max"))
                if out is None:
                    store.fs.create_dir(store.at(self.name))
                    out = pq.ParquetWriter(store.at(message.file), batch.schema, filesystem=store.fs)
                    message.least, message.greatest = least, greatest
                out.write_batch(batch)
                message.least, message.greatest = min(message.least, least), max(message.greatest, greatest)
                message.rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return message if message.rows else Written(None)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store = Manifest(self.path)
        head = {"schema": self.columns.jsonValue(), "keys": [self.columns.names[0]], "catalog": self.catalog}
        files = [{"file": m.file, "least": [m.least], "greatest": [m.greatest], "rows": m.rows}
                 for m in messages if m is not None and m.file]
        store.put(store.version() + 1, [head, *sorted(files, key=lambda e: (e["least"], e["greatest"]))])

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs
        store = Manifest(self.path)
        if store.fs.get_file_info(store.at(self.name)).type != fs.FileType.NotFound:
            store.fs.delete_dir(store.at(self.name))


__all__ = ["FORMAT", "use_wide_tables", "write_wide", "read_wide", "WideTableSource", "may_match"]
