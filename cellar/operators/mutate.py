"""Table changes as DataFrame -> DataFrame transforms.

A change never edits files in place: old table + changes -> new table, written
by the caller (``write_table``). Deletes are joins or filters; the newest
version is found with a partial-aggregating ``groupBy`` and then matched back on
the full version identity, so no window ever holds a whole hot row key.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.functions.predicates import ROW_KEY, is_true
from cellar.operators.widetable import FAMILY, QUALIFIER, SEQ, TS, VALUE, newest_version

CELL_KEY = (ROW_KEY, FAMILY, QUALIFIER)
CELL_SCHEMA = T.StructType([
    T.StructField(ROW_KEY, T.StringType()), T.StructField(FAMILY, T.StringType()),
    T.StructField(QUALIFIER, T.StringType()), T.StructField(TS, T.TimestampNTZType()),
    T.StructField(VALUE, T.StringType()), T.StructField(SEQ, T.LongType()),
])


def _order(df: DataFrame, order: Sequence[str]) -> list[str]:
    return [c for c in order if c in df.columns]


def upsert(cells: DataFrame, changes: DataFrame, order: Sequence[str] = (TS, SEQ),
           keep_versions: bool = False) -> DataFrame:
    """M2 (+D12): put a batch of cells.

    ``keep_versions=False``: newest per (row_key, family, qualifier) wins, by
    ``(ts, seq)`` - deterministic where the store's arrival order is not.
    ``keep_versions=True``: the versioned table; a put on an existing
    (row_key, family, qualifier, ts) replaces that version, the later ``seq`` winning.

    A change without a timestamp fails the job: it would sort below every stored
    version and be lost. ``to_cells`` and ``put_cell`` stamp changes with the current time.
    """
    if TS in cells.columns:
        if TS not in changes.columns:
            raise ValueError("changes need a timestamp column; see to_cells and put_cell")
        missing = F.raise_error(F.lit("a put without a timestamp would be lost")).cast(changes.schema[TS].dataType)
        changes = changes.withColumn(TS, F.coalesce(F.col(TS), missing))
    both = cells.unionByName(changes, allowMissingColumns=True)
    order = _order(both, order)
    if not keep_versions:
        agg = both.groupBy(*CELL_KEY).agg(F.max(newest_version(order)).alias("_v"))
        return agg.select(*CELL_KEY, *[F.col(f"_v.{c}").alias(c) for c in order], F.col(f"_v.{VALUE}").alias(VALUE))
    tie = [c for c in order if c != TS]
    agg = both.groupBy(*CELL_KEY, TS).agg(F.max(newest_version(tie)).alias("_v"))
    return agg.select(*CELL_KEY, TS, *[F.col(f"_v.{c}").alias(c) for c in tie], F.col(f"_v.{VALUE}").alias(VALUE))


def binary_cells(cells: DataFrame) -> DataFrame:
    """The table with byte values (text becomes its UTF-8 bytes); puts of any bytes go into such a table."""
    if isinstance(cells.schema[VALUE].dataType, T.BinaryType):
        return cells
    return cells.withColumn(VALUE, F.encode(F.col(VALUE), "UTF-8"))


def put_cell(spark: SparkSession, cells: DataFrame, row_key: str, family: str, qualifier: str,
             value, ts=None, seq: int | None = None) -> DataFrame:
    """M1: put one cell - a one-row :func:`upsert`.

    Without ``ts`` the put is stamped with the current time (UTC), like a put at
    the store; without ``seq`` it gets one above the cell's versions of that time
    or later, so it wins a tie. A table of byte values (:func:`binary_cells`) takes
    any bytes, and text as UTF-8; a table of text takes bytes that are UTF-8.
    """
    binary = isinstance(cells.schema[VALUE].dataType, T.BinaryType)
    if binary and isinstance(value, str):
        value = value.encode()
    elif not binary and isinstance(value, (bytes, bytearray)):
        try:
            value = bytes(value).decode("utf-8")
        except UnicodeDecodeError as e:
            raise ValueError("these bytes aren't UTF-8 text; put them into binary_cells(cells)") from e
    if ts is None:
        ts = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    if seq is None and SEQ in cells.columns:
        same = cells.where((F.col(ROW_KEY) == row_key) & (F.col(FAMILY) == family) & (F.col(QUALIFIER) == qualifier))
        if TS in cells.columns:
            same = same.where(F.col(TS) >= F.lit(ts).cast(cells.schema[TS].dataType))
        seq = (same.agg(F.max(SEQ)).first()[0] or 0) + 1
    schema = T.StructType([T.StructField(f.name, T.BinaryType()) if binary and f.name == VALUE else f
                           for f in CELL_SCHEMA.fields])
    one = spark.createDataFrame([(row_key, family, qualifier, ts, value, seq)], schema)
    return upsert(cells, one.select(*[c for c in one.columns if c in cells.columns or c in (TS, SEQ)]))


def delete_rows(df: DataFrame, keys: DataFrame, key: str = ROW_KEY) -> DataFrame:
    """M3: drop every row (or cell) whose key is in ``keys`` - a left-anti join."""
    return df.join(keys.select(F.col(key)).distinct(), key, "left_anti")


def delete_latest(cells: DataFrame, requests: DataFrame, order: Sequence[str] = (TS, SEQ)) -> DataFrame:
    """M4: delete the named cells, newest version only - an older version shows again.

    ``requests`` holds (row_key, family, qualifier). The newest version of each
    requested cell is found by a partial-aggregating ``groupBy`` and removed by
    an anti-join on the full version identity (key + ts + tie-break), which
    spreads a hot cell's versions over many tasks.
    """
    order = _order(cells, order)
    version = F.struct(*[F.col(c) for c in order])
    wanted = requests.select(*CELL_KEY).distinct()
    newest = (cells.join(wanted, list(CELL_KEY), "left_semi")
              .groupBy(*CELL_KEY).agg(F.max(version).alias("_v"))
              .select(*CELL_KEY, *[F.col(f"_v.{c}").alias(c) for c in order]))
    # Null-safe on the version columns: a NULL ts is still a version.
    cond = [cells[c] == newest[c] for c in CELL_KEY] + [cells[c].eqNullSafe(newest[c]) for c in order]
    return cells.join(newest, cond, "left_anti")


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """M5: drop rows that match; an unknown (NULL) result keeps the row."""
    return df.where(~is_true(condition))


def delete_where_pred(df: DataFrame, condition: Column, predicate: Column) -> DataFrame:
    """M6 (+E3): drop rows matching the filter and a caller's predicate (a Column or pandas-UDF result)."""
    return df.where(~(is_true(condition) & is_true(predicate)))


def delete_rows_where_cells(cells: DataFrame, cell_condition: Column) -> DataFrame:
    """M5 on the cell form: drop whole rows that have a cell matching the condition."""
    doomed = cells.where(is_true(cell_condition)).select(ROW_KEY).distinct()
    return cells.join(doomed, ROW_KEY, "left_anti")


def range_layout(df: DataFrame, n_ranges: int | None = None, key: str = ROW_KEY,
                 then: Sequence[str] = ()) -> DataFrame:
    """K2: pre-split into ``n_ranges`` key ranges, sorted inside each range.

    Written out, each file holds one key range with sorted row groups, which is
    what lets later key-range and prefix reads skip files and row groups.
    ``n_ranges=None`` lets the data size decide (``spark.sql.shuffle.partitions``
    ranges, merged by AQE): a fixed small count, like the 5 ranges at the source,
    would leave a few tasks writing everything. ``then`` adds columns to
    the range key after ``key``: the files stay ordered by ``key`` first, but one
    key with very many rows (a hot row of a cell table) can be split over ranges.
    """
    cols = [F.col(key), *[F.col(c) for c in then]]
    ranged = df.repartitionByRange(int(n_ranges), *cols) if n_ranges else df.repartitionByRange(*cols)
    return ranged.sortWithinPartitions(*cols)


def write_table(df: DataFrame, path: str, n_ranges: int | str | None = None, key: str = ROW_KEY,
                fmt: str = "parquet", mode: str = "overwrite", ranged: bool = True) -> None:
    """K1: write a table (row or cell form) through its mapping, range-split by key (K2)
    into ``n_ranges`` ranges (``None``: sized by the data); ``ranged=False`` writes as is.
    A cell table is split on (row_key, family, qualifier, ts[, seq]), so a hot row key
    spreads over several ranges while the files stay ordered by row key."""
    then = [c for c in (FAMILY, QUALIFIER, TS, SEQ) if c in df.columns] if FAMILY in df.columns else []
    out = range_layout(df, int(n_ranges) if n_ranges else None, key, then) if ranged else df
    out.write.format(fmt).mode(mode).save(path)


__all__ = ["CELL_KEY", "CELL_SCHEMA", "upsert", "binary_cells", "put_cell", "delete_rows", "delete_latest", "delete_where",
           "delete_where_pred", "delete_rows_where_cells", "range_layout", "write_table"]
