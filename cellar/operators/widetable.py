"""Wide-column tables as DataFrames.

Two interchangeable forms:

* cell form ``row_key, family, qualifier, ts, value`` (+ an optional tie-break
  column, ``seq`` by default) - exact and versioned;
* row form ``row_key`` + one column per mapped ``family:qualifier``, NULL for a
  missing cell - what scans, filters and joins run on, so Catalyst can push
  predicates and prune columns.

Every "newest version" step is a ``groupBy`` with ``max(struct(ts, seq, value))``:
it aggregates partially before the shuffle, so a row key holding a large share
of all cells is collapsed map-side instead of landing in one task.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.functions.predicates import ROW_KEY, any_of

FAMILY, QUALIFIER, TS, VALUE, SEQ = "family", "qualifier", "ts", "value", "seq"
CELL_COLUMNS = (ROW_KEY, FAMILY, QUALIFIER, TS, VALUE)
# Label used by the column listing for a family that is selected whole.
ANY_COLUMN = "ANY COLUMN"

_TYPES = {
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "boolean": T.BooleanType(),
    "double": T.DoubleType(),
}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    family: str
    qualifier: str
    type: str = "string"


@dataclass(frozen=True)
class Catalog:
    """Column mapping of a wide table (S3): row-key column + ``name -> (family, qualifier, type)``."""

    table: str
    row_key: str = ROW_KEY
    columns: tuple[ColumnSpec, ...] = field(default_factory=tuple)
    namespace: str = "default"

    @classmethod
    def from_dict(cls, d: dict) -> "Catalog":
        tbl = d.get("table", {})
        key = d["rowkey"]
        cols = []
        for name, spec in d["columns"].items():
            if name == key or spec.get("cf") == "rowkey":
                continue
            cols.append(ColumnSpec(name, spec["cf"], spec.get("col", name), spec.get("type", "string")))
        return cls(table=tbl.get("name", ""), row_key=key, columns=tuple(cols),
                   namespace=tbl.get("namespace", "default"))

    @classmethod
    def from_json(cls, text: str) -> "Catalog":
        return cls.from_dict(json.loads(text))

    @property
    def families(self) -> list[str]:
        seen: list[str] = []
        for c in self.columns:
            if c.family not in seen:
                seen.append(c.family)
        return seen

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def schema(self) -> T.StructType:
        fields = [T.StructField(self.row_key, T.StringType(), True)]
        fields += [T.StructField(c.name, _TYPES[c.type], True) for c in self.columns]
        return T.StructType(fields)

    def column(self, family: str, qualifier: str) -> ColumnSpec | None:
        for c in self.columns:
            if c.family == family and c.qualifier == qualifier:
                return c
        return None


def catalog_schema(catalog: Catalog) -> T.StructType:
    """S3: the flat ``StructType`` a column mapping declares."""
    return catalog.schema()


def as_records(df: DataFrame, catalog: Catalog, source_names: Sequence[str] | None = None) -> DataFrame:
    """Typed records of the mapping from a DataFrame (positional when ``source_names`` is given)."""
    targets = [catalog.row_key, *catalog.names]
    sources = list(source_names) if source_names is not None else targets
    if len(sources) != len(targets):
        raise ValueError("source_names must list one column per mapped column, row key first")
    schema = catalog.schema()
    return df.select(*[F.col(s).cast(schema[t].dataType).alias(t) for s, t in zip(sources, targets)])


# --- form conversion -------------------------------------------------------------------------

def to_cells(rows: DataFrame, catalog: Catalog, ts=None, seq=None) -> DataFrame:
    """Row form -> cell form; NULL columns are missing cells and produce no cell.

    ``ts``/``seq`` are a column name, a Column or a literal; by default all cells get
    the time (UTC) of this call, so that an upsert of them is newer than what is stored.
    """
    if ts is None:
        ts = F.lit(_dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")
    ts_col = _as_value(ts, T.TimestampNTZType())
    entries = [
        F.struct(F.lit(c.family).alias(FAMILY), F.lit(c.qualifier).alias(QUALIFIER),
                 F.col(c.name).cast("string").alias(VALUE))
        for c in catalog.columns
    ]
    out = rows.select(
        F.col(catalog.row_key).alias(ROW_KEY), ts_col.alias(TS),
        *([_as_value(seq, T.LongType()).alias(SEQ)] if seq is not None else []),
        F.inline(F.array(*entries)),
    ).where(F.col(VALUE).isNotNull())
    cols = [ROW_KEY, FAMILY, QUALIFIER, TS, VALUE] + ([SEQ] if seq is not None else [])
    return out.select(*cols)


def to_rows(cells: DataFrame, catalog: Catalog, order: Sequence[str] = (TS, SEQ)) -> DataFrame:
    """Cell form -> row form: newest version of every mapped cell, one row per row key.

    One ``groupBy(row_key)`` with a conditional ``max(struct(ts, seq, value))`` per mapped column
    (no pivot value collection, partial aggregation before the shuffle).
    Cells of unmapped families or qualifiers are ignored.
    """
    order = [c for c in order if c in cells.columns]
    mapped = any_of([(F.col(FAMILY) == c.family) & (F.col(QUALIFIER) == c.qualifier) for c in catalog.columns])
    newest = newest_version(order)
    aggs = []
    for c in catalog.columns:
        hit = (F.col(FAMILY) == c.family) & (F.col(QUALIFIER) == c.qualifier)
        aggs.append(F.max(F.when(hit, newest)).alias(c.name))
    out = (cells.where(F.col(FAMILY).isin(catalog.families)).where(mapped)
           .groupBy(ROW_KEY).agg(*aggs))
    schema = catalog.schema()
    return out.select(F.col(ROW_KEY).alias(catalog.row_key),
                      *[F.col(f"`{c.name}`").getField(VALUE).cast(schema[c.name].dataType).alias(c.name)
                        for c in catalog.columns])


def newest_version(order: Sequence[str]) -> Column:
    """The struct whose ``max`` is the newest version: the version columns, then the value.

    One aggregate gives both the newest version and its value, and copies that
    tie on the version still have one deterministic winner.
    """
    return F.struct(*[F.col(c) for c in order], F.col(VALUE).alias(VALUE))


def latest_cells(cells: DataFrame, order: Sequence[str] = (TS, SEQ)) -> DataFrame:
    """Newest version of every cell: one row per (row_key, family, qualifier)."""
    order = [c for c in order if c in cells.columns]
    newest = cells.groupBy(ROW_KEY, FAMILY, QUALIFIER).agg(F.max(newest_version(order)).alias("_v"))
    return newest.select(ROW_KEY, FAMILY, QUALIFIER, *[F.col(f"_v.{c}").alias(c) for c in order],
                         F.col(f"_v.{VALUE}").alias(VALUE))


# --- reads -----------------------------------------------------------------------------------

def scan_families(cells: DataFrame, families: Iterable[str]) -> DataFrame:
    """The cells of the families known at open."""
    return cells.where(F.col(FAMILY).isin(list(families)))


def scan(df: DataFrame, condition: Column | None = None, start: str | None = None,
         prefix: str | None = None, columns: Sequence[str] | None = None,
         key: str = ROW_KEY, limit: int | None = None) -> DataFrame:
    """F10 (+F1, F2, P6, O1): one scan entry point: optional start key, key prefix, filter,
    columns and row limit (the first ``limit`` matching rows in key order, as a scanner
    with a limit returns them; without one the whole table, like ``readAll``).

    Covers every ``scan``/``scanPrefix`` form; all conditions reach the
    Parquet scan as pushed filters when the input is a Parquet table.
    """
    out = df
    if start is not None:
        out = out.where(F.col(key) >= F.lit(start))
    if prefix is not None:
        out = out.where(F.col(key).startswith(prefix))
    if condition is not None:
        out = out.where(condition)
    if columns is not None:
        out = out.select(key, *[c for c in columns if c != key])
    if limit is not None:
        out = first_n(out, limit, key)
    return out


def get_row(df: DataFrame, row_key: str, condition: Column | None = None, key: str = ROW_KEY) -> DataFrame:
    """One row by key (plus an optional filter); empty when absent."""
    out = df.where(F.col(key) == F.lit(row_key))
    return out.where(condition) if condition is not None else out


def named_columns(rows: DataFrame, catalog: Catalog, family: str, qualifiers: Iterable[str],
                  keep_other_families: bool = False) -> DataFrame:
    """P6 on the row form: row key + the named columns of one family.

    D4: with ``keep_other_families=True`` the other families stay whole, as a
    get that first adds every family and then names columns of one of them.
    """
    wanted = set(qualifiers)
    keep = [c.name for c in catalog.columns
            if (c.family == family and c.qualifier in wanted) or (keep_other_families and c.family != family)]
    return rows.select(catalog.row_key, *keep)


def named_cells(cells: DataFrame, family: str, qualifiers: Iterable[str],
                keep_other_families: bool = False) -> DataFrame:
    """P6 on the cell form (same D4 switch)."""
    cond = (F.col(FAMILY) == family) & F.col(QUALIFIER).isin(list(qualifiers))
    if keep_other_families:
        cond = cond | (F.col(FAMILY) != family)
    return cells.where(cond)


def column_prefix_cells(cells: DataFrame, prefixes: Iterable[str]) -> DataFrame:
    """Cells whose qualifier starts with any of the prefixes."""
    return cells.where(any_of([F.col(QUALIFIER).startswith(p) for p in prefixes]))


def column_prefix_rows(rows: DataFrame, catalog: Catalog, prefixes: Iterable[str]) -> DataFrame:
    """P7 on the row form: keep the columns whose *qualifier* in the mapping starts with any prefix."""
    ps = tuple(prefixes)
    return rows.select(catalog.row_key, *[c.name for c in catalog.columns if c.qualifier.startswith(ps)])


def keys_only(df: DataFrame, key: str = ROW_KEY) -> DataFrame:
    """Row keys only - distinct in the cell form, a projection in the row form."""
    if FAMILY in df.columns and QUALIFIER in df.columns:
        return df.select(key).distinct()
    return df.select(key)


def family_map(cells: DataFrame, family: str, order: Sequence[str] = (TS, SEQ)) -> DataFrame:
    """``row_key, cells map<qualifier, value>`` of one family; empty map when the row lacks it.

    One pass over the cells: those of other families are carried as their row key alone and
    collapse map-side, those of the family to their newest per qualifier (``map_from_entries``
    rejects duplicate keys); then a list per row key. The map is as wide as the row's family;
    :func:`latest_cells` gives the same cells as rows where a family is too wide for one value.
    """
    order = [c for c in order if c in cells.columns]
    mine = F.coalesce(F.col(FAMILY) == family, F.lit(False))
    tagged = cells.select(ROW_KEY, mine.alias("_mine"), F.when(mine, F.col(QUALIFIER)).alias("_name"),
                          F.when(mine, newest_version(order)).alias("_v"))
    newest = tagged.groupBy(ROW_KEY, "_mine", "_name").agg(F.max("_v").alias("_v"))
    entry = F.when(F.col("_mine"), F.struct(F.col("_name").alias("key"), F.col(f"_v.{VALUE}").alias("value")))
    return newest.groupBy(ROW_KEY).agg(F.map_from_entries(F.collect_list(entry)).alias("cells"))


def latest_value(cells: DataFrame, family: str, qualifier: str, order: Sequence[str] = (TS, SEQ)) -> DataFrame:
    """``row_key, value`` - newest value of one cell per row that has it."""
    order = [c for c in order if c in cells.columns]
    return (cells.where((F.col(FAMILY) == family) & (F.col(QUALIFIER) == qualifier))
            .groupBy(ROW_KEY).agg(F.max(newest_version(order)).alias("_v"))
            .select(ROW_KEY, F.col(f"_v.{VALUE}").alias(VALUE)))


def column_listing(cells: DataFrame, whole_families: Iterable[str] = ()) -> DataFrame:
    """The (family, qualifier) pairs present; a family selected whole is listed once as ANY COLUMN."""
    whole = list(whole_families)
    qual = F.when(F.col(FAMILY).isin(whole), F.lit(ANY_COLUMN)).otherwise(F.col(QUALIFIER)) if whole \
        else F.col(QUALIFIER)
    return cells.select(F.col(FAMILY), qual.alias(QUALIFIER)).distinct()


def first_n(df: DataFrame, n: int, key: str = ROW_KEY) -> DataFrame:
    """O1: the first ``n`` rows in key order (a top-k: ``TakeOrderedAndProject``)."""
    return df.orderBy(F.col(key)).limit(n)


def page(df: DataFrame, n: int, key: str = ROW_KEY) -> DataFrame:
    """O2: page filter - ``n`` rows in key order over the whole table (D7: global, not per region)."""
    return first_n(df, n, key)


def prefix_exists(df: DataFrame, prefix: str, key: str = ROW_KEY) -> bool:
    """does any row key start with ``prefix``? Stops at the first hit."""
    return len(df.where(F.col(key).startswith(prefix)).select(key).limit(1).take(1)) > 0


def prefixes_exist(prefixes: DataFrame, df: DataFrame, prefix_col: str = "prefix", key: str = ROW_KEY,
                   lengths: Iterable[int] | None = None) -> DataFrame:
    """F9 for many prefixes: ``prefix, exists``.

    Once its length is fixed, a starts-with test is an equality on
    ``substring(row_key, 1, len)``: every key is cut to each requested prefix
    length in one pass, the cuts are made distinct (duplicates of a hot prefix
    collapse map-side) and matched to the prefixes by an equi semi-join - no
    cross join. The set of lengths is small (bounded by the key length); pass
    ``lengths`` to skip the pass that finds them: a prefix of another length then
    fails the job rather than being reported as absent.
    """
    if lengths is None:
        lengths = [r[0] for r in prefixes.select(F.length(prefix_col).alias("n")).distinct().collect()]
        lengths = sorted(set(int(x) for x in lengths if x is not None))
    else:
        lengths = sorted(set(int(x) for x in lengths))
        known = F.col(prefix_col).isNull() | F.length(prefix_col).isin(lengths)
        prefixes = prefixes.select(F.when(known, F.col(prefix_col)).otherwise(F.raise_error(F.concat(
            F.lit("a prefix of a length that isn't listed: "), F.col(prefix_col)))).alias(prefix_col))
    if not lengths:
        return prefixes.select(prefix_col, F.lit(False).alias("exists"))
    cuts = F.explode(F.array(*[F.substring(F.col(key), 1, n) for n in lengths]))
    hits = (df.select(cuts.alias(prefix_col)).distinct()
            .join(prefixes.select(prefix_col), prefix_col, "left_semi")
            .withColumn("_hit", F.lit(True)))
    return (prefixes.join(hits, prefix_col, "left")
            .select(prefix_col, F.coalesce(F.col("_hit"), F.lit(False)).alias("exists")))


def _as_value(v, dtype) -> Column:
    if v is None:
        return F.lit(None).cast(dtype)
    if isinstance(v, Column):
        return v
    if isinstance(v, str):
        return F.col(v)
    return F.lit(v)


__all__ = [
    "FAMILY", "QUALIFIER", "TS", "VALUE", "SEQ", "CELL_COLUMNS", "ANY_COLUMN", "ColumnSpec", "Catalog",
    "catalog_schema", "as_records", "to_cells", "to_rows", "latest_cells", "scan_families", "scan", "get_row",
    "named_columns", "named_cells", "column_prefix_cells", "column_prefix_rows", "keys_only", "family_map",
    "latest_value", "column_listing", "first_n", "page", "prefix_exists", "prefixes_exist", "newest_version",
]
