"""Key lookups as joins.

The source does one store round trip per row; here a lookup is one join. The
lookup side is reduced to one row per key first (a row key is unique in the
store), so matches never multiply rows. Broadcast is left to Catalyst, whose
size estimate and AQE's runtime statistics are the size check; an explicit
broadcast is only added on request, after counting the lookup side against a bound. A key holding a large share of the probe side is split by
AQE's skew-join handling (the other side has one row per key, so the split is cheap).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellar.functions.predicates import ROW_KEY
from cellar.operators.widetable import FAMILY, QUALIFIER, SEQ, TS, VALUE, newest_version

ON_MISSING = ("error", "null", "drop")
# Most lookup rows broadcast on request (checked by counting first).
MAX_BROADCAST_ROWS = 1_000_000
# Copies of a row that are repeated at a time.
COPIES_PER_PIECE = 1_000


def lookup_table(cells: DataFrame, family: str, qualifier: str, value_name: str,
                 order: Sequence[str] = (TS, SEQ), key_name: str = ROW_KEY) -> DataFrame:
    """One row per key: the newest value of ``family:qualifier`` (P10) as ``key_name, value_name``."""
    order = [c for c in order if c in cells.columns]
    return (cells.where((F.col(FAMILY) == family) & (F.col(QUALIFIER) == qualifier))
            .groupBy(F.col(ROW_KEY).alias(key_name)).agg(F.max(newest_version(order)).alias("_v"))
            .select(key_name, F.col(f"_v.{VALUE}").alias(value_name)))


def enrich(df: DataFrame, lookup: DataFrame, left_key: str, right_key: str, value_cols: Sequence[str],
           on_missing: str = "error", broadcast_lookup: bool | int = False, salt_buckets: int = 1,
           collapse_copies: bool = False) -> DataFrame:
    """Add ``value_cols`` of ``lookup`` to every row of ``df`` by key.

    ``lookup`` must already be one row per key (see :func:`lookup_table`).
    ``on_missing`` (D5): ``'error'`` fails the job on a key that is absent or
    whose value is NULL, ``'null'`` leaves NULL, ``'drop'`` removes the row.
    ``broadcast_lookup`` asks for a broadcast of the lookup side; it is checked: the
    side is counted (at most ``bound + 1`` rows, ``bound`` = ``MAX_BROADCAST_ROWS`` or
    the number given) and broadcast only within the bound, else joined by shuffle.
    ``salt_buckets > 1`` spreads every key of the probe side over that many
    tasks (salt = hash of the row's content) and copies each lookup row once per
    salt - explicit salting for a shuffled join when the adaptive skew split is not
    available. Identical probe rows share a salt; ``collapse_copies=True`` counts
    identical probe rows first (partial aggregation), joins each distinct row once
    and repeats the result by its count - for inputs where one group of copies is
    itself a large share of the rows.
    """
    if collapse_copies:
        counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
        joined = enrich(counted, lookup, left_key, right_key, value_cols, on_missing=on_missing,
                        broadcast_lookup=broadcast_lookup, salt_buckets=salt_buckets)
        # in pieces, so that no array is as long as a group of copies
        pieces = joined.withColumn("_piece", F.explode(F.sequence(
            F.lit(0).cast("long"), F.call_function("div", F.col("_copies") - 1, F.lit(COPIES_PER_PIECE)))))
        held = F.least(F.lit(COPIES_PER_PIECE), F.col("_copies") - F.col("_piece") * COPIES_PER_PIECE)
        return (pieces.withColumn("_rep", F.explode(F.array_repeat(F.lit(0), held.cast("int"))))
                .drop("_rep", "_piece", "_copies"))
    if on_missing not in ON_MISSING:
        raise ValueError(f"on_missing must be one of {ON_MISSING}")
    right = lookup.select(F.col(right_key).alias("_lk"), *value_cols)
    if broadcast_lookup:
        bound = MAX_BROADCAST_ROWS if broadcast_lookup is True else int(broadcast_lookup)
        if right.limit(bound + 1).count() <= bound:
            right = F.broadcast(right)
    how = "inner" if on_missing == "drop" else "left"
    left = df
    cond = df[left_key] == right["_lk"]
    if salt_buckets > 1:
        # a content hash, not a random number: a re-run task salts every row the same way
        left = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]),
                                             F.lit(salt_buckets)).cast("int"))
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
        cond = (left[left_key] == right["_lk"]) & (left["_salt"] == right["_salt"])
    joined = left.join(right, cond, how)
    if on_missing == "drop":
        for c in value_cols:
            joined = joined.where(F.col(c).isNotNull())
    out_cols = [left[c] for c in df.columns]
    for c in value_cols:
        v = F.col(c)
        if on_missing == "error":
            v = F.coalesce(v, F.raise_error(F.concat(F.lit("lookup found no value for key "),
                                                     F.coalesce(left[left_key].cast("string"), F.lit("NULL")))))
        out_cols.append(v.alias(c))
    return joined.select(*out_cols)


def batch_get(keys: DataFrame, table: DataFrame, key: str = ROW_KEY, pos: str = "pos",
              condition: Column | None = None) -> DataFrame:
    """One result per requested key, duplicates kept, NULL columns where absent.

    ``keys`` carries ``key`` and a request position ``pos``; order by ``pos``
    to get the request order back. ``condition`` (J3) filters the table before
    the match, so a key whose row fails the filter comes back empty.
    """
    right = table.where(condition) if condition is not None else table
    return keys.select(pos, key).join(right, key, "left")


def point_get(table: DataFrame, row_key: str, condition: Column | None = None, key: str = ROW_KEY) -> DataFrame:
    """One key (plus an optional filter); empty when absent."""
    out = table.where(F.col(key) == F.lit(row_key))
    return out.where(condition) if condition is not None else out


__all__ = ["ON_MISSING", "MAX_BROADCAST_ROWS", "lookup_table", "enrich", "batch_get", "point_get"]
