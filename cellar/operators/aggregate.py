"""Aggregations.

* A1 gathers the values of a key as text. A key (or one group of identical
  copies) may hold a large share of all rows, so the values are never put into
  one unbounded array: copies collapse to counts first, and the sorted values of every
  key are cut into chunks of exactly ``chunk_size`` (the last one may be shorter).
  :func:`gather_counts` is the compact exact form (value, count) of the same bag.
* A2 is the consumed offset range per (topic, partition).
* E4 is a caller's zero / add / merge aggregate run as map-side partials
  (one accumulator per key and input partition) followed by a sorted, streaming merge,
  the shape of ``aggregateByKey``.
"""

from __future__ import annotations

import copy
import pickle
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from cellar.session import checkpoint_dir

DEFAULT_CHUNK_SIZE = 10_000
# Accumulators that a task holds before it hands them on.
MOST_KEYS = 100_000
# Results of a batch that a merge task hands on.
RESULT_ROWS = 10_000


def gather_values(df: DataFrame, key: str, value: str, chunk_size: int = DEFAULT_CHUNK_SIZE,
                  out: str = "values") -> DataFrame:
    """A1: ``key, chunk, values`` - the values of each key as sorted text, cut into arrays of ``chunk_size``.

    Chunk ``i`` holds the values at positions ``i * chunk_size`` to ``(i + 1) * chunk_size - 1``
    of the key's sorted values: all chunks but the last are full, and a key with at most
    ``chunk_size`` values is one row. One path serves every key:

    1. rows collapse to ``(key, value, n)``, map-side before the shuffle;
    2. the distinct values are split into ranges of (key, value), so that a hot key spans
       several; the ranges are fixed by a reliable checkpoint, and a running sum inside a
       range plus the key's sum in the ranges before it gives each value's first position;
    3. each value is repeated into the chunks that its positions cover.

    The input is read once. No array is longer than ``chunk_size``.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    bag = (df.groupBy(F.col(key).alias("_k"), F.col(value).cast("string").alias("_v"))
           .agg(F.count(F.lit(1)).alias("_n")))
    ranged = bag.repartitionByRange("_k", "_v").withColumn("_range", F.spark_partition_id()).checkpoint(eager=True)
    upto = Window.partitionBy("_range", "_k").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumn("_end", F.sum("_n").over(upto))
    # one row per key and range it lies in: a key's ranges are as many as its share of all values
    before = (ranged.groupBy("_k", "_range").agg(F.sum("_n").alias("_sum"))
              .withColumn("_before", F.sum("_sum").over(Window.partitionBy("_k").orderBy("_range")) - F.col("_sum"))
              .where("_before > 0").select(F.col("_k").alias("_bk"), F.col("_range").alias("_br"), "_before"))
    placed = local.join(before, (F.col("_range") == F.col("_br")) & F.col("_k").eqNullSafe(F.col("_bk")), "left")
    first = F.coalesce("_before", F.lit(0)) + F.col("_end") - F.col("_n")
    size = F.lit(chunk_size).cast("long")
    covered = placed.select("_k", "_v", first.alias("_first"), (first + F.col("_n")).alias("_until")).select(
        "_k", "_v", "_first", "_until",
        F.explode(F.sequence(F.call_function("div", "_first", size), F.call_function("div", F.col("_until") - 1, size)))
        .alias("_chunk"))
    copies = F.least("_until", (F.col("_chunk") + 1) * size) - F.greatest("_first", F.col("_chunk") * size)
    lists = covered.groupBy("_k", "_chunk").agg(F.sort_array(F.collect_list(F.struct(
        F.col("_v"), copies.cast("int").alias("_c")))).alias("_l"))
    return lists.select(F.col("_k").alias(key), F.col("_chunk").cast("int").alias("chunk"),
                        F.flatten(F.transform("_l", lambda x: F.array_repeat(x["_v"], x["_c"]))).alias(out))


def gather_counts(df: DataFrame, key: str, value: str) -> DataFrame:
    """A1, compact: ``key, value, n`` - the bag of each key as value counts (partial aggregation)."""
    return (df.groupBy(F.col(key), F.col(value).cast("string").alias("value"))
            .agg(F.count(F.lit(1)).alias("n")))


def offset_ranges(messages: DataFrame, topic: str = "topic", partition: str = "partition",
                  offset: str = "offset") -> DataFrame:
    """A2/T5: ``topic, partition, from_offset, until_offset`` (until exclusive) of the rows present."""
    return (messages.groupBy(F.col(topic).alias("topic"), F.col(partition).alias("partition"))
            .agg(F.min(offset).alias("from_offset"), (F.max(offset) + F.lit(1)).alias("until_offset")))


def aggregate_by_key(df: DataFrame, key: str, value: str, zero, seq_op: Callable, comb_op: Callable,
                     finish: Callable = str, result_type: T.DataType = T.StringType(),
                     out: str = "result", most_keys: int = MOST_KEYS) -> DataFrame:
    """User aggregate with a zero value, an add (``seq_op``) and a merge (``comb_op``).

    Every input partition is folded into one accumulator per key, handed on when the task holds
    ``most_keys`` of them. The partials go to their key's partition, sorted by key, and are merged as
    they stream by: a task holds one accumulator and one Arrow batch, however many partials a key
    has, and there is one shuffle. Values and keys travel as Arrow and reach the callbacks as
    Python objects of their own type (a long stays a long beside a NULL, a NULL is None);
    -0.0 is the key 0.0, and NaN is one key. Accumulators travel pickled.
    """
    key_type = df.schema[key].dataType
    floating = isinstance(key_type, (T.FloatType, T.DoubleType))
    k = F.when(F.col(key) == 0, F.lit(0.0)).otherwise(F.col(key)).cast(key_type) if floating else F.col(key)
    rows = df.select(k.alias("k"), F.col(value).alias("v"))
    partial_schema = T.StructType([T.StructField("k", key_type), T.StructField("acc", T.BinaryType())])
    out_schema = T.StructType([T.StructField(key, key_type), T.StructField(out, result_type)])
    k_arrow, out_arrow = to_arrow_type(key_type), to_arrow_type(result_type)

    def partials(accs: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(accs), k_arrow), pa.array(map(pickle.dumps, accs.values()), pa.binary())],
                                          names=["k", "acc"])

    def fold_partition(batches):
        accs: dict = {}
        for batch in batches:
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                accs[k] = seq_op(accs[k] if k in accs else copy.deepcopy(zero), v)
            if len(accs) >= most_keys:
                yield partials(accs)
                accs = {}
        if accs:
            yield partials(accs)

    def results(done: list) -> pa.RecordBatch:
        keys, accs = zip(*done)
        return pa.RecordBatch.from_arrays([pa.array(keys, k_arrow), pa.array([finish(a) for a in accs], out_arrow)],
                                          names=[key, out])

    def merge_sorted(batches):
        held: list = []  # the key being merged and its accumulator, once there is one
        done: list = []
        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                acc = pickle.loads(blob.as_py())
                if held and (held[0] == k or (k != k and held[0] != held[0])):
                    held[1] = comb_op(held[1], acc)
                    continue
                if held:
                    done.append(held)
                held = [k, acc]
            if len(done) >= RESULT_ROWS:
                yield results(done)
                done = []
        if held:
            yield results([*done, held])

    folded = rows.mapInArrow(fold_partition, partial_schema)
    return folded.repartition("k").sortWithinPartitions("k").mapInArrow(merge_sorted, out_schema)


__all__ = ["DEFAULT_CHUNK_SIZE", "gather_values", "gather_counts", "offset_ranges", "aggregate_by_key"]
