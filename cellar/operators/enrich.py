"""Caller code on partitions, rows and batches.

* E1 opens a resource once per partition, closes it in ``finally``.
* E2 hands Arrow batches of rows to a vectorised callback.
* E5 numbers values globally (exact, distributed), cuts them into fixed-size
  batches, joins each batch into one request text and calls a service per
  batch with bounded retries. Nothing passes through the driver: copies
  collapse to counts first, positions come from a range shuffle plus per-range
  sums (a table of one row per range), the batches are built by ``groupBy``
  (each holds at most ``size`` values) and the calls run in ``mapInPandas`` tasks.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.session import checkpoint_dir

# Values per service call, and the pause before a retry in the source.
BATCH_SIZE = 99
RETRY_PAUSE_SECONDS = 30.0


def map_partitions_with_resource(df: DataFrame, open_resource: Callable[[], object],
                                 fn: Callable[[object, pd.DataFrame], pd.DataFrame], schema,
                                 close: Callable[[object], None] | None = None) -> DataFrame:
    """``fn(resource, batch)`` over every Arrow batch; the resource is opened once per partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = open_resource()
        try:
            for pdf in batches:
                yield fn(resource, pdf)
        finally:
            if close is not None:
                close(resource)

    return df.mapInPandas(run, schema)


def map_rows(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """E2 (result form): a vectorised per-row callback over Arrow batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)

    return df.mapInPandas(run, schema)


def for_each_batch(df: DataFrame, fn: Callable[[pd.DataFrame], None]) -> None:
    """E2 (side-effect form): call ``fn`` on every Arrow batch of rows, on the executors.

    Runs as one Spark job (a ``mapInPandas`` stage into the ``noop`` sink), so
    failed tasks are retried by Spark; ``fn`` should be idempotent.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fn(pdf)
        yield pd.DataFrame({"n": pd.Series([], dtype="int64")})

    df.mapInPandas(run, "n long").write.format("noop").mode("overwrite").save()


# --- E5 ----------------------------------------------------------------------------------------

def global_index(df: DataFrame, order: Sequence[str], index_col: str = "idx",
                 n_ranges: int | None = None) -> DataFrame:
    """Exact 0-based position of every row in ``order``, computed without a single-task window.

    Rows are range-partitioned and sorted; each row's position inside its range
    and the range id are fixed by a reliable checkpoint (so a lost executor
    cannot renumber them); the start of each range is the running count of the
    ranges before it, over a table of one row per range (broadcast - its size is
    the number of ranges).

    Rows with equal ``order`` values share a range, so this suits (nearly)
    distinct keys; for values repeated across much of the input, collapse them
    to counts and use :func:`weighted_positions`, as :func:`batch_requests` does.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = n_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *[F.col(c) for c in order]).sortWithinPartitions(*order)
              .withColumn("_range", F.spark_partition_id())
              .withColumn("_local", F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    frozen = ranged.checkpoint(eager=True)
    counts = frozen.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_start"))
    return (frozen.join(F.broadcast(starts), "_range")
            .withColumn(index_col, F.col("_start") + F.col("_local"))
            .drop("_range", "_local", "_start"))


def weighted_positions(bag: DataFrame, order_col: str, weight_col: str, n_ranges: int | None = None) -> DataFrame:
    """Start position of each (distinct) ``order_col`` value when it counts ``weight_col`` times.

    The values are range-partitioned and sorted, and each task adds up its range as it
    goes; ranges and sums are fixed by a reliable checkpoint. The total of the ranges
    before (a table of one row per range, broadcast) gives each value's first
    position. One shuffle in all.
    """
    spark = bag.sparkSession
    checkpoint_dir(spark)
    n = n_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (bag.repartitionByRange(n, F.col(order_col)).sortWithinPartitions(order_col)
              .withColumn("_range", F.spark_partition_id()))
    schema = T.StructType([*ranged.schema.fields, T.StructField("_cum", T.LongType())])

    def running(batches):
        total = 0
        for batch in batches:
            sums = pc.add(pc.cumulative_sum(batch.column(weight_col).cast(pa.int64())), total)
            if len(sums):
                total = sums[-1].as_py()
            yield pa.RecordBatch.from_arrays([*batch.columns, sums], names=[*batch.schema.names, "_cum"])

    local = ranged.mapInArrow(running, schema).checkpoint(eager=True)
    totals = local.groupBy("_range").agg(F.max("_cum").alias("_t"))
    starts = totals.select("_range", (F.sum("_t").over(Window.orderBy("_range")) - F.col("_t")).alias("_r0"))
    return (local.join(F.broadcast(starts), "_range")
            .withColumn("start", F.col("_r0") + F.col("_cum") - F.col(weight_col))
            .drop("_range", "_cum", "_r0"))


# Batches one exploded row may expand into inside a single task; longer runs are cut first.
BATCHES_PER_PIECE = 10_000


def batch_requests(values: DataFrame, value_col: str, size: int = BATCH_SIZE, sep: str = ",",
                   n_ranges: int | None = None) -> DataFrame:
    """E5 (first half): ``batch_id, n_values, numbers`` - consecutive groups of ``size`` values in
    value order, joined with ``sep``; the last group may be partial (D10).

    Copies collapse first to ``(value, n)``, so one value repeated across a large
    share of the input is one row; values are numbered by weighted positions;
    each value then goes to the batches its positions ``[start, start + n)``
    cover, with the number of copies in each. A value spanning very many
    batches is cut into pieces that are spread over tasks before expanding.
    Each batch holds at most ``size`` values.
    """
    bag = values.groupBy(F.col(value_col)).agg(F.count(F.lit(1)).alias("_n"))
    pos = weighted_positions(bag, value_col, "_n", n_ranges=n_ranges)
    sz = F.lit(size).cast("long")
    first = F.floor(F.col("start") / sz).cast("long")
    last = F.floor((F.col("start") + F.col("_n") - 1) / sz).cast("long")
    per = F.lit(BATCHES_PER_PIECE).cast("long")
    pieces = (pos.select(value_col, "start", "_n", first.alias("_b0"), last.alias("_b1"))
              .withColumn("_p", F.explode(F.sequence(F.floor(F.col("_b0") / per).cast("long"),
                                                     F.floor(F.col("_b1") / per).cast("long"))))
              .repartition(F.col(value_col), F.col("_p")))
    lo = F.greatest(F.col("_b0"), F.col("_p") * per)
    hi = F.least(F.col("_b1"), (F.col("_p") + 1) * per - 1)
    placed = pieces.select(value_col, "start", "_n", F.explode(F.sequence(lo, hi)).alias("batch_id"))
    copies = (F.least(F.col("start") + F.col("_n"), (F.col("batch_id") + 1) * sz)
              - F.greatest(F.col("start"), F.col("batch_id") * sz))
    entries = F.array_sort(F.collect_list(F.struct(F.col(value_col).alias("v"), copies.cast("int").alias("c"))))
    batches = placed.groupBy("batch_id").agg(F.sum(copies).alias("n_values"), entries.alias("_e"))
    text = F.array_join(F.flatten(F.transform("_e", lambda e: F.array_repeat(e["v"], e["c"]))), sep)
    return batches.select("batch_id", "n_values", text.alias("numbers"))


def call_batches(batches: DataFrame, call: Callable[[str], str | None], max_attempts: int = 5,
                 pause_seconds: float = RETRY_PAUSE_SECONDS, backoff: float = 2.0,
                 on_exhausted: str = "error", request_col: str = "numbers",
                 sleep: Callable[[float], None] = time.sleep, concurrency: int = 1) -> DataFrame:
    """E5 (second half): ``call(request)`` once per batch row; an empty or missing answer is retried
    up to ``max_attempts`` times with a growing pause (D10 (c)). When every attempt
    comes back empty the task fails (``on_exhausted='error'``) or the response is NULL.

    Batches are spread over tasks; ``concurrency > 1`` also keeps that many calls in
    flight inside a task (the calls wait on the service, not on the CPU). A re-run task
    calls its batches again, so the service should tolerate repeats (at-least-once)."""
    if on_exhausted not in ("error", "null"):
        raise ValueError("on_exhausted must be 'error' or 'null'")
    schema = T.StructType([*batches.schema.fields, T.StructField("response", T.StringType())])

    def one(request: str) -> str | None:
        wait = pause_seconds
        for attempt in range(max_attempts):
            answer = call(request)
            if answer:
                return answer
            if attempt + 1 < max_attempts:
                sleep(wait)
                wait *= backoff
        if on_exhausted == "error":
            raise RuntimeError(f"service gave no answer after {max_attempts} attempts")
        return None

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pool = ThreadPoolExecutor(max_workers=concurrency) if concurrency > 1 else None
        try:
            for pdf in parts:
                requests = pdf[request_col].tolist()
                answers = list(pool.map(one, requests)) if pool else [one(r) for r in requests]
                yield pdf.assign(response=answers)
        finally:
            if pool:
                pool.shutdown(wait=True)

    return batches.mapInPandas(run, schema)


def result_lines(called: DataFrame, request_col: str = "numbers") -> DataFrame:
    """K4: ``numbers <TAB> response`` text lines."""
    return called.select(F.concat(F.col(request_col), F.lit("\t"), F.col("response")).alias("value"))


def write_lines(lines: DataFrame, path: str) -> None:
    """K4 (D3): a directory of text part files."""
    lines.write.mode("overwrite").text(path)


def count_service(request: str) -> str:
    """A local stand-in for the remote service: answers with the number of values in the request."""
    return str(len(request.split(","))) if request else ""


__all__ = ["BATCH_SIZE", "RETRY_PAUSE_SECONDS", "map_partitions_with_resource", "map_rows", "for_each_batch",
           "global_index", "weighted_positions", "batch_requests", "call_batches", "result_lines", "write_lines", "count_service"]
