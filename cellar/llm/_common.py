"""Helpers shared by the training-data operators: table reads, written intermediates, word patterns."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellar.session import checkpoint_dir, shared_path, ship_code

#: Words of the mixing and near-duplicate operators: runs of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Code on the executors and a checkpoint folder that all of them share."""
    ship_code(spark)
    checkpoint_dir(spark)


#: Bytes of an Arrow batch between Spark and a Python worker, at most (of whole rows).
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """From now on the session hands Python workers batches of ``BATCH_BYTES`` at most."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name, None) or 1 << 30) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function for ``mapInPandas`` or ``mapInArrow`` whose worker gives free memory back when its input ends.

    Spark keeps Python workers for later tasks; without this each holds the most that any of its tasks has needed.
    """
    def work(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim is not None:
            trim(0)

    return work


#: Narrow rows (ids and numbers) that one task writes.
ROWS_PER_TASK = 200_000


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: lineage ends there.

    ``rows``: the most narrow rows that it can have; a small table is then written by few
    tasks, however many shuffle partitions there are, and read by few.

    A lost executor loses nothing of it, and its size is known to the planner.
    The folder is ``<spark.checkpoint.dir>/cellar/llm/<application>/<name>/<unique>``;
    :func:`release` removes an application's folders.
    """
    spark = df.sparkSession
    path = shared_path(spark, "llm", spark.sparkContext.applicationId, name, unique=True)
    if rows is not None:
        df = df.coalesce(groups_for(rows, ROWS_PER_TASK))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Remove the intermediates that this application has written (results must have been saved)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(shared_path(spark, "llm", spark.sparkContext.applicationId))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text column with null as empty, as a string."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def groups_for(rows: int, per_group: int) -> int:
    """How many groups of about ``per_group`` rows hold ``rows`` rows."""
    return max(1, -(-int(rows) // per_group))
