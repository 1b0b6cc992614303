"""Run operators with injected task failures (first attempt of some tasks raises) on a session
that retries tasks, and print whether each result equals the failure-free result.

Run by tests/test_recovery.py in its own process (it needs its own SparkContext).
"""

import datetime as dt
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pandas as pd  # noqa: E402
from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from cellar.operators import aggregate as A  # noqa: E402
from cellar.operators import enrich as E  # noqa: E402
from cellar.operators import mutate as M  # noqa: E402
from cellar.operators import widetable as W  # noqa: E402
from cellar.session import get_session  # noqa: E402


def fail_first_attempt(s: pd.Series) -> pd.Series:
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        raise RuntimeError("injected task failure")
    return s


def main():
    spark = get_session("local[4, 4]", app="cellar-recovery", shuffle_partitions=6)
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cellar-recovery-"))
    flaky = F.pandas_udf(fail_first_attempt, T.LongType())
    t0 = dt.datetime(2024, 1, 1)
    base = spark.range(0, 20_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.format_string("k%d", F.col("id") % 500)).alias("row_key"),
        F.lit("f").alias("family"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("qualifier"),
        (F.lit(t0) + F.make_interval(secs=(F.col("id") % 997).cast("int"))).cast("timestamp_ntz").alias("ts"),
        F.col("id").cast("string").alias("value"), F.col("id").alias("seq"))

    def with_failures(df):
        # fails before the first shuffle (map side) ...
        return df.withColumn("seq", flaky("seq"))

    def after_shuffle(df):
        # ... and after it (reduce side)
        return df.repartition(5).withColumn("_x", flaky(F.lit(1).cast("long"))).drop("_x")

    def rows(df):
        return sorted(tuple(str(v) for v in r) for r in df.collect())

    checks = {
        "gather": lambda c: A.gather_values(c, "row_key", "value", chunk_size=700),
        "latest": lambda c: W.latest_cells(c),
        "upsert": lambda c: M.upsert(c, c.where("qualifier = 'a'").withColumn("value", F.lit("x"))),
        "delete_latest": lambda c: M.delete_latest(c, c.select("row_key", "family", "qualifier").distinct()),
        "numbering": lambda c: E.batch_requests(c.select(F.col("value").alias("number")), "number", size=99),
    }
    for name, op in checks.items():
        clean = rows(op(base))
        noisy = rows(after_shuffle(op(with_failures(base))))
        print(f"RECOVERY {name} {'same' if clean == noisy else 'DIFFERENT'} {len(clean)}")
    spark.stop()


if __name__ == "__main__":
    main()
