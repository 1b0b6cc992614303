"""Phone-list enrichment: tab-separated lines -> clean numbers -> batches of 99 ->
service call per batch -> ``numbers <TAB> response`` lines.

The source runs this on one machine, one line at a time; here every step is a
column expression or a distributed stage, and the batches are called in parallel.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellar.functions import scalar as X
from cellar.operators import enrich as E


def read_phone_list(spark: SparkSession, path: str, encoding: str = "UTF-8", multiline_raw: bool = False) -> DataFrame:
    """Raw records as ``line``. D13: line-based by default (a quoted line break starts a new
    record); ``multiline_raw=True`` keeps a quoted line break inside its record."""
    if multiline_raw:
        from cellar.sources.delimited import DelimitedOptions, read_records
        opts = DelimitedOptions(delimiter="\t", charset=encoding, skip_empty_records=False)
        return read_records(spark, path, opts, multiline_raw=True).select(F.col("raw").alias("line"))
    return spark.read.option("encoding", encoding).text(path).withColumnRenamed("value", "line")


def phone_numbers(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """X1 -> X2 -> X4 -> X5: the first field of each line, quotes removed, trimmed, normalised."""
    fields = X.split_keep_trailing(X.strip_double_quotes(line_col), "\t")
    return lines.withColumn("number", X.normalise_phone(X.first_field_or_empty(fields)))


def numeric_numbers(numbers: DataFrame, allow_blank: bool = False) -> DataFrame:
    """F11 + D6: keep the all-digit numbers (blank ones only with ``allow_blank``)."""
    return numbers.where(X.is_numeric("number", allow_blank=allow_blank))


def enrich_phone_list(lines: DataFrame, call: Callable[[str], str | None] = E.count_service,
                      size: int = E.BATCH_SIZE, allow_blank: bool = False, **call_options) -> DataFrame:
    """The whole job: ``batch_id, n_values, numbers, response, line`` (D10: every number kept,
    the last partial batch sent, bounded retries, no trailing comma)."""
    nums = numeric_numbers(phone_numbers(lines), allow_blank=allow_blank)
    batches = E.batch_requests(nums, "number", size=size)
    called = E.call_batches(batches, call, **call_options)
    return called.withColumn("line", F.concat(F.col("numbers"), F.lit("\t"), F.col("response")))


__all__ = ["read_phone_list", "phone_numbers", "numeric_numbers", "enrich_phone_list"]
