"""Literal rows spread over a fixed number of partitions (tests and small parameters only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def literal_rows(spark: SparkSession, rows, schema, partitions: int) -> DataFrame:
    return spark.createDataFrame(rows, schema).repartition(partitions)
