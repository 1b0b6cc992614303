"""Aggregations: A1, A2, E4."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellar.operators import aggregate as A
from cellar.plans import callbacks as CB
from cellar.plans import fixtures as FX
from cellar.plans.queries._common import register


@register("gather_values", """SELECT l_orderkey, 0 AS chunk,
        string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY CAST(l_linenumber AS VARCHAR)) AS values_text,
        count(*) AS n_values
    FROM lineitem GROUP BY l_orderkey""")
def gather_values(spark, sf):
    """A1: the line numbers of every order as text (chunked gather; an order is one chunk)."""
    li = FX.table(spark, sf, "lineitem")
    g = A.gather_values(li, "l_orderkey", "l_linenumber")
    return g.select("l_orderkey", "chunk", F.array_join("values", ",").alias("values_text"),
                    F.size("values").cast("long").alias("n_values"))


@register("gather_counts", """SELECT l_returnflag, CAST(l_linenumber AS VARCHAR) AS value, count(*) AS n
    FROM lineitem GROUP BY ALL""")
def gather_counts(spark, sf):
    """A1, compact exact form: the bag of line numbers per return flag as value counts."""
    return A.gather_counts(FX.table(spark, sf, "lineitem"), "l_returnflag", "l_linenumber")


@register("offset_report", """SELECT 'events' AS topic, CAST(user_id % 3 AS INTEGER) AS partition,
        min(event_id) AS from_offset, max(event_id) + 1 AS until_offset
    FROM events GROUP BY 2""")
def offset_report(spark, sf):
    """A2/T5: consumed range per topic and partition."""
    return A.offset_ranges(FX.messages(spark, sf))


@register("user_aggregate_types", """SELECT l_returnflag, CAST(count(*) AS VARCHAR) || ':' || CAST(count(v) AS VARCHAR) || ':'
        || CAST(sum(v) AS VARCHAR) AS result
    FROM (SELECT l_returnflag, CASE WHEN l_linenumber = 3 THEN NULL ELSE 1152921504606846976 + l_orderkey END AS v FROM lineitem)
    GROUP BY l_returnflag""")
def user_aggregate_types(spark, sf):
    """Values with NULLs and longs above 2**53 reach the callbacks unchanged."""
    li = FX.table(spark, sf, "lineitem").select("l_returnflag", F.when(F.col("l_linenumber") != 3, F.lit(1 << 60) + F.col("l_orderkey")).alias("v"))
    return A.aggregate_by_key(li, "l_returnflag", "v", (0, 0, 0), CB.exact_add, CB.exact_merge, CB.exact_text)


@register("user_aggregate", """SELECT l_returnflag, CAST(count(*) AS VARCHAR) || ':' || CAST(sum(l_linenumber) AS VARCHAR)
        AS result FROM lineitem GROUP BY l_returnflag""")
def user_aggregate(spark, sf):
    """Zero / add / merge aggregate on three keys that each hold about a third of the rows."""
    li = FX.table(spark, sf, "lineitem")
    return A.aggregate_by_key(li, "l_returnflag", "l_linenumber", (0, 0), CB.count_sum_add, CB.count_sum_merge,
                              CB.count_sum_text)
