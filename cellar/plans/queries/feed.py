"""The batch ETL over the order feed: S1, S2, P1-P5, J1, M2, K1, K2."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellar.plans import etl
from cellar.plans import fixtures as FX
from cellar.plans.queries._common import REPORT_SQL, register


@register("crawl_order_report", REPORT_SQL)
def crawl_order_report(spark, sf):
    """The flagship job, upserted by key."""
    report = etl.order_report(FX.order_feed(spark, sf), FX.user_cells(spark, sf), on_missing="error")
    return etl.upsert_rows(None, report, key="key")


@register("dated_feed", """SELECT CAST(o_custkey AS VARCHAR) AS userid, CAST(o_orderkey AS VARCHAR) AS orderid,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS addtime
    FROM orders WHERE strftime(o_orderdate, '%Y%m%d') = '19970315'""")
def dated_feed(spark, sf):
    """S1 + S2: one day of the feed, chosen by the partition column (partition pruning)."""
    from cellar.sources.json_feed import feed_date
    day = feed_date(["19970315"])
    docs = FX.order_feed(spark, sf, date=day)
    return etl.explode_orders(docs).select("userid", F.col("orderInfo.orderNo").alias("orderid"), "addtime")


@register("explode_inner", """SELECT CAST(o_custkey AS VARCHAR) AS userid, CAST(o_orderkey AS VARCHAR) AS orderid,
        o_orderstatus AS invoicetype FROM orders""")
def explode_inner(spark, sf):
    """Documents with an empty or NULL order list give no row."""
    from cellar.sources.json_feed import order_doc_schema
    # only the nested fields this query reads are parsed (no nested pruning for JSON)
    docs = FX.order_feed(spark, sf, schema=order_doc_schema(["orderNo", "invoiceType"], top=["sUserId"]))
    return etl.explode_orders(docs, with_add_time=False).select(
        "userid", F.col("orderInfo.orderNo").alias("orderid"), F.col("orderInfo.invoiceType").alias("invoicetype"))


@register("report_table", REPORT_SQL)
def report_table(spark, sf):
    """K1 + K2 + M2: the flagship report deduplicated, then range-split by key, written to the shared folder and read back."""
    from cellar.session import run_path
    path = run_path(spark, "order_report")
    etl.write_report_upserted(etl.order_report(FX.order_feed(spark, sf), FX.user_cells(spark, sf)), path)
    return spark.read.parquet(path)
