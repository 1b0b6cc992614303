"""Shared pieces of the registered queries: the registry, the derived tables in SQL form
(for the oracles) and their Spark readers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cellar.operators import widetable as W
from cellar.plans import fixtures as FX


QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


C_SQL = """c AS (SELECT lpad(CAST(user_id AS VARCHAR), 12, '0') AS row_key, 'ev' AS family,
        event_type AS qualifier, ts, CAST(event_id AS VARCHAR) AS value, event_id AS seq FROM events)"""
R_SQL = """r AS (SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS row_key, o_orderstatus AS status,
        CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS priority,
        CAST(o_custkey AS VARCHAR) AS cust, strftime(o_orderdate, '%Y-%m-%d') AS odate FROM orders)"""
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
EVENT_CATALOG = W.Catalog(table="events_wide", columns=tuple(W.ColumnSpec(t, FX.EVENT_FAMILY, t)
                                                             for t in EVENT_TYPES))
C_ROWS_SQL = "c_rows AS (SELECT row_key, " + ", ".join(
    f"arg_max(value, (ts, seq)) FILTER (WHERE qualifier = '{t}') AS {t}" for t in EVENT_TYPES
) + " FROM c GROUP BY row_key)"
H_SQL = r"""h AS (SELECT c_custkey, (CASE c_custkey % 8
          WHEN 0 THEN b WHEN 1 THEN '+86' || b WHEN 2 THEN '  ' || b || chr(9) || ' '
          WHEN 3 THEN '"' || b || '"' WHEN 4 THEN substr(b, 1, 3) || '*' || substr(b, 4, 8) || '#'
          WHEN 5 THEN 'tel' || b WHEN 6 THEN '' ELSE '+' || b || '*' END)
          || chr(9) || c_name || chr(9) || c_mktsegment AS line
        FROM (SELECT *, '1' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS b FROM customer))"""
PHONE_NUMBER_SQL = r"""regexp_replace(regexp_replace(split_part(replace(line, '"', ''), chr(9), 1),
        '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g'), '\+86|#|\+|\*', '', 'g')"""
REPORT_SQL = """SELECT c.c_name || '_MY_' || CAST(o.o_orderkey AS VARCHAR) AS key,
        c.c_mktsegment || ' road ' || CAST(o.o_custkey AS VARCHAR) AS addressdetail,
        c.c_name AS addressname, '1' || lpad(CAST(o.o_custkey AS VARCHAR), 10, '0') AS addressphone,
        strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS addtime, o.o_orderpriority AS invoicetitle,
        o.o_orderstatus AS invoicetype, CAST(o.o_orderkey AS VARCHAR) AS orderid,
        strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS ordertime, CAST(o.o_custkey AS VARCHAR) AS userid
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""


def stored_cells(spark, sf):
    """C as the stored cell table (range-split and sorted by row key)."""
    return FX.event_cell_table(spark, sf)


def stored_rows(spark, sf):
    """R as the stored row table (range-split and sorted by row key)."""
    return FX.order_table(spark, sf)


CELL_OUT = ["row_key", "family", "qualifier", "value", "seq"]
