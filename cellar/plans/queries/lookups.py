"""Key lookups as joins: J1-J4."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellar.operators import lookup as J
from cellar.operators import widetable as W
from cellar.plans import fixtures as FX
from cellar.plans.queries._common import (C_ROWS_SQL, C_SQL, EVENT_CATALOG, EVENT_TYPES, R_SQL, register,
                                          stored_cells, stored_rows)


@register("lookup_left", f"""WITH {C_SQL},
    lp AS (SELECT row_key, arg_max(value, (ts, seq)) AS last_purchase FROM c WHERE qualifier = 'purchase'
           GROUP BY row_key)
    SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS row_key, CAST(o_custkey AS VARCHAR) AS cust,
           lp.last_purchase
    FROM orders LEFT JOIN lp ON lpad(CAST(o_custkey AS VARCHAR), 12, '0') = lp.row_key""")
def lookup_left(spark, sf):
    """J1 with ``on_missing='null'``: each order gets its customer's newest purchase event."""
    rows = stored_rows(spark, sf).select("row_key", "cust", FX.padded_key(F.col("cust")).alias("_ck"))
    lk = J.lookup_table(stored_cells(spark, sf), FX.EVENT_FAMILY, "purchase", "last_purchase", key_name="_pk")
    return J.enrich(rows, lk, "_ck", "_pk", ["last_purchase"], on_missing="null").drop("_ck")


_BATCH_GET_SQL = f"""WITH {C_SQL}, {C_ROWS_SQL}
    SELECT o_orderkey AS pos, lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS row_key,
           {", ".join(f"c_rows.{t}" for t in EVENT_TYPES)}
    FROM orders LEFT JOIN c_rows{{cond}} ON lpad(CAST(o_custkey AS VARCHAR), 12, '0') = c_rows.row_key"""


@register("batch_get", _BATCH_GET_SQL.format(cond=""))
def batch_get(spark, sf):
    """One result per requested key (duplicates kept, NULLs where absent), request position kept."""
    keys = FX.table(spark, sf, "orders").select(F.col("o_orderkey").alias("pos"),
                                                 FX.padded_key(F.col("o_custkey")).alias("row_key"))
    return J.batch_get(keys, W.to_rows(stored_cells(spark, sf), EVENT_CATALOG))


@register("batch_get_filtered", _BATCH_GET_SQL.replace("LEFT JOIN c_rows{cond}",
                                                       "LEFT JOIN (SELECT * FROM c_rows WHERE purchase IS NOT NULL) c_rows"))
def batch_get_filtered(spark, sf):
    """As J2, the table filtered first - a key whose row fails comes back empty."""
    keys = FX.table(spark, sf, "orders").select(F.col("o_orderkey").alias("pos"),
                                                 FX.padded_key(F.col("o_custkey")).alias("row_key"))
    return J.batch_get(keys, W.to_rows(stored_cells(spark, sf), EVENT_CATALOG), condition=F.col("purchase").isNotNull())


@register("point_get", f"""WITH {R_SQL} SELECT * FROM r WHERE row_key = '000000000777' AND status <> 'X'""")
def point_get(spark, sf):
    """One key plus a filter."""
    return J.point_get(stored_rows(spark, sf), "000000000777", condition=F.col("status") != "X")


@register("salted_lookup", f"""WITH {C_SQL},
    lp AS (SELECT row_key, arg_max(value, (ts, seq)) AS last_view FROM c WHERE qualifier = 'view' GROUP BY row_key)
    SELECT l_orderkey, l_linenumber, lp.last_view
    FROM lineitem LEFT JOIN lp ON lpad(CAST(l_suppkey AS VARCHAR), 12, '0') = lp.row_key""")
def salted_lookup(spark, sf):
    """J1 with explicit salting: every line item looks up its supplier's newest view event."""
    li = FX.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                                FX.padded_key(F.col("l_suppkey")).alias("_k"))
    lk = J.lookup_table(stored_cells(spark, sf), FX.EVENT_FAMILY, "view", "last_view", key_name="_pk")
    return J.enrich(li, lk, "_k", "_pk", ["last_view"], on_missing="null", salt_buckets=8).drop("_k")
