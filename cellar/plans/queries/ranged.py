"""Tables with a range manifest and the ``wide_table`` format: K1, K2, S3, M1-M3, O1, J2, F1, F2."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from cellar.functions import predicates as P
from cellar.operators import widetable as W
from cellar.operators.ranged_table import RangedTable
from cellar.plans import fixtures as FX
from cellar.plans.queries._common import CELL_OUT, C_SQL, R_SQL, register, stored_cells, stored_rows
from cellar.plans.queries.changes import _UPSERT_CHANGES_SQL, _upsert_changes
from cellar.session import run_path

CELL_KEYS = ("row_key", "family", "qualifier")


def _cell_table(spark, sf) -> RangedTable:
    """The newest cells as a table of ranges of (row_key, family, qualifier)."""
    cells = stored_cells(spark, sf)
    return RangedTable(spark, run_path(spark, "ranged_cells"), CELL_KEYS).create(W.latest_cells(cells))


def _row_table(spark, sf) -> RangedTable:
    return RangedTable(spark, run_path(spark, "ranged_rows")).create(FX.order_rows(spark, sf))


@register("ranged_upsert", f"""WITH {C_SQL}, u AS (SELECT * FROM c UNION ALL {_UPSERT_CHANGES_SQL})
    SELECT row_key, family, qualifier, value, seq FROM (
        SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY ts DESC, seq DESC) AS rn FROM u)
    WHERE rn = 1""")
def ranged_upsert(spark, sf):
    """M2, K2: a batch of cells put into the ranges that it falls in."""
    table = _cell_table(spark, sf)
    table.upsert(_upsert_changes(stored_cells(spark, sf)))
    return table.read().select(*CELL_OUT)


@register("ranged_put", f"""WITH {R_SQL}, late AS (SELECT max(row_key) AS k FROM r)
    SELECT row_key, status, CASE WHEN row_key = late.k THEN 'changed' ELSE priority END AS priority, cust, odate FROM r, late
    UNION ALL SELECT late.k || 'x', 'N', 'added', '0', NULL FROM late""")
def ranged_put(spark, sf):
    """M1: one row changed and one added: one range is rewritten."""
    table = _row_table(spark, sf)
    last = table.ranges()[-1][-1].greatest[0]
    changed = table.scan(start=last).withColumn("priority", F.lit("changed"))
    added = spark.createDataFrame([(last + "x", "N", "added", "0", None)], table.schema())
    table.upsert(changed.unionByName(added))
    return table.read()


@register("ranged_delete", f"WITH {C_SQL} SELECT row_key, family, qualifier, value, seq FROM (SELECT *, "
          "row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY ts DESC, seq DESC) AS rn FROM c) "
          "WHERE rn = 1 AND right(row_key, 1) <> '7'")
def ranged_delete(spark, sf):
    """M3: whole rows dropped from a table of cell ranges."""
    table = _cell_table(spark, sf)
    table.delete(stored_cells(spark, sf).select("row_key").where(F.col("row_key").endswith("7")))
    return table.read().select(*CELL_OUT)


@register("ranged_first_n", f"""WITH {R_SQL} SELECT row_key, priority FROM r
    WHERE priority = '1-URGENT' AND row_key >= '000000000100' ORDER BY row_key LIMIT 40""")
def ranged_first_n(spark, sf):
    """O1, F2: the first matching rows from a start key on; ranges are visited until they are found."""
    found, _ = _row_table(spark, sf).first_n(40, P.column_equals("priority", "1-URGENT"), start="000000000100")
    return found.select("row_key", "priority")


@register("ranged_get_many", f"WITH {R_SQL} SELECT row_key, status, cust FROM r WHERE row_key IN "
          "(SELECT lpad(CAST(l_partkey AS VARCHAR), 12, '0') FROM lineitem)")
def ranged_get_many(spark, sf):
    """The rows of many requested keys (repeated and absent ones too), from the ranges that can hold them."""
    asked = FX.table(spark, sf, "lineitem").select(FX.padded_key(F.col("l_partkey")).alias("row_key"))
    return _row_table(spark, sf).get_many(asked).select("row_key", "status", "cust")


ORDER_CATALOG_JSON = json.dumps({
    "table": {"namespace": "default", "name": "orders_wide"}, "rowkey": "key",
    "columns": {"key": {"cf": "rowkey", "col": "key", "type": "string"},
                **{c: {"cf": "o", "col": c, "type": "string"} for c in ("status", "priority", "cust", "odate")}}})


@register("wide_format", f"WITH {R_SQL} SELECT row_key AS key, status, priority, cust, odate FROM r")
def wide_format(spark, sf):
    """K1, K2, S3: rows written and read through the ``wide_table`` format and its JSON column mapping, five ranges."""
    from cellar.sources import wide_format as X
    path = run_path(spark, "wide_format")
    X.write_wide(FX.order_rows(spark, sf).withColumnRenamed("row_key", "key"), path, ORDER_CATALOG_JSON, n_ranges=5)
    return X.read_wide(spark, path, ORDER_CATALOG_JSON)


@register("wide_format_prefix", f"WITH {R_SQL} SELECT row_key AS key, status FROM r "
          "WHERE (row_key LIKE '00000000001%' OR row_key >= '000000010000') AND status <> 'P'")
def wide_format_prefix(spark, sf):
    """a prefix and a start key given to the format: files of other ranges aren't opened."""
    from cellar.sources import wide_format as X
    path = run_path(spark, "wide_prefix")
    X.write_wide(stored_rows(spark, sf).withColumnRenamed("row_key", "key"), path, ORDER_CATALOG_JSON, n_ranges=8)
    some = X.read_wide(spark, path, ORDER_CATALOG_JSON, prefix="00000000001")
    late = X.read_wide(spark, path, ORDER_CATALOG_JSON, start="000000010000").where(~F.col("key").startswith("00000000001"))
    return some.unionByName(late).where("status <> 'P'").select("key", "status")
