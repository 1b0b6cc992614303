"""Table changes: M1-M6, K2."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.functions import predicates as P
from cellar.operators import mutate as M
from cellar.plans import callbacks as CB
from cellar.plans import fixtures as FX
from cellar.plans.queries._common import CELL_OUT, C_SQL, R_SQL, register, stored_cells, stored_rows


_UPSERT_CHANGES_SQL = "SELECT row_key, family, 'click' AS qualifier, ts, 'p' || value AS value, seq + 1000000000000000 AS seq FROM c WHERE qualifier = 'purchase'"


def _upsert_changes(cells: DataFrame) -> DataFrame:
    return cells.where(F.col("qualifier") == "purchase").select(
        "row_key", "family", F.lit("click").alias("qualifier"), "ts",
        F.concat(F.lit("p"), F.col("value")).alias("value"), (F.col("seq") + F.lit(10 ** 15)).alias("seq"))


@register("upsert_cells", f"""WITH {C_SQL}, u AS (SELECT * FROM c UNION ALL {_UPSERT_CHANGES_SQL})
    SELECT row_key, family, qualifier, value, seq FROM (
        SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY ts DESC, seq DESC) AS rn FROM u)
    WHERE rn = 1""")
def upsert_cells(spark, sf):
    """Newest-wins put of a batch of cells."""
    cells = stored_cells(spark, sf)
    return M.upsert(cells, _upsert_changes(cells)).select(*CELL_OUT)


@register("upsert_versions", f"""WITH {C_SQL}, u AS (SELECT * FROM c UNION ALL {_UPSERT_CHANGES_SQL})
    SELECT row_key, family, qualifier, value, seq FROM (
        SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier, ts ORDER BY seq DESC) AS rn FROM u)
    WHERE rn = 1""")
def upsert_versions(spark, sf):
    """M2 keeping versions: a put on an existing version replaces it, other versions stay."""
    cells = stored_cells(spark, sf)
    return M.upsert(cells, _upsert_changes(cells), keep_versions=True).select(*CELL_OUT)


@register("put_one_cell", f"""WITH {C_SQL}, u AS (SELECT * FROM c UNION ALL
        SELECT '000000000007', 'ev', 'click', TIMESTAMP '2030-01-01 00:00:00', 'manual', 0)
    SELECT row_key, family, qualifier, value, seq FROM (
        SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY ts DESC, seq DESC) AS rn FROM u)
    WHERE rn = 1""")
def put_one_cell(spark, sf):
    """M1: put one cell into the whole table (newest wins)."""
    import datetime as _dt
    return M.put_cell(spark, stored_cells(spark, sf), "000000000007", "ev", "click", "manual",
                      ts=_dt.datetime(2030, 1, 1), seq=0).select(*CELL_OUT)


@register("put_default_time", f"""WITH {C_SQL}, u AS (SELECT * FROM c UNION ALL
        SELECT '000000000007', 'ev', 'click', TIMESTAMP '9999-01-01 00:00:00', 'now', NULL)
    SELECT row_key, family, qualifier, value FROM (
        SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY ts DESC, seq DESC) AS rn FROM u)
    WHERE rn = 1""")
def put_default_time(spark, sf):
    """M1: a put without a timestamp is newer than every stored version of its cell."""
    out = M.put_cell(spark, stored_cells(spark, sf), "000000000007", "ev", "click", "now")
    return out.select("row_key", "family", "qualifier", "value")


@register("put_bytes", f"""WITH {C_SQL}, u AS (SELECT row_key, family, qualifier, ts, encode(value) AS value, seq FROM c UNION ALL
        SELECT '000000000007', 'ev', 'click', TIMESTAMP '2030-01-01 00:00:00', from_hex('FF0001'), 0)
    SELECT row_key, family, qualifier, hex(value) AS value_hex, seq FROM (
        SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY ts DESC, seq DESC) AS rn FROM u)
    WHERE rn = 1""")
def put_bytes(spark, sf):
    """M1 on byte values: any bytes round-trip, UTF-8 or not."""
    import datetime as _dt
    cells = M.binary_cells(stored_cells(spark, sf))
    return M.put_cell(spark, cells, "000000000007", "ev", "click", b"\xff\x00\x01", ts=_dt.datetime(2030, 1, 1),
                      seq=0).select("row_key", "family", "qualifier", F.hex("value").alias("value_hex"), "seq")


@register("delete_keys", f"""WITH {C_SQL} SELECT row_key, family, qualifier, value, seq FROM c
    WHERE row_key NOT IN (SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0') FROM customer
                          WHERE c_mktsegment = 'HOUSEHOLD')""")
def delete_keys(spark, sf):
    """M3: delete rows by key (anti join)."""
    keys = (FX.table(spark, sf, "customer").where(F.col("c_mktsegment") == "HOUSEHOLD")
            .select(FX.padded_key(F.col("c_custkey")).alias("row_key")))
    return M.delete_rows(stored_cells(spark, sf), keys).select(*CELL_OUT)


@register("delete_latest", f"""WITH {C_SQL},
    req AS (SELECT DISTINCT row_key FROM c WHERE qualifier = 'error'),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY ts DESC, seq DESC) AS rn
               FROM c)
    SELECT row_key, family, qualifier, value, seq FROM ranked
    WHERE NOT (rn = 1 AND qualifier = 'view' AND family = 'ev' AND row_key IN (SELECT row_key FROM req))""")
def delete_latest(spark, sf):
    """M4: for rows with an error cell, delete the newest ``view`` version (older ones show again)."""
    cells = stored_cells(spark, sf)
    req = (cells.where(F.col("qualifier") == "error").select("row_key").distinct()
           .select("row_key", F.lit(FX.EVENT_FAMILY).alias("family"), F.lit("view").alias("qualifier")))
    return M.delete_latest(cells, req).select(*CELL_OUT)


@register("delete_where", f"WITH {R_SQL} SELECT * FROM r WHERE NOT coalesce(priority = '1-URGENT', false)")
def delete_where(spark, sf):
    """M5: delete rows matching a filter; NULL keeps the row."""
    return M.delete_where(stored_rows(spark, sf), P.column_equals("priority", "1-URGENT"))


@register("delete_where_pred", f"""WITH {R_SQL} SELECT * FROM r
    WHERE NOT (coalesce(status = 'F', false) AND coalesce(odate < '1996-01-01', false))""")
def delete_where_pred(spark, sf):
    """M6 + E3: filter and a caller's predicate (here a pandas UDF)."""
    before_1996 = F.pandas_udf(CB.before_1996, T.BooleanType())
    return M.delete_where_pred(stored_rows(spark, sf), P.column_equals("status", "F"), before_1996("odate"))


@register("delete_rows_where_cells", f"""WITH {C_SQL} SELECT row_key, family, qualifier, value, seq FROM c
    WHERE row_key NOT IN (SELECT row_key FROM c WHERE qualifier = 'signup' AND value LIKE '%7')""")
def delete_rows_where_cells(spark, sf):
    """M5 on the cell form: drop whole rows that have a matching cell."""
    cond = (F.col("qualifier") == "signup") & F.col("value").endswith("7")
    return M.delete_rows_where_cells(stored_cells(spark, sf), cond).select(*CELL_OUT)


@register("range_layout", f"WITH {R_SQL} SELECT * FROM r")
def range_layout(spark, sf):
    """K2: pre-split into the source's 5 key ranges (layout checked in the unit tests)."""
    return M.range_layout(stored_rows(spark, sf), 5)
