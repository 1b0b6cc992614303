"""Hot keys: three row keys with about a third of all rows each."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellar.operators import aggregate as A
from cellar.operators import mutate as M
from cellar.operators import widetable as W
from cellar.plans import fixtures as FX
from cellar.plans.queries._common import CELL_OUT, register


L_SQL = """l AS (SELECT l_returnflag AS row_key, 'li' AS family, l_linestatus AS qualifier, l_shipdate AS ts,
        CAST(l_partkey AS VARCHAR) AS value, l_orderkey * 8 + l_linenumber AS seq FROM lineitem)"""


@register("hot_latest", f"""WITH {L_SQL} SELECT row_key, family, qualifier, arg_max(value, (ts, seq)) AS value
    FROM l GROUP BY ALL""")
def hot_latest(spark, sf):
    """P10 on hot keys: newest version per cell when each row key holds a third of all cells
    (partial aggregation collapses them before the shuffle)."""
    return W.latest_cells(FX.lineitem_cells(spark, sf)).select("row_key", "family", "qualifier", "value")


@register("hot_gather", """WITH p AS (SELECT l_returnflag, CAST(l_partkey AS VARCHAR) AS v,
        row_number() OVER (PARTITION BY l_returnflag ORDER BY CAST(l_partkey AS VARCHAR)) - 1 AS pos FROM lineitem)
    SELECT l_returnflag, CAST(pos // 10000 AS INTEGER) AS chunk, CAST(count(*) AS INTEGER) AS n_values,
        md5(string_agg(v, ',' ORDER BY v)) AS contents
    FROM p GROUP BY l_returnflag, pos // 10000""")
def hot_gather(spark, sf):
    """A1 on hot keys: the contents of every chunk of 10,000 values."""
    g = A.gather_values(FX.table(spark, sf, "lineitem"), "l_returnflag", "l_partkey", chunk_size=10_000)
    return g.select("l_returnflag", "chunk", F.size("values").alias("n_values"),
                    F.md5(F.array_join("values", ",")).alias("contents"))


@register("hot_upsert", f"""WITH {L_SQL}, u AS (SELECT * FROM l UNION ALL
        SELECT row_key, family, qualifier, ts + INTERVAL 1 DAY, 'r' || value, seq FROM l WHERE qualifier = 'F')
    SELECT row_key, family, qualifier, value, seq FROM (
        SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY ts DESC, seq DESC) AS rn FROM u)
    WHERE rn = 1""")
def hot_upsert(spark, sf):
    """M2 on hot keys: a batch of puts one day newer for every cell version of status F."""
    cells = FX.lineitem_cells(spark, sf)
    changes = cells.where(F.col("qualifier") == "F").select(
        "row_key", "family", "qualifier", (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"),
        F.concat(F.lit("r"), F.col("value")).alias("value"), "seq")
    return M.upsert(cells, changes).select(*CELL_OUT)


@register("hot_delete_latest", f"""WITH {L_SQL},
    ranked AS (SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY ts DESC, seq DESC) AS rn
               FROM l)
    SELECT row_key, qualifier, count(*) AS n_cells, CAST(sum(seq) AS BIGINT) AS seq_sum,
        CAST(max(CASE WHEN rn = 1 + CAST(qualifier = 'O' AS INTEGER) THEN seq END) AS BIGINT) AS newest_seq
    FROM ranked WHERE NOT (rn = 1 AND qualifier = 'O') GROUP BY ALL""")
def hot_delete_latest(spark, sf):
    """M4 on hot keys: drop the newest version of every status-O cell; the anti-join on the
    full version identity spreads each hot cell over many tasks (summed to compare)."""
    cells = FX.lineitem_cells(spark, sf)
    req = cells.where(F.col("qualifier") == "O").select("row_key", "family", "qualifier").distinct()
    kept = M.delete_latest(cells, req)
    return (kept.groupBy("row_key", "qualifier")
            .agg(F.count(F.lit(1)).alias("n_cells"), F.sum("seq").alias("seq_sum"),
                 F.max(F.struct("ts", "seq")).getField("seq").alias("newest_seq")))
