"""One row key holding a third of all rows: results stay whole and exact, the hot key is
collapsed by partial aggregation before any shuffle, and no window holds it in one task."""

import datetime as dt

from pyspark.sql import functions as F

from cellar.operators import aggregate as A
from cellar.operators import lookup as J
from cellar.operators import mutate as M
from cellar.operators import widetable as W

T0 = dt.datetime(2024, 1, 1)


def skewed_cells(spark, n=30_000):
    ids = spark.range(n)
    return ids.select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.format_string("k%05d", "id")).alias("row_key"),
                      F.lit("f").alias("family"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("qualifier"),
                      (F.lit(T0) + F.make_interval(secs=(F.col("id") % 1000).cast("int"))).cast("timestamp_ntz").alias("ts"),
                      F.col("id").cast("string").alias("value"), F.col("id").alias("seq"))


def test_newest_version_on_hot_key_is_exact_and_partial(spark):
    cells = skewed_cells(spark)
    latest = W.latest_cells(cells).where("row_key = 'hot'").orderBy("qualifier").collect()
    # ids divisible by 3: newest by (ts = id % 1000, seq = id)
    hot_a = max((i % 1000, i) for i in range(0, 30_000, 6))
    hot_b = max((i % 1000, i) for i in range(3, 30_000, 6))
    assert [r["value"] for r in latest] == [str(hot_a[1]), str(hot_b[1])]
    plan = W.latest_cells(cells)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_upsert_and_delete_latest_on_hot_key(spark):
    cells = skewed_cells(spark)
    changes = cells.where("row_key = 'hot'").select("row_key", "family", "qualifier",
                                                     (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("ts"),
                                                     F.concat(F.lit("new"), "value").alias("value"), "seq")
    up = M.upsert(cells, changes).where("row_key = 'hot'").collect()
    assert all(r["value"].startswith("new") for r in up) and len(up) == 2
    req = spark.createDataFrame([("hot", "f", "a")], "row_key string, family string, qualifier string")
    after = M.delete_latest(cells, req)
    assert after.count() == cells.count() - 1
    plan = after._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_gather_and_lookup_on_hot_key(spark):
    cells = skewed_cells(spark)
    g = A.gather_values(cells, "row_key", "seq", chunk_size=1_000).where("row_key = 'hot'").collect()
    assert len(g) == 10 and {len(r["values"]) for r in g} == {1_000}
    assert sum(len(r["values"]) for r in g) == 10_000
    lk = W.latest_cells(cells).where("qualifier = 'a'").select("row_key", F.col("value").alias("v"))
    out = J.enrich(cells.select("row_key", "seq"), lk, "row_key", "row_key", ["v"], on_missing="null", salt_buckets=4)
    assert out.where("row_key = 'hot'").count() == 10_000


def test_cell_table_write_splits_a_hot_row(spark, scratch):
    cells = skewed_cells(spark)
    path = scratch + "/cells"
    M.write_table(cells, path, n_ranges=6)
    per_file = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("row_key") == "hot", 1).otherwise(0)).alias("hot"))
    rows = per_file.collect()
    assert sum(r["n"] for r in rows) == 30_000
    assert sum(1 for r in rows if r["hot"] > 0) >= 2          # the hot row spans several files
    assert max(r["n"] for r in rows) < 30_000 * 0.5


def test_lookup_with_collapsed_copies(spark):
    cells = skewed_cells(spark)
    lk = W.latest_cells(cells).where("qualifier = 'a'").select("row_key", F.col("value").alias("v"))
    probe = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.lit("k00001")).alias("row_key"))
    out = J.enrich(probe, lk, "row_key", "row_key", ["v"], on_missing="null", collapse_copies=True)
    plain = J.enrich(probe, lk, "row_key", "row_key", ["v"], on_missing="null")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, plain.collect()))
    assert out.count() == 9000
