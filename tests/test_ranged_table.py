import random

import pytest
from pyspark.sql import functions as F

from cellar.functions import predicates as P
from cellar.operators import mutate as M
from cellar.operators import ranged_table as R

CELLS = ("row_key", "family", "qualifier")


def cells(spark, rows):
    return spark.createDataFrame(rows, M.CELL_SCHEMA).select("row_key", "family", "qualifier", "ts", "seq", "value")


def some_cells(n, seq=0, value="v", step=1):
    from datetime import datetime
    return [(f"{i:06d}", "f", f"q{i % 2}", datetime(2020, 1, 1, 0, seq), f"{value}{i}", seq) for i in range(0, n * step, step)]


def table(spark, scratch, rows, n_ranges=8):
    return R.RangedTable(spark, f"{scratch}/table", CELLS).create(cells(spark, rows), n_ranges)


def content(df):
    return sorted(map(tuple, df.collect()))


def test_a_put_rewrites_one_range_of_many(spark, scratch):
    base, put = some_cells(4000), some_cells(1, seq=1, value="new")
    t = table(spark, scratch, base)
    files = {f.file for g in t.ranges() for f in g}
    assert len(files) == 8
    assert t.upsert(cells(spark, put)) == 1
    now = {f.file for g in t.ranges() for f in g}
    assert len(files & now) == 7
    assert content(t.read()) == content(M.upsert(cells(spark, base), cells(spark, put)))


@pytest.mark.parametrize("seed", range(3))
def test_upserts_and_deletes_equal_those_on_the_whole_table(spark, scratch, seed):
    rng = random.Random(seed)
    base = some_cells(900, step=3)
    t = table(spark, scratch, base, 6)
    whole = cells(spark, base)
    for turn in range(3):
        keys = sorted(rng.sample(range(-5, 2800), rng.choice((1, 4, 40))))
        from datetime import datetime
        put = [(f"{max(k, 0):06d}" if k >= 0 else f"-{k}", "f", f"q{k % 2}", datetime(2020, 1, 2, 0, turn), f"p{turn}", turn)
               for k in keys]
        t.upsert(cells(spark, put))
        whole = spark.createDataFrame(M.upsert(whole, cells(spark, put)).collect(), whole.schema)
        gone = spark.createDataFrame([(f"{k:06d}",) for k in rng.sample(range(2700), 5)], "row_key string")
        t.delete(gone)
        whole = spark.createDataFrame(M.delete_rows(whole, gone).collect(), whole.schema)
        assert content(t.read()) == content(whole)
        tops = [(g[0].least, max(f.greatest for f in g)) for g in t.ranges()]
        assert all(a[1] < b[0] for a, b in zip(tops, tops[1:]))  # ranges never overlap
    assert sum(f.rows for g in t.ranges() for f in g) == whole.count()


def test_a_hot_row_spreads_over_ranges_and_a_put_touches_few(spark, scratch):
    from datetime import datetime
    hot = [("hot", "f", f"q{i:05d}", datetime(2020, 1, 1), "v", 0) for i in range(3000)]
    t = table(spark, scratch, hot + some_cells(300))
    assert len(t.ranges()) >= 6
    assert t.upsert(cells(spark, [("hot", "f", "q00007", datetime(2021, 1, 1), "new", 1)])) == 1
    assert t.read().where("value = 'new'").count() == 1 and t.read().count() == 3300
    t.delete(spark.createDataFrame([("hot",)], "row_key string"))
    assert t.read().count() == 300


def test_versions_of_one_cell_over_several_files_are_one_range(spark, scratch):
    from datetime import datetime, timedelta
    rows = [("k", "f", "q", datetime(2020, 1, 1) + timedelta(seconds=i), f"v{i}", i) for i in range(2000)]
    t = R.RangedTable(spark, f"{scratch}/table", CELLS)
    parts = cells(spark, rows).repartition(4)
    files = t._written(parts)  # versions dealt over files, as a writer of another order would leave them
    t._commit(1, parts.schema, files)
    assert len(t.ranges()) == 1 and len(t.ranges()[0]) == 4
    assert t.upsert(cells(spark, [("k", "f", "q", datetime(2030, 1, 1), "last", 9)])) == 4
    assert [r["value"] for r in t.read().collect()] == ["last"]


def test_a_failed_write_leaves_the_table_readable(spark, scratch):
    t = table(spark, scratch, some_cells(200))
    before, version = content(t.read()), t.version()
    with pytest.raises(Exception, match="boom"):
        t.rewrite(t.read().limit(1), lambda old: old.withColumn("value", F.raise_error(F.lit("boom")).cast("string")))
    with pytest.raises(Exception, match="without row_key"):
        t.upsert(cells(spark, [(None, "f", "q", some_cells(1)[0][3], "x", 1)]))
    assert t.version() == version and content(t.read()) == before


def test_a_second_writer_of_a_version_fails(spark, scratch):
    t = table(spark, scratch, some_cells(50))
    with pytest.raises(RuntimeError, match="another writer"):
        t._commit(t.version(), t.schema(), [])


def test_a_limit_scan_visits_the_ranges_it_needs(spark, scratch):
    t = table(spark, scratch, some_cells(4000))
    rows, seen = t.first_n(5)
    assert seen == 1 and [r["row_key"] for r in rows.collect()] == [f"{i:06d}" for i in range(5)]
    rows, seen = t.first_n(3, start="002000")
    assert seen <= 2 and [r["row_key"] for r in rows.collect()] == ["002000", "002001", "002002"]
    rows, seen = t.first_n(2, F.col("value") == "v3999")
    assert [r["value"] for r in rows.collect()] == ["v3999"] and seen == len(t.ranges())
    rows, _ = t.first_n(10, prefix="00012")
    assert [r["row_key"] for r in rows.collect()] == [f"{i:06d}" for i in range(120, 130)]
    assert t.first_n(3, prefix="zz")[0].isEmpty()


def test_scans_read_only_files_that_can_match(spark, scratch):
    t = table(spark, scratch, some_cells(4000))
    whole = t.read()
    for start, prefix in (("003500", None), (None, "0001"), ("001000", "001"), ("zz", None)):
        got = t.scan(P.column_equals("qualifier", "q1"), start, prefix)
        want = whole.where("qualifier = 'q1'")
        want = want.where(F.col("row_key") >= start) if start else want
        want = want.where(F.col("row_key").startswith(prefix)) if prefix else want
        assert content(got) == content(want)
        assert len(t.files_for(start, prefix)) < 8


def scanned_rows(df):
    """Rows that the file scan of an executed plan has put out."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size())
               if leaves.apply(i).metrics().contains("numOutputRows"))


def test_lookups_read_the_ranges_of_their_keys(spark, scratch):
    t = table(spark, scratch, some_cells(4000, step=2))
    keys = spark.createDataFrame([("000010",), ("000010",), ("000011",), (None,), ("007000",)], "row_key string")
    assert sorted(r["row_key"] for r in t.get_many(keys).collect()) == ["000010", "007000"]
    assert len(t.touched(keys.where("row_key is not null"))) == 2
    absent = t.get_many(spark.createDataFrame([("000011",), ("005001",)], "row_key string"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert scanned_rows(absent) == 0  # inside the ranges' least and greatest keys, but no row group holds them
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    many = spark.createDataFrame([(f"{i:06d}",) for i in range(3000)], "row_key string")
    assert t.get_many(many).count() == 1500


def test_delete_where_and_vacuum(spark, scratch):
    t = table(spark, scratch, some_cells(1000))
    assert 0 < t.delete_where(F.col("value") == "v17", prefix="0000") <= 2
    assert t.read().count() == 999
    assert t.delete_where(F.col("value") == "nothing") == 0
    assert t.vacuum() >= 1 and t.read().count() == 999 and t.vacuum() == 0


def test_rows_with_one_key_column_and_an_empty_table(spark, scratch):
    rows = [(f"k{i:03d}", f"a{i}", i) for i in range(200)]
    t = R.RangedTable(spark, f"{scratch}/rows", ("key",)).create(spark.createDataFrame(rows, "key string, a string, n int"), 4)
    assert t.upsert(spark.createDataFrame([("k003", "new", 1), ("k0031", None, None)], "key string, a string, n int")) == 1
    got = {r["key"]: r["a"] for r in t.read().collect()}
    assert len(got) == 201 and got["k003"] == "new" and got["k0031"] is None and got["k004"] == "a4"
    empty = R.RangedTable(spark, f"{scratch}/none", ("key",)).create(spark.createDataFrame([], "key string, a string"))
    assert empty.read().isEmpty() and empty.first_n(3)[0].isEmpty()
    assert empty.get_many(spark.createDataFrame([("x",)], "key string")).isEmpty()
    empty.upsert(spark.createDataFrame([("x", "1"), ("y", "2")], "key string, a string"))
    assert content(empty.read()) == [("x", "1"), ("y", "2")]
