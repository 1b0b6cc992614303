import json

import pytest
from pyspark.sql import functions as F

from cellar.operators.ranged_table import RangedTable
from cellar.sources import wide_format as X

CATALOG = json.dumps({"table": {"name": "t"}, "rowkey": "key", "columns": {
    "key": {"cf": "rowkey", "col": "key", "type": "string"}, "a": {"cf": "f", "col": "a", "type": "string"},
    "n": {"cf": "f", "col": "n", "type": "int"}, "x": {"cf": "g", "col": "x", "type": "double"}}})
DDL = "key string, a string, n int, x double"


def rows(n, first=0):
    return [(f"k{i:04d}", None if i % 7 == 0 else f"a{i}", i, i / 2) for i in range(first, first + n)]


def content(df):
    return sorted(map(tuple, df.collect()))


def test_round_trip_in_ranges(spark, scratch):
    path = f"{scratch}/t"
    X.write_wide(spark.createDataFrame(rows(500), DDL), path, CATALOG, 5)
    assert content(X.read_wide(spark, path, CATALOG)) == rows(500)
    files = X.Manifest(path).files()
    assert len(files) == 5 and sum(f["rows"] for f in files) == 500
    assert all(a["greatest"] < b["least"] for a, b in zip(files, files[1:]))


def test_the_plain_spark_api(spark, scratch):
    X.use_wide_tables(spark)
    df = spark.createDataFrame(rows(20), DDL)
    df.write.format("wide_table").mode("overwrite").options(path=f"{scratch}/t", catalog=CATALOG).save()
    df.limit(3).write.format("wide_table").mode("overwrite").options(path=f"{scratch}/t", catalog=CATALOG).save()
    assert spark.read.format("wide_table").options(path=f"{scratch}/t", catalog=CATALOG).load().count() == 3
    with pytest.raises(Exception, match="overwrite"):
        df.write.format("wide_table").mode("append").options(path=f"{scratch}/t", catalog=CATALOG).save()


def test_a_failed_write_leaves_the_old_table(spark, scratch):
    path = f"{scratch}/t"
    X.write_wide(spark.createDataFrame(rows(50), DDL), path, CATALOG, 4)
    bad = spark.createDataFrame(rows(50, 100), DDL).withColumn(
        "a", F.when(F.col("n") == 120, F.raise_error(F.lit("boom")).cast("string")).otherwise("a"))
    with pytest.raises(Exception, match="boom"):
        X.write_wide(bad, path, CATALOG, 4)
    with pytest.raises(Exception, match="without key"):
        X.write_wide(spark.createDataFrame([(None, "a", 1, 1.0)], DDL), path, CATALOG)
    assert X.Manifest(path).version() == 1
    assert content(X.read_wide(spark, path, CATALOG)) == rows(50)


def test_key_ranges_drop_files(spark, scratch):
    path = f"{scratch}/t"
    X.write_wide(spark.createDataFrame(rows(800), DDL), path, CATALOG, 8)
    for start, prefix, most in (("k0750", None, 1), (None, "k07", 3), ("k0305", "k030", 1), ("z", None, 1), (None, "k0799x", 1)):
        found = X.read_wide(spark, path, CATALOG, start, prefix)
        assert found.rdd.getNumPartitions() <= most
        assert content(found) == [r for r in rows(800) if r[0] >= (start or "") and r[0].startswith(prefix or "")]


def test_two_ranges_of_one_table_in_a_query(spark, scratch):
    path = f"{scratch}/t"
    X.write_wide(spark.createDataFrame(rows(300), DDL), path, CATALOG, 6)
    whole = X.read_wide(spark, path, CATALOG)
    both = whole.where(F.col("key") < "k0010").unionByName(whole.where(F.col("key") >= "k0290"))
    assert content(both) == rows(10) + rows(10, 290)
    ranges = X.read_wide(spark, path, CATALOG, prefix="k000").unionByName(X.read_wide(spark, path, CATALOG, start="k0290"))
    assert content(ranges) == rows(10) + rows(10, 290)


def test_which_files_may_match():
    assert X.may_match("b", "d", "c", None) and X.may_match("b", "d", "d", None) and not X.may_match("b", "d", "da", None)
    assert X.may_match("b", "d", None, "c") and X.may_match("bb", "d", None, "b") and not X.may_match("b", "d", None, "da")
    assert not X.may_match("b", "d", None, "a")


def test_a_table_of_the_format_can_be_changed_by_ranges(spark, scratch):
    path = f"{scratch}/t"
    X.write_wide(spark.createDataFrame(rows(400), DDL), path, CATALOG, 4)
    t = RangedTable(spark, path, ("key",))
    assert t.upsert(spark.createDataFrame([("k0005", "new", 1, 0.5)], DDL)) == 1
    got = X.read_wide(spark, path, CATALOG)
    assert got.count() == 400 and got.where("key = 'k0005'").first()["a"] == "new"


def test_an_empty_table(spark, scratch):
    X.write_wide(spark.createDataFrame([], DDL), f"{scratch}/t", CATALOG)
    assert X.read_wide(spark, f"{scratch}/t", CATALOG).count() == 0
