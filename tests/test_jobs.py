"""The three runnable jobs, driven in-process through their command lines."""

import os

import pytest
from pyspark.sql import functions as F

from cellar.plans import jobs
from cellar.streaming import forwarder as S


def _feed(scratch, day, docs):
    d = os.path.join(scratch, "feed", f"dt={day}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "p.json"), "w") as f:
        f.write("\n".join(docs) + "\n")
    return os.path.join(scratch, "feed")


def test_order_report_job_snapshots(spark, scratch):
    users = os.path.join(scratch, "users")
    spark.createDataFrame([("1", "yhxx", "sidno", None, "ID1", 1)],
                          "row_key string, family string, qualifier string, ts timestamp_ntz, value string, seq long") \
        .write.parquet(users)
    feed = _feed(scratch, "20240101", ['{"sUserId":"1","addTime":"a","message":{"orderInfo":[{"orderNo":"o1","address":"x"}]}}'])
    _feed(scratch, "20240102", ['{"sUserId":"1","addTime":"b","message":{"orderInfo":[{"orderNo":"o1","address":"y"},'
                                '{"orderNo":"o2","address":"z"}]}}'])
    out = os.path.join(scratch, "report")
    assert jobs.main(["order-report", "--feed", feed, "--users", users, "--out", out, "20240101"]) == 0
    assert jobs.main(["order-report", "--feed", feed, "--users", users, "--out", out, "20240102"]) == 0
    snaps = spark.read.parquet(out)
    day2 = {r["key"]: r["addressdetail"] for r in snaps.where(F.col("snapshot") == 20240102).collect()}
    assert day2 == {"ID1_MY_o1": "y", "ID1_MY_o2": "z"}          # the newer day wins on o1
    assert snaps.where(F.col("snapshot") == 20240101).count() == 1


def test_forward_job_once(spark, scratch):
    src = os.path.join(scratch, "src")
    spark.createDataFrame([("t", 0, 1, "k", "v")], S.MESSAGE_SCHEMA).write.parquet(src)
    out, ck = os.path.join(scratch, "out"), os.path.join(scratch, "ck")
    assert jobs.main(["forward", "--source", src, "--out", out, "--checkpoint", ck, "--once"]) == 0
    assert [r["value"] for r in spark.read.parquet(out).collect()] == ["k:v"]


def test_phones_job(spark, scratch):
    src = os.path.join(scratch, "phones")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("+8613800000001\tx\n13900000002\ty\n")
    out = os.path.join(scratch, "out")
    assert jobs.main(["phones", "--input", src, "--out", out]) == 0
    assert [r[0] for r in spark.read.text(out).collect()] == ["13800000001,13900000002\t2"]


def test_order_report_job_refuses_a_table_without_snapshots(spark, scratch):
    users = os.path.join(scratch, "users")
    spark.createDataFrame([("1", "yhxx", "sidno", None, "ID1", 1)],
                          "row_key string, family string, qualifier string, ts timestamp_ntz, value string, seq long") \
        .write.parquet(users)
    feed = _feed(scratch, "20240101", ['{"sUserId":"1","addTime":"a","message":{"orderInfo":[{"orderNo":"o1"}]}}'])
    out = os.path.join(scratch, "report")
    spark.createDataFrame([("k", "v")], "key string, v string").write.parquet(out)
    with pytest.raises(ValueError, match="no snapshots"):
        jobs.main(["order-report", "--feed", feed, "--users", users, "--out", out, "20240101"])
