"""The order feed and the flagship job on the FIXTURES.md cases."""

import os

import pytest
from pyspark.sql import functions as F

from cellar.operators import enrich as E
from cellar.plans import etl
from cellar.plans import fixtures as FX
from cellar.session import local_fs_path
from cellar.sources.json_feed import feed_date, read_json_feed
from cellar.streaming import forwarder as S
from tests.conftest import SMALL

DOCS = [
    '{"sUserId":"1","addTime":"t1","message":{"orderInfo":[{"orderNo":"o1","address":"a1","shipTime":"s"},'
    '{"orderNo":"o2","address":"a2","shipTime":5}]}}',
    '{"sUserId":"2","addTime":"t2","message":{"orderInfo":[]}}',
    '{"sUserId":"3","addTime":"t3","message":{"orderInfo":null}}',
    '{"sUserId":"4","addTime":"t4"}',
    '{"sUserId": broken',
    '{"sUserId":"9","addTime":"t9","message":{"orderInfo":[{"orderNo":"o9"}]}}',
]


def feed(scratch, day="20240101"):
    d = os.path.join(scratch, "feed", f"dt={day}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "part-0.json"), "w") as f:
        f.write("\n".join(DOCS) + "\n")
    return os.path.join(scratch, "feed")


def users(spark):
    return spark.createDataFrame([("1", "yhxx", "sidno", None, "ID1", 1), ("9", "yhxx", "sidno", None, None, 2)],
                                 "row_key string, family string, qualifier string, ts timestamp_ntz, value string, seq long")


def test_feed_date_rule():
    assert feed_date(["20170711"]) == "20170711"
    assert len(feed_date([])) == 8 and len(feed_date(["a", "b"])) == 8


def test_explode_is_inner_and_malformed_is_null(spark, scratch):
    docs = read_json_feed(spark, feed(scratch))
    assert docs.count() == 6
    assert docs.where(F.col("sUserId").isNull()).count() == 1          # the malformed line
    flat = etl.flatten_orders(docs)
    got = sorted((r["userid"], r["orderid"], r["ordertime"]) for r in flat.collect())
    assert got == [("1", "o1", "s"), ("1", "o2", "5"), ("9", "o9", None)]   # numbers arrive as text
    assert read_json_feed(spark, feed(scratch), date="20240101").count() == 6


def test_report_missing_lookup_rules(spark, scratch):
    docs = read_json_feed(spark, feed(scratch))
    with pytest.raises(Exception, match="lookup found no value"):
        etl.order_report(docs, users(spark), on_missing="error").collect()
    kept = etl.order_report(docs, users(spark), on_missing="drop").collect()
    assert sorted(r["key"] for r in kept) == ["ID1_MY_o1", "ID1_MY_o2"]
    nulls = etl.order_report(docs, users(spark), on_missing="null").collect()
    assert sorted((r["key"] or "-") for r in nulls) == ["-", "ID1_MY_o1", "ID1_MY_o2"]


def test_report_write_is_range_split_and_upserted(spark, scratch):
    docs = read_json_feed(spark, feed(scratch))
    report = etl.order_report(docs, users(spark), on_missing="drop")
    path = os.path.join(scratch, "report")
    etl.write_report_upserted(report.unionByName(report), path, n_ranges=2)
    back = spark.read.parquet(path)
    assert back.count() == 2 and back.columns[0] == "key"


def test_derived_feed_has_empty_and_null_lists(spark):
    docs = FX.order_feed(spark, SMALL)
    assert docs.where(F.size("message.orderInfo") == 0).count() > 0
    assert docs.where(F.col("message").isNotNull() & F.col("message.orderInfo").isNull()).count() > 0
    assert docs.where(F.col("message").isNull()).count() > 0
    assert etl.explode_orders(docs).count() == FX.table(spark, SMALL, "orders").count()


@pytest.mark.parametrize("n,sizes", [(98, [98]), (99, [99]), (100, [99, 1]), (198, [99, 99]), (250, [99, 99, 52])])
def test_batches_of_99_edges(spark, n, sizes):
    nums = spark.range(n).select(F.format_string("1%010d", "id").alias("number"))
    got = sorted(((r["batch_id"], r["n_values"]) for r in E.batch_requests(nums, "number").collect()))
    assert [s for _, s in got] == sizes


def test_empty_stream_batch(spark, scratch):
    empty = spark.createDataFrame([], S.MESSAGE_SCHEMA)
    S.forward_batch(S.folder_sink(os.path.join(scratch, "o")), report=S.folder_sink(os.path.join(scratch, "r")))(empty, 0)
    assert spark.read.schema("key string, value string").parquet(os.path.join(scratch, "o")).count() == 0


def test_narrow_schema_reads_only_named_fields(spark, scratch):
    from cellar.sources.json_feed import order_doc_schema
    docs = read_json_feed(spark, feed(scratch), schema=order_doc_schema(["orderNo"], top=["sUserId"]))
    assert docs.schema.simpleString().startswith("struct<sUserId:string,message:struct<orderInfo:array<struct<orderNo")
    assert sorted(r["orderInfo"]["orderNo"] for r in etl.explode_orders(docs, with_add_time=False).collect()) == \
        ["o1", "o2", "o9"]


def test_phone_list_quoted_line_break(spark, scratch):
    from cellar.plans.phones import numeric_numbers, phone_numbers, read_phone_list
    p = os.path.join(scratch, "phones")
    os.makedirs(p)
    with open(os.path.join(p, "a.txt"), "w", encoding="utf-8") as f:
        f.write('"138\n0001"\tx\n+8613900000002\ty\n')
    line_based = sorted(r["number"] for r in numeric_numbers(phone_numbers(read_phone_list(spark, p))).collect())
    assert line_based == ["0001", "138", "13900000002"]
    whole = read_phone_list(spark, p, multiline_raw=True)
    got = sorted(r["number"] for r in phone_numbers(whole).collect())
    assert got == ["138\n0001", "13900000002"]


def test_ranged_upsert_same_rows_with_and_without_hot_keys(spark):
    import cellar.plans.etl as ETL
    uniq = spark.range(2000).select(F.format_string("k%05d", "id").alias("key"), F.col("id").cast("string").alias("v"))
    hot = uniq.unionByName(spark.range(3000).select(F.lit("k00007").alias("key"), F.lit("z").alias("v")))
    for df in (uniq, hot):
        fast = sorted(map(tuple, ETL.upsert_ranged(df, n_ranges=4).collect()))
        plain = sorted(map(tuple, ETL.upsert_rows(None, df).collect()))
        assert fast == plain
    assert dict(map(tuple, ETL.upsert_ranged(hot, n_ranges=4).collect()))["k00007"] == "z"


def test_missing_day_fails_loudly(spark, scratch):
    with pytest.raises(Exception, match="(?i)path does not exist|PATH_NOT_FOUND"):
        read_json_feed(spark, feed(scratch), date="20991231").count()


def test_dated_layout_without_a_date_reads_every_day(spark, scratch):
    for day, order in (("20240101", "o1"), ("20240102", "o2")):
        os.makedirs(os.path.join(scratch, "d", day))
        with open(os.path.join(scratch, "d", day, "p.json"), "w") as f:
            f.write('{"sUserId":"1","addTime":"a","message":{"orderInfo":[{"orderNo":"%s"}]}}\n' % order)
    root = os.path.join(scratch, "d")
    assert read_json_feed(spark, root, layout="dated").count() == 2
    assert read_json_feed(spark, root, layout="dated", date="20240102").count() == 1


def test_derived_inputs_follow_their_source(spark, scratch):
    from cellar.plans.queries import queries
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    path = os.path.join(scratch, "events.parquet")
    events.limit(100).write.parquet(path)
    assert queries()["row_callback"](spark, scratch).count() == 100
    events.limit(300).write.mode("overwrite").parquet(path)
    assert queries()["row_callback"](spark, scratch).count() == 300


def test_feed_ranges_grow_with_the_orders_and_keep_every_order(spark, scratch, monkeypatch):
    """narrow rows in ranges of a stated size, packed files; null keys, repeated rows and a busy day stay right."""
    import datetime
    day = datetime.datetime(2024, 1, 2)
    orders = [(i, i % 7, "OFP"[i % 3], day, "1-URGENT") for i in range(400)]
    orders += [(500, 3, "O", None, None), (501, None, "O", day, "5-LOW"), (502, 99, "O", day, "5-LOW"), orders[0]]
    customers = [(i, f"c{i}", ["BUILDING", "MACHINERY", "AUTOMOBILE", "FURNITURE"][i % 4]) for i in range(7)]
    customers += [customers[2], (None, "nobody", "BUILDING")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, "
                          "o_orderpriority string").write.parquet(os.path.join(scratch, "orders.parquet"))
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_mktsegment string").write.parquet(
        os.path.join(scratch, "customer.parquet"))
    monkeypatch.setattr(FX, "FEED_RANGE_ORDERS", 20)
    docs = FX.order_documents(spark, scratch)
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and ", 21)" in plan
    root = local_fs_path(FX.ensure_order_feed(spark, scratch))
    names = [n for _, _, files in os.walk(root) for n in files if n.startswith("part-")]
    assert names and all(n.endswith(".json.gz") for n in names)
    feed_docs = FX.order_feed(spark, scratch)
    got = sorted((r["userid"], r["orderInfo"]["orderNo"]) for r in etl.explode_orders(feed_docs).collect())
    times = {k: sum(c[0] == k for c in customers) for k in range(7)}
    assert got == sorted((str(o[1]), str(o[0])) for o in orders for _ in range(times.get(o[1], 0)))
    assert feed_docs.where("size(message.orderInfo) > 0").count() == 8
    # an order-less document per customer row of three segments, the one without a key among them
    assert feed_docs.where(F.col("dt") == FX.EMPTY_DAY).count() == 8
