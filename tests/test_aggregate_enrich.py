import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.operators import aggregate as A
from cellar.operators import enrich as E
from cellar.plans.phones import enrich_phone_list
from cellar.sources.literal import literal_rows

PAIRS = [("oak", 4), ("elm", 2), ("oak", 4), ("elm", 7), ("ash", 4), ("oak", 9)]


def test_gather_values_pairs(spark):
    df = literal_rows(spark, PAIRS, "k string, v int", 3)
    assert df.rdd.getNumPartitions() == 3
    got = {r["k"]: r["values"] for r in A.gather_values(df, "k", "v").collect()}
    assert got == {"oak": ["4", "4", "9"], "elm": ["2", "7"], "ash": ["4"]}


def test_gather_values_hot_key_is_chunked_and_whole(spark):
    df = spark.range(10_000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    out = A.gather_values(df, "k", "v", chunk_size=1000).collect()
    assert [len(r["values"]) for r in out] == [1000] * 10
    ordered = [v for r in sorted(out, key=lambda r: r["chunk"]) for v in r["values"]]
    assert ordered == sorted(ordered)
    assert sorted(int(v) for r in out for v in r["values"]) == list(range(10_000))


def test_gather_counts(spark):
    df = literal_rows(spark, PAIRS, "k string, v int", 3)
    assert sorted(map(tuple, A.gather_counts(df, "k", "v").collect())) == [("ash", "4", 1), ("elm", "2", 1), ("elm", "7", 1), ("oak", "4", 2), ("oak", "9", 1)]


def test_aggregate_by_key_lists(spark):
    df = literal_rows(spark, PAIRS, "k string, v int", 3)
    out = A.aggregate_by_key(df, "k", "v", [], lambda acc, v: acc + [str(v)], lambda a, b: a + b,
                             finish=lambda acc: ",".join(sorted(acc)))
    assert dict(map(tuple, out.collect())) == {"oak": "4,4,9", "elm": "2,7", "ash": "4"}


def test_offset_ranges(spark):
    msgs = spark.createDataFrame([("t", 0, 5), ("t", 0, 9), ("t", 1, 3)], "topic string, partition int, offset long")
    got = sorted(map(tuple, A.offset_ranges(msgs).collect()))
    assert got == [("t", 0, 5, 10), ("t", 1, 3, 4)]


def test_global_index_exact(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("n"))
    idx = E.global_index(df, ["n"], n_ranges=6).collect()
    assert sorted((r["n"], r["idx"]) for r in idx) == [(i, i) for i in range(5000)]


def test_batches_of_99(spark):
    df = spark.range(250).select(F.format_string("%05d", "id").alias("number"))
    b = {r["batch_id"]: r for r in E.batch_requests(df, "number").collect()}
    assert [b[i]["n_values"] for i in range(3)] == [99, 99, 52]
    assert not b[0]["numbers"].endswith(",") and b[2]["numbers"].startswith("00198")


def test_call_batches_retries_then_answers(spark):
    calls = {}

    def flaky(req):
        calls[req] = calls.get(req, 0) + 1
        return "ok" if calls[req] >= 3 else ""

    b = spark.createDataFrame([(0, "1,2")], "batch_id long, numbers string").coalesce(1)
    out = E.call_batches(b, flaky, max_attempts=3, pause_seconds=0, sleep=lambda s: None).first()
    assert out["response"] == "ok"
    with pytest.raises(Exception, match="no answer after 2 attempts"):
        E.call_batches(b, lambda r: "", max_attempts=2, pause_seconds=0, sleep=lambda s: None).collect()
    assert E.call_batches(b, lambda r: None, max_attempts=1, on_exhausted="null").first()["response"] is None


def test_phone_job_end_to_end(spark, scratch):
    lines = spark.createDataFrame([('"+86138 0000 0001"\tx',), ("\t",), ("abc\t1",), ("*139#0000\t2",)], "line string")
    out = enrich_phone_list(lines, max_attempts=1).collect()
    assert [(r["numbers"], r["response"]) for r in out] == [("1390000", "1")]
    lines2 = spark.createDataFrame([("13800000001\tx",), ("",)], "line string")
    out2 = enrich_phone_list(lines2, allow_blank=True, max_attempts=1).first()
    assert out2["numbers"] == ",13800000001" and out2["n_values"] == 2
    E.write_lines(E.result_lines(E.call_batches(E.batch_requests(
        spark.createDataFrame([("1",)], "number string"), "number"), E.count_service)), scratch + "/out")
    assert spark.read.text(scratch + "/out").first()[0] == "1\t1"


def test_partition_resource_opened_once_and_closed(spark):
    df = spark.range(0, 100, 1, 4)

    def fn(res, pdf):
        return pdf.assign(tag=res["name"])

    out = E.map_partitions_with_resource(df, lambda: {"name": "r"}, fn, "id long, tag string",
                                         close=lambda r: r.clear())
    assert out.where("tag = 'r'").count() == 100
    rows = E.map_rows(df, lambda pdf: pdf.assign(id=pdf["id"] * 2), "id long").agg(F.sum("id")).first()[0]
    assert rows == 2 * sum(range(100))


def test_gather_values_hot_null_key(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 4000, F.lit(None)).otherwise(F.lit("k")).alias("k"),
                                  F.col("id").alias("v"))
    out = A.gather_values(df, "k", "v", chunk_size=500).collect()
    assert sorted((r["k"] or "", r["chunk"], len(r["values"])) for r in out) == [("", i, 500) for i in range(8)] + [
        ("k", i, 500) for i in range(2)]
    assert sorted(int(v) for r in out for v in r["values"]) == list(range(5000))


def test_gather_values_many_copies_of_few_values(spark):
    """Values with about a chunk of copies each: chunks are exact, sorted and whole."""
    df = spark.range(110 * 970).select(F.lit("hot").alias("k"), F.format_string("v%03d", F.col("id") % 110).alias("v"))
    out = sorted(A.gather_values(df, "k", "v", chunk_size=1000).collect(), key=lambda r: r["chunk"])
    assert [r["chunk"] for r in out] == list(range(107)) and {len(r["values"]) for r in out[:-1]} == {1000}
    assert [v for r in out for v in r["values"]] == sorted(f"v{i % 110:03d}" for i in range(110 * 970))


def test_aggregate_by_key_keeps_types(spark):
    """NULLs beside longs above 2**53, and a NULL key."""
    rows = [("a", 1), ("a", None), ("a", 2**60 + 1), (None, 5), (None, None)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(3)
    out = A.aggregate_by_key(df, "k", "v", [], lambda acc, v: acc + [v], lambda a, b: a + b,
                             finish=lambda acc: ",".join(sorted(map(repr, acc))))
    assert {r["k"]: r["result"] for r in out.collect()} == {"a": f"1,{2**60 + 1},None", None: "5,None"}


def test_aggregate_by_key_accumulator_none(spark):
    """An accumulator that is None isn't a missing one."""
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3)], "k string, v long").coalesce(1)
    out = A.aggregate_by_key(df, "k", "v", 0, lambda acc, v: None if acc == 0 else v, lambda a, b: b)
    assert out.first()["result"] == "3"


def test_aggregate_by_key_many_partials(spark):
    df = spark.range(0, 4000, 1, 40).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    out = A.aggregate_by_key(df, "k", "v", (0, 0), lambda a, v: (a[0] + 1, a[1] + v),
                             lambda a, b: (a[0] + b[0], a[1] + b[1]), finish=lambda a: f"{a[0]}:{a[1]}")
    assert out.collect()[0]["result"] == f"4000:{sum(range(4000))}"
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


def test_aggregate_by_key_small_batches_and_odd_keys(spark):
    """Partials of a key in several batches; NaN, -0.0 and NULL keys; tasks that hand on early."""
    nan = float("nan")
    rows = [(k, i) for i in range(60) for k in (nan, -0.0, 0.0, None, float(i % 4))]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        df = spark.createDataFrame(rows, "k double, v int").repartition(6)
        out = A.aggregate_by_key(df, "k", "v", 0, lambda a, v: a + v, lambda a, b: a + b, finish=lambda a: a,
                                 result_type=T.LongType(), most_keys=2).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    total = sum(range(60))
    got = {"nan" if r["k"] is not None and r["k"] != r["k"] else r["k"]: r["result"] for r in out}
    assert len(out) == 6 and got == {"nan": total, None: total, 1.0: sum(range(1, 60, 4)), 2.0: sum(range(2, 60, 4)),
                                     3.0: sum(range(3, 60, 4)), 0.0: 2 * total + sum(range(0, 60, 4))}


def test_aggregate_by_key_of_no_rows(spark):
    df = spark.createDataFrame([], "k string, v int")
    assert A.aggregate_by_key(df, "k", "v", 0, lambda a, v: a + v, lambda a, b: a + b).collect() == []


def test_gather_values_group_of_copies(spark):
    # a third of all rows are one identical (key, value) copy
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit("k")).otherwise(F.format_string("u%d", "id")).alias("k"),
                                  F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("v"))
    out = A.gather_values(df, "k", "v", chunk_size=500).where("k = 'k'").collect()
    assert len(out) == 6 and all(len(r["values"]) == 500 for r in out)
    assert sum(len(r["values"]) for r in out) == 3000 and {v for r in out for v in r["values"]} == {"7"}


def test_call_batches_concurrent_keeps_order(spark):
    import time as _t
    b = spark.createDataFrame([(i, f"{i},x") for i in range(40)], "batch_id long, numbers string").coalesce(2)

    def slow(req):
        _t.sleep(0.01)
        return "r" + req.split(",")[0]

    out = E.call_batches(b, slow, concurrency=8).collect()
    assert all(r["response"] == f"r{r['batch_id']}" for r in out) and len(out) == 40


def test_batches_with_a_hot_repeated_number(spark):
    # a third of the list is one number repeated; batches stay exact and bounded
    vals = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("13800000000"))
                                    .otherwise(F.format_string("139%08d", "id")).alias("number"))
    got = {r["batch_id"]: r for r in E.batch_requests(vals, "number", size=99).collect()}
    expect = sorted(["13800000000"] * 1000 + [f"139{i:08d}" for i in range(3000) if i % 3])
    assert sorted(got) == list(range(31))
    flat = [n for b in sorted(got) for n in got[b]["numbers"].split(",")]
    assert flat == expect and all(got[b]["n_values"] == len(got[b]["numbers"].split(",")) <= 99 for b in got)


def test_batch_pieces_for_very_long_runs(spark):
    old = E.BATCHES_PER_PIECE
    E.BATCHES_PER_PIECE = 3
    try:
        vals = spark.range(1000).select(F.lit("5").alias("number"))
        got = sorted((r["batch_id"], r["n_values"]) for r in E.batch_requests(vals, "number", size=99).collect())
    finally:
        E.BATCHES_PER_PIECE = old
    assert got == [(i, 99) for i in range(10)] + [(10, 10)]
