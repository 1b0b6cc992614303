import os

from cellar.streaming import forwarder as S


def test_kafka_options_mapping():
    o = S.kafka_source_options("h:9092", ["a", "b"], group_id="g")
    assert o["subscribe"] == "a,b" and o["startingOffsets"] == "latest" and o["kafka.group.id"] == "g"
    assert o["kafka.max.partition.fetch.bytes"] == "10485760"
    assert S.kafka_sink_options("h:9092", "out") == {"kafka.bootstrap.servers": "h:9092", "topic": "out"}


def test_kafka_records_without_key(spark):
    df = spark.createDataFrame([("k", "v")], "key string, value string")
    assert S.kafka_records(df, key=None).first().asDict() == {"key": None, "value": "v"}


def _batch(spark, path, rows):
    spark.createDataFrame(rows, S.MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_forwarder_restarts_from_checkpoint(spark, scratch):
    src, out, rep, ck = (os.path.join(scratch, n) for n in ("src", "out", "rep", "ck"))
    _batch(spark, src, [("t", 0, 0, "a", "x"), ("t", 1, 1, None, "y")])

    def run():
        q = S.start_forwarder(S.read_message_files(spark, src, files_per_batch=1), S.folder_sink(out), ck,
                              report=S.folder_sink(rep), trigger={"availableNow": True})
        q.awaitTermination()
        assert q.exception() is None

    run()
    got = sorted((r["key"] or "", r["value"]) for r in spark.read.parquet(out).collect())
    assert got == [("", ":y"), ("a", "a:x")]
    _batch(spark, src, [("t", 0, 2, "b", "z")])
    run()
    batches = spark.read.parquet(out)
    assert batches.count() == 3
    assert sorted(r["batch_id"] for r in batches.select("batch_id").distinct().collect()) == [0, 1]
    report = sorted(tuple(r) for r in spark.read.parquet(rep).select("partition", "from_offset", "until_offset", "batch_id").collect())
    assert report == [(0, 0, 1, 0), (0, 2, 3, 1), (1, 1, 2, 0)]


def test_replayed_batch_replaces_its_output(spark, scratch):
    out, rep = os.path.join(scratch, "o"), os.path.join(scratch, "r")
    batch = spark.createDataFrame([("t", 0, 5, "k", "v"), ("t", 0, 6, None, "w")], S.MESSAGE_SCHEMA)
    run = S.forward_batch(S.folder_sink(out), report=S.folder_sink(rep))
    run(batch, 7)
    run(batch, 7)     # at-least-once: the same batch again after a restart
    assert spark.read.parquet(out).count() == 2
    assert spark.read.parquet(rep).count() == 1


def test_kafka_reader_is_wired_to_the_connector(spark):
    import pytest
    with pytest.raises(Exception, match="(?i)kafka"):
        S.read_kafka(spark, S.kafka_source_options("localhost:1", "t"))


def test_processing_time_trigger_picks_up_new_files(spark, scratch):
    import time
    src, out, ck = (os.path.join(scratch, n) for n in ("src", "out", "ck"))
    _batch(spark, src, [("t", 0, 0, "a", "x")])
    q = S.start_forwarder(S.read_message_files(spark, src), S.folder_sink(out), ck,
                          trigger={"processingTime": "1 second"}, query_name="fwd_test")
    try:
        q.processAllAvailable()
        _batch(spark, src, [("t", 0, 1, "b", "y")])
        deadline = time.time() + 60
        while time.time() < deadline:
            q.processAllAvailable()
            if spark.read.parquet(out).count() == 2:
                break
            time.sleep(0.5)
    finally:
        q.stop()
    assert sorted(r["value"] for r in spark.read.parquet(out).collect()) == ["a:x", "b:y"]


def test_progress_offsets_from_kafka_progress():
    prog = [{"batchId": 3, "sources": [{"description": "KafkaV2[Subscribe[t]]",
                                        "startOffset": {"t": {"0": 10, "1": 4}},
                                        "endOffset": {"t": {"0": 15, "1": 4}}}]},
            {"batchId": 4, "sources": [{"description": "FileStreamSource", "startOffset": {"logOffset": 1},
                                        "endOffset": {"logOffset": 2}}]}]
    got = S.progress_offsets(prog)
    assert sorted(got) == [(3, "t", 0, 10, 15), (3, "t", 1, 4, 4)]
