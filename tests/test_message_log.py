import pytest

from cellar.sources import message_log as L
from cellar.streaming import forwarder as S


def messages(first, last, parts=2, topic="t"):
    return [(topic, i % parts, i, None if i % 5 == 0 else str(i), f"v{i}") for i in range(first, last)]


def append(spark, log, rows, files=3):
    L.append_messages(spark.createDataFrame(rows, L.MESSAGE_SCHEMA), log, files)


def forward(spark, root, number, positions=None, **options):
    return S.start_forwarder(S.read_message_log(spark, f"{root}/log", **options), S.folder_sink(f"{root}/out{number}"),
                             f"{root}/ck{number}", report=S.folder_sink(f"{root}/report{number}"), report_of=S.gap_report,
                             trigger={"processingTime": "0 seconds"}, positions=positions)


def drained(q):
    q.processAllAvailable()
    q.stop()


def values(spark, root, number):
    return sorted(int(r["value"].split("v")[1]) for r in spark.read.parquet(f"{root}/out{number}").collect())


def test_starts_at_the_newest_message_and_resumes_from_its_checkpoint(spark, scratch):
    append(spark, f"{scratch}/log", messages(0, 20))
    q = forward(spark, scratch, 1)
    q.processAllAvailable()
    append(spark, f"{scratch}/log", messages(20, 30) + messages(0, 4, topic="new"))
    drained(q)
    assert values(spark, scratch, 1) == sorted([*range(20, 30), *range(4)])  # a new topic from its first message
    append(spark, f"{scratch}/log", messages(30, 33))
    drained(forward(spark, scratch, 1))
    assert values(spark, scratch, 1) == sorted([*range(20, 33), *range(4)])


def test_positions_given_and_earliest(spark, scratch):
    append(spark, f"{scratch}/log", messages(0, 20))
    drained(forward(spark, scratch, 1, startingPositions="earliest"))
    drained(forward(spark, scratch, 2, startingPositions='{"t": {"0": 10, "1": 15}}'))
    assert values(spark, scratch, 1) == list(range(20))
    assert values(spark, scratch, 2) == [10, 12, 14, 15, 16, 17, 18, 19]


def test_a_group_resumes_where_it_saved(spark, scratch):
    log = f"{scratch}/log"
    append(spark, log, messages(0, 20))
    drained(forward(spark, scratch, 1, L.save_positions(log, "g"), group="g", startingPositions="earliest"))
    assert L.Log(log).positions("g") == {"t": {"0": 19, "1": 20}}
    append(spark, log, messages(20, 26))
    drained(forward(spark, scratch, 2, L.save_positions(log, "g"), group="g"))  # a checkpoint of its own
    assert values(spark, scratch, 2) == list(range(20, 26))
    drained(forward(spark, scratch, 3, group="other"))
    L.Log(log).save("g", {"t": {"0": 3}})  # positions never go back
    assert L.Log(log).positions("g") == {"t": {"0": 25, "1": 26}}


def test_batches_are_bounded_also_after_a_restart(spark, scratch):
    log = f"{scratch}/log"
    append(spark, log, messages(0, 50))
    options = {"group": "g", "startingPositions": "earliest", "maxMessagesPerPartition": "12"}
    drained(forward(spark, scratch, 1, **options))
    append(spark, log, messages(50, 100))
    drained(forward(spark, scratch, 1, **options))
    assert values(spark, scratch, 1) == list(range(100))
    report = spark.read.parquet(f"{scratch}/report1").collect()
    assert max(r["until_offset"] - r["from_offset"] for r in report) <= 12
    assert max(r["batch_id"] for r in report) >= 8
    with pytest.raises(Exception, match="needs a group"):
        drained(forward(spark, scratch, 2, maxMessagesPerPartition="12"))


def test_ranges_of_the_query_progress(spark, scratch):
    append(spark, f"{scratch}/log", messages(0, 30))
    q = forward(spark, scratch, 1, group="g", startingPositions="earliest", maxMessagesPerPartition="10")
    q.processAllAvailable()
    got = [r for r in S.progress_offsets(q.recentProgress) if r[0] > 0]
    q.stop()
    assert got == [(1, "t", 0, 10, 20), (1, "t", 1, 11, 21), (2, "t", 0, 20, 29), (2, "t", 1, 21, 30)]


def test_gaps_are_reported(spark, scratch):
    rows = [("t", 0, i, "k", f"v{i}") for i in (3, 4, 7, 11)] + [("t", 1, 5, None, "v5")] * 2
    got = S.gap_report(spark.createDataFrame(rows, L.MESSAGE_SCHEMA)).collect()
    assert sorted(map(tuple, got)) == [("t", 0, 3, 12, 4, 5), ("t", 1, 5, 6, 1, 0)]


@pytest.mark.parametrize("strict", [True, False])
def test_messages_that_are_gone(spark, scratch, strict):
    append(spark, f"{scratch}/log", messages(10, 20))  # the log's first ten have expired
    q = forward(spark, scratch, 1, startingPositions='{"t": {"0": 2, "1": 11}}', failOnDataLoss=str(strict).lower())
    if strict:
        with pytest.raises(Exception, match="failOnDataLoss"):
            drained(q)
        return
    drained(q)
    assert values(spark, scratch, 1) == [10, *range(11, 20)]


def test_an_append_is_seen_whole_or_not_at_all(spark, scratch):
    log = f"{scratch}/log"
    append(spark, log, messages(0, 10))
    # data files of an append whose index entry was never renamed into place
    spark.createDataFrame(messages(10, 20), L.MESSAGE_SCHEMA).write.parquet(f"{log}/data/unfinished")
    drained(forward(spark, scratch, 1, startingPositions="earliest"))
    assert values(spark, scratch, 1) == list(range(10))


def test_an_empty_log(spark, scratch):
    append(spark, f"{scratch}/log", [])
    q = forward(spark, scratch, 1)
    q.processAllAvailable()
    append(spark, f"{scratch}/log", messages(0, 3))
    drained(q)
    assert values(spark, scratch, 1) == [0, 1, 2]


def test_a_hot_partition_spreads_over_files(spark, scratch):
    append(spark, f"{scratch}/log", messages(0, 3000, parts=1), files=6)
    segments = L.Log(f"{scratch}/log").segments()
    assert len(segments) >= 5 and max(s.next - s.first for s in segments) < 1500
