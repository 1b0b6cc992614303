"""The stream forwarder: S7, K3, T1-T6."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellar.plans import fixtures as FX
from cellar.plans.queries._common import register


@register("forward_stream", """SELECT CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(user_id AS VARCHAR) END AS key,
        coalesce(CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(user_id AS VARCHAR) END, '') || ':' || props AS value
    FROM events""")
def forward_stream(spark, sf):
    """File stream of messages -> ``key:value`` -> batch-keyed sink
    (a replayed batch replaces its output), offsets reported per batch, positions in the query
    checkpoint; drained with ``availableNow``."""
    from cellar.session import run_path
    from cellar.streaming import forwarder as S
    src = FX.ensure_message_files(spark, sf)
    run = run_path(spark, "forward")
    q = S.start_forwarder(S.read_message_files(spark, src, files_per_batch=FILES_PER_BATCH), S.folder_sink(f"{run}/out"),
                          f"{run}/checkpoint", report=S.folder_sink(f"{run}/report"),
                          trigger={"availableNow": True})
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(f"{run}/out").select("key", "value")


@register("stream_offset_report", """SELECT 'events' AS topic, CAST(user_id % 3 AS INTEGER) AS partition,
        min(event_id) AS from_offset, max(event_id) + 1 AS until_offset FROM events GROUP BY 2""")
def stream_offset_report(spark, sf):
    """T5: the per-batch offset report of a forwarder run, merged over its batches."""
    from cellar.session import run_path
    from cellar.streaming import forwarder as S
    src = FX.ensure_message_files(spark, sf)
    run = run_path(spark, "report")
    q = S.start_forwarder(S.read_message_files(spark, src, files_per_batch=FILES_PER_BATCH), S.folder_sink(f"{run}/out"),
                          f"{run}/checkpoint", report=S.folder_sink(f"{run}/report"),
                          trigger={"availableNow": True})
    q.awaitTermination()
    rep = spark.read.parquet(f"{run}/report")
    return (rep.groupBy("topic", "partition")
            .agg(F.min("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset")))


#: Files of a micro-batch: a constant, so a batch doesn't grow with the log.
FILES_PER_BATCH = 8


def _half(spark, sf):
    """The messages and the offset that cuts them in two: what a log holds at first, and what is appended later."""
    messages = FX.messages(spark, sf)
    least, most = messages.agg(F.min("offset"), F.max("offset")).first()
    return messages, (least + most) // 2, most - least + 1


_HALF_SQL = """WITH m AS (SELECT CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(user_id AS VARCHAR) END AS key, props, event_id,
        event_id > (SELECT (min(event_id) + max(event_id)) // 2 FROM events) AS late FROM events)"""


def _forward_log(spark, log, run, number, group=None, after_start=None, **options):
    """Forward a log until nothing is left; ``after_start`` runs when the query has reached the log's end."""
    from cellar.sources import message_log as L
    from cellar.streaming import forwarder as S
    q = S.start_forwarder(S.read_message_log(spark, log, **({"group": group} if group else {}), **options),
                          S.folder_sink(f"{run}/out{number}"), f"{run}/checkpoint{number}",
                          report=S.folder_sink(f"{run}/report{number}"), report_of=S.gap_report,
                          trigger={"processingTime": "0 seconds"},
                          positions=L.save_positions(log, group) if group else None)
    try:
        q.processAllAvailable()
        if after_start is not None:
            after_start()
            q.processAllAvailable()
    finally:
        q.stop()


@register("log_start_latest", f"{_HALF_SQL} SELECT key, coalesce(key, '') || ':' || props AS value FROM m WHERE late")
def log_start_latest(spark, sf):
    """A query on a message log without saved positions starts at the newest message."""
    from cellar.session import run_path
    from cellar.sources import message_log as L
    run = run_path(spark, "log_latest")
    log = f"{run}/log"
    messages, half, _ = _half(spark, sf)
    L.append_messages(messages.filter(F.col("offset") <= half), log)
    _forward_log(spark, log, run, 1, after_start=lambda: L.append_messages(messages.filter(F.col("offset") > half), log))
    return spark.read.parquet(f"{run}/out1").select("key", "value")


@register("log_resume_saved", f"""{_HALF_SQL} SELECT CAST(CASE WHEN late THEN 2 ELSE 1 END AS INTEGER) AS run, key,
        coalesce(key, '') || ':' || props AS value FROM m""")
def log_resume_saved(spark, sf):
    """A second query (with a checkpoint of its own) resumes at the positions its group has saved;
    the first one takes a bounded number of messages a batch."""
    from cellar.session import run_path
    from cellar.sources import message_log as L
    run = run_path(spark, "log_resume")
    log = f"{run}/log"
    messages, half, width = _half(spark, sf)
    L.append_messages(messages.filter(F.col("offset") <= half), log)
    _forward_log(spark, log, run, 1, group="forwarder", startingPositions="earliest",
                 maxMessagesPerPartition=str(width // 4 + 1))
    L.append_messages(messages.filter(F.col("offset") > half), log)
    _forward_log(spark, log, run, 2, group="forwarder")
    first, second = (spark.read.parquet(f"{run}/out{n}").select(F.lit(n).alias("run"), "key", "value") for n in (1, 2))
    return first.unionByName(second)


@register("log_gap_report", """SELECT 'events' AS topic, CAST(user_id % 3 AS INTEGER) AS partition, min(event_id) AS from_offset,
        max(event_id) + 1 AS until_offset, count(*) AS messages, max(event_id) + 1 - min(event_id) - count(*) AS missing
    FROM events GROUP BY 2""")
def log_gap_report(spark, sf):
    """T5: the offset ranges of a log's batches, with the offsets that no message has."""
    from cellar.session import run_path
    from cellar.sources import message_log as L
    run = run_path(spark, "log_gaps")
    log = f"{run}/log"
    messages, _, width = _half(spark, sf)
    L.append_messages(messages, log)
    _forward_log(spark, log, run, 1, group="report", startingPositions="earliest", maxMessagesPerPartition=str(width // 2 + 1))
    rep = spark.read.parquet(f"{run}/report1")
    merged = rep.groupBy("topic", "partition").agg(F.min("from_offset").alias("from_offset"),
                                                   F.max("until_offset").alias("until_offset"), F.sum("messages").alias("messages"))
    return merged.withColumn("missing", F.col("until_offset") - F.col("from_offset") - F.col("messages"))
