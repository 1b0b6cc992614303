"""Message forwarding between streams.

``readStream`` -> ``key:value`` -> ``writeStream.foreachBatch``: each micro-batch
first appends its offset report (T5), then forwards its messages (T6). The
query's checkpoint replaces the source's external offset store: positions are
committed only after the batch function returns (T4), so a restart replays the
last uncommitted batch - at-least-once. Both writes are keyed by ``batch_id``
(overwrite of that batch's folder), so a replay replaces instead of duplicating.

Kafka needs the ``spark-sql-kafka`` package on the classpath; it is not part of
the development image, so there only the option mapping is checked and the
forwarder itself is tested on a file stream.
"""

from __future__ import annotations

import ast
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cellar.functions.scalar import message_text
from cellar.operators.aggregate import offset_ranges
from cellar.sources.message_log import MESSAGE_SCHEMA, read_message_log

# Fixed values of the source job: batch interval, fetch size limit (bytes).
BATCH_INTERVAL = "5 seconds"
FETCH_MAX_BYTES = 10_485_760

Sink = Callable[[DataFrame, int], None]


# --- sources -----------------------------------------------------------------------------------

def kafka_source_options(bootstrap_servers: str, topics: list[str] | str, group_id: str | None = None,
                         starting_offsets: str = "latest", extra: dict | None = None) -> dict:
    """S7 + T2: reader options. Without a checkpoint the query starts at ``starting_offsets``
    (the newest message by default); with one it resumes where the last committed batch ended."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topics if isinstance(topics, str) else ",".join(topics),
        "startingOffsets": starting_offsets,
        "kafka.max.partition.fetch.bytes": str(FETCH_MAX_BYTES),
        "failOnDataLoss": "true",
    }
    if group_id:
        opts["kafka.group.id"] = group_id
    opts.update(extra or {})
    return opts


def read_kafka(spark: SparkSession, options: dict) -> DataFrame:
    """A Kafka topic as a stream of ``topic, partition, offset, key, value`` (text)."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select("topic", "partition", "offset", F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"))


def read_message_files(spark: SparkSession, path: str, fmt: str = "parquet", files_per_batch: int | None = None,
                       schema: T.StructType = MESSAGE_SCHEMA) -> DataFrame:
    """A folder of message files as a stream with the same columns (tests, backfills)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


# --- sinks -------------------------------------------------------------------------------------

def kafka_records(df: DataFrame, key: str | None = "key", value: str = "value") -> DataFrame:
    """K3: ``key, value`` records; ``key=None`` sends without a key."""
    k = F.col(key) if key else F.lit(None).cast("string")
    return df.select(k.alias("key"), F.col(value).alias("value"))


def kafka_sink_options(bootstrap_servers: str, topic: str, extra: dict | None = None) -> dict:
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
    opts.update(extra or {})
    return opts


def kafka_sink(options: dict) -> Sink:
    """K3 inside ``foreachBatch``: write one micro-batch to a topic."""
    def write(df: DataFrame, batch_id: int) -> None:
        kafka_records(df).write.format("kafka").options(**options).save()
    return write


def folder_sink(path: str, fmt: str = "parquet") -> Sink:
    """A batch-keyed folder sink: batch N goes to ``path/batch_id=N``, replaced on replay."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch_id={batch_id}")
    return write


# --- the forwarder -----------------------------------------------------------------------------

def forward_messages(messages: DataFrame) -> DataFrame:
    """T6 (+P13, D11): the forwarded record - key unchanged, value ``key:value``."""
    return messages.select(F.col("key"), message_text("key", "value").alias("value"))


def gap_report(messages: DataFrame) -> DataFrame:
    """T5 with gaps: ``topic, partition, from_offset, until_offset, messages, missing`` - the offsets of a
    range that no message has (expired, compacted or never written). Repeated messages count once."""
    once = messages.groupBy("topic", "partition", "offset").agg(F.lit(1).alias("one"))
    ranges = once.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset"), F.count("one").alias("messages"))
    return ranges.withColumn("missing", F.col("until_offset") - F.col("from_offset") - F.col("messages"))


def forward_batch(sink: Sink, report: Sink | None = None,
                  report_of: Callable[[DataFrame], DataFrame] = offset_ranges,
                  positions: Callable[[DataFrame], None] | None = None) -> Callable[[DataFrame, int], None]:
    """The function run on each micro-batch - report offsets (T5), then forward (T6), then save positions (T4).

    ``report_of``: what is reported of a batch, :func:`gap_report` for instance. ``positions``:
    saves a batch's positions outside the checkpoint (``message_log.save_positions``).
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        # the batch feeds two writes: keep it so the source is read once per batch
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if report is not None:
                report(report_of(batch).withColumn("batch_id", F.lit(batch_id)), batch_id)
            sink(forward_messages(batch), batch_id)
            if positions is not None:
                positions(batch)
        finally:
            batch.unpersist()
    return run


def start_forwarder(messages: DataFrame, sink: Sink, checkpoint_location: str, report: Sink | None = None,
                    trigger: dict | None = None, query_name: str | None = None,
                    report_of: Callable[[DataFrame], DataFrame] = offset_ranges,
                    positions: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
    """Start the forwarding query. ``trigger`` defaults to a 5-second micro-batch;
    ``{'availableNow': True}`` drains what is there and stops (tests, backfills)."""
    writer = (messages.writeStream.foreachBatch(forward_batch(sink, report, report_of, positions))
              .option("checkpointLocation", checkpoint_location)
              .trigger(**(trigger or {"processingTime": BATCH_INTERVAL})))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


def _positions(offset):
    """A source's position as a dict where it is one (a Python data source reports it as text)."""
    if not isinstance(offset, str):
        return offset
    try:
        return ast.literal_eval(offset)
    except (ValueError, SyntaxError):
        return None


def progress_offsets(progress: list[dict] | dict) -> list[tuple[int, str, int, int, int]]:
    """T5 from the query's own bookkeeping: ``(batch_id, topic, partition, from_offset, until_offset)``
    for each batch in ``query.recentProgress`` (or one ``lastProgress``), read from the Kafka
    or message log source's start and end offsets - the exact fetched ranges, gaps included."""
    out = []
    for p in ([progress] if isinstance(progress, dict) else progress):
        for src in p.get("sources", []):
            start, end = (_positions(src.get(name)) for name in ("startOffset", "endOffset"))
            if not isinstance(end, dict) or not all(isinstance(v, dict) for v in end.values()):
                continue   # file sources report a log position
            for topic, parts in end.items():
                for part, until in parts.items():
                    frm = (start or {}).get(topic, {}).get(part, until) if isinstance(start, dict) else until
                    out.append((p.get("batchId"), topic, int(part), int(frm), int(until)))
    return out


__all__ = ["MESSAGE_SCHEMA", "BATCH_INTERVAL", "FETCH_MAX_BYTES", "kafka_source_options", "read_kafka",
           "read_message_files", "read_message_log", "gap_report", "kafka_records", "kafka_sink_options", "kafka_sink", "folder_sink",
           "forward_messages", "forward_batch", "start_forwarder", "progress_offsets"]
