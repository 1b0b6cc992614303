"""Runnable jobs, one per entry point of the source: ``python -m cellar.plans.jobs <job> ...``.

* ``order-report`` (§3.1): one day of the JSON order feed -> flat records keyed by the
  user lookup -> newest-wins upsert into a range-split Parquet table.
* ``forward`` (§3.2): a message stream -> ``key:value`` -> another stream, offsets
  reported per batch, positions in the query checkpoint.
* ``phones`` (§3.3): a tab-separated phone list -> clean numbers -> batches of 99 ->
  a service call per batch -> ``numbers<TAB>response`` lines.
"""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cellar.plans import etl
from cellar.session import file_system, get_session
from cellar.sources.json_feed import feed_date, read_json_feed


def order_report_job(spark: SparkSession, feed: str, users: str, out: str, args: list[str] = (),
                     on_missing: str = "error", n_ranges: int | None = None) -> str:
    """§3.1: the day is the single positional argument, else today (S2). ``users`` is the user
    table in cell form (Parquet). ``out`` holds one snapshot per day (``snapshot=yyyyMMdd``):
    the day's snapshot is the latest earlier snapshot upserted with the day's report, so
    re-running a day rewrites the same snapshot (old table + changes -> new table)."""
    day = feed_date(list(args))
    docs = read_json_feed(spark, feed, date=day)
    report = etl.order_report(docs, spark.read.parquet(users), on_missing=on_missing)
    previous = None
    fs, root = file_system(spark, out)
    if fs.exists(root):  # a first run has nothing to merge with; anything else must be readable
        snaps = spark.read.parquet(out)
        if "snapshot" not in snaps.columns:
            raise ValueError(f"{out} holds no snapshots (snapshot=yyyyMMdd folders); the report would lose its rows")
        before = (snaps.select(F.col("snapshot").cast("string").alias("s")).where(F.col("s") < F.lit(day))
                  .distinct().orderBy(F.col("s").desc()).limit(1).collect())
        if before:
            previous = snaps.where(F.col("snapshot").cast("string") == before[0][0]).drop("snapshot")
    target = f"{out.rstrip('/')}/snapshot={day}"
    etl.write_report_upserted(report, target, n_ranges=n_ranges, table=previous)
    return target


def forward_job(spark: SparkSession, source: str, out: str, checkpoint: str, report: str | None = None,
                kafka_servers: str | None = None, topics: str | None = None, out_topic: str | None = None,
                once: bool = False):
    """§3.2: ``source`` is ``kafka`` (needs the connector) or a folder of message files."""
    from cellar.streaming import forwarder as S
    if source == "kafka":
        messages = S.read_kafka(spark, S.kafka_source_options(kafka_servers, topics))
        sink = S.kafka_sink(S.kafka_sink_options(kafka_servers, out_topic))
    else:
        messages = S.read_message_files(spark, source)
        sink = S.folder_sink(out)
    q = S.start_forwarder(messages, sink, checkpoint, report=S.folder_sink(report) if report else None,
                          trigger={"availableNow": True} if once else None)
    if once:
        q.awaitTermination()
    return q


def phones_job(spark: SparkSession, input_path: str, out: str, service: str = "cellar.operators.enrich:count_service",
               encoding: str = "UTF-8", max_attempts: int = 5, concurrency: int = 1) -> None:
    """§3.3: ``service`` names the call as ``module:function`` (a function ``str -> str``)."""
    from cellar.operators.enrich import write_lines
    from cellar.plans.phones import enrich_phone_list, read_phone_list
    module, name = service.split(":")
    call = getattr(importlib.import_module(module), name)
    done = enrich_phone_list(read_phone_list(spark, input_path, encoding=encoding), call,
                             max_attempts=max_attempts, concurrency=concurrency)
    write_lines(done.select("line").withColumnRenamed("line", "value"), out)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="cellar.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    r = sub.add_parser("order-report")
    r.add_argument("--feed", required=True)
    r.add_argument("--users", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--ranges", type=int)
    r.add_argument("day", nargs="*")
    f = sub.add_parser("forward")
    f.add_argument("--source", required=True)
    f.add_argument("--out")
    f.add_argument("--checkpoint", required=True)
    f.add_argument("--report")
    f.add_argument("--kafka-servers")
    f.add_argument("--topics")
    f.add_argument("--out-topic")
    f.add_argument("--once", action="store_true")
    p = sub.add_parser("phones")
    p.add_argument("--input", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--service", default="cellar.operators.enrich:count_service")
    p.add_argument("--concurrency", type=int, default=1)
    a = ap.parse_args(argv)
    spark = get_session(app=f"cellar-{a.job}")
    if a.job == "order-report":
        print(order_report_job(spark, a.feed, a.users, a.out, a.day, n_ranges=a.ranges))
    elif a.job == "forward":
        q = forward_job(spark, a.source, a.out, a.checkpoint, a.report, a.kafka_servers, a.topics, a.out_topic,
                        once=a.once)
        if not a.once:
            q.awaitTermination()
    else:
        phones_job(spark, a.input, a.out, a.service, concurrency=a.concurrency)
    return 0


if __name__ == "__main__":
    sys.exit(main())
