"""Inputs of the jobs, derived by Spark from the driver tables (FIXTURES.md, SURVEY §7.5).

* C - cell table from ``events``: row key = user id, family ``ev``, qualifier =
  event type, version ``(ts, event_id)``, value = event id as text.
* R - row table from ``orders`` (family ``o``): status, priority (missing where
  the status is ``P``), customer, order day.
* users - lookup cells from ``customer``: row key = customer key, ``yhxx:sidno`` = name.
* H - phone list lines from ``customer``, with prefixes, signs, quotes, blanks,
  letters and empty fields chosen by the key's residue.
* G - messages from ``events``: partition = user id mod 3, offset = event id,
  key = user id (NULL for sign-ups), value = props.
* order feed - one JSON document per customer and order day, written once per
  input folder under the shared checkpoint folder, partitioned by ``dt``.
"""

from __future__ import annotations

import functools
import hashlib
import inspect
import re
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellar.functions.predicates import ROW_KEY
from cellar.operators.widetable import Catalog, ColumnSpec
from cellar.plans.etl import USER_FAMILY, USER_ID_QUALIFIER
from cellar.session import file_system, shared_path
from cellar.sources.json_feed import ORDER_DOC_SCHEMA, read_json_feed

KEY_WIDTH = 12
EVENT_FAMILY = "ev"
ORDER_ROW_FAMILY = "o"
ORDER_ROWS_CATALOG = Catalog(table="orders_wide", row_key=ROW_KEY, columns=(
    ColumnSpec("status", ORDER_ROW_FAMILY, "status"),
    ColumnSpec("priority", ORDER_ROW_FAMILY, "priority"),
    ColumnSpec("cust", ORDER_ROW_FAMILY, "cust"),
    ColumnSpec("odate", ORDER_ROW_FAMILY, "odate"),
))
MESSAGE_TOPIC = "events"
MESSAGE_PARTITIONS = 3
FEED_VERSION = "v1"
EMPTY_DAY = "19700101"
#: Orders of a range of the feed, about: what one task sorts and one file holds at most.
FEED_RANGE_ORDERS = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def padded_key(c) -> F.Column:
    return F.lpad(c.cast("string"), KEY_WIDTH, "0")


def event_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C."""
    ev = table(spark, sf_dir, "events")
    return ev.select(padded_key(F.col("user_id")).alias(ROW_KEY), F.lit(EVENT_FAMILY).alias("family"),
                     F.col("event_type").alias("qualifier"), F.col("ts"),
                     F.col("event_id").cast("string").alias("value"), F.col("event_id").alias("seq"))


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R."""
    o = table(spark, sf_dir, "orders")
    return o.select(padded_key(F.col("o_orderkey")).alias(ROW_KEY), F.col("o_orderstatus").alias("status"),
                    F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
                    .otherwise(F.col("o_orderpriority")).alias("priority"),
                    F.col("o_custkey").cast("string").alias("cust"),
                    F.date_format(F.col("o_orderdate"), "yyyy-MM-dd").alias("odate"))


def user_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User lookup in cell form (customer key -> name)."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("string").alias(ROW_KEY), F.lit(USER_FAMILY).alias("family"),
                    F.lit(USER_ID_QUALIFIER).alias("qualifier"), F.lit(None).cast("timestamp_ntz").alias("ts"),
                    F.col("c_name").alias("value"), F.col("c_custkey").alias("seq"))


def phone_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H: ``c_custkey, line`` - tab-separated, the phone number first."""
    c = table(spark, sf_dir, "customer")
    base = F.concat(F.lit("1"), F.lpad(F.col("c_custkey").cast("string"), 10, "0"))
    r = F.pmod(F.col("c_custkey"), F.lit(8))
    first = (F.when(r == 0, base)
             .when(r == 1, F.concat(F.lit("+86"), base))
             .when(r == 2, F.concat(F.lit("  "), base, F.lit("\t ")))
             .when(r == 3, F.concat(F.lit('"'), base, F.lit('"')))
             .when(r == 4, F.concat(F.substring(base, 1, 3), F.lit("*"), F.substring(base, 4, 8), F.lit("#")))
             .when(r == 5, F.concat(F.lit("tel"), base))
             .when(r == 6, F.lit(""))
             .otherwise(F.concat(F.lit("+"), base, F.lit("*"))))
    line = F.concat(first, F.lit("\t"), F.col("c_name"), F.lit("\t"), F.col("c_mktsegment"))
    return c.select(F.col("c_custkey"), line.alias("line"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G: ``topic, partition, offset, key, value``."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.lit(MESSAGE_TOPIC).alias("topic"),
                     F.pmod(F.col("user_id"), F.lit(MESSAGE_PARTITIONS)).cast("int").alias("partition"),
                     F.col("event_id").alias("offset"),
                     F.when(F.col("event_type") == "signup", F.lit(None).cast("string"))
                     .otherwise(F.col("user_id").cast("string")).alias("key"),
                     F.col("props").alias("value"))


# --- the order feed --------------------------------------------------------------------------

def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per (customer, order day) with that day's orders, plus order-less
    documents (empty list, NULL list, no message) that the inner explode drops.

    Orders are dealt to ranges over (day, user) before they become documents: only narrow rows
    are shuffled, a range's documents are made where they are written, and ranges stay of one
    size however many orders there are. Order-less documents need no shuffle.
    """
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-o.count() // FEED_RANGE_ORDERS))
    info = F.struct(
        F.concat(F.col("c_mktsegment"), F.lit(" road "), F.col("o_custkey").cast("string")).alias("address"),
        F.col("c_name").alias("consignee"),
        F.concat(F.lit("1"), F.lpad(F.col("o_custkey").cast("string"), 10, "0")).alias("phoneNumber"),
        F.col("o_orderpriority").alias("invoiceTitle"),
        F.col("o_orderstatus").alias("invoiceType"),
        F.col("o_orderkey").cast("string").alias("orderNo"),
        F.date_format(F.col("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("shipTime"),
    )
    joined = (o.join(c, o["o_custkey"] == c["c_custkey"])
              .select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "c_name",
                      "c_mktsegment", F.date_format(F.col("o_orderdate"), "yyyyMMdd").alias("dt")))
    # few files per day, and a day holding much of the data spreads over tasks; a stated range count keeps
    # the thousands of day folders spread over tasks even when the data is small (AQE would merge an
    # unnumbered one into a single writer)
    with_orders = (joined.repartitionByRange(n, "dt", "o_custkey")
                   .groupBy(F.col("o_custkey").alias("cust"), "dt")
                   .agg(F.collect_list(info).alias("orders"),
                        F.date_format(F.min("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("addTime")))
    docs = with_orders.select(F.col("cust").cast("string").alias("sUserId"), "addTime",
                              F.struct(F.col("orders").alias("orderInfo")).alias("message"), "dt")
    # one order-less document per customer of three segments, on a day of its own:
    # an empty list (AUTOMOBILE), a NULL list (BUILDING), no message at all (MACHINERY)
    seg = F.col("c_mktsegment")
    empty_list = F.array_compact(F.array(F.lit(None).cast(info_type())))
    message = (F.when(seg == "MACHINERY", F.lit(None))
               .otherwise(F.struct(F.when(seg == "BUILDING", F.lit(None)).otherwise(empty_list).alias("orderInfo"))))
    empty = c.where(seg.isin("AUTOMOBILE", "BUILDING", "MACHINERY")).select(
        F.col("c_custkey").cast("string").alias("sUserId"), F.lit(None).cast("string").alias("addTime"),
        message.alias("message"), F.lit(EMPTY_DAY).alias("dt"))
    return docs.unionByName(empty.select(*docs.columns))


def info_type():
    return ORDER_DOC_SCHEMA["message"].dataType["orderInfo"].dataType.elementType


def _committed(spark: SparkSession, path: str) -> bool:
    """Does ``path`` hold a committed write?"""
    fs, root = file_system(spark, path)
    return fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, "_SUCCESS"))


def source_state(spark: SparkSession, sf_dir: str) -> str:
    """Names, lengths and modification times of all files below a folder (metadata only, one listing per folder)."""
    fs, root = file_system(spark, sf_dir)
    folders, seen = [root], []
    while folders:
        for f in fs.listStatus(folders.pop()):
            # a file status shows path, length and modification time; the time of the last read doesn't count
            text = f.toString()
            seen.append(re.sub(r"access_time=\d+", "", text))
            if "isDirectory=true" in text:
                folders.append(f.getPath())
    return hashlib.sha1("\n".join(sorted(seen)).encode()).hexdigest()


@functools.lru_cache(maxsize=512)
def _fingerprint(fn, depth: int = 2) -> str:
    """Source text of a builder and of the functions it closes over, so a changed builder gets a new folder."""
    try:
        text = inspect.getsource(fn)
    except (OSError, TypeError):
        text = getattr(fn, "__qualname__", repr(fn))
    if depth > 0:
        for cell in getattr(fn, "__closure__", None) or ():
            try:
                inner = cell.cell_contents
            except ValueError:
                continue
            if callable(inner):
                text += _fingerprint(inner, depth - 1)
            elif isinstance(inner, (str, int, float)):
                text += repr(inner)
    return text


@functools.lru_cache(maxsize=1)
def _modules_code() -> str:
    """Source of the modules derived inputs are built with (helpers, writers, readers), so a change
    to any of them also gives new folders."""
    import cellar.operators.mutate as mutate
    import cellar.operators.widetable as widetable
    import cellar.sources.json_feed as json_feed
    text = ""
    for mod in (sys.modules[__name__], mutate, widetable, json_feed):
        try:
            text += inspect.getsource(mod)
        except (OSError, TypeError):
            text += mod.__name__
    return hashlib.sha1(text.encode()).hexdigest()


def derived_path(spark: SparkSession, sf_dir: str, name: str, *builders) -> str:
    code = "".join(_fingerprint(b) for b in builders)
    state = source_state(spark, sf_dir)
    tag = hashlib.sha1(f"{FEED_VERSION}:{sf_dir.rstrip('/')}:{state}:{_modules_code()}:{code}".encode()).hexdigest()[:16]
    return shared_path(spark, "derived", name, tag)


def ensure_written(spark: SparkSession, sf_dir: str, name: str, build, write) -> str:
    """Write a derived input once per state of the input folder and builder version; reuse it when its
    commit marker exists. It is written aside and renamed, so two applications can't mix their files."""
    path = derived_path(spark, sf_dir, name, build, write)
    if not _committed(spark, path):
        aside = f"{path}-{uuid.uuid4().hex}"
        write(build(spark, sf_dir), aside)
        fs, root = file_system(spark, path)
        hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        if _committed(spark, path) or not fs.rename(hadoop_path(aside), root):
            fs.delete(hadoop_path(aside), True)  # another application was faster
    return path


def ensure_order_feed(spark: SparkSession, sf_dir: str) -> str:
    """The order feed, one folder per day (``dt=yyyyMMdd``)."""
    return ensure_written(spark, sf_dir, "order_docs", order_documents, _write_feed)


# Derived inputs are reused only when their _SUCCESS marker exists, so the single-rename
# output committer is safe for them (a failed write is simply redone) and much faster
# with thousands of partition folders.
FAST_COMMIT = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def _write_feed(df: DataFrame, path: str) -> None:
    # the documents come in ranges over (day, user); their repeated field names and texts pack well
    (df.sortWithinPartitions("dt")
     .write.options(**FAST_COMMIT, compression="gzip").mode("overwrite").partitionBy("dt").json(path))


MESSAGE_FILES = 4


def ensure_message_files(spark: SparkSession, sf_dir: str) -> str:
    """G as a folder of Parquet files ordered by offset, like a topic log (a file stream reads
    a few files per micro-batch)."""
    return ensure_written(spark, sf_dir, "messages", messages, _write_messages)


def _write_messages(df: DataFrame, path: str) -> None:
    # a log ordered by offset, in as many files as the session's shuffle width (at least MESSAGE_FILES)
    n = max(MESSAGE_FILES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    df.repartitionByRange(n, F.col("offset")).sortWithinPartitions("offset").write.mode("overwrite").parquet(path)


def order_feed(spark: SparkSession, sf_dir: str, date: str | None = None, schema=ORDER_DOC_SCHEMA) -> DataFrame:
    return read_json_feed(spark, ensure_order_feed(spark, sf_dir), schema=schema, date=date)


# --- delimited text ----------------------------------------------------------------------------

FILE_GROUP_ROWS = 10_000


def ensure_text(spark: SparkSession, sf_dir: str, name: str, build, header: str | None = None,
                order: str | None = None, line_sep: str | None = None) -> str:
    """Write derived text lines (column ``line``) once per input folder.

    With a header or a fixed line order, the lines go to one file per group of
    ``FILE_GROUP_ROWS`` consecutive ``order`` values (folder ``grp=<n>``), each
    file sorted and starting with the header: every file is bounded and written
    by its own task. Otherwise every task writes its lines in parallel.
    """
    def write(df: DataFrame, path: str) -> None:
        w = None
        if header is not None or order is not None:
            key = F.col(order) if order else F.col("p_partkey")
            grp = ((key - key % F.lit(FILE_GROUP_ROWS)) / F.lit(FILE_GROUP_ROWS)).cast("long")
            body = df.select(grp.alias("grp"), key.cast("long").alias("_o"), F.col("line").alias("value"))
            if header is not None:
                heads = body.select("grp").distinct().select("grp", F.lit(-1).cast("long").alias("_o"),
                                                             F.lit(header).alias("value"))
                body = heads.unionByName(body)
            w = (body.repartition("grp").sortWithinPartitions("grp", "_o").select("grp", "value")
                 .write.mode("overwrite").partitionBy("grp"))
        else:
            w = df.select(F.col("line").alias("value")).write.mode("overwrite")
        if line_sep is not None:
            w = w.option("lineSep", line_sep)
        w.text(path)
    return ensure_written(spark, sf_dir, name, build, write)


def ensure_csv(spark: SparkSession, sf_dir: str, name: str, build, options: dict) -> str:
    """Write a derived table with Spark's CSV writer (parallel, one header per file)."""
    return ensure_written(spark, sf_dir, name, build,
                          lambda df, p: df.write.mode("overwrite").options(**options).csv(p))


# --- stored wide tables ------------------------------------------------------------------------

def _write_ranged(df: DataFrame, path: str) -> None:
    from cellar.operators.mutate import write_table
    write_table(df, path, n_ranges=df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def order_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R as a stored table: written once (K1) pre-split into key ranges and sorted by key (K2),
    so key-range and prefix scans push down and skip files and row groups."""
    path = ensure_written(spark, sf_dir, "orders_wide", order_rows, _write_ranged)
    return spark.read.parquet(path)


def event_cell_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C as a stored cell table, range-partitioned and sorted by row key."""
    path = ensure_written(spark, sf_dir, "events_cells", event_cells, _write_ranged)
    return spark.read.parquet(path)


def lineitem_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hot-key cells from ``lineitem``: row key = return flag (three keys, about a third of all
    rows each), family ``li``, qualifier = line status, version ``(l_shipdate, seq)``,
    value = part key as text; ``seq = l_orderkey * 8 + l_linenumber`` is unique."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_returnflag").alias(ROW_KEY), F.lit("li").alias("family"),
                     F.col("l_linestatus").alias("qualifier"), F.col("l_shipdate").alias("ts"),
                     F.col("l_partkey").cast("string").alias("value"),
                     (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"))


__all__ = ["KEY_WIDTH", "EVENT_FAMILY", "ORDER_ROW_FAMILY", "ORDER_ROWS_CATALOG", "table", "padded_key", "event_cells",
           "order_rows", "user_cells", "phone_lines", "messages", "lineitem_cells", "order_documents",
           "ensure_written", "ensure_order_feed", "ensure_message_files", "ensure_text", "ensure_csv", "order_feed",
           "order_table", "event_cell_table"]
