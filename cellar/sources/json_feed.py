"""Dated feeds of JSON-lines documents.

The reader always gets an explicit schema: no inference pass over the files,
numbers arrive as text, a malformed line becomes a row of NULLs, and only the
declared nested fields are read.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field names of an order document.
ORDER_FIELDS = ("address", "consignee", "phoneNumber", "invoiceTitle", "invoiceType", "orderNo", "shipTime")

ORDER_DOC_SCHEMA = T.StructType([
    T.StructField("sUserId", T.StringType()),
    T.StructField("addTime", T.StringType()),
    T.StructField("message", T.StructType([
        T.StructField("orderInfo", T.ArrayType(T.StructType(
            [T.StructField(f, T.StringType()) for f in ORDER_FIELDS]))),
    ])),
])



def order_doc_schema(fields=ORDER_FIELDS, top=("sUserId", "addTime")) -> T.StructType:
    """The order-document schema narrowed to the given order fields (and top-level fields).

    Catalyst prunes nested fields for Parquet but not for JSON, so a job that
    needs only some fields passes this narrower schema and the parser skips the rest.
    """
    order = T.StructType([T.StructField(f, T.StringType()) for f in ORDER_FIELDS if f in fields])
    out = [T.StructField(t, T.StringType()) for t in ("sUserId", "addTime") if t in top]
    out.append(T.StructField("message", T.StructType([T.StructField("orderInfo", T.ArrayType(order))])))
    return T.StructType(out)


DATE_PARTITION = "dt"
FEED_DATE_FORMAT = "%Y%m%d"


def feed_date(args: Sequence[str] = (), today: _dt.date | None = None) -> str:
    """The day to read - the single argument when exactly one is given, else today (``yyyyMMdd``)."""
    if len(args) == 1:
        return args[0]
    return (today or _dt.datetime.now(_dt.timezone.utc).date()).strftime(FEED_DATE_FORMAT)


_LISTING_KEY = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_LISTING_DEFAULT = "10000"
FEED_LISTING_TASKS = "64"


@contextlib.contextmanager
def _listing_parallelism(spark: SparkSession):
    """List a feed's many day folders in a few tasks instead of one tiny task per folder
    (only while the folder index is built, and only when the session keeps Spark's default)."""
    current = spark.conf.get(_LISTING_KEY, _LISTING_DEFAULT)
    if current != _LISTING_DEFAULT:
        yield
        return
    spark.conf.set(_LISTING_KEY, FEED_LISTING_TASKS)
    try:
        yield
    finally:
        spark.conf.set(_LISTING_KEY, current)


def read_json_feed(spark: SparkSession, path: str, schema: T.StructType = ORDER_DOC_SCHEMA,
                   date: str | None = None, layout: str = "partitioned") -> DataFrame:
    """S1 (+S2): read a directory of JSON lines with an explicit schema.

    ``layout='partitioned'``: ``path/dt=yyyyMMdd/...``; a ``date`` becomes a
    filter on the partition column, so only that directory is listed and read.
    ``layout='dated'``: ``path/yyyyMMdd/...``; a ``date`` picks the directory, without one all days are read.
    A day without a folder fails the read (as the source job does) rather than
    yielding an empty day, so a missing input never turns into an empty snapshot.
    """
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE")
    if layout == "dated":
        if date:
            return reader.json(f"{path.rstrip('/')}/{date}")
        return reader.option("recursiveFileLookup", "true").json(path)
    if DATE_PARTITION not in schema.fieldNames():
        # declare the partition column as text, so 'yyyyMMdd' is not inferred as a number
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(DATE_PARTITION, T.StringType())]))
    if date is None:
        with _listing_parallelism(spark):
            return reader.json(path)
    # list only the day's directory; basePath keeps the partition column
    root = path.rstrip("/")
    return (reader.option("basePath", root).json(f"{root}/{DATE_PARTITION}={date}")
            .where(F.col(DATE_PARTITION) == F.lit(date)))


__all__ = ["ORDER_FIELDS", "ORDER_DOC_SCHEMA", "order_doc_schema", "DATE_PARTITION", "feed_date", "read_json_feed"]
