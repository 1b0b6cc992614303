"""WARC: content-addressed archive.

An archive is two tables in a folder: ``payloads`` holds each distinct payload
once under its SHA-256 digest, ``records`` holds every record's exact header
bytes and the digest of its payload. Original records come back through a join
on the digest.

Writing groups by (digest, payload), so bytes are compared, not only digests:
two payloads under one digest would be two rows and stop the write. Partial
aggregation collapses copies before the shuffle; the later joins carry digests
and headers only, unless the caller asks for the payload. Reading recomputes
every digest and fails on a payload that doesn't match its own.

Of records with equal payloads of at least ``min_revisit`` bytes, the one with
the largest page_id is a response and the others revisit it; smaller payloads
are stored once too, but all their records are responses.

Defined results: a null payload is empty, a null url gives a record without
WARC-Target-URI, line breaks in a url are percent-encoded, a null page_id is
smaller than any number (a group without numbers is all responses), rows that
repeat the largest page_id are all responses, and an empty table gives an empty
archive. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellar.llm._common import prepare

#: Fixed values of the record format (WARC 1.1).
CRLF = "\r\n"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

MIN_REVISIT = 1000
#: The tables carry no crawl time; records are stamped with this one unless the caller gives another.
RECORD_DATE = "1970-01-01T00:00:00Z"


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def record_header(page_id: Column, url: Column, digest: Column, payload_bytes: Column, keeper: Column,
                  date: str = RECORD_DATE) -> Column:
    """Everything of a record before its payload: WARC header and HTTP head, as UTF-8 bytes.

    ``keeper`` is the page_id that the record revisits, null for a response.
    """
    head = len(HTTP_HEAD.encode())
    revisit = keeper.isNotNull()
    address = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    lines = F.concat(
        F.lit(VERSION + CRLF),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _record_id(page_id)),
        F.coalesce(_line("WARC-Target-URI", address), F.lit("")),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        F.when(revisit, F.concat(_line("WARC-Profile", F.lit(REVISIT_PROFILE)),
                                 _line("WARC-Refers-To", _record_id(keeper)))).otherwise(F.lit("")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", (F.when(revisit, F.lit(0)).otherwise(payload_bytes) + head).cast("string")),
        F.lit(CRLF + HTTP_HEAD))
    return F.encode(lines, "UTF-8")


def write_archive(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT, date: str = RECORD_DATE) -> None:
    """Write ``pages`` (page_id, url, html) as ``path/payloads`` and ``path/records``."""
    spark = pages.sparkSession
    prepare(spark)
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
                        F.encode(F.coalesce(pages["html"].cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    (rows.groupBy("digest", "payload").agg(F.max("page_id").alias("last_page"))
     .withColumn("payload_bytes", F.length("payload").cast("long"))
     .write.parquet(f"{path}/payloads"))
    stored = spark.read.parquet(f"{path}/payloads").select("digest", "payload_bytes", "last_page")
    if not stored.groupBy("digest").count().filter("count > 1").isEmpty():
        raise ValueError("two different payloads share a SHA-256 digest")
    keeper = F.when((F.col("payload_bytes") >= min_revisit)
                    & ~F.col("page_id").eqNullSafe(F.col("last_page")), F.col("last_page"))
    (rows.select("page_id", "url", "digest").join(stored, "digest")
     .select("digest", record_header(F.col("page_id"), F.col("url"), F.col("digest"), F.col("payload_bytes"), keeper,
                                     date).alias("header"))
     .write.parquet(f"{path}/records"))


def _field(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(found != "", found)


def _page(record_id: Column) -> Column:
    return F.regexp_extract(record_id, r"<urn:page:(-?[0-9]+)>", 1).try_cast("long")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record of an archive, its header parsed and its payload joined and verified.

    Columns: page_id, url, record_type, refers_to (page_id), header, payload
    (of a revisit: the payload it refers to), payload_bytes, payload_digest
    (SHA-1, hex) and payload_sha256. Columns that aren't selected aren't moved.
    """
    payloads = spark.read.parquet(f"{path}/payloads")
    whole = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload doesn't match its digest "), F.col("digest"))).cast("binary"))
    verified = payloads.withColumn("payload", whole).select(
        "digest", "payload", F.length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"))
    records = spark.read.parquet(f"{path}/records").withColumn("head", F.decode("header", "UTF-8"))
    head = F.col("head")
    parsed = records.select(
        "header", F.replace(_field(head, "WARC-Payload-Digest"), F.lit("sha256:"), F.lit("")).alias("digest"),
        _page(_field(head, "WARC-Record-ID")).alias("page_id"), _field(head, "WARC-Target-URI").alias("url"),
        _field(head, "WARC-Type").alias("record_type"), _page(_field(head, "WARC-Refers-To")).alias("refers_to"))
    return (parsed.join(verified, "digest")
            .select("page_id", "url", "record_type", "refers_to", "header", "payload", "payload_bytes",
                    "payload_digest", F.col("digest").alias("payload_sha256")))


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record): every record's exact bytes, as a WARC file would hold them."""
    archive = read_archive(spark, path)
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.encode(F.lit(""), "UTF-8"))
    return archive.select("page_id", F.concat("header", body, F.encode(F.lit(CRLF + CRLF), "UTF-8")).alias("record"))
