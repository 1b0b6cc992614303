import hashlib
import tempfile

import pytest
from pyspark.sql import functions as F

from cellar.llm import warc as W

LONG = "<p>" + "é" * 600


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, payload string").repartition(3)


ROWS = [(1, "http://a/1", LONG, "d", "p"), (7, "http://a/7", LONG, "d", "p"), (3, "http://a/\r\n3", LONG, None, None),
        (4, None, "short", "d", "p"), (5, "http://a/5", "short", "d", "p"), (6, "u", None, "d", "p"), (8, "u", "", "d", "p"),
        (None, "u", LONG, "d", "p"), (None, "u", "x" * 2000, "d", "p"), (7, "http://a/7", LONG, "d", "p")]


@pytest.fixture()
def path(spark):
    out = tempfile.mkdtemp(prefix="cellar-warc-") + "/archive"
    W.write_archive(pages(spark, ROWS), out)
    return out


def test_records(spark, path):
    got = {(r["page_id"], r["payload_digest"], r["record_type"], r["refers_to"], r["payload_bytes"])
           for r in W.read_archive(spark, path).collect()}
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    n = len(LONG.encode())
    assert got == {(1, sha(LONG), "revisit", 7, n), (7, sha(LONG), "response", None, n), (3, sha(LONG), "revisit", 7, n),
                   (4, sha("short"), "response", None, 5), (5, sha("short"), "response", None, 5),
                   (6, sha(""), "response", None, 0), (8, sha(""), "response", None, 0),
                   (None, sha(LONG), "revisit", 7, n), (None, sha("x" * 2000), "response", None, 2000)}
    assert W.read_archive(spark, path).count() == len(ROWS)


def test_payloads_are_stored_once(spark, path):
    assert spark.read.parquet(f"{path}/payloads").count() == 4


def test_reconstructed_bytes(spark, path):
    records = [bytes(r["record"]) for r in W.reconstruct(spark, path).filter("page_id in (1, 4)").orderBy("page_id").collect()]
    head, block = records[0].split(b"\r\n\r\n", 1)
    assert b"WARC-Type: revisit\r\n" in head + b"\r\n" and b"WARC-Refers-To: <urn:page:7>" in head
    assert block == W.HTTP_HEAD.encode() + b"\r\n\r\n"
    head, block = records[1].split(b"\r\n\r\n", 1)
    length = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
    assert block == W.HTTP_HEAD.encode() + b"short" + b"\r\n\r\n" and length == len(block) - 4
    assert b"WARC-Target-URI" not in head


def test_url_line_breaks_are_encoded(spark, path):
    assert W.read_archive(spark, path).filter("page_id = 3").first()["url"] == "http://a/%0D%0A3"


def test_damaged_payload_is_noticed(spark, path):
    payloads = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.encode(F.lit("other"), "UTF-8"))
    bad = tempfile.mkdtemp(prefix="cellar-warc-") + "/archive"
    payloads.write.parquet(f"{bad}/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{bad}/records")
    with pytest.raises(Exception, match="doesn't match its digest"):
        W.read_archive(spark, bad).collect()


def test_empty_table(spark):
    out = tempfile.mkdtemp(prefix="cellar-warc-") + "/archive"
    W.write_archive(pages(spark, []), out)
    assert W.read_archive(spark, out).isEmpty()
