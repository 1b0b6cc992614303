"""Scalar functions: X1-X9, F11, P13."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.functions import scalar as X
from cellar.plans import fixtures as FX
from cellar.plans.queries._common import H_SQL, PHONE_NUMBER_SQL, R_SQL, register, stored_rows


@register("message_text", """SELECT 'events' AS topic, CAST(user_id % 3 AS INTEGER) AS partition,
        event_id AS offset,
        coalesce(CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(user_id AS VARCHAR) END, '') || ':' || props
        AS text
    FROM events""")
def message_text(spark, sf):
    """P13 + D11: ``key:value``, a NULL key as ''."""
    g = FX.messages(spark, sf)
    return g.select("topic", "partition", "offset", X.message_text("key", "value").alias("text"))


def _phone_numbers(spark, sf) -> DataFrame:
    h = FX.phone_lines(spark, sf)
    fields = X.split_keep_trailing(X.strip_double_quotes("line"), "\t")
    return h.select("c_custkey", "line", X.normalise_phone(X.first_field_or_empty(fields)).alias("number"))


@register("normalise_phone", f"""WITH {H_SQL}
    SELECT c_custkey, line, {PHONE_NUMBER_SQL} AS number,
           regexp_full_match({PHONE_NUMBER_SQL}, '[0-9]*') AS numeric FROM h""")
def normalise_phone(spark, sf):
    """Clean the first field of each phone line."""
    return _phone_numbers(spark, sf).withColumn("numeric", X.is_numeric("number"))


@register("numeric_only", f"""WITH {H_SQL}
    SELECT c_custkey, number FROM (SELECT c_custkey, {PHONE_NUMBER_SQL} AS number FROM h)
    WHERE regexp_full_match(number, '[0-9]+')""")
def numeric_only(spark, sf):
    """F11 + D6: keep all-digit numbers; blank ones are dropped (``allow_blank=False``)."""
    return (_phone_numbers(spark, sf).where(X.is_numeric("number", allow_blank=False))
            .select("c_custkey", "number"))


@register("key_words", f"""WITH {R_SQL} SELECT row_key,
        CASE WHEN row_key = '' THEN '' WHEN rtrim(row_key, '0') = '' THEN ''
             ELSE array_to_string(string_split(rtrim(row_key, '0'), '0'), '|') END AS words,
        CAST(CASE WHEN row_key = '' THEN 1 WHEN rtrim(row_key, '0') = '' THEN 0
             ELSE len(string_split(rtrim(row_key, '0'), '0')) END AS INTEGER) AS n_words
    FROM r""")
def key_words(spark, sf):
    """Split the row key, trailing empty parts dropped."""
    words = X.split_drop_trailing("row_key", "0")
    return stored_rows(spark, sf).select("row_key", F.array_join(words, "|").alias("words"),
                                   F.size(words).alias("n_words"))


_DATE_TEXT = ("CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y/%m/%d') "
              "ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END")
_PARSED_MS = f"(epoch_us(try_strptime({_DATE_TEXT}, '%Y-%m-%d %H:%M:%S')) // 1000)"


def _date_text():
    return (F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy/MM/dd"))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")))


def _line_dates(spark, sf) -> DataFrame:
    """Line items with their order's date parsed once per order (before the join), and the ship time in ms."""
    li = FX.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = FX.table(spark, sf, "orders").select("o_orderkey", X.parse_epoch_millis(_date_text()).alias("order_ms"))
    return li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
        "l_orderkey", "l_linenumber", "order_ms", X.ts_epoch_millis("l_shipdate").alias("ship_ms"))


@register("days_between", f"""SELECT l_orderkey, l_linenumber,
        CAST(coalesce((epoch_us(l_shipdate) // 1000 - {_PARSED_MS}) // 86400000, 0) AS INTEGER) AS days
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def days_between(spark, sf):
    """Whole days from the order date text (strict, read as UTC) to the ship time (ms); 0 when the text does not parse."""
    d = _line_dates(spark, sf)
    return d.select("l_orderkey", "l_linenumber", X.days_between_millis("order_ms", "ship_ms").alias("days"))


@register("days_between_rev", f"""SELECT l_orderkey, l_linenumber,
        CAST(coalesce(({_PARSED_MS} - epoch_us(l_shipdate) // 1000) // 86400000, 0) AS INTEGER) AS days
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def days_between_rev(spark, sf):
    """The same with the other sign."""
    d = _line_dates(spark, sf)
    return d.select("l_orderkey", "l_linenumber", X.days_between_millis("ship_ms", "order_ms").alias("days"))


@register("unix_text", f"""SELECT o_orderkey, coalesce(CAST({_PARSED_MS} // 1000 AS VARCHAR), '') AS unix_text
    FROM orders""")
def unix_text(spark, sf):
    """Date text -> epoch seconds as text, '' when it does not parse."""
    o = FX.table(spark, sf, "orders")
    return o.select("o_orderkey", X.unix_seconds_text(_date_text()).alias("unix_text"))


# a month without a leading zero, days 21 to 51 and a trailing word, read with fields that roll over
_ROLLED_SQL = "(epoch_ms(make_date(year({0}), month({0}), 1)) // 86400000 + day({0}) + 19)"


def _rolled_text(date: str):
    c = F.col(date)
    return F.concat(F.year(c).cast("string"), F.lit("-"), F.month(c).cast("string"), F.lit("-"),
                    (F.day(c) + 20).cast("string"), F.lit(" late"))


@register("days_between_lenient", f"""SELECT l_orderkey, l_linenumber,
        CAST(trunc((epoch_us(l_shipdate) // 1000 - {_ROLLED_SQL.format('l_shipdate')} * 86400000) / 86400000) AS INTEGER) AS days
    FROM lineitem""")
def days_between_lenient(spark, sf):
    """The lenient reader - fields roll over, trailing text is ignored."""
    li = FX.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", X.days_between(
        _rolled_text("l_shipdate"), X.ts_epoch_millis("l_shipdate"), "yyyy-MM-dd", lenient=True).alias("days"))


@register("days_between_rev_lenient", f"""SELECT l_orderkey, l_linenumber,
        CAST(trunc(({_ROLLED_SQL.format('l_shipdate')} * 86400000 - epoch_us(l_shipdate) // 1000) / 86400000) AS INTEGER) AS days
    FROM lineitem""")
def days_between_rev_lenient(spark, sf):
    """The same with the other sign."""
    li = FX.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", X.days_between_rev(
        _rolled_text("l_shipdate"), X.ts_epoch_millis("l_shipdate"), "yyyy-MM-dd", lenient=True).alias("days"))


@register("unix_text_lenient", f"""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN ''
        ELSE CAST({_ROLLED_SQL.format('o_orderdate')} * 86400 + 25 * 3600 + 61 * 60 AS VARCHAR) END AS unix_text FROM orders""")
def unix_text_lenient(spark, sf):
    """Hour 25 and minute 61 roll over; '' where the text doesn't begin like the pattern."""
    text = F.when(F.col("o_orderstatus") == "P", F.lit("soon")).otherwise(
        F.regexp_replace(_rolled_text("o_orderdate"), " late", " 25:61:0 late"))
    return FX.table(spark, sf, "orders").select("o_orderkey", X.unix_seconds_text(text, lenient=True).alias("unix_text"))


@register("utf8_bytes", """SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes,
        decode(encode(text)) = text AS round_trip FROM documents""")
def utf8_bytes(spark, sf):
    """Text <-> UTF-8 bytes over whole documents."""
    d = FX.table(spark, sf, "documents")
    b = X.to_utf8("text")
    return d.select("doc_id", F.length(b).cast("long").alias("n_bytes"), (X.from_utf8(b) == F.col("text")).alias("round_trip"))
