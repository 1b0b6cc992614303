
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellar.functions import predicates as P
from cellar.functions import scalar as X


def one(spark, col, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def java_split_drop_trailing(s, sep):
    parts = s.split(sep)
    if s == "":
        return [""]
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_split_drop_trailing_cases(spark):
    f = X.split_drop_trailing("s", "_")
    assert one(spark, f, "a_b__") == ["a", "b"]
    assert one(spark, f, "__") == []
    assert one(spark, f, "") == [""]
    assert one(spark, f, "_a") == ["", "a"]
    assert one(spark, f, None) is None


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet="ab_", max_size=8))
def test_split_drop_trailing_matches_java_rule(spark, s):
    assert one(spark, X.split_drop_trailing("s", "_"), s) == java_split_drop_trailing(s, "_")


def test_split_keep_trailing(spark):
    assert one(spark, X.split_keep_trailing("s", "\t"), "a\t\t") == ["a", "", ""]


def test_java_trim_strips_tabs_and_controls(spark):
    assert one(spark, X.java_trim("s"), "\t 12\x01\n") == "12"


def test_first_field_or_empty(spark):
    assert one(spark, X.first_field_or_empty(F.split("s", "\t", -1)), "") == ""
    assert one(spark, X.first_field_or_empty(F.split("s", "\t", -1)), " 7 \tx") == "7"


def test_normalise_phone(spark):
    assert one(spark, X.normalise_phone("s"), "+86#15*0+1") == "1501"


def test_is_numeric_blank_and_newline(spark):
    assert one(spark, X.is_numeric("s"), "") is True
    assert one(spark, X.is_numeric("s", allow_blank=False), "") is False
    assert one(spark, X.is_numeric("s"), "123\n") is False
    assert one(spark, X.is_numeric("s"), "12a") is False


def test_order_key_null_propagates(spark):
    df = spark.createDataFrame([("u", "1"), (None, "2")], "a string, b string")
    got = [r[0] for r in df.select(X.order_key("a", "b")).collect()]
    assert got == ["u_MY_1", None]


def test_message_text_null_key(spark):
    df = spark.createDataFrame([(None, "v"), ("k", "v")], "k string, v string")
    assert [r[0] for r in df.select(X.message_text("k", "v")).collect()] == [":v", "k:v"]


DAY = 86_400_000


def test_days_between_cases(spark):
    base = 1_500_000_000_000 - 1_500_000_000_000 % DAY  # a midnight (UTC)
    text = "2017-07-14 00:00:00"
    ms_text = base
    cases = [
        (text, ms_text, 0),
        (text, ms_text + DAY - 1, 0),
        (text, ms_text + DAY, 1),
        (text, ms_text - 1, 0),              # toward zero, not floor
        (text, ms_text - DAY - 1, -1),
        ("1960-01-01 00:00:00", 0, 3653),    # before 1970
        ("2017-02-30 00:00:00", 0, 0),       # does not parse (strict)
        ("garbage", 0, 0),
        (None, 0, 0),
    ]
    df = spark.createDataFrame(cases, "d string, ms long, want int")
    got = df.select(X.days_between("d", "ms").alias("g"), X.days_between_rev("d", "ms").alias("r"), "want").collect()
    for row in got:
        assert row["g"] == row["want"]
        assert row["r"] == -row["want"]


def test_days_between_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        assert one(spark, X.unix_seconds_text("s"), "2017-07-22 09:30:46") == "1500715846"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_unix_seconds_text(spark):
    assert one(spark, X.unix_seconds_text("s"), "1970-01-01 00:00:01") == "1"
    assert one(spark, X.unix_seconds_text("s"), "bad") == ""
    assert one(spark, X.unix_seconds_text("s", "yyyyMMdd"), "19700102") == "86400"


def test_utf8_round_trip(spark):
    assert one(spark, X.from_utf8(X.to_utf8("s")), "näive ✓") == "näive ✓"
    assert one(spark, F.length(X.to_utf8("s")), "ä") == 2


def test_int_div_toward_zero(spark):
    df = spark.createDataFrame([(-3,), (3,), (-4,)], "n long")
    assert [r[0] for r in df.select(X.int_div("n", 2)).collect()] == [-1, 1, -2]


def test_java_trim_long_blank_runs_are_fast(spark):
    import time
    s = " " * 200_000 + "x" + "\t" * 200_000
    t = time.time()
    assert one(spark, X.java_trim("s"), s) == "x"
    assert one(spark, X.java_trim("s"), "\x00\x1f a b \x20") == "a b"
    assert time.time() - t < 20


def test_dates_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2017-03-12 02:30:00",), ("2017-11-05 01:30:00",), ("nonsense",), (None,)], "t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    got = []
    for z in ("UTC", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", z)
        try:
            got.append([tuple(r) for r in df.select(X.parse_epoch_millis("t"), X.unix_seconds_text("t")).collect()])
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)
    assert got[0] == got[1] == [(1489285800000, "1489285800"), (1509845400000, "1509845400"), (None, ""), (None, "")]


def test_integer_division_is_exact(spark):
    df = spark.createDataFrame([(2**62 + 999,), (-(2**62) - 999,), (-1,)], "n long")
    assert [r[0] for r in df.select(X.int_div("n", 1000)).collect()] == [(2**62 + 999) // 1000, -((2**62 + 999) // 1000), 0]


def test_lenient_dates_roll_over(spark):
    from datetime import datetime, timedelta, timezone

    def at(*a, **k):
        return int((datetime(*a, tzinfo=timezone.utc) + timedelta(**k)).timestamp() * 1000)

    cases = [("2017-02-30", "yyyy-MM-dd", at(2017, 3, 2)), ("2017-7-2", "yyyy-MM-dd", at(2017, 7, 2)),
             ("2016-2-29 rest", "yyyy-MM-dd", at(2016, 2, 29)), ("2017-13-1", "yyyy-MM-dd", at(2018, 1, 1)),
             ("2017-0-0", "yyyy-MM-dd", at(2016, 11, 30)), ("1969-12-31 25:61:61", "yyyy-MM-dd HH:mm:ss", at(1970, 1, 1, hours=2, minutes=2, seconds=1)),
             (" 2017- 1-1", "yyyy-MM-dd", at(2017, 1, 1)), ("20170230", "yyyyMMdd", at(2017, 3, 2)), ("x2017-01-01", "yyyy-MM-dd", None),
             ("2017-01", "yyyy-MM-dd", None), ("", "yyyy-MM-dd", None), (None, "yyyy-MM-dd", None), ("12:5", "HH:mm", 43_500_000),
             ("2000-02-29", "yyyy-MM-dd", at(2000, 2, 29)), ("1900-02-29", "yyyy-MM-dd", at(1900, 3, 1)), ("99999999999-1-1", "yyyy-MM-dd", None)]
    for text, fmt, expected in cases:
        assert one(spark, X.parse_epoch_millis("s", fmt, lenient=True), text) == expected, (text, fmt)
    assert one(spark, X.unix_seconds_text("s", "yyyy-MM-dd", lenient=True), "bad") == ""
    assert one(spark, X.days_between("s", F.lit(at(2017, 3, 4)), "yyyy-MM-dd", lenient=True), "2017-02-30") == 2
    with pytest.raises(ValueError):
        X.parse_epoch_millis("s", "EEE yyyy", lenient=True)


def test_lenient_dates_equal_strict_ones_on_plain_dates(spark):
    df = spark.range(0, 400_000, 37).selectExpr("date_format(date_add(date'1600-01-01', cast(id as int)), 'yyyy-MM-dd') AS s")
    wrong = df.where(X.parse_epoch_millis("s", "yyyy-MM-dd") != X.parse_epoch_millis("s", "yyyy-MM-dd", lenient=True))
    assert wrong.isEmpty() and df.where(X.parse_epoch_millis("s", "yyyy-MM-dd", lenient=True).isNull()).isEmpty()


def test_prefixes_of_regexes(spark):
    assert P.regex_prefixes("^0000(1|2).*") == ["00001", "00002"]
    assert P.regex_prefixes("^ab?c") == ["a"] and P.regex_prefixes("^a+b") == ["a"] and P.regex_prefixes("^(ab)+c") == ["ab"]
    assert P.regex_prefixes("^x[12]y|^z") == ["x1y", "x2y", "z"]
    for none in ("abc", "^", "^.*a", "(?i)^abc", "a|^b", "^a|b", "^[a-z]b", "(?m)^a", r"^\p{L}", "^a*"):
        assert P.regex_prefixes(none) is None, none


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "[ab]", "(a|bc)", "a?", "b+", ".", "(ab)+", "(?:c|d)", "$", "[^a]", "a{2}", "|^b"]), max_size=6))
def test_pushed_prefixes_change_no_row(spark, parts):
    pattern = "^" + "".join(parts)
    values = [(x,) for x in ["", "a", "b", "ab", "abc", "bca", "aab", "bc", "cd", "da", "ba\nb", "aaa", "c"]]
    df = spark.createDataFrame(values, "row_key string")
    got = sorted(r[0] for r in df.where(P.key_regex(pattern)).collect())
    assert got == sorted(r[0] for r in df.where(F.col("row_key").rlike(pattern)).collect())
