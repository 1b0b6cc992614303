from hypothesis import given, settings
from hypothesis import strategies as st
import os

import pytest
from cellar.sources import delimited as D


def write(dirpath, name, data: bytes):
    os.makedirs(dirpath, exist_ok=True)
    with open(os.path.join(dirpath, name), "wb") as f:
        f.write(data)
    return dirpath


def test_duplicate_header_keeps_last(spark, scratch):
    p = write(scratch + "/h", "a.csv", b"id,name,name\n1,first,last\n")
    df = D.read_delimited(spark, p, D.DelimitedOptions(header=True))
    assert df.columns == ["id", "name"] and df.first()["name"] == "last"


def test_explicit_names(spark, scratch):
    p = write(scratch + "/n", "a.csv", b"1,x\n")
    assert D.read_delimited(spark, p, names=["k", "v"]).first().asDict() == {"k": "1", "v": "x"}


def test_default_charset_is_latin1(spark, scratch):
    p = write(scratch + "/l", "a.csv", "1,café\n".encode("iso-8859-1"))
    assert D.read_delimited(spark, p).first()[1] == "café"


def test_guard_rejects_long_values_unless_off(spark, scratch):
    p = write(scratch + "/g", "a.csv", b"1," + b"x" * 100_001 + b"\n")
    with pytest.raises(Exception):
        D.read_delimited(spark, p, D.DelimitedOptions(), schema="a long, b string").collect()
    ok = D.read_delimited(spark, p, D.DelimitedOptions(safety_switch=False), schema="a long, b string")
    assert len(ok.first()["b"]) == 100_001


def test_empty_values_stay_text(spark, scratch):
    p = write(scratch + "/e", "a.csv", b'1,,""\n')
    assert D.read_delimited(spark, p).first().asDict() == {"_c0": "1", "_c1": "", "_c2": ""}


def test_backslash_escapes(spark):
    df = spark.createDataFrame([("a\\tb\\\\c\\qd\\n",)], "s string")
    assert df.select(D.decode_backslash("s")).first()[0] == "a\tb\\cqd\n"
    df2 = spark.createDataFrame([("\\u0041\\x42\\o103\\d068\\105\\t",)], "s string")
    assert df2.select(D.decode_backslash("s")).first()[0] == "ABCDE\t"


def test_trailing_junk_and_qualified_flags(spark):
    df = spark.createDataFrame([('1," a ""q"" " junk,x, "y"',)], "raw string")
    got = df.select(D.ragged_values("raw").alias("v"), D.qualified_flags("raw").alias("q")).first()
    assert got["v"] == ["1", ' a "q" ', "x", "y"]
    assert got["q"] == [False, True, False, True]


def test_ragged_value_at_and_count(spark):
    df = spark.createDataFrame([("a,b",), ("a",), ("",)], "raw string")
    rows = df.select(D.column_count("raw").alias("n"), D.value_at(D.ragged_values("raw"), 1).alias("v")).collect()
    assert [(r["n"], r["v"]) for r in rows] == [(2, "b"), (1, ""), (1, "")]


def test_record_numbers_across_splits(spark, scratch):
    lines = "\n".join(["#c"] + [f"{i},v" for i in range(3000)] + [""]).encode()
    p = write(scratch + "/r", "big.csv", lines)
    write(p, "small.csv", b"a,1\nb,2\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        recs = D.read_records(spark, p, D.DelimitedOptions(use_comments=True), with_number=True)
        assert spark.read.text(p).rdd.getNumPartitions() > 2
        got = recs.select("record", "values").collect()
        by_first = {r["values"][0]: r["record"] for r in got}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert all(by_first[str(i)] == i for i in range(3000))
    assert by_first["a"] == 0 and by_first["b"] == 1
    kept = D.skip_records(recs, [0]).count()
    assert kept == 3002 - 2


def test_parse_string_column(spark):
    df = spark.createDataFrame([('7,"x,y",3',)], "s string")
    r = df.select(D.parse_delimited("s", "a long, b string, c int").alias("r")).select("r.*").first()
    assert r.asDict() == {"a": 7, "b": "x,y", "c": 3}


def test_multiline_raw_records_keep_quoted_breaks(spark, scratch):
    p = write(scratch + "/m", "a.csv", b'id,text\r\n1,"two\nlines"\r\n\r\n2,plain\n3,"a ""q""\n"\n')
    recs = D.read_records(spark, p, D.DelimitedOptions(header=True), with_number=True, multiline_raw=True)
    got = sorted((r["record"], r["raw"], r["values"][1]) for r in recs.collect())
    assert got == [(0, '1,"two\nlines"', "two\nlines"), (1, "2,plain", "plain"), (2, '3,"a ""q""\n"', 'a "q"\n')]


def test_line_records_with_header(spark, scratch):
    p = write(scratch + "/hh", "a.csv", b"k,v\nx,1\n\ny,2\n")
    recs = D.read_records(spark, p, D.DelimitedOptions(header=True), with_number=True)
    assert sorted((r["record"], r["raw"]) for r in recs.collect()) == [(0, "x,1"), (1, "y,2")]
    assert D.read_records(spark, p, D.DelimitedOptions(header=True)).count() == 2


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.text(alphabet='ab ,"\n', max_size=6), min_size=2, max_size=2), min_size=1, max_size=6))
def test_round_trip_with_python_csv_writer(spark, rows):
    import csv
    import io
    import tempfile
    buf = io.StringIO()
    csv.writer(buf, lineterminator="\n", quoting=csv.QUOTE_ALL).writerows(rows)
    d = tempfile.mkdtemp(prefix="cellar-rt-")
    write(d, "a.csv", buf.getvalue().encode("utf-8"))
    df = D.read_delimited(spark, d, D.DelimitedOptions(multiline=True, charset="UTF-8", trim_whitespace=False),
                          schema="a string, b string")
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, rows))


def test_trailing_junk_is_dropped(spark, scratch):
    p = write(scratch + "/j", "a.csv", b'1,"a" junk\n2,"""b"""\n')
    expected = {"1": "a", "2": '"b"'}
    assert dict(map(tuple, D.read_delimited(spark, p).collect())) == expected
    assert {r["values"][0]: r["values"][1] for r in D.read_records(spark, p).collect()} == expected


def test_record_numbers(spark, scratch):
    p = write(scratch + "/rs", "a.csv", "\n".join(f"{i},v" for i in range(500)).encode())
    lines = spark.read.text(p)
    got = D.with_record_number(lines).collect()
    assert sorted(r["record"] for r in got) == list(range(500))
    assert all(int(r["value"].split(",")[0]) == r["record"] for r in got)


def test_skip_lines_counts_every_physical_line(spark, scratch):
    p = write(scratch + "/sl", "a.csv", b'#c\n\nx,1\n"y\n",2\n')
    got = sorted((r["line_number"], r["value"]) for r in D.skip_lines(spark, p, [0, 3]).collect())
    assert got == [(1, ""), (2, "x,1"), (4, '",2')]
    assert D.header_index(["a", "b", "a"], "a") == 2 and D.header_index(["a"], "z") == -1


def test_read_headers(spark, scratch):
    p = write(scratch + "/rh", "a.csv", b'id,"na,me",x\n1,2,3\n')
    assert D.read_headers(spark, p) == ["id", "na,me", "x"]


def test_raw_fields_linear_tokenizer_cases(spark):
    rows = [("a,,b",), ("a,",), ("",), (",a",), ('x"a,b"',), (' "p,q" ,r',), ('"a""b",c',), ('"u" junk,v',)]
    got = [r[0] for r in spark.createDataFrame(rows, "raw string").select(D.raw_fields("raw")).collect()]
    assert got == [["a", "", "b"], ["a", ""], [""], ["", "a"], ['x"a', 'b"'], [' "p,q" ', "r"],
                   ['"a""b"', "c"], ['"u" junk', "v"]]
    bs = spark.createDataFrame([('"a\\"b,c",d',)], "raw string")
    assert bs.select(D.raw_fields("raw", D.DelimitedOptions(escape_mode="backslash"))).first()[0] == ['"a\\"b,c"', "d"]


def test_long_line_is_split_quickly(spark):
    import time
    line = ",".join(f'"v{i},x"' if i % 2 else f"v{i}" for i in range(20_000))
    df = spark.createDataFrame([(line,)], "raw string")
    t = time.time()
    n = df.select(D.column_count("raw")).first()[0]
    assert n == 20_000 and time.time() - t < 30


def test_custom_qualifier_both_paths(spark, scratch):
    p = write(scratch + "/q", "a.csv", b"1,'x,y',''''\n")
    o = D.DelimitedOptions(qualifier="'")
    assert D.read_delimited(spark, p, o).first().asDict() == {"_c0": "1", "_c1": "x,y", "_c2": "'"}
    assert D.read_records(spark, p, o).first()["values"] == ["1", "x,y", "'"]


def test_custom_record_delimiter_raw_records(spark, scratch):
    p = write(scratch + "/rd", "a.csv", b"a,1;b,2;;c,3")
    recs = D.read_records(spark, p, D.DelimitedOptions(record_delimiter=";"), with_number=True)
    assert sorted((r["record"], r["values"][0]) for r in recs.collect()) == [(0, "a"), (1, "b"), (2, "c")]


BACKSLASH = D.DelimitedOptions(escape_mode="backslash")


def test_backslash_escapes_by_form(spark, scratch):
    p = write(scratch + "/be", "a.csv", b'1,"a\\"b\\tc",a\\tb\n2,"x\\\\y",q\\\\r\n')
    for rows in (D.read_delimited(spark, p, BACKSLASH).collect(),
                 [r["values"] for r in D.read_records(spark, p, BACKSLASH).collect()]):
        # decoded where qualified, kept as written where not
        assert sorted(tuple(r) for r in rows) == [("1", 'a"b\tc', "a\\tb"), ("2", "x\\y", "q\\\\r")]
    off = BACKSLASH.with_(use_qualifier=False)
    p = write(scratch + "/bo", "a.csv", b'1,a\\,b,x\\ty,"q"\n')
    for row in (D.read_delimited(spark, p, off).first(), D.read_records(spark, p, off).first()["values"]):
        assert list(row) == ["1", "a,b", "x\ty", '"q"']


def test_backslash_takes_a_line_break(spark, scratch):
    p = write(scratch + "/bl", "a.csv", b'1,"a\\\nb \\" c",z\n2,"d",y\n')
    recs = D.read_records(spark, p, BACKSLASH, with_number=True, multiline_raw=True).collect()
    assert sorted((r["record"], *r["values"]) for r in recs) == [(0, "1", 'a\nb " c', "z"), (1, "2", "d", "y")]


def test_parse_text_like_the_reader(spark):
    df = spark.createDataFrame([('7,"x\\ty",3',), ("8,,x",), (None,), ("9",)], "s string")
    got = df.select(D.parse_delimited("s", "a long, b string, c int", BACKSLASH).alias("r")).collect()
    assert [r["r"] and tuple(r["r"]) for r in got] == [(7, "x\ty", 3), (8, "", None), None, (9, "", None)]


def test_very_long_qualified_values(spark, scratch):
    """Two million characters and a hundred thousand doubled qualifiers: no recursion per character."""
    long_, doubled = "ab" * 1_000_000, '""' * 100_000
    p = write(scratch + "/vl", "a.csv", f'1,"{long_}"\n2,"{doubled}"\n3,"{"x" * 8000}" junk\n'.encode())
    o = D.DelimitedOptions(safety_switch=False)
    got = {r["values"][0]: r["values"][1] for r in D.read_records(spark, p, o).collect()}
    assert got == {"1": long_, "2": '"' * 100_000, "3": "x" * 8000}
    assert len(D.read_delimited(spark, p, o).where("_c0 = '1'").first()["_c1"]) == 2_000_000
    with pytest.raises(Exception, match="safety_switch"):
        D.read_records(spark, p).collect()


def test_no_column_limit_with_the_guard_off(spark, scratch):
    p = write(scratch + "/nc", "a.csv", ("1," * 150_000 + "end\n").encode())
    assert len(D.read_records(spark, p, D.DelimitedOptions(safety_switch=False)).first()["values"]) == 150_001
    with pytest.raises(Exception, match="safety_switch"):
        D.read_records(spark, p).collect()


def test_records_across_splits(spark, scratch):
    """Quoted line breaks on every split border: the same records, numbered, whatever the split size."""
    rows = [(f"{i}", ("x\n" * (i % 7)) + ('"q"' if i % 3 == 0 else ""), "") if i % 5 else ("",) for i in range(400)]
    text = "".join((",".join('"' + v.replace('"', '""') + '"' for v in r) if len(r) > 1 else "") + "\n" for r in rows)
    p = write(scratch + "/sp", "a.csv", text.encode())
    kept = [r for r in rows if len(r) > 1]
    for size in ("64", "1000", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            recs = D.read_records(spark, p, with_number=True, multiline_raw=True).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert [tuple(r["values"]) for r in sorted(recs, key=lambda r: r["record"])] == kept
        assert sorted(r["record"] for r in recs) == list(range(len(kept)))
