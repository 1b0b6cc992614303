"""Record borders against a plain parser that walks a file's text from its start."""

import os
import random
import tempfile

import pytest
from cellar.sources import delimited as D

BREAKS = ("\r\n", "\r", "\n")


def write(dirpath, files):
    os.makedirs(dirpath, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(dirpath, name), "wb") as f:
            f.write(text.encode("utf-8"))
    return dirpath


def break_at(text, i):
    return next((b for b in BREAKS if text.startswith(b, i)), "")


def decode(value):
    out, i, letters = "", 0, dict(D.BACKSLASH_LETTERS)
    while i < len(value):
        if value[i] == "\\":
            i += 1
            out += letters.get(value[i], value[i]) if i < len(value) else ""
        else:
            out += value[i]
        i += 1
    return out


def field_at(text, i, o):
    """(value, end) of the field that starts at ``i``; ``end``: at a delimiter, a line break or the end."""
    blanks = " \t" if o.trim_whitespace else ""
    first = i
    while first < len(text) and text[first] in blanks:
        first += 1
    if o.use_qualifier and text[first:first + 1] == o.qualifier:
        j, value = first + 1, ""
        while j < len(text):
            if o.escape_mode == "backslash" and text[j] == "\\":
                value += text[j:j + 2]
                j += 2
            elif text[j] != o.qualifier:
                value += text[j]
                j += 1
            elif o.escape_mode == "doubled" and text[j + 1:j + 2] == o.qualifier:
                value += o.qualifier
                j += 2
            else:
                break
        while j < len(text) and text[j] != o.delimiter and not break_at(text, j):
            j += 1  # the closing qualifier and junk
        return (decode(value) if o.escape_mode == "backslash" else value), min(j, len(text))
    j = i
    escapes = o.escape_mode == "backslash" and not o.use_qualifier
    while j < len(text) and text[j] != o.delimiter and not break_at(text, j):
        j += 2 if escapes and text[j] == "\\" else 1
    j = min(j, len(text))
    value = text[i:j].strip(blanks) if blanks else text[i:j]
    return (decode(value) if escapes else value), j


def parse(text, o):
    """[(raw, values)] of a file's text."""
    end = next((b for b in BREAKS if text.endswith(b)), "")
    text = text[:len(text) - len(end)] if end else text  # a last line break ends nothing or is lost
    if not text and not end:
        return []
    out, i = [], 0
    while True:
        start = i
        begin = text[i:].lstrip(" \t") if o.trim_whitespace else text[i:]
        if o.use_comments and begin.startswith(o.comment):
            while i < len(text) and not break_at(text, i):
                i += 1
        else:
            values = []
            while True:
                value, i = field_at(text, i, o)
                values.append(value)
                if text[i:i + 1] != o.delimiter:
                    break
                i += 1
            if i > start or not o.skip_empty_records:
                out.append((text[start:i], values))
        if i >= len(text):
            return out
        i += len(break_at(text, i))


OPTIONS = [D.DelimitedOptions(charset="UTF-8", trim_whitespace=trim, use_comments=comments, escape_mode=mode,
                              use_qualifier=qualifier, skip_empty_records=skip)
           for trim in (True, False) for comments in (True, False)
           for mode, qualifier in (("doubled", True), ("backslash", True), ("backslash", False), ("doubled", False))
           for skip in (True, False)]


@pytest.mark.parametrize("split", ["24", "128m"])
@pytest.mark.parametrize("number", range(0, len(OPTIONS), 3))
def test_random_files_against_a_plain_parser(spark, number, split):
    o = OPTIONS[number]
    rng = random.Random(number)
    pieces = ['a', 'b c', ' ', '\t', ',', ',', '"', '"', '""', '"a,b"', '"x\ny"', '\n', '\r\n', '\r', '\n#', ' # i"t', '\\', '\\"', '\\\n', 'é']
    files = {f"f{i:02d}.csv": "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 40))) for i in range(12)}
    if o.escape_mode == "backslash" and o.use_qualifier:
        # a backslash right after a closing qualifier is not part of this comparison
        files = {n: t.replace('"\\', '" \\') for n, t in files.items()}
    path = write(tempfile.mkdtemp(prefix="cellar-borders-"), files)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        recs = D.read_records(spark, path, o, with_number=True, multiline_raw=True).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    expected = [(i, raw, values) for t in files.values() for i, (raw, values) in enumerate(parse(t, o))]
    assert sorted((r["record"], r["raw"], r["values"]) for r in recs) == sorted(expected)


def multi(spark, scratch, data, **options):
    p = write(tempfile.mkdtemp(dir=scratch), {"a.csv": data})
    o = D.DelimitedOptions(**options)
    recs = sorted(D.read_records(spark, p, o, with_number=True, multiline_raw=True).collect(), key=lambda r: r["record"])
    return [(r["raw"], list(r["values"])) for r in recs]


def test_a_qualifier_in_a_plain_value_opens_nothing(spark, scratch):
    got = multi(spark, scratch, 'a,5" pipe,c\n1,2,3\n4,5,6\n')
    assert [v for _, v in got] == [["a", '5" pipe', "c"], ["1", "2", "3"], ["4", "5", "6"]]


def test_a_qualifier_in_a_comment_opens_nothing(spark, scratch):
    assert [v for _, v in multi(spark, scratch, '# it"s\n1,2\n3,4\n', use_comments=True)] == [["1", "2"], ["3", "4"]]


def test_line_breaks_in_values_stay_as_they_are(spark, scratch):
    got = multi(spark, scratch, '1,"a\r\nb\rc\nd"\r\n2,x\r3,y\n')
    assert got == [('1,"a\r\nb\rc\nd"', ["1", "a\r\nb\rc\nd"]), ("2,x", ["2", "x"]), ("3,y", ["3", "y"])]


def test_a_leading_blank_starts_a_plain_value_without_trimming(spark, scratch):
    p = write(scratch + "/lb", {"a.csv": ' "a,b",c\n'})
    o = D.DelimitedOptions(trim_whitespace=False)
    assert list(D.read_delimited(spark, p, o).first()) == [' "a', 'b"', "c"]
    for whole in (True, False):
        assert D.read_records(spark, p, o, multiline_raw=whole).first()["values"] == [' "a', 'b"', "c"]
    raw = spark.read.text(p)
    assert raw.select(D.qualified_flags("value", o)).first()[0] == [False, False, False]
    assert raw.select(D.qualified_flags("value")).first()[0] == [True, False]


def test_blanks_before_a_comment(spark, scratch):
    p = write(scratch + "/bc", {"a.csv": " # c,1\n2,x\n"})
    o = D.DelimitedOptions(use_comments=True)
    assert [tuple(r) for r in D.read_delimited(spark, p, o).collect()] == [("2", "x")]
    assert [r["raw"] for r in D.read_records(spark, p, o).collect()] == ["2,x"]
    assert [r["raw"] for r in D.read_records(spark, p, o, multiline_raw=True).collect()] == ["2,x"]
    assert D.read_records(spark, p, o.with_(trim_whitespace=False)).count() == 2


def test_a_record_of_blanks_is_one_record_in_every_reader(spark, scratch):
    p = write(scratch + "/br", {"a.csv": "1,x\n  \t\n\n2,y\n"})
    assert sorted(map(tuple, D.read_delimited(spark, p, schema="k string, v string").collect())) == [
        ("", ""), ("1", "x"), ("2", "y")]
    for whole in (True, False):
        assert D.read_records(spark, p, multiline_raw=whole).count() == 3


def test_a_value_that_nothing_closes_goes_to_the_end(spark, scratch):
    assert multi(spark, scratch, '1,"a,b\n2,c') == [('1,"a,b\n2,c', ["1", "a,b\n2,c"])]


def test_the_guard_stops_a_value_that_nothing_closes(spark, scratch):
    p = write(scratch + "/go", {"a.csv": '1,"open\n' + "line of text,1\n" * 20_000})
    with pytest.raises(Exception, match="safety_switch"):
        D.read_records(spark, p, multiline_raw=True).count()
    o = D.DelimitedOptions(safety_switch=False)
    assert D.read_records(spark, p, o, multiline_raw=True).count() == 1


def test_typed_multiline_read_takes_many_tasks_a_file(spark, scratch):
    rows = [(i, f"two\nlines {i}" if i % 3 else f'5" of {i}') for i in range(2000)]
    text = "".join(f'{i},"{t}"\n' if "\n" in t else f"{i},{t}\n" for i, t in rows)
    p = write(scratch + "/ty", {"a.csv": text})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = D.read_delimited(spark, p, D.DelimitedOptions(multiline=True), schema="k long, t string")
        assert spark.read.text(p).rdd.getNumPartitions() > 4
        assert sorted(map(tuple, df.collect())) == rows
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_escapes_by_default_in_every_reader(spark, scratch):
    o = D.DelimitedOptions(escape_mode="backslash", charset="UTF-8")
    text = r'1,"A\x42\d067\o104\105é😀\uD83Dz\t\q\\"' + "\n"
    want = "ABCDEé\U0001F600�z\tq\\"
    p = write(scratch + "/nu", {"a.csv": text})
    assert D.read_delimited(spark, p, o).first()["_c1"] == want
    assert D.read_records(spark, p, o).first()["values"][1] == want
    parsed = spark.read.text(p).select(D.parse_delimited("value", "a int, b string", o).alias("r")).first()["r"]
    assert tuple(parsed) == (1, want)


def test_a_zero_character_is_ordinary_text(spark, scratch):
    p = write(scratch + "/z", {"a.csv": '"a\x00b\\\\c"\n'})
    assert D.read_records(spark, p, D.DelimitedOptions(escape_mode="backslash")).first()["values"] == ["a\x00b\\c"]
