"""Delimited text: S6, S6.1-S6.15, S9."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellar.plans import fixtures as FX
from cellar.plans.queries._common import register


def _part(spark, sf):
    return FX.table(spark, sf, "part")


def _lines(expr):
    """A builder of derived text lines from ``part``: ``p_partkey, p_size, line``."""
    def build(spark, sf):
        return _part(spark, sf).select("p_partkey", "p_size", expr().alias("line"))
    return build


def _k():
    return F.col("p_partkey").cast("string")


PART_CSV_SCHEMA = "p_partkey long, p_name string, p_brand string, p_type string, p_size int"


@register("read_delimited", "SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part")
def read_delimited(spark, sf):
    """S6 + S6.1: files written with a header per file, read with the header and a schema."""
    from cellar.sources import delimited as D
    path = FX.ensure_csv(spark, sf, "csv_part", lambda s, f: _part(s, f).select(*[c.split()[0] for c in PART_CSV_SCHEMA.split(", ")]),
                         {"header": "true", "escape": '"'})
    return D.read_delimited(spark, path, D.DelimitedOptions(header=True, charset="UTF-8"), schema=PART_CSV_SCHEMA)


@register("csv_duplicate_header", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_brand AS p_name FROM part")
def csv_duplicate_header(spark, sf):
    """S6.1 + D1: a duplicate header name resolves to its last column."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_dup_header",
                          _lines(lambda: F.concat_ws(",", _k(), F.col("p_name"), F.col("p_brand"))),
                          header="p_partkey,p_name,p_name", order="p_partkey")
    return D.read_delimited(spark, path, D.DelimitedOptions(header=True)).select("p_partkey", "p_name")


@register("csv_qualified", """SELECT p_partkey,
        CASE WHEN p_size > 45 THEN replace(p_type, ' ', chr(10)) ELSE replace(p_type, ' ', ', ') END AS t,
        replace(p_name, ' ', '"') AS n FROM part""")
def csv_qualified(spark, sf):
    """S6.2 + S6.3: qualified values holding delimiters, line breaks and doubled qualifiers."""
    from cellar.sources import delimited as D
    t = F.when(F.col("p_size") > 45, F.replace("p_type", F.lit(" "), F.lit("\n"))) \
        .otherwise(F.replace("p_type", F.lit(" "), F.lit(", ")))
    n = F.replace("p_name", F.lit(" "), F.lit('""'))
    path = FX.ensure_text(spark, sf, "csv_qualified", _lines(
        lambda: F.concat(_k(), F.lit(',"'), t, F.lit('","'), n, F.lit('"'))))
    return D.read_delimited(spark, path, D.DelimitedOptions(multiline=True), schema="p_partkey long, t string, n string")


@register("csv_multiline_raw", """SELECT CAST(p_partkey AS VARCHAR) AS key,
        CASE WHEN p_size > 45 THEN replace(p_type, ' ', chr(10)) ELSE replace(p_type, ' ', ', ') END AS t,
        replace(p_name, ' ', '"') AS n FROM part""")
def csv_multiline_raw(spark, sf):
    """S6.9 + D13: raw records that keep their quoted line breaks (many tasks a file)."""
    from cellar.sources import delimited as D
    t = F.when(F.col("p_size") > 45, F.replace("p_type", F.lit(" "), F.lit("\n"))) \
        .otherwise(F.replace("p_type", F.lit(" "), F.lit(", ")))
    n = F.replace("p_name", F.lit(" "), F.lit('""'))
    path = FX.ensure_text(spark, sf, "csv_qualified", _lines(
        lambda: F.concat(_k(), F.lit(',"'), t, F.lit('","'), n, F.lit('"'))))
    recs = D.read_records(spark, path, multiline_raw=True)
    return recs.select(D.value_at("values", 0).alias("key"), D.value_at("values", 1).alias("t"),
                       D.value_at("values", 2).alias("n"))


@register("csv_no_qualifier", """SELECT p_partkey, '"' || p_brand AS b, p_size FROM part""")
def csv_no_qualifier(spark, sf):
    """S6.2 off: quotes are ordinary text."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_no_qualifier", _lines(
        lambda: F.concat(_k(), F.lit(',"'), F.col("p_brand"), F.lit(","), F.col("p_size").cast("string"))))
    return D.read_delimited(spark, path, D.DelimitedOptions(use_qualifier=False), schema="p_partkey long, b string, p_size int")


@register("csv_backslash", """SELECT p_partkey, 'A' || replace(p_name, ' ', chr(9)) || '"' AS n FROM part""")
def csv_backslash(spark, sf):
    """S6.4: backslash escapes (letters and numeric forms) inside qualified values."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_backslash", _lines(
        lambda: F.concat(_k(), F.lit(',"\\u0041'), F.replace("p_name", F.lit(" "), F.lit("\\t")), F.lit('\\""'))))
    return D.read_delimited(spark, path, D.DelimitedOptions(escape_mode="backslash"),
                            schema="p_partkey long, n string")


@register("csv_backslash_letters", """SELECT p_partkey, replace(p_name, ' ', chr(9)) || chr(10) || '\\' AS n FROM part""")
def csv_backslash_letters(spark, sf):
    """S6.4: letters and a backslash at the end of a value."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_backslash_letters", _lines(
        lambda: F.concat(_k(), F.lit(',"'), F.replace("p_name", F.lit(" "), F.lit("\\t")), F.lit('\\n\\\\"'))))
    return D.read_delimited(spark, path, D.DelimitedOptions(escape_mode="backslash"), schema="p_partkey long, n string")


_COMMENT_LINES = _lines(lambda: F.when(F.col("p_size") > 40, F.concat(F.lit("#"), _k(), F.lit(",comment")))
                        .otherwise(F.concat_ws(",", _k(), F.col("p_brand"))))


@register("csv_comments", "SELECT p_partkey, p_brand FROM part WHERE p_size <= 40")
def csv_comments(spark, sf):
    """S6.5: comment lines are skipped."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_comments", _COMMENT_LINES)
    return D.read_delimited(spark, path, D.DelimitedOptions(use_comments=True), schema="p_partkey long, p_brand string")


@register("csv_trim", "SELECT p_partkey, p_brand, p_size FROM part")
def csv_trim(spark, sf):
    """S6.6: blanks and tabs around unqualified values are trimmed."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_trim", _lines(
        lambda: F.concat(F.lit("  "), _k(), F.lit(" ,\t"), F.col("p_brand"), F.lit("\t, "), F.col("p_size").cast("string"))))
    return D.read_delimited(spark, path, D.DelimitedOptions(), schema="p_partkey long, p_brand string, p_size int")


@register("csv_record_delimiter", "SELECT p_partkey, p_brand FROM part")
def csv_record_delimiter(spark, sf):
    """S6.7: records end with ';' instead of a line break."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_semicolon", _lines(lambda: F.concat_ws(",", _k(), F.col("p_brand"))),
                          line_sep=";")
    return D.read_delimited(spark, path, D.DelimitedOptions(record_delimiter=";"), schema="p_partkey long, p_brand string")


_GAPPED_LINES = _lines(lambda: F.concat(F.concat_ws(",", _k(), F.col("p_brand")), F.lit("\n")))


@register("csv_skip_empty", "SELECT p_partkey, p_brand FROM part")
def csv_skip_empty(spark, sf):
    """S6.8: empty records are skipped."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_gapped", _GAPPED_LINES)
    return D.read_delimited(spark, path, D.DelimitedOptions(), schema="p_partkey long, p_brand string")


@register("csv_keep_empty", """SELECT CAST(p_partkey AS VARCHAR) || ',' || p_brand AS raw, 2 AS n_values FROM part
    UNION ALL SELECT '' AS raw, 1 AS n_values FROM part""")
def csv_keep_empty(spark, sf):
    """S6.8 off + S6.9: empty records kept, each with its raw text."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_gapped", _GAPPED_LINES)
    recs = D.read_records(spark, path, D.DelimitedOptions(skip_empty_records=False))
    return recs.select("raw", F.size("values").alias("n_values"))


@register("csv_raw_record", """SELECT CAST(p_partkey AS VARCHAR) || ',"' || p_brand || '"' AS raw,
        CAST(p_partkey AS VARCHAR) AS key, p_brand AS brand FROM part""")
def csv_raw_record(spark, sf):
    """S6.9: the raw record next to its parsed values."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_raw", _lines(
        lambda: F.concat(_k(), F.lit(',"'), F.col("p_brand"), F.lit('"'))))
    recs = D.read_records(spark, path)
    return recs.select("raw", D.value_at("values", 0).alias("key"), D.value_at("values", 1).alias("brand"))


_NUMBERED_SQL = """SELECT CAST(row_number() OVER (PARTITION BY p_partkey // 10000 ORDER BY p_partkey) - 1 AS BIGINT)
        AS record, CAST(p_partkey AS VARCHAR) AS key FROM part WHERE p_size <= 40"""


@register("csv_record_number", _NUMBERED_SQL)
def csv_record_number(spark, sf):
    """S6.10: 0-based record numbers per file, in file order; comment lines are not counted
    (one file per 10,000 part keys)."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_comments_ordered", _COMMENT_LINES, order="p_partkey")
    recs = D.read_records(spark, path, D.DelimitedOptions(use_comments=True), with_number=True)
    return recs.select("record", D.value_at("values", 0).alias("key"))


@register("csv_skip_records", f"SELECT * FROM ({_NUMBERED_SQL}) WHERE record >= 3")
def csv_skip_records(spark, sf):
    """S6.11: skip the first three records of each file by number."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_comments_ordered", _COMMENT_LINES, order="p_partkey")
    recs = D.read_records(spark, path, D.DelimitedOptions(use_comments=True), with_number=True)
    return D.skip_records(recs, [0, 1, 2]).select("record", D.value_at("values", 0).alias("key"))


@register("csv_ragged", """SELECT CAST(p_partkey AS VARCHAR) AS key, CAST(1 + p_size % 4 AS INTEGER) AS n_cols,
        CASE WHEN p_size % 4 >= 1 THEN p_brand ELSE '' END AS v1,
        CASE WHEN p_size % 4 >= 3 THEN p_brand ELSE '' END AS v3 FROM part""")
def csv_ragged(spark, sf):
    """S6.12: records with different value counts; a missing position reads as ''."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_ragged", _lines(
        lambda: F.concat(_k(), F.repeat(F.concat(F.lit(","), F.col("p_brand")), F.pmod(F.col("p_size"), F.lit(4))))))
    recs = D.read_records(spark, path)
    return recs.select(D.value_at("values", 0).alias("key"), D.column_count("raw").alias("n_cols"),
                       D.value_at("values", 1).alias("v1"), D.value_at("values", 3).alias("v3"))


@register("csv_is_qualified", """SELECT CAST(p_partkey AS VARCHAR) AS key, p_size > 25 AS q1, p_brand AS brand FROM part""")
def csv_is_qualified(spark, sf):
    """S6.14: which values were enclosed in the qualifier."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_maybe_quoted", _lines(
        lambda: F.concat(_k(), F.lit(","), F.when(F.col("p_size") > 25, F.concat(F.lit('"'), F.col("p_brand"), F.lit('"')))
                         .otherwise(F.col("p_brand")))))
    recs = D.read_records(spark, path)
    return recs.select(D.value_at("values", 0).alias("key"),
                       F.element_at(D.qualified_flags("raw"), 2).alias("q1"), D.value_at("values", 1).alias("brand"))


def _junk_lines():
    return F.concat(_k(), F.lit(',"'), F.col("p_brand"), F.lit('" junk,'), F.col("p_size").cast("string"))


@register("csv_trailing_junk", "SELECT p_partkey, p_brand AS b, p_size FROM part")
def csv_trailing_junk(spark, sf):
    """S6.15 (D2): text after a closing qualifier is dropped (raw-record reader, exact)."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_junk", _lines(_junk_lines))
    recs = D.read_records(spark, path)
    return recs.select(D.value_at("values", 0).cast("long").alias("p_partkey"), D.value_at("values", 1).alias("b"),
                       D.value_at("values", 2).cast("int").alias("p_size"))


@register("csv_trailing_junk_parsed", "SELECT p_partkey, p_brand AS b, p_size FROM part")
def csv_trailing_junk_parsed(spark, sf):
    """S6.15 (D2) in typed columns."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_junk", _lines(_junk_lines))
    return D.read_delimited(spark, path, schema="p_partkey long, b string, p_size int")


_QUOTED = {"escape": '"', "quoteAll": "true", "encoding": "UTF-8"}


def _quoted_documents(spark, sf):
    return FX.table(spark, sf, "documents").select("doc_id", "text")


@register("csv_guard_off", "SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars FROM documents")
def csv_guard_off(spark, sf):
    """S6.13: whole documents as qualified multi-line values, guard switched off (some exceed 100,000 chars)."""
    from cellar.sources import delimited as D
    path = FX.ensure_csv(spark, sf, "csv_documents", _quoted_documents, _QUOTED)
    df = D.read_delimited(spark, path, D.DelimitedOptions(safety_switch=False, multiline=True, charset="UTF-8",
                                                          trim_whitespace=False), schema="doc_id long, text string")
    return df.select("doc_id", F.length("text").alias("n_chars"))


@register("raw_documents", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(length(text) AS INTEGER) AS n_chars, md5(text) AS digest FROM documents")
def raw_documents(spark, sf):
    """S6.9 + S6.13: whole documents as qualified values of raw records, line breaks kept, guard off."""
    from cellar.sources import delimited as D
    path = FX.ensure_csv(spark, sf, "csv_documents", _quoted_documents, _QUOTED)
    recs = D.read_records(spark, path, D.DelimitedOptions(safety_switch=False, charset="UTF-8", trim_whitespace=False),
                          multiline_raw=True)
    text = D.value_at("values", 1)
    return recs.select(D.value_at("values", 0).alias("doc_id"), F.length(text).alias("n_chars"), F.md5(text).alias("digest"))


_ESCAPED = _lines(lambda: F.concat(_k(), F.lit(',"'), F.replace("p_name", F.lit(" "), F.lit("\\t")), F.lit('\\"",'),
                                   F.replace("p_brand", F.lit("#"), F.lit("\\t"))))


@register("csv_backslash_forms", r"""SELECT CAST(p_partkey AS VARCHAR) AS key, replace(p_name, ' ', chr(9)) || '"' AS qualified,
        replace(p_brand, '#', '\t') AS plain FROM part""")
def csv_backslash_forms(spark, sf):
    """S6.4 in raw records: escapes count in a qualified value, not in an unqualified one."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_escaped", _ESCAPED)
    recs = D.read_records(spark, path, D.DelimitedOptions(escape_mode="backslash"))
    return recs.select(D.value_at("values", 0).alias("key"), D.value_at("values", 1).alias("qualified"),
                       D.value_at("values", 2).alias("plain"))


@register("csv_backslash_no_qualifier", "SELECT p_partkey, replace(p_name, ' ', ',') AS n, p_size FROM part")
def csv_backslash_no_qualifier(spark, sf):
    """S6.4 with the qualifier off: an escaped delimiter belongs to the value."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_escaped_delimiter", _lines(lambda: F.concat_ws(
        ",", _k(), F.replace("p_name", F.lit(" "), F.lit("\\,")), F.col("p_size").cast("string"))))
    return D.read_delimited(spark, path, D.DelimitedOptions(escape_mode="backslash", use_qualifier=False),
                            schema="p_partkey long, n string, p_size int")


@register("parse_text_escaped", """SELECT p_partkey, replace(p_name, ' ', chr(9)) AS n, '' AS missing FROM part""")
def parse_text_escaped(spark, sf):
    """S9 + S6.4: escapes in parsed text, and '' for a missing value."""
    from cellar.sources import delimited as D
    line = F.concat(_k(), F.lit(',"'), F.replace("p_name", F.lit(" "), F.lit("\\t")), F.lit('"'))
    parsed = _part(spark, sf).select(D.parse_delimited(line, "p_partkey long, n string, missing string",
                                                       D.DelimitedOptions(escape_mode="backslash")).alias("r"))
    return parsed.select("r.*")


@register("parse_text", "SELECT p_partkey, p_brand, p_size FROM part")
def parse_text(spark, sf):
    """Delimited text held in a column, parsed into a struct."""
    from cellar.sources import delimited as D
    line = F.concat_ws(",", _k(), F.concat(F.lit('"'), F.col("p_brand"), F.lit('"')), F.col("p_size").cast("string"))
    parsed = _part(spark, sf).select(D.parse_delimited(line, "p_partkey long, p_brand string, p_size int").alias("r"))
    return parsed.select("r.*")


@register("csv_skip_lines", """SELECT * FROM (
        SELECT CAST(row_number() OVER (PARTITION BY p_partkey // 10000 ORDER BY p_partkey) - 1 AS BIGINT) AS line_number,
               CASE WHEN p_size > 40 THEN '#' || CAST(p_partkey AS VARCHAR) || ',comment'
                    ELSE CAST(p_partkey AS VARCHAR) || ',' || p_brand END AS value
        FROM part) WHERE line_number NOT IN (0, 1, 2)""")
def csv_skip_lines(spark, sf):
    """S6.11 ``skipLine``: physical lines (comments included) numbered per file, the first three skipped."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_comments_ordered", _COMMENT_LINES, order="p_partkey")
    return D.skip_lines(spark, path, [0, 1, 2]).select("line_number", "value")


def _two_lines():
    """A value that holds a line break for some parts."""
    return F.when(F.col("p_size") > 45, F.replace("p_type", F.lit(" "), F.lit("\n"))).otherwise(F.col("p_type"))


_TWO_LINES_SQL = "CASE WHEN p_size > 45 THEN replace(p_type, ' ', chr(10)) ELSE p_type END"


@register("csv_plain_qualifier", f"""SELECT p_partkey, CAST(p_size AS VARCHAR) || '" pipe' AS d, {_TWO_LINES_SQL} AS t FROM part""")
def csv_plain_qualifier(spark, sf):
    """S6.2 + S6.9: a qualifier inside an unqualified value opens nothing, next to values that span lines."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_plain_qualifier", _lines(lambda: F.concat(
        _k(), F.lit(","), F.col("p_size").cast("string"), F.lit('" pipe,"'), _two_lines(), F.lit('"'))))
    return D.read_delimited(spark, path, D.DelimitedOptions(multiline=True), schema="p_partkey long, d string, t string")


@register("csv_comment_qualifier", f"""SELECT p_partkey, {_TWO_LINES_SQL} || chr(10) || '#not a comment' AS t
        FROM part WHERE p_size <= 40 OR p_size > 45""")
def csv_comment_qualifier(spark, sf):
    """S6.5 + S6.9: comments (blanks before them too) that hold a qualifier, and a value with a line like one."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_comment_qualifier", _lines(lambda: F.when(
        F.col("p_size").between(41, 45), F.concat(F.lit(' # it"s '), _k(), F.lit(",1")))
        .otherwise(F.concat(_k(), F.lit(',"'), _two_lines(), F.lit('\n#not a comment"')))))
    return D.read_delimited(spark, path, D.DelimitedOptions(multiline=True, use_comments=True),
                            schema="p_partkey long, t string")


@register("csv_line_breaks", """SELECT CAST(p_partkey AS VARCHAR) || ',"' || t || '"' AS raw, t FROM (
        SELECT p_partkey, p_brand || chr(13) || chr(10) || p_type || chr(13) || p_name || chr(10) AS t FROM part)""")
def csv_line_breaks(spark, sf):
    """S6.9: raw records and values keep their line breaks as written (CR LF, CR, LF)."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_line_breaks", _lines(lambda: F.concat(
        _k(), F.lit(',"'), F.col("p_brand"), F.lit("\r\n"), F.col("p_type"), F.lit("\r"), F.col("p_name"), F.lit('\n"'))))
    recs = D.read_records(spark, path, multiline_raw=True)
    return recs.select("raw", D.value_at("values", 1).alias("t"))


@register("csv_leading_blank", """SELECT CAST(p_partkey AS VARCHAR) AS key, ' "' || p_brand AS b, p_type || '"' AS t,
        CAST(3 AS INTEGER) AS n, false AS q FROM part""")
def csv_leading_blank(spark, sf):
    """S6.6 off: a blank before a qualifier starts an unqualified value (S6.12, S6.14 agree)."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_leading_blank", _lines(lambda: F.concat(
        _k(), F.lit(', "'), F.col("p_brand"), F.lit(","), F.col("p_type"), F.lit('"'))))
    o = D.DelimitedOptions(trim_whitespace=False)
    recs = D.read_records(spark, path, o)
    return recs.select(D.value_at("values", 0).alias("key"), D.value_at("values", 1).alias("b"), D.value_at("values", 2).alias("t"),
                       D.column_count("raw", o).alias("n"), F.element_at(D.qualified_flags("raw", o), 2).alias("q"))


@register("csv_blank_records", """SELECT CAST(p_partkey AS VARCHAR) AS k, p_brand AS b FROM part
        UNION ALL SELECT '' AS k, '' AS b FROM part""")
def csv_blank_records(spark, sf):
    """S6.8: a record of blanks is a record of one empty value, an empty line is none."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_blank_records", _lines(
        lambda: F.concat(F.concat_ws(",", _k(), F.col("p_brand")), F.lit("\n \t\n"))))
    return D.read_delimited(spark, path, schema="k string, b string")


@register("csv_backslash_numbers", """SELECT p_partkey, 'ABCDE' || chr(233) || chr(128512) || p_brand || chr(9) AS n FROM part""")
def csv_backslash_numbers(spark, sf):
    """S6.4: hexadecimal, octal, decimal and surrogate escapes next to letters, without a switch."""
    from cellar.sources import delimited as D
    path = FX.ensure_text(spark, sf, "csv_backslash_numbers", _lines(lambda: F.concat(
        _k(), F.lit(r',"\u0041\x42\d067\o104\105\xe9\uD83D\uDE00'), F.col("p_brand"), F.lit(r'\t"'))))
    return D.read_delimited(spark, path, D.DelimitedOptions(escape_mode="backslash"), schema="p_partkey long, n string")
