"""Delimited text: text lines, a record-boundary scan and column expressions.

:class:`DelimitedOptions` holds the reader's switches with the source's
defaults (comma, ``"`` qualifier, doubled escape, trimming on, comments off,
empty records skipped, guard on, ISO-8859-1 for files). Every way to read goes
through the same steps, so all agree on trimming, comments, junk, escapes and
empty records:

* lines come from Spark's text reader; where qualified values may hold line breaks,
  :func:`whole_records` finds the records' borders, many tasks a file;
* a record is cut into fields by one linear, qualifier-aware tokenizing match a field
  (:func:`raw_fields`), and a field becomes a value by :func:`unqualify` (S6.3, S6.4, S6.6,
  S6.15: text after a closing qualifier is dropped);
* a duplicate header name resolves to the last column (S6.1, D1);
* record numbers (S6.10) come from the file, block and position of each line.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.functions._util import as_col

# The reader's defaults and its guard limits.
DEFAULT_DELIMITER = ","
DEFAULT_QUALIFIER = '"'
DEFAULT_COMMENT = "#"
FILE_CHARSET = "ISO-8859-1"
MAX_COLUMN_CHARS = 100_000
MAX_COLUMNS = 100_000
# Single-letter backslash escapes and the characters they stand for.
BACKSLASH_LETTERS = (("n", "\n"), ("r", "\r"), ("t", "\t"), ("b", "\b"), ("f", "\f"), ("e", "\x1b"),
                     ("v", "\x0b"), ("a", "\x07"))


@dataclass(frozen=True)
class DelimitedOptions:
    delimiter: str = DEFAULT_DELIMITER
    qualifier: str = DEFAULT_QUALIFIER
    use_qualifier: bool = True
    escape_mode: str = "doubled"          # or "backslash"
    use_comments: bool = False
    comment: str = DEFAULT_COMMENT
    trim_whitespace: bool = True
    record_delimiter: str | None = None   # None: CR, LF or CRLF
    skip_empty_records: bool = True
    safety_switch: bool = True
    header: bool = False
    charset: str = FILE_CHARSET
    multiline: bool = False               # qualified values may hold line breaks

    def with_(self, **kw) -> "DelimitedOptions":
        return replace(self, **kw)


def read_delimited(spark: SparkSession, path: str, options: DelimitedOptions = DelimitedOptions(),
                   schema: T.StructType | str | None = None, names: Sequence[str] | None = None) -> DataFrame:
    """Read delimited files, one column a value. ``names`` sets the column names (S6.1
    ``setHeaders``); with ``header=True`` a duplicate header name keeps only its last column (D1).

    A missing or empty text value is ``''``; a value that isn't of its type is NULL. Without a
    ``schema`` the first record tells the number of columns. ``multiline=True`` keeps line breaks
    inside qualified values (:func:`whole_records`).
    """
    o = options
    header = read_headers(spark, path, o) if o.header and schema is None else None
    if schema is not None:
        fields = _struct(schema).fields
    else:
        width = header or names or read_headers(spark, path, o)
        fields = [T.StructField(f"_c{i}", T.StringType()) for i in range(len(width))]
    lines = _record_lines(spark, path, o, multiline_raw=o.multiline)
    if o.safety_switch:
        lines = lines.withColumn("raw", F.when(_too_much(F.col("raw"), o), _guard_error("string")).otherwise(F.col("raw")))
    tokens = lines.select(raw_fields("raw", o).alias("f"))
    out = tokens.select(*[_typed(F.coalesce(unqualify(F.get("f", i), o), F.lit("")), f.dataType).alias(f"c{i}")
                          for i, f in enumerate(fields)]).toDF(*[f.name for f in fields])
    if names is not None:
        return out.toDF(*names)
    return keep_last_duplicate(out, header) if header else out


def _struct(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _typed(text: Column, kind: T.DataType) -> Column:
    """A value as its type; text stays as it is, what doesn't convert is NULL."""
    return text if isinstance(kind, T.StringType) else text.try_cast(kind)


def parse_delimited(text, schema: T.StructType | str, options: DelimitedOptions = DelimitedOptions()) -> Column:
    """Parse delimited text held in a column into a struct, by the raw-record tokenizer.

    A missing or empty text value is ``''`` (NULL only where the whole text is), a value that
    isn't of its type NULL.
    """
    values = ragged_values(text, options)
    parts = [_typed(value_at(values, i), f.dataType).alias(f.name) for i, f in enumerate(_struct(schema).fields)]
    return F.when(as_col(text).isNotNull(), F.struct(*parts))


def read_headers(spark: SparkSession, path: str, options: DelimitedOptions = DelimitedOptions()) -> list[str]:
    """S6.1 ``readHeaders``/``getHeaders``: the names in the first record (``len`` is the header count,
    ``[i]`` the i-th header). Only that one record is read."""
    first = read_records(spark, path, options.with_(header=False)).select("values").limit(1).collect()
    return list(first[0][0]) if first else []


def keep_last_duplicate(df: DataFrame, header: Sequence[str]) -> DataFrame:
    """A header name that appears more than once resolves to its last column."""
    cols = df.columns
    if not header or len(header) > len(cols):
        return df
    last = {name: i for i, name in enumerate(header)}
    keep = [i for i, name in enumerate(header) if last[name] == i]
    extra = cols[len(header):]          # partition columns follow the data columns
    return df.select(*[F.col(f"`{cols[i]}`").alias(header[i]) for i in keep], *[F.col(f"`{c}`") for c in extra])


# --- backslash escapes (S6.4) ------------------------------------------------------------------

# The numeric forms - \uXXXX and \xXX (hexadecimal), \oOOO and \OOO (octal), \dDDD (decimal).
_HEX_PAIR = r"\\[uU][dD][89abAB][0-9a-fA-F]{2}\\[uU][dD][c-fC-F][0-9a-fA-F]{2}"
_ESCAPE = (_HEX_PAIR + r"|\\[uU][0-9a-fA-F]{4}|\\[xX][0-9a-fA-F]{2}|\\[oO][0-7]{3}|\\[dD][0-9]{3}|\\[0-7]{3}|\\[\s\S]")
_LETTERS = "".join(letter for letter, _ in BACKSLASH_LETTERS)
_CONTROLS = "".join(char for _, char in BACKSLASH_LETTERS)


def decode_backslash(c) -> Column:
    """Decode the escapes of a value: letters (``\\n \\r \\t \\b \\f \\e \\v \\a``), numbers (``\\uXXXX``, ``\\xXX``,
    ``\\oOOO``, ``\\dDDD``, ``\\OOO``) and a backslash before any other character.

    The value is cut into escapes and text between them, left to right, and each escape is
    decoded on its own. A lone half of a surrogate pair becomes U+FFFD; a backslash at the end stays out.
    """
    text = as_col(c)
    pieces = F.regexp_extract_all(text, F.lit(_ESCAPE + r"|[^\\]+"), 0)
    return F.when(F.contains(text, F.lit("\\")), F.array_join(F.transform(pieces, _decoded), "")).otherwise(text)


def _decoded(piece: Column) -> Column:
    kind = F.lower(F.substring(piece, 2, 1))
    digits = F.substring(piece, 3, 8)
    units = (F.when(F.length(piece) == 12, F.concat(F.substring(piece, 3, 4), F.substring(piece, 9, 4)))
             .when(kind == "u", F.when(digits.rlike("^[dD][89a-fA-F]"), F.lit("fffd")).otherwise(digits))
             .when(kind == "x", digits).when(kind == "o", F.conv(digits, 8, 16)).when(kind == "d", F.conv(digits, 10, 16))
             .otherwise(F.conv(F.substring(piece, 2, 8), 8, 16)))
    width = F.when(F.length(units) > 4, 8).otherwise(4)
    number = F.decode(F.unhex(F.lpad(units, width, "0")), "UTF-16BE")
    letter = F.translate(F.substring(piece, 2, 1), _LETTERS, _CONTROLS)
    return (F.when(~piece.startswith("\\"), piece).when(F.length(piece) > 2, number).otherwise(letter))


# --- raw records, ragged rows, qualifiers, junk (S6.9, S6.12, S6.14, S6.15) --------------------

def raw_fields(raw, options: DelimitedOptions = DelimitedOptions()) -> Column:
    """The fields of a raw record as written (qualifiers kept).

    One tokenizing match per field, left to right, so the work is linear in the
    line length: a field is either qualified - the qualifier, text with doubled (or
    backslash-escaped) qualifiers, the closing qualifier and any text up to the next
    delimiter, or the rest of the record if none closes it - or anything up to the next
    delimiter (a qualifier inside an unqualified field is ordinary text). Blanks before the
    qualifier are allowed if whitespace is trimmed. A record without qualifiers is split.
    """
    o, text = options, as_col(raw)
    d = _re_escape(o.delimiter)
    backslash = o.escape_mode == "backslash"
    split = F.split(text, d, -1)
    if not o.use_qualifier and not backslash:
        return split
    # every field match starts at a delimiter (one is put in front of the record), so no
    # match is empty and there is exactly one field per delimiter
    if o.use_qualifier:
        q = _re_escape(o.qualifier)
        field, special = f"{d}({_blanks(o)}{q}{_qualified_run(q, backslash)}(?:{q}[^{d}]*+|\\\\?\\z)|[^{d}]*+)", o.qualifier
    else:
        field, special = f"{d}({_escaped_run(d)}\\\\?)", "\\"
    tokens = F.regexp_extract_all(F.concat(F.lit(o.delimiter), text), F.lit(field), 1)
    return F.when(F.contains(text, F.lit(special)), tokens).otherwise(split)


def _blanks(o: DelimitedOptions) -> str:
    """Regex of what may stand before a qualifier or comment character."""
    return "[ \\t]*+" if o.trim_whitespace else ""


def _escaped_run(stop: str) -> str:
    """Regex of text up to ``stop``, a backslash taking the next character with it. Possessive: no recursion per
    character, so a value's length doesn't matter."""
    return rf"[^{stop}\\]*+(?:\\[\s\S][^{stop}\\]*+)*+"


def _qualified_run(q: str, backslash: bool) -> str:
    """Regex of the text between qualifiers (possessive as well)."""
    return _escaped_run(q) if backslash else f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+"


def unqualify(field, options: DelimitedOptions = DelimitedOptions()) -> Column:
    """One raw field -> its value: outer blanks trimmed, qualifiers removed, doubled qualifiers
    undone, text after the closing qualifier dropped (S6.15).

    In backslash mode the escapes of a qualified value are decoded (:func:`decode_backslash`);
    with the qualifier off, those of every value.
    """
    o, f = options, as_col(field)
    backslash = o.escape_mode == "backslash"
    blank = F.lit(" \t")
    plain = F.trim(f, blank) if o.trim_whitespace else f
    if not o.use_qualifier:
        return decode_backslash(plain) if backslash else plain
    q = _re_escape(o.qualifier)
    begun = F.ltrim(f, blank) if o.trim_whitespace else f
    inner = F.regexp_extract(begun, f"^{q}({_qualified_run(q, backslash)})", 1)
    value = decode_backslash(inner) if backslash else F.replace(inner, F.lit(o.qualifier * 2), F.lit(o.qualifier))
    return F.when(begun.startswith(o.qualifier), value).otherwise(plain)


def ragged_values(raw, options: DelimitedOptions = DelimitedOptions()) -> Column:
    """S6.12: every value of a record, however many there are."""
    return F.transform(raw_fields(raw, options), lambda x: unqualify(x, options))


def value_at(values, i: int) -> Column:
    """S6.12 ``get(i)``: the value at 0-based position ``i``; ``''`` past the end."""
    return F.coalesce(F.try_element_at(as_col(values), F.lit(i + 1)), F.lit(""))


def column_count(raw, options: DelimitedOptions = DelimitedOptions()) -> Column:
    """S6.12: number of values in the record."""
    return F.size(raw_fields(raw, options))


def qualified_flags(raw, options: DelimitedOptions = DelimitedOptions()) -> Column:
    """S6.14: for each value, was it enclosed in the qualifier?"""
    if not options.use_qualifier:
        return F.transform(raw_fields(raw, options), lambda x: F.lit(False))
    start = f"^{_blanks(options)}{_re_escape(options.qualifier)}"
    return F.transform(raw_fields(raw, options), lambda x: x.rlike(start))


def read_records(spark: SparkSession, path: str, options: DelimitedOptions = DelimitedOptions(),
                 with_number: bool = False, multiline_raw: bool = False) -> DataFrame:
    """S6.9 (+S6.8, S6.5, S6.10, S6.1 header): one row per record: ``raw`` text and its ``values``.

    Line-based by default: a qualified line break starts a new record (D13).
    ``multiline_raw=True`` (or the option ``multiline``) joins the lines of a record whose qualified
    values hold line breaks (:func:`whole_records`). Empty records are skipped unless
    ``skip_empty_records=False``; comment lines are dropped when comments are on; with ``header=True``
    the first record of each file is the header and is neither returned nor counted. ``with_number``
    adds ``record`` (S6.10). With the guard on (S6.13) a longer value or record fails the job.
    """
    lines = _record_lines(spark, path, options, with_number, multiline_raw or options.multiline)
    values = ragged_values("raw", options)
    if options.safety_switch:
        values = F.when(_too_much(F.col("raw"), options), _guard_error("array<string>")).otherwise(values)
    return lines.withColumn("values", values)


def _decoded_text(charset: str) -> Column:
    """The text reader's ``value``, which holds a line's bytes, in its charset."""
    value = F.col("value")
    return value if charset.upper() in ("UTF-8", "UTF8") else F.decode(value.cast("binary"), charset)


def _record_lines(spark: SparkSession, path: str, o: DelimitedOptions, with_number: bool = False,
                  multiline_raw: bool = False) -> DataFrame:
    """``raw`` (and ``record``) of every record that isn't skipped."""
    reader = spark.read.option("encoding", o.charset)
    if multiline_raw:
        lines = whole_records(reader.option("lineSep", o.record_delimiter or "\n").text(path), o)
    else:
        if o.record_delimiter is not None:
            reader = reader.option("lineSep", o.record_delimiter)
        text, decoded = reader.text(path), _decoded_text(o.charset)
        keep = _kept(o, decoded)
        lines = with_record_number(text, keep=keep) if with_number or o.header else text.where(keep)
        lines = lines.withColumn("raw", decoded).drop("value")
    if o.header:
        lines = lines.where(F.col("record") > 0).withColumn("record", F.col("record") - 1)
    return lines if with_number else lines.select("raw")


def _guard_error(kind: str) -> Column:
    """S6.13: fails the job where it is evaluated."""
    why = f"a value of more than {MAX_COLUMN_CHARS} characters or more than {MAX_COLUMNS} values (safety_switch)"
    return F.raise_error(F.lit(why)).cast(kind)


def _too_much(raw: Column, o: DelimitedOptions) -> Column:
    """S6.13: does a record hold a value that is too long, or too many? Shorter records are not tokenized for it."""
    values = ragged_values(raw, o)
    return (F.length(raw) > MAX_COLUMN_CHARS) & (F.exists(values, lambda v: F.length(v) > MAX_COLUMN_CHARS)
                                                 | (F.size(values) > MAX_COLUMNS))


def _places(lines: DataFrame) -> DataFrame:
    """Lines with the file, split and place (ascending in a split) they come from."""
    return lines.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                        F.monotonically_increasing_id().alias("_pos"))


def _pieces(lines: DataFrame, o: DelimitedOptions) -> DataFrame:
    """Lines (cut at line feeds) cut at carriage returns too, each with the break that ended it.

    ``_sub`` is a piece's place in its line. A custom record delimiter leaves lines as they are.
    """
    if o.record_delimiter is not None:
        return lines.withColumn("_sub", F.lit(0)).withColumn("_end", F.lit(o.record_delimiter))
    parts, n = F.split("value", "\r", -1), F.size(F.split("value", "\r", -1))
    pair = F.element_at(parts, -1) == ""  # the last carriage return stands before the line feed

    def piece(text: Column, i: Column) -> Column:
        end = F.when(i == n - 1, "\n").when((i == n - 2) & pair, "\r\n").otherwise("\r")
        return F.struct(text.alias("value"), end.alias("_end"))

    cut = F.slice(F.transform(parts, piece), F.lit(1), F.when(pair, n - 1).otherwise(n))
    one = F.array(F.struct(F.col("value"), F.lit("\n").alias("_end")))
    rows = lines.select(*[c for c in lines.columns if c != "value"],
                        F.posexplode(F.when(F.contains("value", F.lit("\r")), cut).otherwise(one)).alias("_sub", "_piece"))
    return rows.select(*[c for c in lines.columns if c != "value"], "_sub", "_piece.value", "_piece._end")


#: A value that ends in a backslash which escapes what follows.
PENDING = r"(?<!\\)(?:\\\\)*+\\\z"


def _opens(o: DelimitedOptions) -> tuple[Column, Column]:
    """Does a line end inside a value: entered at the start of a record, and entered inside a value?

    The value is a qualified one, or in backslash mode with the qualifier off one whose last
    line break is escaped.
    """
    value = F.col("value")
    d, backslash = _re_escape(o.delimiter), o.escape_mode == "backslash"
    comment = value.rlike(f"^{_blanks(o)}{_re_escape(o.comment)}") if o.use_comments else F.lit(False)
    if not o.use_qualifier:
        if not backslash:
            return F.lit(0), F.lit(0)
        pending = value.rlike(PENDING)
        return (pending & ~comment).cast("int"), pending.cast("int")
    q = _re_escape(o.qualifier)
    run, blanks = _qualified_run(q, backslash), _blanks(o)
    rest = r"\\?\z" if backslash else r"\z"
    field = f"(?:{blanks}{q}{run}{q}[^{d}]*+|(?!{blanks}{q})[^{d}]*+)"
    begun = f"(?:{field}{d})*+{blanks}{q}{run}{rest}"
    quoted = F.contains(value, F.lit(o.qualifier))
    fresh = F.when(quoted & ~comment, value.rlike("^" + begun).cast("int")).otherwise(0)
    inside = F.when(quoted, value.rlike(f"^{run}(?:{rest}|{q}[^{d}]*+{d}{begun})").cast("int")).otherwise(1)
    return fresh, inside


def whole_records(lines: DataFrame, options: DelimitedOptions = DelimitedOptions()) -> DataFrame:
    """S6.9, D13: ``raw, record`` - records that may span lines, numbered per file from 0.

    ``lines`` come straight from the text reader, cut at line feeds (or the record delimiter). Whether a
    qualifier opens a value depends on what stands before it: in an unqualified value, after a closing
    qualifier or in a comment it is ordinary text. So each line maps the state it may be entered in (at the
    start of a record, or inside a value) to the state it is left in, and the maps compose: first
    along each split, then over a table of one row a split, which gives each split its entry state and first
    number. No task reads a whole file. Skipped records (empty, comments) are not numbered. A
    record keeps the line breaks as they are in the file (``\\r``, ``\\n``, ``\\r\\n``), but for one at the end
    of a file inside a value that nothing closes. Files whose only breaks are carriage returns are cut into splits with
    ``record_delimiter="\\r"``. With the guard on, a value that goes on for more than
    ``MAX_COLUMN_CHARS`` over whole lines fails the job before it is put together.
    """
    o = options
    fresh, inside = _opens(o)
    pieces = _pieces(_places(lines).withColumn("value", _decoded_text(o.charset)), o)
    if not o.use_qualifier and o.escape_mode == "backslash":
        # an escape takes the carriage return only: the line feed after it ends the record
        half = (F.col("_end") == "\r\n") & F.col("value").rlike(PENDING)
        pieces = pieces.withColumn("value", F.when(half, F.concat("value", F.lit("\r"))).otherwise(F.col("value")))
    tagged = pieces.select(
        "_file", "_block", F.struct("_pos", "_sub").alias("_at"), "value", "_end", fresh.alias("_f0"), inside.alias("_f1"),
        _kept(o, F.col("value")).cast("long").alias("_keep"))
    upto = Window.partitionBy("_file", "_block").orderBy("_at")
    local = _scanned(tagged, upto)

    def state(entry) -> Column:
        return F.coalesce("_base", F.lit(entry) if isinstance(entry, int) else entry).bitwiseXOR(F.col("_flips"))

    def starts(entry: int) -> Column:
        return F.sum(F.when(state(entry) == 0, F.col("_keep")).otherwise(0))

    def all_starts(entry: int) -> Column:
        return F.sum(F.when(state(entry) == 0, 1).otherwise(0))

    def left(entry: int) -> Column:
        out = F.when(state(entry) == 0, F.col("_f0")).otherwise(F.col("_f1"))
        return F.max(F.struct("_at", out.alias("state")))["state"]

    splits = local.groupBy("_file", "_block").agg(
        left(0).alias("_f0"), left(1).alias("_f1"), starts(0).alias("_k0"), starts(1).alias("_k1"),
        all_starts(0).alias("_a0"), all_starts(1).alias("_a1"))
    order = Window.partitionBy("_file").orderBy("_block")
    splits = _scanned(splits, order).withColumn("_state", state(0))
    own = F.when(F.col("_state") == 0, F.col("_k0")).otherwise(F.col("_k1"))
    every = F.when(F.col("_state") == 0, F.col("_a0")).otherwise(F.col("_a1"))
    splits = splits.select("_file", "_block", "_state", (F.sum(own).over(order) - own).alias("_first"),
                           (F.sum(every).over(order) - every).alias("_group"))

    placed = local.join(splits, ["_file", "_block"]).withColumn("_begins", (state(F.col("_state")) == 0).cast("long"))
    counted = F.col("_begins") * F.col("_keep")
    placed = (placed.withColumn("_record", F.col("_group") + F.sum("_begins").over(upto))
              .withColumn("record", F.col("_first") + F.sum(counted).over(upto) - 1))
    if o.safety_switch:
        # lines that lie inside one value altogether, since the last line that doesn't
        within = (F.col("_begins") == 0) & (F.col("_f1") == 1) & ~F.contains("value", F.lit(o.qualifier))
        total = F.sum(F.when(within, F.length("value") + F.length("_end")).otherwise(0)).over(upto)
        last = F.last(F.when(~within, F.col("_sum")), ignorenulls=True).over(upto)
        placed = (placed.withColumn("_sum", total).withColumn("_since", F.coalesce(last, F.lit(0)))
                  .withColumn("value", F.when(F.col("_sum") - F.col("_since") > MAX_COLUMN_CHARS, _guard_error("string"))
                              .otherwise(F.col("value"))))
    line = F.struct("_block", "_at", "value", "_end", "record", counted.alias("keep"))
    rows = placed.groupBy("_file", "_record").agg(F.sort_array(F.collect_list(line)).alias("_lines"))
    first, n = F.get("_lines", 0), F.size("_lines")
    joined = F.array_join(F.transform("_lines", lambda x, i: F.concat(x["value"], F.when(i < n - 1, x["_end"])
                                                                       .otherwise(""))), "")
    return rows.where(first["keep"] == 1).select(joined.alias("raw"), first["record"].alias("record"))


def _scanned(rows: DataFrame, upto: Window) -> DataFrame:
    """Rows with ``_base`` and ``_flips``: entered in ``coalesce(_base, entry) xor _flips`` if the first is entered in ``entry``.

    A row maps the state it is entered in (0 or 1) to ``_f0`` or ``_f1``. If both are one state, the row sets
    it; if not, it keeps or swaps the states. So all rows before a row compose to the state that
    was set last and the parity of the swaps since then.
    """
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    sets = F.col("_f0") == F.col("_f1")
    swaps = F.sum(F.when(sets, 0).otherwise(F.col("_f0"))).over(upto) % 2
    counted = rows.withColumn("_swaps", swaps.cast("int"))
    return (counted.withColumn("_flips", F.coalesce(F.last("_swaps").over(before), F.lit(0)))
            .withColumn("_base", F.last(F.when(sets, F.col("_f0").bitwiseXOR(F.col("_swaps"))), ignorenulls=True).over(before)))


def _kept(o: DelimitedOptions, text: Column) -> Column:
    """Is a line that starts a record neither empty nor a comment (S6.5, S6.8)? One of blanks is a record."""
    keep = F.lit(True)
    if o.skip_empty_records:
        keep = keep & (text != "")
    if o.use_comments:
        start = F.ltrim(text, F.lit(" \t")) if o.trim_whitespace else text
        keep = keep & ~start.startswith(o.comment)
    return keep


def with_record_number(lines: DataFrame, keep: Column | None = None, number_col: str = "record") -> DataFrame:
    """S6.10: 0-based record number per file, in file order, skipped lines not counted.

    ``lines`` must come straight from a file reader (it uses the ``_metadata`` column).
    A line's place is (file, split start, place inside the split). Ids taken
    right after the filter are consecutive inside a split, so the place inside
    the split is ``id - first id of the split``; a table with one row per split
    gives the number of kept lines in the splits before it. That table is small, and AQE
    broadcasts it by its measured size, so the lines themselves are then not shuffled.
    """
    kept = lines.where(keep) if keep is not None else lines
    tagged = _places(kept)
    splits = tagged.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    before = splits.select("_file", "_block", "_first",
                           (F.sum("_n").over(Window.partitionBy("_file").orderBy("_block")) - F.col("_n"))
                           .alias("_before"))
    # computed inside the same job as the lines (not fetched ahead), so both see one split layout
    return (tagged.join(before, ["_file", "_block"])
            .withColumn(number_col, F.col("_before") + F.col("_pos") - F.col("_first"))
            .drop("_file", "_block", "_pos", "_first", "_before"))


def skip_records(records: DataFrame, numbers: Sequence[int], number_col: str = "record") -> DataFrame:
    """S6.11 ``skipRecord``: drop the records with the given numbers (per file)."""
    return records.where(~F.col(number_col).isin(list(numbers)))


def skip_lines(spark: SparkSession, path: str, numbers: Sequence[int], charset: str = FILE_CHARSET) -> DataFrame:
    """S6.11 ``skipLine``: the physical lines of each file without the given 0-based line numbers.

    Unlike :func:`skip_records` this counts raw lines - empty and comment lines
    included - so a qualified value spread over lines is cut like any other text.
    """
    lines = with_record_number(spark.read.option("encoding", charset).text(path), number_col="line_number")
    return lines.where(~F.col("line_number").isin(list(numbers))).withColumn("value", _decoded_text(charset))


def header_index(header: Sequence[str], name: str) -> int:
    """S6.1 ``getIndex``: position of a header name; a duplicate name resolves to its last column (D1); -1 if absent."""
    found = [i for i, h in enumerate(header) if h == name]
    return found[-1] if found else -1


def _re_escape(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?{}[]\|()" else ch for ch in s)


__all__ = ["DelimitedOptions", "read_delimited", "read_headers", "parse_delimited", "keep_last_duplicate",
           "decode_backslash", "raw_fields", "unqualify", "ragged_values", "value_at", "column_count", "qualified_flags",
           "read_records", "whole_records", "with_record_number", "skip_records", "skip_lines", "header_index",
           "MAX_COLUMN_CHARS", "MAX_COLUMNS"]
