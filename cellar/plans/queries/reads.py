"""Wide-table reads: S3-S5, F1-F10, P6-P12, O1, O2."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.functions import predicates as P
from cellar.operators import widetable as W
from cellar.plans import fixtures as FX
from cellar.plans.queries._common import (CELL_OUT, C_ROWS_SQL, C_SQL, EVENT_CATALOG, R_SQL, register, stored_cells,
                                          stored_rows)


@register("to_cells", f"""WITH {R_SQL}
    SELECT row_key, 'o' AS family, qualifier, value FROM r
    UNPIVOT (value FOR qualifier IN (status, priority, cust, odate))""")
def to_cells(spark, sf):
    """Row form -> cell form (missing cells give no cell)."""
    return W.to_cells(stored_rows(spark, sf), FX.ORDER_ROWS_CATALOG).select("row_key", "family", "qualifier", "value")


@register("to_rows", f"WITH {C_SQL}, {C_ROWS_SQL} SELECT * FROM c_rows")
def to_rows(spark, sf):
    """Cell form -> row form, newest version per mapped cell."""
    return W.to_rows(stored_cells(spark, sf), EVENT_CATALOG)


@register("full_scan", f"WITH {R_SQL} SELECT * FROM r")
def full_scan(spark, sf):
    """The whole table (lazy; nothing pulled to the driver)."""
    return W.scan(stored_rows(spark, sf))


@register("key_prefix", f"WITH {R_SQL} SELECT * FROM r WHERE starts_with(row_key, '000000001')")
def key_prefix(spark, sf):
    """prefix scan."""
    return W.scan(stored_rows(spark, sf), prefix="000000001")


@register("key_from", f"WITH {R_SQL} SELECT * FROM r WHERE row_key >= '000000012000'")
def key_from(spark, sf):
    """scan from a start key."""
    return W.scan(stored_rows(spark, sf), start="000000012000")


@register("key_regex", f"WITH {R_SQL} SELECT * FROM r WHERE regexp_matches(row_key, '[05]7$')")
def key_regex(spark, sf):
    """row key regex (find)."""
    return W.scan(stored_rows(spark, sf), condition=P.key_regex("[05]7$"))


@register("key_regex_anchored", f"WITH {R_SQL} SELECT * FROM r WHERE regexp_matches(row_key, '^0000000(1|2[3-5])[0-9]*7$')")
def key_regex_anchored(spark, sf):
    """the literal begins of an anchored regex are pushed into the scan as prefixes."""
    return W.scan(stored_rows(spark, sf), condition=P.key_regex("^0000000(1|2[3-5])[0-9]*7$"))


@register("col_equals", f"WITH {R_SQL} SELECT * FROM r WHERE priority = '1-URGENT'")
def col_equals(spark, sf):
    """a missing cell fails."""
    return W.scan(stored_rows(spark, sf), condition=P.column_equals("priority", "1-URGENT"))


@register("col_at_least", f"WITH {R_SQL} SELECT * FROM r WHERE priority >= '3-MEDIUM'")
def col_at_least(spark, sf):
    """text comparison, a missing cell fails."""
    return W.scan(stored_rows(spark, sf), condition=P.column_at_least("priority", "3-MEDIUM"))


@register("col_regex", f"WITH {R_SQL} SELECT * FROM r WHERE priority IS NULL OR regexp_matches(priority, 'URGENT|HIGH')")
def col_regex(spark, sf):
    """a missing cell passes."""
    return W.scan(stored_rows(spark, sf), condition=P.column_regex("priority", "URGENT|HIGH"))


@register("all_of", f"""WITH {R_SQL} SELECT * FROM r
    WHERE odate >= '1997-01-01' AND (priority IS NULL OR regexp_matches(priority, 'HIGH')) AND status = 'P'""")
def all_of(spark, sf):
    """F7."""
    cond = P.all_of([P.column_at_least("odate", "1997-01-01"), P.column_regex("priority", "HIGH"),
                     P.column_equals("status", "P")])
    return W.scan(stored_rows(spark, sf), condition=cond)


@register("any_of", f"""WITH {R_SQL} SELECT * FROM r
    WHERE coalesce(priority = '1-URGENT', false) OR regexp_matches(row_key, '99$')""")
def any_of(spark, sf):
    """F8."""
    cond = P.any_of([P.column_equals("priority", "1-URGENT"), P.key_regex("99$")])
    return W.scan(stored_rows(spark, sf), condition=cond)


@register("filter_scan", f"""WITH {R_SQL} SELECT row_key, status, odate FROM r
    WHERE row_key >= '000000001000' AND starts_with(row_key, '00000000') AND status = 'F'""")
def filter_scan(spark, sf):
    """F10 + scanPrefix/scan(start) forms: start key, prefix, filter and named columns in one scan."""
    return W.scan(stored_rows(spark, sf), condition=P.column_equals("status", "F"), start="000000001000",
                  prefix="00000000", columns=["status", "odate"])


@register("prefix_exists", f"""WITH {C_SQL},
    p AS (SELECT DISTINCT substr(lpad(CAST(c_custkey AS VARCHAR), 12, '0'), 1, 11) AS prefix FROM customer)
    SELECT prefix, EXISTS (SELECT 1 FROM c WHERE starts_with(c.row_key, p.prefix)) AS "exists" FROM p""")
def prefix_exists(spark, sf):
    """F9 for many prefixes: equi semi-join per prefix length, no cross join."""
    prefixes = (FX.table(spark, sf, "customer")
                .select(F.substring(FX.padded_key(F.col("c_custkey")), 1, 11).alias("prefix")).distinct())
    return W.prefixes_exist(prefixes, stored_cells(spark, sf), lengths=[11])


@register("named_columns", f"""WITH {C_SQL} SELECT row_key, family, qualifier, value, seq FROM c
    WHERE family = 'ev' AND qualifier IN ('click', 'purchase')""")
def named_columns(spark, sf):
    """P6 on the cell form."""
    return W.named_cells(stored_cells(spark, sf), FX.EVENT_FAMILY, ["click", "purchase"]).select(*CELL_OUT)


@register("named_columns_rows", f"WITH {R_SQL} SELECT row_key, status, cust FROM r")
def named_columns_rows(spark, sf):
    """P6 on the row form."""
    return W.named_columns(stored_rows(spark, sf), FX.ORDER_ROWS_CATALOG, FX.ORDER_ROW_FAMILY, ["status", "cust"])


@register("column_prefix", f"""WITH {C_SQL} SELECT row_key, family, qualifier, value, seq FROM c
    WHERE starts_with(qualifier, 'cl') OR starts_with(qualifier, 'pu')""")
def column_prefix(spark, sf):
    """P7."""
    return W.column_prefix_cells(stored_cells(spark, sf), ["cl", "pu"]).select(*CELL_OUT)


@register("column_prefix_rows", f"WITH {R_SQL} SELECT row_key, priority FROM r")
def column_prefix_rows(spark, sf):
    """P7 on the row form: the columns whose name starts with a prefix."""
    return W.column_prefix_rows(stored_rows(spark, sf), FX.ORDER_ROWS_CATALOG, ["pri"])


@register("keys_only", f"WITH {C_SQL} SELECT DISTINCT row_key FROM c")
def keys_only(spark, sf):
    """P8."""
    return W.keys_only(stored_cells(spark, sf))


@register("family_map", f"""WITH {C_SQL},
    n AS (SELECT row_key, qualifier, arg_max(value, (ts, seq)) AS value FROM c GROUP BY row_key, qualifier)
    SELECT row_key, string_agg(qualifier || '=' || value, ',' ORDER BY qualifier || '=' || value) AS cells_text
    FROM n GROUP BY row_key""")
def family_map(spark, sf):
    """One family as a map (compared as sorted ``k=v`` text)."""
    m = W.family_map(stored_cells(spark, sf), FX.EVENT_FAMILY)
    entries = F.transform(F.map_entries("cells"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return m.select("row_key", F.array_join(F.array_sort(entries), ",").alias("cells_text"))


@register("latest_value", f"""WITH {C_SQL} SELECT row_key, family, qualifier, arg_max(value, (ts, seq)) AS value
    FROM c GROUP BY row_key, family, qualifier""")
def latest_value(spark, sf):
    """Newest value of every cell."""
    return W.latest_cells(stored_cells(spark, sf)).select("row_key", "family", "qualifier", "value")


@register("latest_click", f"""WITH {C_SQL} SELECT row_key, arg_max(value, (ts, seq)) AS value
    FROM c WHERE family = 'ev' AND qualifier = 'click' GROUP BY row_key""")
def latest_click(spark, sf):
    """P10: newest value of one named cell per row."""
    return W.latest_value(stored_cells(spark, sf), FX.EVENT_FAMILY, "click")


@register("column_listing", """SELECT DISTINCT 'ev' AS family, event_type AS qualifier FROM events
    UNION SELECT 'yhxx', 'ANY COLUMN' FROM customer""")
def column_listing(spark, sf):
    """(family, column) pairs; a family selected whole shows as ANY COLUMN."""
    both = stored_cells(spark, sf).unionByName(FX.user_cells(spark, sf))
    return W.column_listing(both, whole_families=["yhxx"])


@register("first_n", f"WITH {R_SQL} SELECT * FROM r ORDER BY row_key LIMIT 25")
def first_n(spark, sf):
    """O1: first rows in key order (top-k)."""
    return W.first_n(stored_rows(spark, sf), 25)


@register("page", f"WITH {R_SQL} SELECT * FROM r WHERE status = 'O' ORDER BY row_key LIMIT 50")
def page(spark, sf):
    """O2: page of a filtered scan, global over the key order."""
    return W.page(W.scan(stored_rows(spark, sf), condition=P.column_equals("status", "O")), 50)


META_SQL = """m AS (SELECT lpad(CAST(user_id AS VARCHAR), 12, '0') AS row_key, 'meta' AS family, 'props' AS qualifier,
        ts, props AS value, event_id AS seq FROM events)"""


def _two_family_cells(spark, sf) -> DataFrame:
    """C plus a second family ``meta`` (``props`` of each event)."""
    ev = FX.table(spark, sf, "events")
    meta = ev.select(FX.padded_key(F.col("user_id")).alias("row_key"), F.lit("meta").alias("family"),
                     F.lit("props").alias("qualifier"), "ts", F.col("props").alias("value"),
                     F.col("event_id").alias("seq"))
    return stored_cells(spark, sf).unionByName(meta)


@register("scan_families", f"""WITH {C_SQL}, {META_SQL}
    SELECT row_key, family, qualifier, value, seq FROM (SELECT * FROM c UNION ALL SELECT * FROM m)
    WHERE family IN ('meta')""")
def scan_families(spark, sf):
    """The cells of the families a reader knows (here one of two)."""
    return W.scan_families(_two_family_cells(spark, sf), ["meta"]).select(*CELL_OUT)


@register("named_cells_keep_families", f"""WITH {C_SQL}, {META_SQL}
    SELECT row_key, family, qualifier, value, seq FROM (SELECT * FROM c UNION ALL SELECT * FROM m)
    WHERE (family = 'ev' AND qualifier IN ('click')) OR family <> 'ev'""")
def named_cells_keep_families(spark, sf):
    """P6 + D4: naming columns of one family keeps the other families whole."""
    return W.named_cells(_two_family_cells(spark, sf), FX.EVENT_FAMILY, ["click"],
                         keep_other_families=True).select(*CELL_OUT)


@register("scan_limit", f"""WITH {R_SQL} SELECT row_key, status FROM r WHERE row_key >= '000000005000' AND status = 'F'
    ORDER BY row_key LIMIT 30""")
def scan_limit(spark, sf):
    """O1 + F2 + F10: a scan from a start key with a filter and a row limit (first rows in key order)."""
    return W.scan(stored_rows(spark, sf), condition=P.column_equals("status", "F"), start="000000005000",
                  columns=["status"], limit=30)
