"""Caller code: E1, E2, E5, K4."""

from __future__ import annotations

from cellar.plans import callbacks as CB
from cellar.plans import fixtures as FX
from cellar.plans.queries._common import C_SQL, H_SQL, PHONE_NUMBER_SQL, register, stored_cells


@register("batch_calls", f"""WITH {H_SQL},
    n AS (SELECT number FROM (SELECT {PHONE_NUMBER_SQL} AS number FROM h) WHERE regexp_full_match(number, '[0-9]+')),
    b AS (SELECT number, (row_number() OVER (ORDER BY number) - 1) // 99 AS batch_id FROM n),
    g AS (SELECT batch_id, count(*) AS n_values, string_agg(number, ',' ORDER BY number) AS numbers FROM b
          GROUP BY batch_id)
    SELECT batch_id, n_values, numbers, CAST(n_values AS VARCHAR) AS response,
           numbers || chr(9) || CAST(n_values AS VARCHAR) AS line FROM g""")
def batch_calls(spark, sf):
    """Numbers in consecutive batches of 99, one service call per batch, ``numbers<TAB>response`` lines."""
    from cellar.plans.phones import enrich_phone_list
    return enrich_phone_list(FX.phone_lines(spark, sf).select("line"), max_attempts=3, pause_seconds=0.1)


@register("partition_stage", r"""SELECT event_id, CAST(NULLIF(regexp_extract(props, '"k":\s*(\d+)', 1), '') AS BIGINT) AS k
    FROM events""")
def partition_stage(spark, sf):
    """A resource (a compiled pattern) opened once per partition, applied batch by batch."""
    from cellar.operators.enrich import map_partitions_with_resource
    ev = FX.table(spark, sf, "events").select("event_id", "props")
    return map_partitions_with_resource(ev, CB.open_k_parser, CB.parse_k, "event_id long, k long")


@register("row_callback", f"""WITH {C_SQL} SELECT row_key, row_key || '/' || qualifier || '=' || value AS label FROM c""")
def row_callback(spark, sf):
    """A per-row callback over every scanned cell, vectorised over Arrow batches."""
    from cellar.operators.enrich import map_rows
    return map_rows(stored_cells(spark, sf).select("row_key", "qualifier", "value"), CB.cell_label,
                    "row_key string, label string")
