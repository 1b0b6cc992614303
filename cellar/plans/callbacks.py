"""Small per-batch helpers the registered queries hand to executors.

Kept apart from the registry so that a Python worker importing them runs no
Spark code at import time.
"""

from __future__ import annotations

import re

import pandas as pd

# Pattern of the integer field ``k`` in the events' JSON props.
K_PATTERN = r'"k":\s*(\d+)'


def open_k_parser():
    return re.compile(K_PATTERN)


def parse_k(rx, pdf: pd.DataFrame) -> pd.DataFrame:
    ks = [int(m.group(1)) if (m := rx.search(p or "")) else None for p in pdf["props"].tolist()]
    return pd.DataFrame({"event_id": pdf["event_id"], "k": pd.array(ks, dtype="Int64")})


def cell_label(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"row_key": pdf["row_key"],
                         "label": pdf["row_key"] + "/" + pdf["qualifier"] + "=" + pdf["value"]})


def count_sum_add(acc, v):
    return (acc[0] + 1, acc[1] + int(v))


def count_sum_merge(a, b):
    return (a[0] + b[0], a[1] + b[1])


def count_sum_text(acc):
    return f"{acc[0]}:{acc[1]}"


def before_1996(odate: pd.Series) -> pd.Series:
    return odate < "1996-01-01"


def exact_add(acc, v):
    """E4 add: rows, values that aren't NULL, and their sum."""
    return (acc[0] + 1, acc[1] + (v is not None), acc[2] + (v or 0))


def exact_merge(a, b):
    return (a[0] + b[0], a[1] + b[1], a[2] + b[2])


def exact_text(acc) -> str:
    return ":".join(str(x) for x in acc)
