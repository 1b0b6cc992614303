"""Plan properties of the registered queries, on the smallest tables."""

import re

import pytest

from cellar.plans.queries import queries
from tests.conftest import SMALL

# Queries whose semantics need Python (caller code).
PYTHON_ALLOWED = {"delete_where_pred", "batch_calls", "partition_stage",
                  "row_callback", "user_aggregate", "user_aggregate_types"}
# Bounded single-partition steps: the E5 numbering's window over a table of one row per range, and a
# global count/sum whose exchange carries one partial row per partition.
SINGLE_PARTITION_ALLOWED = {"batch_calls"}


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for name, fn in queries().items():
        df = fn(spark, SMALL)
        df.write.format("noop").mode("overwrite").save()
        out[name] = df._jdf.queryExecution().executedPlan().toString()
    return out


def test_no_cross_or_nested_loop_joins(plans):
    bad = [n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p]
    assert not bad


def test_no_single_partition_exchange(plans):
    bad = [n for n, p in plans.items() if "SinglePartition" in p and n not in SINGLE_PARTITION_ALLOWED]
    assert not bad


def test_python_only_where_needed(plans):
    py = re.compile(r"ArrowEvalPython|BatchEvalPython|MapIn|FlatMapGroupsIn")
    bad = [n for n, p in plans.items() if py.search(p) and n not in PYTHON_ALLOWED]
    assert not bad


def test_flagship_is_one_jvm_plan(plans):
    p = plans["crawl_order_report"]
    assert "Python" not in p and "Scan ExistingRDD" not in p
    assert re.search(r"BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin", p)


def test_stored_table_filters_reach_the_scan(plans):
    assert "StringStartsWith(row_key,000000001)" in plans["key_prefix"]
    assert "GreaterThanOrEqual(row_key,000000012000)" in plans["key_from"]
    assert "EqualTo(priority,1-URGENT)" in plans["col_equals"]


def test_every_query_reads_files(plans):
    # every registered query reads the driver tables or data Spark derived from them
    # (a query whose lineage is cut by a reliable checkpoint scans the checkpointed data instead)
    bad = [n for n, p in plans.items() if "FileScan" not in p and "ExistingRDD" not in p and "wide_table" not in p]
    assert not bad
    assert "ExistingRDD" in plans["batch_calls"]
