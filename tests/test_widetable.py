import os
import datetime as dt

import pytest
from pyspark.sql import functions as F

from cellar.functions import predicates as P
from cellar.operators import lookup as J
from cellar.operators import mutate as M
from cellar.operators import widetable as W

T0 = dt.datetime(2024, 1, 1)
CELLS = "row_key string, family string, qualifier string, ts timestamp_ntz, value string, seq long"
CAT = W.Catalog(table="t", columns=(W.ColumnSpec("a", "f", "a"), W.ColumnSpec("b", "f", "b"),
                                    W.ColumnSpec("x", "g", "x")))


def cells(spark, rows):
    return spark.createDataFrame(rows, CELLS)


def ts(m):
    return T0 + dt.timedelta(minutes=m)


@pytest.fixture()
def versioned(spark):
    return cells(spark, [
        ("r1", "f", "a", ts(1), "old", 1), ("r1", "f", "a", ts(2), "new", 2),
        ("r1", "f", "b", ts(1), "b1", 3), ("r1", "g", "x", ts(5), "x1", 4),
        ("r2", "f", "a", ts(3), "t1", 5), ("r2", "f", "a", ts(3), "t2", 6),   # equal ts: seq decides
        ("r3", "g", "x", ts(1), "ünï", 7), ("r4", "f", "b", ts(1), "", 8),
    ])


def test_catalog_from_json():
    text = ('{"table":{"namespace":"default","name":"t"},"rowkey":"key","columns":{'
            '"key":{"cf":"rowkey","col":"key","type":"string"},'
            '"a":{"cf":"f","col":"a","type":"string"},"n":{"cf":"f","col":"num","type":"int"}}}')
    cat = W.Catalog.from_json(text)
    assert cat.row_key == "key" and cat.names == ["a", "n"]
    assert cat.schema().simpleString() == "struct<key:string,a:string,n:int>"
    assert cat.column("f", "num").name == "n"


def test_to_rows_newest_and_missing(spark, versioned):
    rows = {r["row_key"]: r.asDict() for r in W.to_rows(versioned, CAT).collect()}
    assert rows["r1"] == {"row_key": "r1", "a": "new", "b": "b1", "x": "x1"}
    assert rows["r2"]["a"] == "t2" and rows["r2"]["b"] is None
    assert rows["r3"]["x"] == "ünï" and rows["r4"]["b"] == ""


def test_to_cells_round_trip(spark, versioned):
    rows = W.to_rows(versioned, CAT)
    back = W.to_rows(W.to_cells(rows, CAT, ts=F.lit(T0), seq=F.lit(0)), CAT)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    # missing cells produce no cell
    assert W.to_cells(rows, CAT).where("row_key = 'r2'").count() == 1


def test_family_map_latest_and_absent(spark, versioned):
    m = {r["row_key"]: r["cells"] for r in W.family_map(versioned, "f").collect()}
    assert m["r1"] == {"a": "new", "b": "b1"}
    assert m["r3"] == {}


def test_latest_value_and_keys(spark, versioned):
    got = {r["row_key"]: r["value"] for r in W.latest_value(versioned, "f", "a").collect()}
    assert got == {"r1": "new", "r2": "t2"}
    assert sorted(r[0] for r in W.keys_only(versioned).collect()) == ["r1", "r2", "r3", "r4"]


def test_column_listing_any_column(spark, versioned):
    got = sorted(map(tuple, W.column_listing(versioned, whole_families=["g"]).collect()))
    assert got == [("f", "a"), ("f", "b"), ("g", "ANY COLUMN")]


def test_filters_missing_cell_rules(spark, versioned):
    rows = W.to_rows(versioned, CAT)
    keys = lambda df: sorted(r["row_key"] for r in df.collect())
    assert keys(rows.where(P.column_equals("b", "b1"))) == ["r1"]
    assert keys(rows.where(P.column_at_least("b", "a"))) == ["r1"]          # r2, r3 missing -> fail
    assert keys(rows.where(P.column_regex("b", "^b"))) == ["r1", "r2", "r3"]  # missing passes
    assert keys(rows.where(P.all_of([]))) == ["r1", "r2", "r3", "r4"]
    assert keys(rows.where(P.any_of([]))) == []
    assert keys(rows.where(P.any_of([P.key_prefix("r3"), P.column_equals("a", "t2")]))) == ["r2", "r3"]


def test_named_columns_d4(spark, versioned):
    rows = W.to_rows(versioned, CAT)
    assert W.named_columns(rows, CAT, "f", ["a"]).columns == ["row_key", "a"]
    assert W.named_columns(rows, CAT, "f", ["a"], keep_other_families=True).columns == ["row_key", "a", "x"]
    assert W.named_cells(versioned, "f", ["a"], keep_other_families=True).where("family = 'g'").count() == 2


def test_prefix_exists(spark, versioned):
    assert W.prefix_exists(versioned, "r") and not W.prefix_exists(versioned, "q")
    prefixes = spark.createDataFrame([("r1",), ("r",), ("zz",)], "prefix string")
    got = dict(map(tuple, W.prefixes_exist(prefixes, versioned).collect()))
    assert got == {"r1": True, "r": True, "zz": False}


def test_first_n_and_page(spark, versioned):
    rows = W.to_rows(versioned, CAT)
    assert [r[0] for r in W.first_n(rows, 2).collect()] == ["r1", "r2"]
    assert W.page(rows, 3).count() == 3


def test_upsert_newest_wins_and_versions(spark, versioned):
    change = cells(spark, [("r1", "f", "a", ts(2), "again", 99), ("r9", "f", "a", ts(0), "n", 100)])
    latest = {(r["row_key"], r["qualifier"]): r["value"] for r in M.upsert(versioned, change).collect()}
    assert latest[("r1", "a")] == "again" and latest[("r9", "a")] == "n"
    kept = M.upsert(versioned, change, keep_versions=True)
    r1a = sorted(r["value"] for r in kept.where("row_key = 'r1' AND qualifier = 'a'").collect())
    assert r1a == ["again", "old"]


def test_put_cell(spark, versioned):
    out = M.put_cell(spark, versioned, "r5", "f", "a", b"bytes", ts=ts(9), seq=50)
    assert out.where("row_key = 'r5'").first()["value"] == "bytes"


def test_delete_latest_shows_older_version(spark, versioned):
    req = spark.createDataFrame([("r1", "f", "a")], "row_key string, family string, qualifier string")
    after = M.delete_latest(versioned, req)
    assert {r["row_key"]: r["value"] for r in W.latest_value(after, "f", "a").collect()}["r1"] == "old"
    assert after.count() == versioned.count() - 1


def test_delete_where_null_keeps(spark, versioned):
    rows = W.to_rows(versioned, CAT)
    kept = M.delete_where(rows, P.column_equals("b", "b1"))
    assert sorted(r[0] for r in kept.collect()) == ["r2", "r3", "r4"]
    pred = M.delete_where_pred(rows, P.key_prefix("r"), F.col("a").isNull())
    assert sorted(r[0] for r in pred.collect()) == ["r1", "r2"]


def test_delete_rows_and_cells(spark, versioned):
    keys = spark.createDataFrame([("r1",), ("zz",)], "row_key string")
    assert M.delete_rows(versioned, keys).where("row_key = 'r1'").count() == 0
    gone = M.delete_rows_where_cells(versioned, F.col("value") == "x1")
    assert gone.where("row_key = 'r1'").count() == 0


def test_range_layout_five_sorted_ranges(spark, scratch):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("row_key"))
    laid = M.range_layout(df, 5)
    assert laid.rdd.getNumPartitions() == 5
    parts = laid.rdd.glom().map(lambda rs: [r[0] for r in rs]).collect()
    assert all(p == sorted(p) for p in parts)
    assert all(parts[i][-1] < parts[i + 1][0] for i in range(4))


def test_prefix_filter_is_pushed_to_parquet(spark, scratch):
    df = spark.range(100).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("row_key"),
                                 F.col("id").cast("string").alias("v"))
    df.write.mode("overwrite").parquet(scratch + "/t")
    scan = W.scan(spark.read.parquet(scratch + "/t"), start="000010", prefix="0000", columns=["row_key"])
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(row_key,0000)" in plan and "GreaterThanOrEqual(row_key,000010)" in plan
    assert "ReadSchema: struct<row_key:string>" in plan
    assert scan.count() == 90


def test_lookup_is_a_jvm_join_and_missing_rules(spark, versioned):
    probe = spark.createDataFrame([("p1", "r1"), ("p2", "nope"), ("p3", "r1")], "id string, k string")
    lk = J.lookup_table(versioned, "f", "a", "a_val")
    out = J.enrich(probe, lk, "k", "row_key", ["a_val"], on_missing="null")
    assert sorted((r["id"], r["a_val"]) for r in out.collect()) == [("p1", "new"), ("p2", None), ("p3", "new")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
    assert J.enrich(probe, lk, "k", "row_key", ["a_val"], on_missing="drop").count() == 2
    with pytest.raises(Exception, match="lookup found no value"):
        J.enrich(probe, lk, "k", "row_key", ["a_val"], on_missing="error").collect()


def test_batch_get_keeps_order_and_duplicates(spark, versioned):
    rows = W.to_rows(versioned, CAT)
    keys = spark.createDataFrame([(0, "r2"), (1, "zz"), (2, "r2"), (3, "r1")], "pos int, row_key string")
    got = [(r["pos"], r["row_key"], r["a"]) for r in J.batch_get(keys, rows).orderBy("pos").collect()]
    assert got == [(0, "r2", "t2"), (1, "zz", None), (2, "r2", "t2"), (3, "r1", "new")]
    filt = J.batch_get(keys, rows, condition=F.col("b").isNotNull()).orderBy("pos").collect()
    assert [r["a"] for r in filt] == [None, None, None, "new"]
    assert J.point_get(rows, "r1").count() == 1 and J.point_get(rows, "zz").count() == 0


def test_salted_lookup_same_result(spark, versioned):
    probe = spark.range(3000).select(F.col("id").cast("string").alias("id"),
                                     F.when(F.col("id") % 3 == 0, "nope").otherwise("r1").alias("k"))
    lk = J.lookup_table(versioned, "f", "a", "a_val")
    plain = sorted(map(tuple, J.enrich(probe, lk, "k", "row_key", ["a_val"], on_missing="null").collect()))
    salted = sorted(map(tuple, J.enrich(probe, lk, "k", "row_key", ["a_val"], on_missing="null",
                                        salt_buckets=8).collect()))
    assert plain == salted and len(salted) == 3000


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_put = st.tuples(st.sampled_from(["r1", "r2"]), st.sampled_from(["a", "b"]), st.integers(0, 3),
                 st.text(alphabet="xyz", max_size=3))


@settings(max_examples=20, deadline=None)
@given(st.lists(_put, max_size=8), st.lists(_put, max_size=8))
def test_upsert_matches_dict_model(spark, base, changes):
    def frame(puts, seq0):
        return cells(spark, [(k, "f", q, ts(t), v, seq0 + i) for i, (k, q, t, v) in enumerate(puts)])
    model: dict = {}
    for seq, (k, q, t, v) in enumerate(base + changes):
        cur = model.get((k, q))
        if cur is None or (t, seq) > cur[0]:
            model[(k, q)] = ((t, seq), v)
    got = {(r["row_key"], r["qualifier"]): r["value"] for r in M.upsert(frame(base, 0), frame(changes, len(base))).collect()}
    assert got == {k: v[1] for k, v in model.items()}


def test_for_each_batch_side_effects(spark, scratch):
    from cellar.operators.enrich import for_each_batch

    def dump(pdf):
        import uuid
        pdf.to_csv(os.path.join(scratch, f"{uuid.uuid4().hex}.csv"), index=False, header=False)

    for_each_batch(spark.range(0, 50, 1, 3), dump)
    total = sum(len(open(os.path.join(scratch, f)).read().split()) for f in os.listdir(scratch))
    assert total == 50


def test_row_upsert_is_deterministic_on_ties(spark):
    from cellar.plans.etl import upsert_rows
    base = spark.createDataFrame([("k1", "a", "1"), ("k2", "b", "1")], "key string, v string, o string")
    ch = spark.createDataFrame([("k1", "z", "1"), ("k1", "c", "1"), ("k2", "x", "0")], "key string, v string, o string")
    got = dict((r["key"], r["v"]) for r in upsert_rows(base, ch, order="o").collect())
    assert got == {"k1": "z", "k2": "b"}


def test_scan_with_limit_in_key_order(spark, versioned):
    rows = W.to_rows(versioned, CAT)
    got = [r["row_key"] for r in W.scan(rows, start="r2", limit=2).collect()]
    assert got == ["r2", "r3"]


def test_enrich_with_asserted_small_lookup_broadcasts(spark, versioned):
    probe = spark.range(100).select(F.when(F.col("id") % 2 == 0, "r1").otherwise("r2").alias("k"))
    lk = J.lookup_table(versioned, "f", "a", "a_val")
    out = J.enrich(probe, lk, "k", "row_key", ["a_val"], broadcast_lookup=True)
    assert sorted({r["a_val"] for r in out.collect()}) == ["new", "t2"]
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_operators_chain_with_transform(spark, versioned):
    rows = W.to_rows(versioned, CAT)
    out = (rows.transform(W.scan, prefix="r", condition=P.column_regex("b", "^b"))
               .transform(M.delete_where, P.key_regex("3$"))
               .transform(W.first_n, 5))
    assert [r["row_key"] for r in out.collect()] == ["r1", "r2"]


def test_requested_broadcast_is_checked(spark, versioned):
    probe = spark.range(10).select(F.when(F.col("id") % 2 == 0, "r1").otherwise("r2").alias("k"))
    lk = J.lookup_table(versioned, "f", "a", "a_val")
    over = J.enrich(probe, lk, "k", "row_key", ["a_val"], broadcast_lookup=1)      # 2 lookup rows > bound 1
    assert over.count() == 10
    within = J.enrich(probe, lk, "k", "row_key", ["a_val"], broadcast_lookup=5)
    within.collect()
    assert "BroadcastHashJoin" in within._jdf.queryExecution().executedPlan().toString()


def test_as_records_positional_and_typed_to_rows(spark):
    cat = W.Catalog(table="t", row_key="key", columns=(W.ColumnSpec("n", "f", "num", "int"),
                                                       W.ColumnSpec("s", "f", "txt")))
    raw = spark.createDataFrame([("k1", "7", "a"), ("k2", None, "b")], "a string, b string, c string")
    recs = W.as_records(raw, cat, source_names=["a", "b", "c"])
    assert recs.schema.simpleString() == "struct<key:string,n:int,s:string>"
    cells = W.to_cells(recs, cat, ts=F.lit(T0), seq=F.lit(1))
    assert cells.count() == 3                                   # the NULL n of k2 is a missing cell
    back = {r["key"]: (r["n"], r["s"]) for r in W.to_rows(cells, cat).collect()}
    assert back == {"k1": (7, "a"), "k2": (None, "b")}
    with pytest.raises(ValueError):
        W.as_records(raw, cat, source_names=["a"])


def test_put_without_a_time_wins(spark, versioned):
    out = M.put_cell(spark, versioned, "r1", "f", "a", "fresh").where("row_key = 'r1' and family = 'f' and qualifier = 'a'")
    assert out.first()["value"] == "fresh"
    rows = spark.createDataFrame([("r1", "again")], "row_key string, x string")
    cat = W.Catalog(table="t", columns=(W.ColumnSpec("x", "f", "a"),))
    changed = M.upsert(versioned, W.to_cells(rows, cat)).where("row_key = 'r1' and family = 'f' and qualifier = 'a'")
    assert changed.first()["value"] == "again"


def test_put_without_a_time_column_or_value_is_refused(spark, versioned):
    rows = spark.createDataFrame([("r1", "f", "a", None, "x", 1)], M.CELL_SCHEMA)
    with pytest.raises(Exception, match="without a timestamp"):
        M.upsert(versioned, rows).collect()
    with pytest.raises(ValueError, match="timestamp column"):
        M.upsert(versioned, rows.drop("ts"))


def test_put_any_bytes(spark, versioned):
    with pytest.raises(ValueError, match="binary_cells"):
        M.put_cell(spark, versioned, "r1", "f", "a", b"\xff\x01")
    out = M.put_cell(spark, M.binary_cells(versioned), "r1", "f", "a", b"\xff\x01").where("row_key = 'r1' and qualifier = 'a' and family = 'f'")
    assert bytes(out.first()["value"]) == b"\xff\x01"


def test_column_prefix_goes_by_qualifier(spark):
    cat = W.Catalog(table="t", columns=(W.ColumnSpec("total", "f", "price"), W.ColumnSpec("prize", "f", "won")))
    rows = spark.createDataFrame([("k", "1", "2")], "row_key string, total string, prize string")
    assert W.column_prefix_rows(rows, cat, ["pri"]).columns == ["row_key", "total"]


def test_prefixes_of_unlisted_length_fail(spark):
    keys = spark.createDataFrame([("abc",)], "row_key string")
    prefixes = spark.createDataFrame([("a",), ("ab",)], "prefix string")
    assert {r[1] for r in W.prefixes_exist(prefixes, keys, lengths=[1, 2]).collect()} == {True}
    with pytest.raises(Exception, match="isn't listed"):
        W.prefixes_exist(prefixes, keys, lengths=[1]).collect()


def test_literal_begins_of_a_regex_are_pushed(spark, scratch):
    path = f"{scratch}/t"
    spark.range(2000).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("row_key")).write.parquet(path)
    plan = W.scan(spark.read.parquet(path), P.key_regex("^0000(1|2).*"))._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "StringStartsWith(row_key,00001)" in pushed and "StringStartsWith(row_key,00002)" in pushed
