"""latest_per_key and merge_upsert semantics."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.dedup import latest_per_key
from ledgerline.operators.merge import (PAYMENT_MERGE, MergeSpec, append_by_name, merge_upsert,
                                        merge_into_table, write_table)
from ledgerline.session import shared_dir
from tests.conftest import rows

T1, T2 = datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 11)


def test_latest_per_key_keep_ties(spark):
    df = spark.createDataFrame([
        ("a", T1, "x"), ("a", T1, "x"),            # two equal rows -> one
        ("b", T2, "x"), ("b", T2, "y"), ("b", T1, "z"),  # two different rows at max -> both
        ("c", None, "x"), ("c", None, "y"),         # only NULL times -> none
        ("d", None, "x"), ("d", T1, "y"),          # NULL time loses
    ], "k string, t timestamp_ntz, v string")
    got = rows(latest_per_key(df, "k", "t"))
    assert got == [("a", T1, "x"), ("b", T2, "x"), ("b", T2, "y"), ("d", T1, "y")]


def test_latest_per_key_one(spark):
    df = spark.createDataFrame([("b", T2, "x"), ("b", T2, "y"), ("b", T1, "z"), ("c", None, "q")],
                               "k string, t timestamp_ntz, v string")
    assert rows(latest_per_key(df, "k", "t", ties="one")) == [("b", T2, "y")]


SPEC = MergeSpec(on=("k",), update=("v",), insert=("k", "v", "data"))


def _t(spark, data):
    return spark.createDataFrame(data, "k string, v string, data string, id long")


def test_merge_update_keeps_insert_only_column_and_id(spark):
    target = _t(spark, [("a", "old", "d0", 7)])
    source = spark.createDataFrame([("a", "new", "d1"), ("b", "nb", "db")], "k string, v string, data string")
    got = rows(merge_upsert(target, source, SPEC))
    assert got == [("a", "new", "d0", 7), ("b", "nb", "db", None)]


def test_merge_null_key_inserted_every_run(spark):
    target = _t(spark, [("a", "v", "d", 1)])
    source = spark.createDataFrame([(None, "n", "dn")], "k string, v string, data string")
    once = merge_upsert(target, source, SPEC)
    twice = merge_upsert(once, source, SPEC)
    assert len(rows(twice)) == 3
    safe = merge_upsert(merge_upsert(target, source, SPEC, null_safe=True), source, SPEC, null_safe=True)
    assert len(rows(safe)) == 2


def test_merge_idempotent_and_row_count_law(spark):
    target = _t(spark, [(str(i), "v", "d", i) for i in range(20)])
    source = spark.createDataFrame([(str(i), "w", "e") for i in range(10, 30)], "k string, v string, data string")
    m1 = merge_upsert(target, source, SPEC)
    m2 = merge_upsert(m1, source, SPEC)
    assert rows(m1) == rows(m2)
    assert len(rows(m1)) == 20 + 10


def test_merge_validate_rejects_duplicate_source_keys(spark):
    target = _t(spark, [("a", "v", "d", 1)])
    source = spark.createDataFrame([("a", "x", "d"), ("a", "y", "d")], "k string, v string, data string")
    with pytest.raises(Exception, match="several rows"):
        merge_upsert(target, source, SPEC, validate=True).collect()


def test_append_by_name(spark):
    target = _t(spark, [("a", "v", "d", 1)])
    more = spark.createDataFrame([("e", "b")], "data string, k string")
    assert rows(append_by_name(target, more)) == [("a", "v", "d", 1), ("b", None, "e", None)]


def test_merge_into_bucketed_table(spark):
    path = shared_dir(spark, "test-table")
    target = _t(spark, [(str(i), "v", "d", i) for i in range(50)])
    write_table(target, path, ("k",), buckets=8)
    source = spark.createDataFrame([("3", "w", "x"), ("77", "n", "y")], "k string, v string, data string")
    merge_into_table(spark, path, source, SPEC, buckets=8)
    got = {r["k"]: (r["v"], r["data"], r["id"]) for r in spark.read.parquet(path).collect()}
    assert len(got) == 51 and got["3"] == ("w", "d", 3) and got["77"] == ("n", "y", None)
    assert got["4"] == ("v", "d", 4)


def test_payment_spec_leaves_payload(spark):
    assert "payment_data" not in PAYMENT_MERGE.update and "payment_data" in PAYMENT_MERGE.insert


def test_merge_dedupe_by_latest(spark):
    target = _t(spark, [("a", "old", "d0", 7)])
    source = spark.createDataFrame([("a", "x", "d1", T1), ("a", "y", "d2", T2), ("b", "z", "d3", T1)],
                                   "k string, v string, data string, t timestamp_ntz")
    got = rows(merge_upsert(target, source, SPEC, dedupe_by="t"))
    assert got == [("a", "y", "d0", 7), ("b", "z", "d3", None)]


def test_merge_sql_matches_dataframe_merge(spark):
    import duckdb

    from ledgerline.operators.merge import NORM_REFUND_MERGE, merge_sql
    tgt = [("a", "old", "d0", 7), ("c", "keep", "dc", 3), (None, "n", "dn", 1)]
    src = [("a", "new", "d1"), ("b", "nb", "db"), (None, "x", "dx")]
    con = duckdb.connect()
    con.execute("CREATE TABLE tt (k VARCHAR, v VARCHAR, data VARCHAR, id BIGINT)")
    con.executemany("INSERT INTO tt VALUES (?, ?, ?, ?)", tgt)
    con.execute("CREATE TABLE ss (k VARCHAR, v VARCHAR, data VARCHAR)")
    con.executemany("INSERT INTO ss VALUES (?, ?, ?)", src)
    con.execute(merge_sql(SPEC, "tt", "ss"))
    want = sorted(con.execute("SELECT * FROM tt").fetchall(), key=str)
    got = sorted([tuple(r) for r in merge_upsert(_t(spark, tgt), spark.createDataFrame(
        src, "k string, v string, data string"), SPEC).collect()], key=str)
    assert got == want
    # source columns feeding differently named target columns
    assert "created_at = s.payment_created_at" in merge_sql(NORM_REFUND_MERGE, "t", "s")
