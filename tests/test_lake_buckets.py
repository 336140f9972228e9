"""Lake tables: buckets of bounded size, derived tables written where their rows lie."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerline.session import parallelism
from ledgerline.sources import tables as tb
from tests.conftest import rows


@pytest.fixture
def small(spark, tmp_path):
    """Orders with repeated and missing keys of customers, parts and suppliers, some without lines."""
    at = datetime(1996, 1, 1)
    data = {
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(1, "a", 3, 0.0, "HOUSEHOLD"), (1, "b", 4, 0.0, None), (2, "c", None, 0.0, "BUILDING")]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double", [(1, "s", 1, 0.0), (1, "t", 1, 0.0)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double", [(1, "p", "B", "PROMO", 1, 1.0), (1, "p", "C", None, 1, 1.0)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
                   [(k, c, "F", 10.5, at, "1-URGENT") for k, c in ((1, 1), (1, 2), (2, None), (3, 9), (4, 2), (None, 1))]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
                     [(k, p, s, n, 1.0, 2.5, 0.0, 0.0, f, "O", at) for k, p, s, n, f in ((1, 1, 1, 1, "R"), (1, 2, 2, 2, "N"), (2, None, 1, 1, "R"), (3, 1, None, 1, "A"), (None, 1, 1, 1, "R"))]),
        "events": ("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string", [(n, at, 1, "view", 1.0, "{}") for n in range(100)])}
    for name, (schema, values) in data.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_buckets_grow_with_the_input(spark, small, monkeypatch):
    monkeypatch.setattr(tb, "BUCKET_ROWS", 4)
    assert tb.lake_buckets(spark, small) == 25
    assert tb.lake_buckets(spark, "/root/testdata/sf0.001") >= parallelism(spark)


def test_order_facts_are_the_plain_joins(spark, small):
    o, c, p, s = (tb.read_table(spark, small, t) for t in ("orders", "customer", "part", "supplier"))
    lines = tb.order_lines(spark, small)
    plain = (o.join(lines, o.o_orderkey == lines.l_orderkey, "left").join(c, o.o_custkey == c.c_custkey, "left")
             .join(p, F.col("first_line.l_partkey") == p.p_partkey, "left").join(s, F.col("first_line.l_suppkey") == s.s_suppkey, "left"))
    got = tb.order_facts(spark, small)
    columns = [x for x in got.columns if x != "payment_intent_id"]
    assert rows(got.select(*columns)) == rows(plain.select(*columns)) and got.count() > o.count()
    assert got.where("not (payment_intent_id <=> concat('pi_', o_orderkey))").count() == 0


def test_payments_and_refunds_are_not_moved(spark, small):
    tb.lake_table(spark, small, "order_facts")
    buckets = tb.lake_buckets(spark, small)
    for name in ("payment", "refund", "refund_updates"):
        with tb._in_buckets(spark, buckets):
            plan = tb.LAKE_BUILDERS[name](spark, small).toDF(*tb.lake_table(spark, small, name).columns)
            assert plan.rdd.getNumPartitions() == buckets and "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    # The joined tables still lie alike.
    j = tb.lake_table(spark, small, "payment").join(tb.lake_table(spark, small, "refund"), "payment_intent_id").hint("merge")
    assert j.count() > 0
