"""Plan-shape regressions: pushdown, partial aggregation, co-located and
broadcast joins (checked on executed plans, broadcast threshold off so the
planner behaves as with large tables)."""

import re

import pytest

import __spark_entry__ as E

SMALL = "/root/testdata/sf0.001"


@pytest.fixture()
def big_tables(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_incremental_scan_pushes_watermark(big_tables):
    plan = _final_plan(E.queries()["scan_incremental"](big_tables, SMALL))
    assert re.search(r"PushedFilters: \[IsNotNull\(created_at\), GreaterThan\(created_at,", plan)


def test_asof_does_not_shuffle_payments(big_tables):
    plan = _final_plan(E.queries()["join_asof"](big_tables, SMALL))
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan


def test_refund_payment_join_is_co_located(big_tables):
    plan = _final_plan(E.queries()["normalize_refunds"](big_tables, SMALL))
    assert "SortMergeJoin" in plan
    assert "Exchange hashpartitioning(payment_intent_id" not in plan


def test_fold_and_latest_aggregate_map_side(big_tables):
    for key in ("cdc_fold", "latest_per_key"):
        plan = _final_plan(E.queries()[key](big_tables, SMALL))
        assert "partial_" in plan, key


def test_no_python_udf_in_flagship(big_tables):
    plan = _final_plan(E.queries()["normalize_purchases"](big_tables, SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
