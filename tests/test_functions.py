"""Column functions on the edge-case rows of FIXTURES.md section 2."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import (dispute_fields, epoch_to_ts, extract_payment_fields, is_full_refund,
                                  is_fully_refunded_short_term, operational_costs, parse_payload,
                                  processing_fee, purchase_flags, repair_quotes, state_name,
                                  strip_outer_quote, coerce_types)
from ledgerline.plans.refunds import exclude_accounts


def one(spark, data, schema, col):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_quote_repair_and_strip(spark):
    raw = '"{""id"": ""x"", ""e"": """"}"'
    out = one(spark, [(raw,)], "s string", strip_outer_quote(repair_quotes("s")))
    assert out == ['{"id": "x", "e": ""}']


def test_repair_limit_literal_double_single_quote(spark):
    # A literal '' inside a value becomes a double quote (documented limit).
    assert one(spark, [("a''b",)], "s string", repair_quotes("s")) == ['a"b']


def test_parse_payload_permissive(spark):
    df = spark.createDataFrame([("bad",), (None,), ("",), ('{"id": "ch_1", "amount": 5}',)], "s string")
    out = df.select(parse_payload("s").alias("j")).collect()
    assert out[0]["j"] is not None and out[0]["j"]["id"] is None
    assert out[1]["j"] is None
    assert out[2]["j"] is None
    assert out[3]["j"]["id"] == "ch_1" and out[3]["j"]["amount"] == 5


def test_tag_default(spark):
    docs = ['{"id": "a"}', '{"metadata": {"email": "x"}}', '{"metadata": {"packageTag": "p"}}']
    df = spark.createDataFrame([(d,) for d in docs], "s string")
    f = extract_payment_fields(parse_payload("s"))
    got = [tuple(r) for r in df.select(f["productTag"], f["provider"], f["provider_id"]).collect()]
    assert got == [("", "", ""), ("", "", ""), ("p", "", "")]


@pytest.mark.parametrize("tag,expected", [
    ("", (True, False, False, False, True)),
    ("homeRenewal", (False, True, False, False, True)),
    ("homeRenewalNew", (False, True, True, True, True)),
    ("PSDtrainX", (True, False, False, False, False)),
    ("autoRENEW", (True, True, False, False, True)),
    (None, (False, False, None, True, None)),
])
def test_purchase_flags(spark, tag, expected):
    f = purchase_flags("t", "c")
    df = spark.createDataFrame([(tag, None)], "t string, c string")
    r = df.select(f["is_full_fare"], f["is_renewal"], f["is_renewal_new"], f["is_other"],
                  f["has_appointment"]).collect()[0]
    assert tuple(r) == expected


def test_is_addon(spark):
    f = purchase_flags("t", "c")
    got = one(spark, [("x", "Add-on"), ("x", "Package"), ("x", None)], "t string, c string", f["is_addon"])
    assert got == [True, False, False]


def test_short_term_full_refund(spark):
    t0 = datetime(2022, 5, 1, 10, 0, 0)
    data = [
        (10.0, 10.0, t0, datetime(2022, 5, 2, 10, 0, 0)),            # +24 h -> T
        (10.0, 10.0, t0, datetime(2022, 5, 2, 10, 0, 0, 500000)),    # +24 h 0.5 s -> F
        (10.0, 10.0, t0, datetime(2022, 4, 30, 10, 0, 0)),           # -1 day -> T
        (10.0, None, t0, None),                                       # no refund -> F
        (10.0, 9.0, t0, t0),                                          # partial -> F
    ]
    df = spark.createDataFrame(data, "a double, r double, p timestamp_ntz, rt timestamp_ntz")
    got = [x[0] for x in df.select(is_fully_refunded_short_term("a", "r", "p", "rt")).collect()]
    assert got == [True, False, True, False, False]


def test_processing_fee(spark):
    got = one(spark, [(100.0,), (149.0,), (5.0,), (None,)], "a double", processing_fee("a"))
    assert got == [3.2, 4.62, 0.44, None]


def test_operational_costs(spark):
    # flags: has_appointment, full_fare, renewal, addon, created_at
    data = [
        (False, True, True, True, datetime(2022, 1, 1)),
        (True, False, True, False, datetime(2022, 1, 1)),
        (True, False, False, True, datetime(2022, 10, 30)),
        (True, False, False, True, datetime(2022, 10, 31)),
        (True, False, False, False, datetime(2022, 1, 1)),
    ]
    df = spark.createDataFrame(data, "h boolean, f boolean, r boolean, a boolean, t timestamp_ntz")
    got = [x[0] for x in df.select(operational_costs("h", "f", "r", "a", "t")).collect()]
    assert got == [0, 38, 18, 25, 0]


def test_full_refund_threshold(spark):
    assert one(spark, [(98.99,), (99.0,)], "x double", is_full_refund("x")) == [False, True]


def test_due_date_and_status(spark):
    docs = ['{"status": "won", "evidence_details": {"due_by": 1700000000}}', '{"evidence_details": {}}', "{}"]
    df = spark.createDataFrame([(d,) for d in docs], "s string")
    f = dispute_fields(parse_payload("s", "dispute"))
    got = [tuple(r) for r in df.select(f["dispute_response_required_by"], f["dispute_status"]).collect()]
    assert got == [(datetime(2023, 11, 14, 22, 13, 20), "won"), (None, ""), (None, "")]


def test_epoch_to_ts_is_zone_independent(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert one(spark, [(1700000000,)], "x long", epoch_to_ts("x")) == [datetime(2023, 11, 14, 22, 13, 20)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("state,name", [
    ("ca", "California"), ("C A", "California"), ("New York", "New York"), ("newyork", "New York"),
    ("XX", "UNKNOWN"), ("", "UNKNOWN"), (None, "UNKNOWN"), ("NULL", "UNKNOWN"), ("dc", "District of Columbia"),
    (" p r ", "Puerto Rico"), ("Cal", "UNKNOWN"),
])
def test_state_name(spark, state, name):
    assert one(spark, [(state,)], "s string", state_name("s")) == [name]


def test_exclude_accounts_drops_null_email(spark):
    df = spark.createDataFrame([("a@x.com",), (None,), ("ME@INTERNAL.org",), ("qa-team+1@x.com",)], "e string")
    kept = [r[0] for r in df.where(exclude_accounts("e", ["%internal%", "%QA-TEAM%"])).collect()]
    assert kept == ["a@x.com"]


def test_coerce_types_bad_text_is_null(spark):
    df = spark.createDataFrame([("1.5", "2024-01-01 10:00:00", "t"), ("x", "nope", "maybe")], "a string, b string, c string")
    got = [tuple(r) for r in coerce_types(df, {"a": "double", "b": "timestamp_ntz", "c": "boolean"}).collect()]
    assert got == [(1.5, datetime(2024, 1, 1, 10), True), (None, None, None)]
