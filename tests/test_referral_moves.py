"""Purchases stay by their id while the referral events of their buyers are found."""

import re
from datetime import datetime, timedelta

import pytest

import __spark_entry__ as E
from ledgerline.plans import purchases as npur
from tests.conftest import rows

T0 = datetime(2024, 1, 1)
BASE = "external_id string, email string, created_at timestamp_ntz, is_full_fare boolean, extra int"
EVENTS = "event_id long, user_email string, event_date timestamp_ntz, event_type string, campaign_id string, campaign_name string"
# Ids repeat (with another buyer or time, and as copies) and are missing; so are e-mails, times and flags.
PURCHASES = [("p1", "a", 0, True), ("p1", "a", 0, True), ("p1", "b", 0, True), ("p1", "a", 5, True), ("p2", "a", 2, False), ("p3", "a", 2, None),
             (None, "a", 0, True), (None, "b", 3, True), (None, None, 0, True), ("p4", None, 0, True), ("p5", "b", None, True), ("p6", "c", 0, True)]
FOUND = [(1, "a", 1, "user_qualified", "k1"), (2, "a", 1, "user_qualified", "k2"), (3, "a", 2, "page_viewed", "k3"), (4, "a", 3, "user_qualified", None),
         (5, "b", 4, "user_qualified", "k5"), (6, None, 1, "user_qualified", "k6"), (7, "b", None, "user_qualified", "k7"), (8, "c", 0, "user_qualified", "k8")]


def _at(n):
    return None if n is None else T0 + timedelta(hours=n)


def test_attribution_is_the_nearest_event_of_every_row(spark):
    base = [(i, e, _at(t), f, n) for n, (i, e, t, f) in enumerate(PURCHASES)]
    events = [(i, e, _at(t), y, c, c and c.upper()) for i, e, t, y, c in FOUND]
    want = []
    for row in base:
        later = [v for v in events if row[1] and v[1] == row[1] and row[2] and v[2] and v[2] > row[2]]
        nearest = min(later, key=lambda v: (v[2], v[0]), default=None)
        hit = bool(row[3]) and nearest is not None and nearest[3] == "user_qualified"
        want.append((*row, nearest[4] if hit else "", nearest[5] if hit else "", hit))
    got = npur.attribute_referrals(spark.createDataFrame(base, BASE), spark.createDataFrame(events, EVENTS))
    assert got.columns[-3:] == ["campaign_id", "campaign_name", "is_referral_purchase"]
    order = {"key": lambda t: t[4]}
    assert sorted(rows(got), **order) == sorted(want, **order) and sum(w[-1] for w in want) > 4


@pytest.mark.parametrize("query", ["attribute_first_event", "normalize_purchases_sql", "normalize_purchases"])
def test_purchases_are_not_moved_by_e_mail(spark, query):
    """With large tables only the events found are moved, to the ids."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        plan = E.queries()[query](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, old)
    moved = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert set(moved) <= {"__id", "__email", "email"} and moved.count("__id") == 1 and "SortMergeJoin" in plan
    # By e-mail go only the rows without an id.
    assert moved.count("email") <= 1
