"""Linear as-of / next-event joins against brute-force definitions."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.joins import join_asof, join_next, restrict_to
from tests.definitions import join_following_events, join_versions_all
from pyspark.sql import Window
from tests.conftest import rows

T0 = datetime(2020, 1, 1)


def _facts(rnd, n, keys):
    # One hot key holds about a third of the rows.
    out = []
    for i in range(n):
        k = "hot" if rnd.random() < 0.34 else rnd.choice(keys)
        t = T0 + timedelta(days=rnd.randrange(400), seconds=rnd.choice([0, 0, 1, 7200]))
        out.append((i, k if rnd.random() > 0.03 else None, t if rnd.random() > 0.03 else None))
    return out


def _versions(rnd, n, keys):
    out = []
    for i in range(n):
        k = "hot" if rnd.random() < 0.34 else rnd.choice(keys)
        t = T0 + timedelta(days=rnd.randrange(400))
        out.append((1000 + i, k, t, f"name{i}"))
    return out


def _asof_brute(facts, versions):
    res = []
    for i, k, t in facts:
        best = None
        if k is not None and t is not None:
            cands = [(vt, vid, nm) for vid, vk, vt, nm in versions if vk == k and vt <= t]
            best = max(cands) if cands else None
        res.append((i, k, t, best[1] if best else None, best[2] if best else None))
    return sorted(res, key=lambda r: r[0])


@pytest.mark.parametrize("bucket,bcast,hot", [(None, 0, None), (30 * 86400, 0, None), (7 * 86400, 0, None),
                                              (30 * 86400, 10**6, None), (86400, 0, 40)])
def test_asof_matches_brute_force(spark, bucket, bcast, hot):
    rnd = random.Random(11)
    keys = [f"k{i}" for i in range(6)]
    facts, versions = _facts(rnd, 400, keys), _versions(rnd, 60, keys)
    # equal start times for one key: the larger id wins
    versions.append((5000, "hot", versions[0][2] if versions[0][1] == "hot" else T0 + timedelta(days=50), "dup"))
    versions.append((4999, "hot", versions[-1][2], "dup-lower"))
    L = spark.createDataFrame(facts, "i long, k string, t timestamp_ntz")
    R = spark.createDataFrame(versions, "id long, tag string, start timestamp_ntz, name string")
    got = join_asof(L, R, left_key="k", right_key="tag", left_time="t", right_time="start", tiebreak=["id"],
                    columns={"id": "vid", "name": "vname"}, bucket_seconds=bucket, broadcast_max_rows=bcast,
                    hot_key_rows=hot)
    assert sorted([tuple(r) for r in got.collect()], key=lambda r: r[0]) == _asof_brute(facts, versions)


def test_versions_all_fans_out(spark):
    L = spark.createDataFrame([(1, "a", T0 + timedelta(days=10))], "i long, k string, t timestamp_ntz")
    R = spark.createDataFrame([(1, "a", T0), (2, "a", T0 + timedelta(days=5)), (3, "a", T0 + timedelta(days=20))],
                              "id long, tag string, starting_at timestamp_ntz")
    got = rows(join_versions_all(L, R, "k", "t", {"id": "vid"}))
    assert [r[-1] for r in got] == [1, 2]


def _next_brute(facts, events):
    res = []
    for i, k, t in facts:
        best = None
        if k is not None and t is not None:
            cands = [(int(et.timestamp()) // 1, eid, ty) for eid, ek, et, ty in events if ek == k and et > t]
            best = min(cands) if cands else None
        res.append((i, k, t, best[2] if best else None))
    return sorted(res, key=lambda r: r[0])


@pytest.mark.parametrize("bucket,hot", [(None, None), (30 * 86400, None), (86400, None), (3600, 50), (86400, 10**9)])
def test_next_matches_brute_force(spark, bucket, hot):
    rnd = random.Random(5)
    keys = [f"k{i}" for i in range(6)]
    facts = _facts(rnd, 400, keys)
    events = []
    for j in range(300):
        k = "hot" if rnd.random() < 0.34 else rnd.choice(keys)
        base = T0 + timedelta(days=rnd.randrange(400))
        # sub-second times inside one second: ranked by whole second, then id
        t = base + timedelta(microseconds=rnd.choice([0, 200000, 700000]), seconds=rnd.choice([0, 0, 1]))
        events.append((j if j % 2 else 1000 - j, k, t, rnd.choice(["user_qualified", "link_clicked"])))
    L = spark.createDataFrame(facts, "i long, k string, t timestamp_ntz")
    R = spark.createDataFrame(events, "event_id long, email string, event_date timestamp_ntz, event_type string")
    got = join_next(L, R, left_key="k", right_key="email", left_time="t", right_time="event_date",
                    rank=[F.unix_timestamp("event_date"), F.col("event_id")], columns={"event_type": "et"},
                    bucket_seconds=bucket, hot_key_rows=hot)
    assert sorted([tuple(r) for r in got.collect()], key=lambda r: r[0]) == _next_brute(facts, events)


def test_next_is_strict_and_asof_inclusive(spark):
    t = T0 + timedelta(days=3)
    L = spark.createDataFrame([(1, "a", t)], "i long, k string, t timestamp_ntz")
    same = spark.createDataFrame([(9, "a", t, "x")], "event_id long, email string, event_date timestamp_ntz, event_type string")
    nxt = join_next(L, same, left_key="k", right_key="email", left_time="t", right_time="event_date",
                    rank=[F.col("event_id")], columns={"event_type": "et"})
    assert nxt.collect()[0]["et"] is None
    V = spark.createDataFrame([(9, "a", t)], "id long, tag string, starting_at timestamp_ntz")
    asof = join_asof(L, V, left_key="k", right_key="tag", left_time="t", right_time="starting_at", tiebreak=["id"],
                     columns={"id": "vid"})
    assert asof.collect()[0]["vid"] == 9


def test_next_equals_ranked_definition_form(spark):
    """join_next == row_number over the all-pairs definition (rank 1)."""
    rnd = random.Random(3)
    facts = [(i, f"u{rnd.randrange(4)}", T0 + timedelta(days=rnd.randrange(60))) for i in range(80)]
    events = [(j, f"u{rnd.randrange(4)}", T0 + timedelta(days=rnd.randrange(60), hours=rnd.randrange(3)),
               rnd.choice(["a", "b"])) for j in range(60)]
    L = spark.createDataFrame(facts, "i long, email string, t timestamp_ntz")
    R = spark.createDataFrame(events, "event_id long, user_email string, event_date timestamp_ntz, event_type string")
    pairs = join_following_events(L, R, "email", "t", ["event_id", "event_type"])
    w = Window.partitionBy("i").orderBy(F.unix_timestamp("event_date") - F.unix_timestamp("t"), "event_id")
    ranked = pairs.withColumn("rk", F.row_number().over(w)).where("rk = 1").select("i", "email", "t", F.col("event_type").alias("et"))
    fast = join_next(L, R, left_key="email", right_key="user_email", left_time="t", right_time="event_date",
                     rank=[F.unix_timestamp("event_date"), F.col("event_id")], columns={"event_type": "et"},
                     bucket_seconds=7 * 86400)
    assert rows(fast) == rows(ranked)


def test_asof_broadcast_plan_does_not_shuffle_facts(spark):
    L = spark.createDataFrame([(1, "a", T0)], "i long, k string, t timestamp_ntz")
    V = spark.createDataFrame([(9, "a", T0)], "id long, tag string, starting_at timestamp_ntz")
    j = join_asof(L, V, left_key="k", right_key="tag", left_time="t", right_time="starting_at", tiebreak=["id"],
                  columns={"id": "vid"}, bucket_seconds=86400, broadcast_max_rows=1000)
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Window" not in plan.split("BroadcastExchange")[0]


@pytest.mark.parametrize("bcast", [0, 10**6])
def test_asof_equals_ranked_versions_all(spark, bcast):
    rnd = random.Random(21)
    keys = [f"k{i}" for i in range(5)]
    facts = [(i, rnd.choice(keys), T0 + timedelta(days=rnd.randrange(300))) for i in range(150)]
    versions = [(100 + j, rnd.choice(keys), T0 + timedelta(days=rnd.randrange(300))) for j in range(40)]
    L = spark.createDataFrame(facts, "i long, k string, t timestamp_ntz")
    R = spark.createDataFrame(versions, "id long, tag string, starting_at timestamp_ntz")
    fan = join_versions_all(L, R.withColumn("vstart", F.col("starting_at")), "k", "t",
                            {"id": "vid", "vstart": "vstart"})
    w = Window.partitionBy("i").orderBy(F.col("vstart").desc_nulls_last(), F.col("vid").desc_nulls_last())
    ranked = fan.withColumn("rk", F.row_number().over(w)).where("rk = 1").select("i", "k", "t", "vid")
    fast = join_asof(L, R, left_key="k", right_key="tag", left_time="t", right_time="starting_at", tiebreak=["id"],
                     columns={"id": "vid"}, bucket_seconds=20 * 86400, broadcast_max_rows=bcast)
    assert rows(fast) == rows(ranked)


def test_restrict_to_keeps_what_the_increment_needs(spark):
    rows_ = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    increment = spark.createDataFrame([(3,), (3,), (None,), (500,)], "k long")
    assert [r["k"] for r in restrict_to(rows_, increment, "k").collect()] == [3]
    assert restrict_to(rows_, increment, "k", most=1, words=0).count() == 100
