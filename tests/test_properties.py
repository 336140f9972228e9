"""Property tests (hypothesis) of merge and latest-per-key against a plain
Python model."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.operators.dedup import latest_per_key
from ledgerline.operators.merge import MergeSpec, merge_upsert

KEYS = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))
T0 = datetime(2024, 1, 1)
SPEC = MergeSpec(on=("k",), update=("v",), insert=("k", "v", "d"))

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _model_merge(target, source):
    out = []
    by_key = {}
    for k, v, d in source:
        if k is not None:
            by_key[k] = (v, d)
    matched = set()
    for k, v, d in target:
        if k is not None and k in by_key:
            out.append((k, by_key[k][0], d))
            matched.add(k)
        else:
            out.append((k, v, d))
    for k, v, d in source:
        if k is None or k not in matched:
            out.append((k, v, d))
    return sorted(out, key=str)


@SETTINGS
@given(target=st.lists(st.tuples(KEYS, st.integers(0, 9), st.integers(0, 9)), max_size=8),
       source=st.lists(st.tuples(KEYS, st.integers(10, 19), st.integers(10, 19)), max_size=6,
                       unique_by=lambda r: r[0] if r[0] is not None else object()))
def test_merge_matches_model(spark, target, source):
    t = spark.createDataFrame(target, "k string, v int, d int")
    s = spark.createDataFrame(source, "k string, v int, d int")
    got = sorted([tuple(r) for r in merge_upsert(t, s, SPEC).collect()], key=str)
    assert got == _model_merge(target, source)


@SETTINGS
@given(data=st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                               st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 2)), max_size=12))
def test_latest_per_key_matches_model(spark, data):
    rows = [(k, None if h is None else T0 + timedelta(hours=h), v) for k, h, v in data]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v int")
    got = sorted([tuple(r) for r in latest_per_key(df, "k", "t").collect()], key=str)
    want = set()
    for k in {r[0] for r in rows}:
        times = [r[1] for r in rows if r[0] == k and r[1] is not None]
        if times:
            want |= {r for r in rows if r[0] == k and r[1] == max(times)}
    assert got == sorted(want, key=str)
