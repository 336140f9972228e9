"""CDC apply and fold: the one-pass fold equals the per-file replay."""

import random
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import functions as F

from ledgerline.operators.cdc import apply_delta, cdc_fold, cdc_split
from ledgerline.operators.merge import MergeSpec
from tests.conftest import rows

SPEC = MergeSpec(on=("k",), update=("v", "t", "loaded"), insert=("k", "v", "t", "payload", "loaded"))
SCHEMA = "Op string, k string, v string, t timestamp_ntz, payload string, loaded timestamp_ntz, file_time timestamp_ntz"
T0 = datetime(2024, 1, 1)


def _log(seed=7, keys=12, files=6):
    """Random CDC log meeting the fold's preconditions: at most one insert
    per key, first in its key's sequence; update times may run backwards
    across files (a later file wins anyway); some deletes."""
    rnd = random.Random(seed)
    out = []
    for k in range(keys):
        first_file = rnd.randrange(files)
        out.append(("I", f"k{k}", f"i{k}", T0 + timedelta(hours=rnd.randrange(100)), f"p{k}", None, first_file))
        for f in range(first_file, files):
            for _ in range(rnd.randrange(3)):
                op = rnd.choice("UUUD")
                out.append((op, f"k{k}", f"{op}{k}.{f}.{rnd.randrange(1000)}",
                            T0 + timedelta(hours=rnd.randrange(100), seconds=rnd.randrange(60)),
                            f"q{k}.{f}", None, f))
    return [(op, k, v, t, p, T0 + timedelta(days=f + 1), T0 + timedelta(days=f + 1)) for op, k, v, t, p, _, f in out]


def test_split_ignores_deletes(spark):
    df = spark.createDataFrame(_log(), SCHEMA)
    ins, upd = cdc_split(df)
    assert "Op" not in ins.columns
    assert ins.count() + upd.count() == df.where(F.col("Op") != "D").count()


def test_fold_equals_sequential_replay(spark):
    data = _log()
    # keyless rows: both inserts are appended, the update is dropped
    data += [("I", None, "n1", T0, "pn1", T0 + timedelta(days=1), T0 + timedelta(days=1)),
             ("I", None, "n2", T0, "pn2", T0 + timedelta(days=2), T0 + timedelta(days=2)),
             ("U", None, "n3", T0, "pn3", T0 + timedelta(days=2), T0 + timedelta(days=2))]
    log = spark.createDataFrame(data, SCHEMA)
    target = spark.createDataFrame([("t1", "tv", T0, "tp", T0)], "k string, v string, t timestamp_ntz, payload string, loaded timestamp_ntz")
    files = sorted({r[-1] for r in data})
    replay = reduce(lambda acc, f: apply_delta(acc, log.where(F.col("file_time") == f).drop("file_time"), SPEC, "t"),
                    files, target)
    folded = cdc_fold(target, log, SPEC, "t")
    assert rows(folded) == rows(replay)


def test_later_file_wins_over_newer_update_time(spark):
    data = [("I", "a", "v0", T0, "p", T0, T0),
            ("U", "a", "v1", T0 + timedelta(hours=5), "p1", T0, T0 + timedelta(days=1)),
            ("U", "a", "v2", T0 + timedelta(hours=1), "p2", T0, T0 + timedelta(days=2))]
    log = spark.createDataFrame(data, SCHEMA)
    empty = spark.createDataFrame([], "k string, v string, t timestamp_ntz, payload string, loaded timestamp_ntz")
    got = rows(cdc_fold(empty, log, SPEC, "t"))
    assert got == [("a", "v2", T0 + timedelta(hours=1), "p", T0)]


def test_insert_then_update_in_one_batch(spark):
    data = [("I", "a", "v0", T0, "p0", T0, T0), ("U", "a", "v1", T0 + timedelta(hours=1), "p1", T0, T0)]
    batch = spark.createDataFrame(data, SCHEMA).drop("file_time")
    empty = spark.createDataFrame([], "k string, v string, t timestamp_ntz, payload string, loaded timestamp_ntz")
    got = rows(apply_delta(empty, batch, SPEC, "t"))
    assert got == [("a", "v1", T0 + timedelta(hours=1), "p0", T0)]
