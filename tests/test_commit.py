"""Swaps that are cut short, batches in any order, merges that read once."""

import itertools
import os
import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import commit as C
from ledgerline.operators import merge as M
from ledgerline.operators.cdc import any_order_merge, cdc_fold, fold_in_any_order
from ledgerline.operators.merge import BUCKET_COL, MergeSpec, load_table, merge_into_table, merge_upsert, read_table, write_table
from ledgerline.operators.watermark import WatermarkStore
from ledgerline.plans.jobs import CdcSpec, run_cdc_merge
from ledgerline.session import shared_dir
from ledgerline.sources.cdc_files import write_cdc_batches, write_full_load
from ledgerline.streaming import cdc_stream as streaming
from ledgerline.streaming.cdc_stream import with_places
from tests.conftest import rows

SPEC = MergeSpec(("k",), ("v",), ("k", "v"))
T0 = datetime(2024, 1, 1)


def _numbers(spark, n, v):
    return spark.range(n).select(F.col("id").alias("k"), F.lit(v).alias("v"))


def _local(path):
    return path.removeprefix("file:")


class Killed(Exception):
    pass


def _killed_swap(monkeypatch, at):
    """The next swap dies: before it touches anything, with a bucket removed, with one replaced, or before its record is closed."""
    real, end, calls = C.swap, C.RedoLog.end, []

    def swap(spark, path, stage, buckets):
        if calls:
            return real(spark, path, stage, buckets)
        calls.append(1)
        bucket = f"{BUCKET_COL}={buckets[0]}"
        if at in ("removed", "replaced"):
            shutil.rmtree(f"{_local(path)}/{bucket}")
        if at == "replaced":
            os.rename(f"{_local(stage)}/{bucket}", f"{_local(path)}/{bucket}")
        if at == "unclosed":
            real(spark, path, stage, buckets)
        raise Killed

    monkeypatch.setattr(C, "swap", swap)
    assert end is C.RedoLog.end


@pytest.mark.parametrize("at", ["untouched", "removed", "replaced", "unclosed"])
def test_a_swap_that_is_cut_short_is_finished(spark, monkeypatch, at):
    path = shared_dir(spark, "redo")
    write_table(_numbers(spark, 1000, "old"), path, ("k",), 4)
    _killed_swap(monkeypatch, at)
    with pytest.raises(Killed):
        merge_into_table(spark, path, _numbers(spark, 500, "new"), SPEC, 4)
    assert merge_into_table(spark, path, _numbers(spark, 10, "newer"), SPEC, 4) == 10
    got = {r["v"]: r["n"] for r in read_table(spark, path).groupBy("v").agg(F.count("*").alias("n")).collect()}
    assert got == {"newer": 10, "new": 490, "old": 500}
    assert C.RedoLog(spark, path).last()["done"] and not os.listdir(_local(path) + "_stage")


def test_swap_by_copy_is_finished_too(spark, monkeypatch):
    """A file system without atomic renames: buckets are removed, the stage stays whole until the record is closed."""
    monkeypatch.setattr(C, "ATOMIC_RENAME", ())
    path = shared_dir(spark, "copy")
    write_table(_numbers(spark, 300, "old"), path, ("k",), 3)
    _killed_swap(monkeypatch, "removed")
    with pytest.raises(Killed):
        merge_into_table(spark, path, _numbers(spark, 50, "new"), SPEC, 3)
    C.recover(spark, path)
    got = {r["v"]: r["n"] for r in read_table(spark, path).groupBy("v").agg(F.count("*").alias("n")).collect()}
    assert got == {"new": 50, "old": 250}


def test_a_load_that_is_cut_short_is_finished(spark, monkeypatch):
    path = shared_dir(spark, "load")
    _killed_swap(monkeypatch, "untouched")
    with pytest.raises(Killed):
        load_table(spark, _numbers(spark, 100, "x"), path, ("k",), 4)
    C.recover(spark, path)
    assert read_table(spark, path).count() == 100


def test_the_same_token_is_merged_once(spark):
    path = shared_dir(spark, "token")
    write_table(_numbers(spark, 4, "old").withColumn("k", F.col("k").cast("long")), path, ("k",), 2)
    keyless = spark.createDataFrame([(None, "alone")], "k long, v string")
    for _ in range(2):
        assert merge_into_table(spark, path, keyless, SPEC, 2, token="a") == 1
    assert read_table(spark, path).count() == 5
    merge_into_table(spark, path, keyless, SPEC, 2, token="b")
    assert read_table(spark, path).count() == 6


def test_source_and_target_are_read_once(spark):
    paths = [shared_dir(spark, x) for x in ("once-t", "once-s")]
    for p, n in zip(paths, (100, 30), strict=True):
        _numbers(spark, n, p[-1]).write.parquet(p)
    merged = merge_upsert(*(spark.read.parquet(p) for p in paths), SPEC)
    lines = merged._jdf.queryExecution().optimizedPlan().toString().split("\n")
    scans = [above for above, line in zip(lines, lines[1:], strict=False) if "Relation" in line]
    # Rows without a key come by scans of their own, which skip row groups that have none.
    assert len([x for x in scans if "Filter isnull(k" not in x]) == 2 and len(scans) == 4
    assert merged.count() == 100


def test_duplicate_keys_leave_the_table_alone(spark):
    path = shared_dir(spark, "dup")
    write_table(_numbers(spark, 20, "old"), path, ("k",), 2)
    with pytest.raises(ValueError, match="several rows"):
        merge_into_table(spark, path, _numbers(spark, 5, "a").unionByName(_numbers(spark, 5, "b")), SPEC, 2)
    assert read_table(spark, path).where("v = 'old'").count() == 20


# --- batches in any order -------------------------------------------------------

LOG_SPEC = MergeSpec(("k",), ("v", "t"), ("k", "v", "t", "made"))
LOG_TYPES = "Op string, k string, v string, t timestamp_ntz, made string, file_time timestamp_ntz"


def _log(spark):
    """Inserts, updates before and after them, ties within and across files, a key of the snapshot, rows without key or time."""
    day, hour = (lambda d: T0 + timedelta(days=d)), (lambda h: T0 + timedelta(hours=h))
    return spark.createDataFrame([
        ("I", "a", "a0", hour(1), "ins-a", day(1)), ("U", "a", "a2", hour(5), "u2", day(2)), ("U", "a", "a3", hour(3), "u3", day(3)),
        ("U", "b", "b1", hour(2), "first-b", day(1)), ("U", "b", "b1x", hour(4), "latest-b", day(1)), ("U", "b", "b3", hour(1), "x", day(3)),
        ("U", "s", "s2", hour(2), "not-this", day(2)), ("U", "s", None, hour(1), "nor-this", day(4)),
        ("U", "t", "tie-a", hour(7), "m1", day(3)), ("U", "t", "tie-b", hour(7), "m0", day(3)),
        ("I", "c", "c4", None, None, day(4)), ("U", "c", "lost", None, "no", day(4)), ("D", "a", "gone", hour(9), "d", day(4)),
        ("U", None, "keyless", hour(1), "n", day(2))], LOG_TYPES)


def _snapshot(spark):
    return spark.createDataFrame([("s", "s0", T0, "kept"), ("z", "z0", None, "same")], "k string, v string, t timestamp_ntz, made string")


def _apply(spark, state, part):
    cols = ["k", "v", "t", "made"]
    spec, choose = any_order_merge(LOG_SPEC, cols)
    return merge_upsert(state, fold_in_any_order(part, LOG_SPEC, "t", cols), spec, validate=False, choose=choose)


def test_every_order_of_batches_ends_alike(spark):
    log = _log(spark)
    want = rows(cdc_fold(_snapshot(spark), log.where("v is null or v <> 'tie-a'"), LOG_SPEC, "t"))
    parts = [log.where(F.col("file_time") == T0 + timedelta(days=d)) for d in (1, 2, 3, 4)]
    split = [*parts[:2], parts[2].where("v <> 'tie-b'"), parts[2].where("v = 'tie-b'"), parts[3]]  # a batch's files may come apart
    for order in [*itertools.permutations(parts)][::4] + [split, split[::-1], [*parts, *parts]]:
        state = with_places(_snapshot(spark))
        for part in order:
            state = _apply(spark, state, part)
        got = rows(state.select("k", "v", "t", F.when(F.col("k") != "t", F.col("made")).alias("made")))
        assert got == [(k, v, t, None if k == "t" else m) for k, v, t, m in want]


def test_stream_applies_late_files(spark):
    """Batches delivered newest first, each by a restart of the stream."""
    log = _log(spark).where("v <> 'tie-a' or v is null")
    src, table, check = (shared_dir(spark, x) for x in ("late-src", "late-table", "late-check"))
    like = _snapshot(spark)
    streaming.start_table(like, table, LOG_SPEC, 3)
    for day in (4, 2, 1, 3):
        write_cdc_batches(log.where(F.col("file_time") == T0 + timedelta(days=day)), src, mode="append")
        streaming.cdc_stream(spark, src, ["Op", "k", "v", "t", "made"], {"t": "timestamp_ntz"}, table, LOG_SPEC, "t", check, 3, like=like).awaitTermination()
    assert rows(streaming.read_table(spark, table).select("k", "v", "t", "made")) == rows(cdc_fold(like, log, LOG_SPEC, "t"))


JOB_SPEC = MergeSpec(("k",), ("v", "t", "created_at"), ("k", "v", "t", "made", "created_at"))


def test_job_applies_late_files_and_survives_kills(spark, monkeypatch):
    """The first load and the first merge die in their swaps; a late batch comes after newer ones."""
    log = _log(spark).where("v <> 'tie-a' or v is null")
    files, table = shared_dir(spark, "kill-files"), shared_dir(spark, "kill-table")
    store = WatermarkStore(spark, shared_dir(spark, "kill-wm"))
    spec = CdcSpec("d", files, ("Op", "k", "v", "t", "made"), {"t": "timestamp_ntz"}, JOB_SPEC, "t", late_seconds=5 * 86400)
    write_full_load(_snapshot(spark), files)

    def run():
        return run_cdc_merge(spark, spec, table, store, "m", 3, run_ts="2024-06-01 00:00:00")

    def deliver(*days):
        for d in days:
            write_cdc_batches(log.where(F.col("file_time") == T0 + timedelta(days=d)), files, mode="append")

    deliver(1, 4)
    real = C.swap
    _killed_swap(monkeypatch, "untouched")
    with pytest.raises(Killed):
        run()
    monkeypatch.setattr(C, "swap", real)
    real_merge = M.commit

    def die(*args, **kwargs):
        _killed_swap(monkeypatch, "removed")
        return real_merge(*args, **kwargs)

    monkeypatch.setattr(M, "commit", die)
    with pytest.raises(Killed):
        run()
    monkeypatch.setattr(M, "commit", real_merge)
    monkeypatch.setattr(C, "swap", real)
    run()
    deliver(2, 3)
    run()
    want = rows(cdc_fold(_snapshot(spark), log, LOG_SPEC, "t"))
    assert rows(streaming.read_table(spark, table).select("k", "v", "t", "made")) == want
    assert store.get("d", "m").startswith("2024-01-05")
