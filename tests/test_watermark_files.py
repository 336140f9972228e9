"""Watermarks, CDC files and the streaming CDC merge."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ledgerline.operators.cdc import cdc_fold
from ledgerline.operators.merge import MergeSpec
from ledgerline.operators.watermark import (NO_WATERMARK, WatermarkStore, holdback_watermark, latest_ts,
                                            scan_incremental, watermark_floor)
from ledgerline.session import shared_dir
from ledgerline.sources.cdc_files import initial_load, pending_batches, read_cdc, write_cdc_batches, write_full_load
from ledgerline.streaming.cdc_stream import cdc_stream, read_table, start_table
from tests.conftest import rows

T0 = datetime(2024, 1, 1)


def test_holdback_ignores_empty_source(spark):
    a = spark.createDataFrame([(T0 + timedelta(days=d),) for d in (1, 5)], "t timestamp_ntz")
    b = spark.createDataFrame([(T0 + timedelta(days=6),)], "t timestamp_ntz")
    e = spark.createDataFrame([], "t timestamp_ntz")
    assert holdback_watermark((a, "t"), (b, "t"), (e, "t")).collect()[0][0] == T0 + timedelta(days=5)


def test_latest_ts_all_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "created_at timestamp_ntz")
    assert latest_ts(df).collect()[0][0] is None


def test_scan_incremental_whole_seconds(spark):
    assert watermark_floor("2024-01-01T10:00:05.900000") == "2024-01-01 10:00:05"
    assert watermark_floor(NO_WATERMARK) is None
    df = spark.createDataFrame([(T0 + timedelta(seconds=s, microseconds=m),) for s, m in
                                ((5, 0), (5, 950000), (6, 0), (4, 0))], "created_at timestamp_ntz")
    got = scan_incremental(df, "created_at", "2024-01-01T00:00:05.900000").collect()
    # rows of the watermark's own second are read again (strict > on the floored value)
    assert len(got) == 2
    assert scan_incremental(df, "created_at", NO_WATERMARK).count() == 4


def test_scan_incremental_pushes_filter(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(T0,)], "created_at timestamp_ntz").write.parquet(path)
    plan = scan_incremental(spark.read.parquet(path), "created_at", "2024-01-01T00:00:00")._jdf \
        .queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(created_at), GreaterThan(created_at" in plan


def test_watermark_store(spark):
    store = WatermarkStore(spark, shared_dir(spark, "wm"))
    assert store.get("d", "j") == NO_WATERMARK
    store.put("d", "j", "delta merge", "2024-01-01T00:00:00")
    store.put("e", "j", "delta merge", "2024-02-01T00:00:00")
    store.put("d", "j", "delta merge", "2024-03-01T00:00:00")
    store.put("d", "j", "delta merge", None)
    assert store.get("d", "j") == "2024-03-01T00:00:00" and store.get("e", "j") == "2024-02-01T00:00:00"


COLS = ["Op", "k", "v", "t", "payload", "loaded"]
TYPES = {"t": "timestamp_ntz", "loaded": "timestamp_ntz"}
SPEC = MergeSpec(on=("k",), update=("v", "t", "loaded"), insert=("k", "v", "t", "payload", "loaded"))


def _log(spark, days=4):
    data = []
    for d in range(days):
        for k in range(5):
            op = "I" if d == 0 else ("D" if k == 4 and d == 2 else "U")
            data.append((op, f"k{k}", f"v{k}.{d}", T0 + timedelta(days=d, hours=k),
                         f'{{"a": "x|y", "q": "\\"z\\""}}' if k == 1 else ("" if k == 2 else None),
                         T0 + timedelta(days=d + 1), T0 + timedelta(days=d + 1)))
    return spark.createDataFrame(data, "Op string, k string, v string, t timestamp_ntz, payload string, "
                                       "loaded timestamp_ntz, file_time timestamp_ntz")


def test_cdc_files_round_trip(spark):
    log = _log(spark)
    path = shared_dir(spark, "cdc-test")
    write_cdc_batches(log, path)
    back = read_cdc(spark, path, COLS, TYPES)
    assert rows(back.select(*log.columns)) == rows(log)
    newer = read_cdc(spark, path, COLS, TYPES, since="2024-01-03 00:00:00")
    assert {r[0] for r in newer.select("file_time").distinct().collect()} == {T0 + timedelta(days=3), T0 + timedelta(days=4)}
    assert [r[0] for r in pending_batches(spark, path, since="2024-01-03 00:00:00").collect()] == \
        [T0 + timedelta(days=3), T0 + timedelta(days=4)]


def test_initial_load(spark):
    snap = spark.createDataFrame([("k1", "v", T0, "p"), ("k2", "w", T0, "")], "k string, v string, t timestamp_ntz, payload string")
    path = shared_dir(spark, "full-test")
    write_full_load(snap, path)
    got = initial_load(spark, path, ["k", "v", "t", "payload"], {"t": "timestamp_ntz"}, run_ts="2024-05-01 00:00:00")
    assert rows(got) == [("k1", "v", T0, "p", datetime(2024, 5, 1)), ("k2", "w", T0, "", datetime(2024, 5, 1))]


def _empty_target(spark):
    return spark.createDataFrame([], "k string, v string, t timestamp_ntz, payload string, loaded timestamp_ntz")


def test_stream_equals_batch_fold_and_restarts(spark):
    log = _log(spark, days=4)
    target = _empty_target(spark)
    expected = rows(cdc_fold(target, log, SPEC, "t"))

    def run(src, tgt, ck):
        q = cdc_stream(spark, src, COLS, TYPES, tgt, SPEC, "t", ck, buckets=4, like=target)
        q.awaitTermination()
        from pyspark.sql.types import IntegerType, StructField, StructType
        schema = StructType(target.schema.fields + [StructField("key_bucket", IntegerType())])
        return rows(spark.read.schema(schema).parquet(tgt)
                    .select(*target.columns))

    # Uninterrupted: every pending batch in one micro-batch.
    src, tgt, ck = shared_dir(spark, "s-src"), shared_dir(spark, "s-tgt"), shared_dir(spark, "s-ck")
    start_table(target, tgt, SPEC, buckets=4)
    write_cdc_batches(log, src)
    assert run(src, tgt, ck) == expected

    # Stop after half the batches, restart from the checkpoint with the rest.
    src, tgt, ck = shared_dir(spark, "r-src"), shared_dir(spark, "r-tgt"), shared_dir(spark, "r-ck")
    start_table(target, tgt, SPEC, buckets=4)
    write_cdc_batches(log.where(F.col("file_time") <= T0 + timedelta(days=2)), src + "/part1")
    run(src + "/part1", tgt, ck)
    write_cdc_batches(log.where(F.col("file_time") > T0 + timedelta(days=2)), src + "/part2")
    # The new batch folders land in the folder the stream watches.
    import os
    import shutil
    for d in os.listdir(src + "/part2"):
        if d.startswith("batch="):
            shutil.copytree(os.path.join(src, "part2", d), os.path.join(src, "part1", d))
    assert run(src + "/part1", tgt, ck) == expected

    # A batch older than one already applied changes what it would have changed in order.
    late = (log.where(F.col("file_time") == T0 + timedelta(days=1)).withColumn("v", F.lit("late"))
            .withColumn("file_time", F.col("file_time") + F.expr("INTERVAL 1 SECOND")))
    write_cdc_batches(late, src + "/late")
    for d in os.listdir(src + "/late"):
        if d.startswith("batch="):
            shutil.copytree(os.path.join(src, "late", d), os.path.join(src, "part1", d))
    assert run(src + "/part1", tgt, ck) == rows(cdc_fold(target, log.unionByName(late), SPEC, "t"))


def test_read_cdc_repairs_legacy_payloads(spark):
    path = shared_dir(spark, "legacy")
    # A legacy export: payload quotes doubled inside a quoted field, read
    # back without an escape character it keeps the doubling.
    rows_in = spark.createDataFrame([("I", "k1", '"{""id"": ""x""}"', T0)],
                                    "Op string, k string, payload string, file_time timestamp_ntz")
    write_cdc_batches(rows_in, path)
    got = read_cdc(spark, path, ["Op", "k", "payload"], {}, repair=("payload",)).collect()[0]
    assert got["payload"] == "'{\"id\": \"x\"}'"
