"""Faults of the job path that clean inputs do not show."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.cdc import apply_delta
from ledgerline.operators.merge import BUCKET_COL, MergeSpec, merge_into_table, merge_upsert, read_table, write_table
from ledgerline.operators.watermark import NO_WATERMARK, WatermarkStore
from ledgerline.plans.jobs import CdcSpec, run_cdc_merge, table_exists
from ledgerline.session import shared_dir
from ledgerline.sources.cdc_files import pending_batches, read_cdc, write_cdc_batches
from ledgerline.streaming import cdc_stream as streaming
from tests.conftest import rows

SPEC = MergeSpec(on=("k",), update=("v",), insert=("k", "v"))
T0 = datetime(2024, 1, 1)


def test_keys_of_another_type_keep_every_row(spark):
    """40 bigint keys, two matching int keys: 40 rows stay."""
    path = shared_dir(spark, "types")
    write_table(spark.range(40).select(F.col("id").alias("k"), F.lit("old").alias("v")), path, ("k",), 8)
    source = spark.createDataFrame([(3, "new"), (17, "new")], "k int, v string")
    assert merge_into_table(spark, path, source, SPEC, 8) == 2
    got = read_table(spark, path)
    assert got.count() == 40 and got.where("v = 'new'").count() == 2


def test_stray_buckets_are_refused(spark):
    """A table laid out by another bucket count: the swap would drop rows, so nothing is written."""
    path = shared_dir(spark, "strays")
    write_table(spark.range(40).select(F.col("id").alias("k"), F.lit("old").alias("v")), path, ("k",), 8)
    with pytest.raises(ValueError, match="buckets"):
        merge_into_table(spark, path, spark.createDataFrame([(i, "x") for i in range(5)], "k long, v string"), SPEC, 5)
    assert read_table(spark, path).where("v = 'old'").count() == 40


def test_one_file_per_bucket(spark):
    path = shared_dir(spark, "files")
    df = spark.range(5_000).repartition(16).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    write_table(df, path, ("k",), 6)
    merge_into_table(spark, path, df.where("k < 50").withColumn("v", F.lit("new")), SPEC, 6)
    files = [f for d in os.listdir(path) if d.startswith(BUCKET_COL) for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")]
    assert len(files) <= 6 and read_table(spark, path).count() == 5_000


def test_merge_of_bucketed_inputs_has_no_shuffle(spark):
    names = []
    for name, n in (("t", 100), ("s", 30)):
        names.append(f"merge_{name}_{os.getpid()}")
        (spark.range(n).select(F.col("id").alias("k"), F.lit(name).alias("v")).repartition(4, "k").write.mode("overwrite")
         .bucketBy(4, "k").option("path", shared_dir(spark, name)).saveAsTable(names[-1]))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge_upsert(spark.table(names[0]), spark.table(names[1]), SPEC, validate=False)
        assert "Exchange" not in merged._jdf.queryExecution().executedPlan().toString()
        assert merged.count() == 100 and merged.where("v = 's'").count() == 30
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_without_a_key_never_match(spark):
    target = spark.createDataFrame([(None, "t"), (None, "t"), (1, "t")], "k long, v string")
    source = spark.createDataFrame([(None, "s"), (1, "s"), (2, "s")], "k long, v string")
    assert rows(merge_upsert(target, source, SPEC)) == sorted([(None, "t"), (None, "t"), (None, "s"), (1, "s"), (2, "s")], key=lambda r: tuple("" if v is None else str(v) for v in r))


def test_ties_raise_only_where_they_match(spark):
    target = spark.createDataFrame([("a", "t")], "k string, v string")
    twice = spark.createDataFrame([("b", "1"), ("b", "2")], "k string, v string")
    assert merge_upsert(target, twice, SPEC).count() == 3
    with pytest.raises(Exception, match="several rows"):
        merge_upsert(target, twice.unionByName(spark.createDataFrame([("a", "1"), ("a", "2")], "k string, v string")), SPEC).collect()
    batch = spark.createDataFrame([("U", "a", "1", T0), ("U", "a", "2", T0)], "Op string, k string, v string, t timestamp_ntz")
    with pytest.raises(Exception, match="several rows"):
        apply_delta(target.withColumn("t", F.lit(None).cast("timestamp_ntz")), batch, MergeSpec(("k",), ("v", "t"), ("k", "v", "t")), "t").collect()


def _csv(path, name, text):
    os.makedirs(os.path.dirname(f"{path}/{name}"), exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write(text)


def test_columns_are_taken_by_header_name(spark):
    path = shared_dir(spark, "by-name").removeprefix("file:")
    _csv(path, "batch=20240101-000000/part-0.csv", "Op|b|extra|a\nI|bee|x|ay\n")
    got = read_cdc(spark, path, ["Op", "a", "b", "gone"], {}).first()
    assert (got["a"], got["b"], got["gone"]) == ("ay", "bee", None)
    _csv(path, "batch=20240102-000000/part-0.csv", "Op|a|extra|b\nI|ay|x|bee\n")
    got = read_cdc(spark, path, ["Op", "a", "b"], {}).collect()
    assert [(r["a"], r["b"]) for r in got] == [("ay", "bee")] * 2


def test_flat_files_with_the_time_in_their_name(spark):
    path = shared_dir(spark, "flat").removeprefix("file:")
    _csv(path, "LOAD00000001.csv", "k|v\n1|first\n")
    _csv(path, "20240102-030405678.csv", "Op|k|v\nU|1|second\n")
    _csv(path, "20240103-030405678.csv", "Op|k|v\nI|2|third\n")
    got = read_cdc(spark, path, ["Op", "k", "v"], {}, since="2024-01-02 03:04:05").collect()
    assert [(r["v"], r["file_time"]) for r in got] == [("third", datetime(2024, 1, 3, 3, 4, 5))]
    assert [r["v"] for r in read_cdc(spark, path, ["k", "v"], {}, full=True).collect()] == ["first"]
    assert [r[0] for r in pending_batches(spark, path).collect()] == [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 3, 3, 4, 5)]


def test_job_stamps_deltas_and_ends_without_files(spark):
    path, table = shared_dir(spark, "stamp").removeprefix("file:"), shared_dir(spark, "stamped")
    store = WatermarkStore(spark, shared_dir(spark, "stamp-wm"))
    spec = CdcSpec("d", path, ("Op", "k", "v", "t", "created_at"), {"t": "timestamp_ntz"},
                   MergeSpec(("k",), ("v", "t", "created_at"), ("k", "v", "t", "created_at")), "t")
    _csv(path, "LOAD1.csv", "k|v|t\n1|first|2024-01-01 00:00:00\n")
    assert run_cdc_merge(spark, spec, table, store, "m", 2, run_ts="2024-05-01 00:00:00").watermark is None
    _csv(path, "20240102-000000000.csv", "Op|k|v|t\nU|1|second|2024-01-02 00:00:00\nI|2|new|2024-01-02 00:00:00\n")
    assert run_cdc_merge(spark, spec, table, store, "m", 2, run_ts="2024-05-02 00:00:00").rows == 2
    got = {r["k"]: (r["v"], r["created_at"]) for r in read_table(spark, table).collect()}
    assert got == {"1": ("second", datetime(2024, 5, 2)), "2": ("new", datetime(2024, 5, 2))}


STREAM_SPEC = MergeSpec(("k",), ("v", "t", "created_at"), ("k", "v", "t", "created_at"))
STREAM_COLS = ["Op", "k", "v", "t", "created_at"]


def _stream(spark, src, table, checkpoint, like):
    streaming.cdc_stream(spark, src, STREAM_COLS, {"t": "timestamp_ntz", "created_at": "timestamp_ntz"}, table, STREAM_SPEC, "t", checkpoint, 2, like=like).awaitTermination()


def _stream_tables(spark):
    like = spark.createDataFrame([], "k string, v string, t timestamp_ntz, created_at timestamp_ntz")
    src, table, checkpoint = (shared_dir(spark, x) for x in ("st-src", "st-table", "st-check"))
    streaming.start_table(like, table, STREAM_SPEC, 2)
    return like, src.removeprefix("file:"), table, checkpoint


def test_a_batch_of_two_files_is_one_unit(spark):
    """The newer update stands in the file that is read first."""
    like, src, table, checkpoint = _stream_tables(spark)
    head = "Op|k|v|t|created_at\n"
    _csv(src, "batch=20240101-000000/a.csv", head + "U|1|newer|2024-01-03 00:00:00|2024-01-04 00:00:00\n")
    _csv(src, "batch=20240101-000000/b.csv", head + "U|1|older|2024-01-02 00:00:00|2024-01-04 00:00:00\n")
    _stream(spark, src, table, checkpoint, like)
    assert [r["v"] for r in read_table(spark, table).collect()] == ["newer"]


def test_a_replayed_micro_batch_changes_nothing(spark, monkeypatch):
    """A crash after the merge and before the checkpoint's commit."""
    like, src, table, checkpoint = _stream_tables(spark)
    _csv(src, "batch=20240101-000000/a.csv", "Op|k|v|t|created_at\nI|1|one|2024-01-03 00:00:00|2024-01-04 00:00:00\n")
    write = streaming.merge_into_table
    calls = []

    def crash(*args, **kwargs):
        calls.append(write(*args, **kwargs))
        raise RuntimeError("crash")

    monkeypatch.setattr(streaming, "merge_into_table", crash)
    with pytest.raises(Exception, match="crash"):
        _stream(spark, src, table, checkpoint, like)
    monkeypatch.setattr(streaming, "merge_into_table", write)
    _stream(spark, src, table, checkpoint, like)
    assert calls == [1] and [r["v"] for r in read_table(spark, table).collect()] == ["one"]
    _csv(src, "batch=20231231-000000/late.csv", "Op|k|v|t|created_at\nU|1|late|2024-01-05 00:00:00|2024-01-04 00:00:00\n")
    _stream(spark, src, table, checkpoint, like)
    assert [r["v"] for r in read_table(spark, table).collect()] == ["one"]  # a late batch is older than what is there


def test_overlapping_puts_lose_nothing(spark):
    path = shared_dir(spark, "overlap")
    a, b = WatermarkStore(spark, path), WatermarkStore(spark, path)
    assert a.get("x", "j") == NO_WATERMARK
    a.put("x", "j", "delta merge", "2024-01-01T00:00:00")
    b.put("y", "j", "delta merge", "2024-01-02T00:00:00")
    a.put("x", "j", "delta merge", "2024-01-03T00:00:00")
    assert (b.get("x", "j"), a.get("y", "j")) == ("2024-01-03T00:00:00", "2024-01-02T00:00:00")
    assert a.rows().count() == 2


def test_other_failures_are_not_a_missing_table(spark):
    path = shared_dir(spark, "broken").removeprefix("file:")
    assert not table_exists(spark, path)
    _csv(path, "part-0.parquet", "not parquet at all")
    with pytest.raises(Exception):
        table_exists(spark, path)
    with pytest.raises(Exception):
        WatermarkStore(spark, path).get("x", "j")


def test_load_time_is_utc_in_every_zone(spark):
    from ledgerline.functions.coerce import load_time
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        seen = []
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            seen.append(spark.range(1).select(load_time().alias("t")).first()["t"])
        assert abs(seen[0] - seen[1]) < timedelta(minutes=5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_batches_written_and_read_by_name(spark):
    path = shared_dir(spark, "names")
    df = spark.createDataFrame([("I", "a", "b", T0)], "Op string, x string, y string, file_time timestamp_ntz")
    write_cdc_batches(df, path)
    assert rows(read_cdc(spark, path, ["y", "Op"], {}).select("y", "Op")) == [("b", "I")]
