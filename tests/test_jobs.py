"""End-to-end incremental jobs against one-shot results."""

from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators.cdc import cdc_fold
from ledgerline.operators.merge import BUCKET_COL, PAYMENT_MERGE
from ledgerline.operators.watermark import WatermarkStore
from ledgerline.plans.jobs import CdcSpec, run_cdc_merge, run_normalize_disputes, run_normalize_purchases, \
    run_normalize_refunds
from ledgerline.plans.disputes import normalize_disputes
from ledgerline.plans.purchases import normalize_purchases
from ledgerline.plans.refunds import normalize_refunds
from ledgerline.session import shared_dir
from ledgerline.sources import tables as tb
from ledgerline.sources.cdc_files import write_cdc_batches, write_full_load
from tests.conftest import rows

SMALL = "/root/testdata/sf0.001"
RUN = "2024-06-01 12:00:00"
TYPES = schemas.CDC_COERCE["payment"] | {"created_at": "timestamp_ntz"}


def test_stage1_job_incremental_equals_fold(spark):
    payments = tb.payments(spark, SMALL)
    log = tb.cdc_log(spark, SMALL)
    files, table = shared_dir(spark, "job-files"), shared_dir(spark, "job-table")
    store = WatermarkStore(spark, shared_dir(spark, "job-wm"))
    write_full_load(payments.drop("created_at"), files)
    cut = log.agg(F.min("file_time")).collect()[0][0].replace(day=15)
    write_cdc_batches(log.where(F.col("file_time") <= cut), files)
    spec = CdcSpec("dwh.payment", files, tuple(["Op", *schemas.PAYMENT_COLUMNS]), TYPES, PAYMENT_MERGE,
                   "payment_updated_at")
    r1 = run_cdc_merge(spark, spec, table, store, "merge", buckets=4, run_ts=RUN)
    wm1 = r1.watermark
    assert wm1 is not None and wm1 <= cut.isoformat() and r1.rows > 0
    write_cdc_batches(log.where(F.col("file_time") > cut), files + "-more")
    import os
    import shutil
    for d in os.listdir(files + "-more"):
        if d.startswith("batch="):
            shutil.copytree(os.path.join(files + "-more", d), os.path.join(files, d))
    wm2 = run_cdc_merge(spark, spec, table, store, "merge", buckets=4, run_ts=RUN).watermark
    assert wm2 > wm1
    assert run_cdc_merge(spark, spec, table, store, "merge", buckets=4, run_ts=RUN).watermark is None
    got = spark.read.parquet(table).drop(BUCKET_COL)
    initial = payments.withColumn("created_at", F.lit(RUN).cast("timestamp_ntz"))
    want = cdc_fold(initial, log, PAYMENT_MERGE, "payment_updated_at")
    assert rows(got.select(*want.columns)) == rows(want)


def test_stage2_jobs_incremental_equal_one_shot(spark):
    pay, ref, dis = tb.payments(spark, SMALL), tb.refunds(spark, SMALL), tb.disputes(spark, SMALL)
    ver, ev, bill = tb.product_history(spark, SMALL), tb.referral_events(spark, SMALL), tb.client_billing(spark, SMALL)
    store = WatermarkStore(spark, shared_dir(spark, "job2-wm"))
    cut = "1998-01-01 00:00:00"
    early = F.col("created_at") <= F.lit(cut).cast("timestamp_ntz")
    pt, rt, dt = shared_dir(spark, "np"), shared_dir(spark, "nr"), shared_dir(spark, "nd")
    pats = tb.TEST_INTERNAL_EMAIL_PATTERNS
    for source_filter in (early, F.lit(True)):
        res = run_normalize_purchases(spark, payments=pay.where(source_filter), refunds=ref, versions=ver, events=ev,
                                client_billing=bill.where(F.lit(False)), target_path=pt, store=store,
                                dataset="purchases", job="n", buckets=4, run_ts=RUN)
        assert res.rows > 0 and res.watermark is not None
        run_normalize_refunds(spark, refunds=ref.where(source_filter), payments=pay, versions=ver,
                              exclude_patterns=pats, target_path=rt, store=store, dataset="refunds", job="n",
                              buckets=4, run_ts=RUN)
        run_normalize_disputes(spark, disputes=dis.where(source_filter), payments=pay, target_path=dt,
                               store=store, dataset="disputes", job="n", buckets=4, run_ts=RUN)
    want_p = normalize_purchases(pay, ref, ver, ev, run_ts=RUN)
    got_p = spark.read.parquet(pt).drop(BUCKET_COL)
    assert got_p.where(F.col("id").isNotNull()).count() == 0
    assert rows(got_p.select(*want_p.columns)) == rows(want_p)
    want_r = normalize_refunds(ref, pay, ver, pats, run_ts=RUN)
    got_r = spark.read.parquet(rt).drop(BUCKET_COL)
    assert rows(got_r.select(*want_r.columns)) == rows(want_r)
    want_d = normalize_disputes(dis, pay, run_ts=RUN)
    got_d = spark.read.parquet(dt).drop(BUCKET_COL)
    assert rows(got_d.select(*want_d.columns)) == rows(want_d)


def test_replaying_a_run_changes_only_processed_at(spark):
    pay, dis = tb.payments(spark, SMALL), tb.disputes(spark, SMALL)
    path = shared_dir(spark, "replay")
    for run_ts in (RUN, "2024-07-01 00:00:00"):
        store = WatermarkStore(spark, shared_dir(spark, "replay-wm"))  # no watermark: full re-read
        run_normalize_disputes(spark, disputes=dis, payments=pay, target_path=path, store=store,
                               dataset="disputes", job="n", buckets=4, run_ts=run_ts)
        if run_ts == RUN:
            first = spark.read.parquet(path).drop(BUCKET_COL)
            first = rows(first.drop("processed_at"))
    second = spark.read.parquet(path).drop(BUCKET_COL)
    assert rows(second.drop("processed_at")) == first
    assert {r[0] for r in second.select("processed_at").distinct().collect()} == {
        __import__("datetime").datetime(2024, 7, 1)}


def test_stage1_without_full_load_starts_empty(spark):
    log = tb.cdc_log(spark, SMALL)
    files, table = shared_dir(spark, "nofull-files"), shared_dir(spark, "nofull-table")
    write_cdc_batches(log, files)
    store = WatermarkStore(spark, shared_dir(spark, "nofull-wm"))
    spec = CdcSpec("dwh.payment", files, tuple(["Op", *schemas.PAYMENT_COLUMNS]), TYPES, PAYMENT_MERGE,
                   "payment_updated_at")
    res = run_cdc_merge(spark, spec, table, store, "merge", buckets=4)
    assert res.watermark is not None
    empty = tb.payments(spark, SMALL).limit(0)
    want = cdc_fold(empty, log, PAYMENT_MERGE, "payment_updated_at")
    got = spark.read.parquet(table).drop(BUCKET_COL)
    assert rows(got.select(*want.columns)) == rows(want)


def test_registered_purchases_are_held_back_by_client_billing(spark, monkeypatch):
    from ledgerline.plans import jobs, queries
    runs, job = [], jobs.run_normalize_purchases

    def keep(*args, **kw):
        runs.append((job(*args, **kw), kw["client_billing"], kw["payments"]))
        return runs[-1][0]

    monkeypatch.setattr(jobs, "run_normalize_purchases", keep)
    got = queries.q_incremental_purchases(spark, SMALL)
    (first, billing, payments), (_, whole, _) = runs
    held = billing.agg(F.max("created_at")).first()[0]
    assert first.watermark == held.isoformat() and held < payments.agg(F.max("created_at")).first()[0]
    assert whole.count() == tb.client_billing(spark, SMALL).count()
    want = queries.q_normalize_purchases(spark, SMALL).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
