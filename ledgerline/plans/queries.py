"""Registered queries: one per operator of the pipeline, each a function of
``(spark, sf_dir)`` over the test tables (see :mod:`ledgerline.sources.tables`
for how the lake tables are derived from them)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions import (coerce_types, is_fully_refunded_short_term, operational_costs,
                                  parse_payload, processing_fee, purchase_flags, repair_quotes, split_payloads,
                                  state_name, strip_outer_quote)
from ledgerline.operators import cdc, dedup, joins, merge, metrics, watermark
from ledgerline.plans import disputes as nd
from ledgerline.plans import purchases as npur
from ledgerline.plans import refunds as nref
from ledgerline.session import materialize, shared_dir
from ledgerline.sources import cdc_files
from ledgerline.sources import tables as tb

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered runs.
INCREMENTAL_WATERMARK = "1998-06-30T12:34:56.789000"
EARLIER_PURCHASE_CUT = "1999-01-01 00:00:00"


def _payments(s, d):
    return tb.lake_table(s, d, "payment")


def _cdc_rows(s, d):
    return tb.lake_table(s, d, "cdc")


def _refunds(s, d, flag="R"):
    return tb.lake_table(s, d, "refund" if flag == "R" else "refund_updates")


def _disputes(s, d, later=False):
    return tb.lake_table(s, d, "dispute_updates" if later else "dispute")


def _versions(s, d):
    return tb.lake_table(s, d, "product_history")


def _events(s, d):
    return tb.lake_table(s, d, "referral_event")


# --- scans -----------------------------------------------------------------

def q_scan_full(s, d):
    return _payments(s, d)


def q_scan_incremental(s, d):
    return watermark.scan_incremental(_payments(s, d), "created_at", INCREMENTAL_WATERMARK)


# --- CDC stage -------------------------------------------------------------

def q_cdc_split(s, d):
    ins, upd = cdc.cdc_split(_cdc_rows(s, d))
    return ins.withColumn("route", F.lit("insert")).unionByName(upd.withColumn("route", F.lit("update")))


def q_latest_per_key(s, d):
    _, upd = cdc.cdc_split(_cdc_rows(s, d))
    upd = upd.drop("file_time", "created_at")
    return dedup.latest_per_key(upd, "payment_intent_id", "payment_updated_at", ties="keep")


def q_apply_delta(s, d):
    return cdc.apply_delta(_payments(s, d), _cdc_rows(s, d).drop("file_time"), merge.PAYMENT_MERGE,
                           ts="payment_updated_at")


def q_cdc_fold(s, d):
    return cdc.cdc_fold(_payments(s, d), _cdc_rows(s, d), merge.PAYMENT_MERGE, ts="payment_updated_at")


def q_append_by_name(s, d):
    ins, _ = cdc.cdc_split(_cdc_rows(s, d))
    ins = ins.drop("file_time")
    # Columns deliberately in another order: the append matches by name.
    return merge.append_by_name(_payments(s, d), ins.select(*reversed(ins.columns)))


# --- merges ------------------------------------------------------------------

def q_merge_payment(s, d):
    return merge.merge_upsert(_payments(s, d), tb.lake_table(s, d, "payment_updates"), merge.PAYMENT_MERGE)


def q_merge_refund(s, d):
    return merge.merge_upsert(_refunds(s, d, "R"), _refunds(s, d, "A"), merge.REFUND_MERGE)


def q_merge_dispute(s, d):
    return merge.merge_upsert(_disputes(s, d), _disputes(s, d, later=True), merge.DISPUTE_MERGE)


def _purchases(s, d, payments, run_ts):
    return npur.normalize_purchases(payments, _refunds(s, d), _versions(s, d),
                                    _events(s, d), run_ts=run_ts)


def _earlier_purchases(s, d):
    """What an earlier run left in the purchase table."""
    old = _payments(s, d).where(F.col("payment_created_at") < F.lit(EARLIER_PURCHASE_CUT).cast("timestamp_ntz"))
    return _purchases(s, d, old, tb.EARLIER_RUN_TS).select(*[
        (F.substring("external_id", 4, 20).cast("bigint") if c == "id" else F.col(c)).alias(c)
        for c in schemas.PURCHASE_COLUMNS])


def q_merge_purchase(s, d):
    source = materialize(_purchases(s, d, _payments(s, d), tb.RUN_TS), "purchases")  # read by the key check and the merge
    return merge.merge_upsert(tb.lake_table(s, d, "earlier_purchases"), source, merge.PURCHASE_MERGE)


def _norm_refunds(s, d, flag, run_ts):
    return nref.normalize_refunds(_refunds(s, d, flag), _payments(s, d), _versions(s, d),
                                  tb.TEST_INTERNAL_EMAIL_PATTERNS, run_ts=run_ts)


def _earlier_refunds(s, d):
    return _norm_refunds(s, d, "R", tb.EARLIER_RUN_TS).select(*schemas.NORM_REFUND_COLUMNS)


def _earlier_disputes(s, d):
    return nd.normalize_disputes(_disputes(s, d), _payments(s, d), tb.EARLIER_RUN_TS)


# Outputs of earlier runs are lake tables too: written once, keyed as they are merged.
for _name, _key, _build in (("earlier_purchases", "external_id", _earlier_purchases),
                            ("earlier_refunds", "purchase_external_id", _earlier_refunds),
                            ("earlier_disputes", "charge_id", _earlier_disputes)):
    tb.LAKE_BUILDERS[_name], tb.LAKE_KEYS[_name] = _build, _key


def q_merge_norm_refund(s, d):
    target = tb.lake_table(s, d, "earlier_refunds")
    return merge.merge_upsert(target, materialize(_norm_refunds(s, d, "A", tb.RUN_TS), "refunds"), merge.NORM_REFUND_MERGE)


def q_merge_norm_dispute(s, d):
    target = tb.lake_table(s, d, "earlier_disputes")
    source = materialize(nd.normalize_disputes(_disputes(s, d, later=True), _payments(s, d), tb.RUN_TS), "disputes")
    return merge.merge_upsert(target, source, merge.NORM_DISPUTE_MERGE)


# --- watermarks --------------------------------------------------------------

def q_holdback_watermark(s, d):
    return watermark.holdback_watermark(
        (_payments(s, d), "payment_created_at"),
        (tb.lake_table(s, d, "client_billing"), "created_at"),
        (_events(s, d), "inserted_at"))


def q_latest_ts(s, d):
    return watermark.latest_ts(_refunds(s, d), "created_at")


def q_watermark_put(s, d):
    pay, ref, dis = _payments(s, d), _refunds(s, d), _disputes(s, d)
    store = (watermark.watermark_rows(pay.agg(F.min("created_at").alias("t")), "stripe_payment", "merge",
                                      "delta merge", "t")
             .unionByName(watermark.watermark_rows(ref.agg(F.min("created_at").alias("t")), "stripe_refund",
                                                   "merge", "delta merge", "t")))
    new = (watermark.watermark_rows(watermark.latest_ts(ref), "stripe_refund", "merge", "incremental etl",
                                    "created_at")
           .unionByName(watermark.watermark_rows(watermark.latest_ts(dis), "stripe_dispute", "merge",
                                                 "incremental etl", "created_at")))
    return watermark.watermark_put(store, new)


# --- scalar functions --------------------------------------------------------

def q_repair_quotes(s, d):
    e = tb.read_table(s, d, "events")
    mangled = F.concat(F.lit('"'), F.replace(F.col("props"), F.lit('"'), F.lit('""')), F.lit('"'))
    return e.select("event_id", mangled.alias("raw"), repair_quotes(mangled).alias("repaired"))


def q_strip_outer_quote(s, d):
    p = _payments(s, d)
    return p.select("payment_intent_id", strip_outer_quote("payment_data").alias("payment_json"))


def q_parse_payload(s, d):
    p = _payments(s, d)
    j = parse_payload(strip_outer_quote("payment_data"), "payment")
    return p.select("payment_intent_id", j.alias("j")).select(
        "payment_intent_id", F.col("j.id").alias("charge"), F.col("j.amount").alias("amount_cents"),
        F.col("j.status").alias("charge_status"), F.col("j.paid").alias("paid"),
        F.col("j.currency").alias("currency"), F.col("j.metadata.packageTag").alias("package_tag"),
        F.col("j.metadata.provider.fullName").alias("provider_name"))


def q_extract_payload(s, d):
    p = npur.prepare_payments(_payments(s, d))
    return p.select("payment_intent_id", "productTag", "provider", "provider_id")


def q_parse_refund(s, d):
    r = _refunds(s, d)
    j = parse_payload(strip_outer_quote("refund_data"), "refund")
    return r.select("payment_intent_id", j.alias("j")).select(
        "payment_intent_id", F.col("j.id").alias("refund_id"), F.col("j.object").alias("object"),
        F.col("j.amount").alias("amount_cents"), F.col("j.status").alias("refund_status"))


def q_epoch_to_ts(s, d):
    x = nd.enrich_disputes(_disputes(s, d), _payments(s, d))
    return x.select("dispute_id", F.col("dispute_data.evidence_details.due_by").alias("due_by"),
                    "dispute_response_required_by", "dispute_status")


def q_coerce_types(s, d):
    e = tb.read_table(s, d, "events")
    text = e.select(
        "event_id",
        F.col("value").cast("string").alias("amount"),
        F.col("ts").cast("string").alias("updated_at"),
        F.when(F.col("event_type") == "purchase", "true").when(F.col("event_type") == "error", "f")
        .otherwise(F.col("event_type")).alias("is_refunded"),
        F.col("props").alias("bad_amount"))
    return coerce_types(text, {"amount": "double", "updated_at": "timestamp_ntz", "is_refunded": "boolean",
                               "bad_amount": "double"})


# --- joins -------------------------------------------------------------------

def q_join_payment_refund(s, d):
    j = joins.join_payment_refund(_payments(s, d), _refunds(s, d))
    return j.select("payment_intent_id", "amount", "amount_refunded", "refunded_at")


def _payment_refund(s, d):
    return joins.join_payment_refund(_payments(s, d), _refunds(s, d))


def q_is_fully_refunded_short_term(s, d):
    j = _payment_refund(s, d)
    return j.select("payment_intent_id", "amount", "amount_refunded", "payment_created_at", "refunded_at",
                    is_fully_refunded_short_term("amount", "amount_refunded", "payment_created_at",
                                                 "refunded_at").alias("is_fully_refunded_short_term"))


def q_join_asof(s, d):
    p = npur.prepare_payments(_payments(s, d)).select("payment_intent_id", "productTag", "payment_created_at")
    j = joins.join_asof(p, _versions(s, d), left_key="productTag", right_key="tag",
                        left_time="payment_created_at", right_time="starting_at", tiebreak=["id"],
                        columns={"id": "product_history_id", "starting_at": "version_start"},
                        bucket_seconds=npur.VERSION_BUCKET_SECONDS,
                        broadcast_max_rows=npur.VERSION_BROADCAST_MAX_ROWS)
    return j


def q_attribute_first_event(s, d):
    base = npur.purchase_base(_payments(s, d), _refunds(s, d), _versions(s, d))
    base = base.select("external_id", "email", "created_at", "is_full_fare")
    return npur.attribute_referrals(base, _events(s, d))


def q_join_refund_payment(s, d):
    j = joins.join_refund_payment(_refunds(s, d), _payments(s, d))
    return j.select("payment_intent_id", "amount_refunded", "payment_created_at", "email", "payment_amount")


def q_join_dispute_payment(s, d):
    j = joins.join_dispute_payment(_disputes(s, d), _payments(s, d))
    return j.select("dispute_id", "charge_id", "payment_created_at", "email")


def q_product_history_view(s, d):
    return npur.product_history_view(_versions(s, d))


def q_exclude_accounts(s, d):
    r = nref.enrich_refunds(_refunds(s, d), _payments(s, d))
    return r.where(nref.exclude_accounts("email", tb.TEST_INTERNAL_EMAIL_PATTERNS)).select(
        "payment_intent_id", "email")


def q_purchase_flags(s, d):
    base = npur.purchase_base(_payments(s, d), _refunds(s, d), _versions(s, d))
    return base.select("external_id", "product_tag", "is_full_fare", "is_renewal", "is_renewal_new",
                       "is_other", "is_addon", "has_appointment",
                       operational_costs("has_appointment", "is_full_fare", "is_renewal", "is_addon",
                                         "created_at").alias("operational_costs"))


def q_operational_costs(s, d):
    # The decision list over every flag combination the product dimension
    # and a payment time can produce: versions x add-on cutover sides.
    v = _versions(s, d)
    flags = purchase_flags(F.col("tag"), F.col("category"))
    t = v.select("id", "tag", "starting_at", *[c.alias(n) for n, c in flags.items()])
    return t.select("id", "tag", "has_appointment", "is_full_fare", "is_renewal", "is_addon",
                    operational_costs("has_appointment", "is_full_fare", "is_renewal", "is_addon",
                                      "starting_at").alias("operational_costs"),
                    operational_costs("has_appointment", F.lit(False), F.lit(False), "is_addon",
                                      "starting_at").alias("addon_rule_cost"))


def q_processing_fee(s, d):
    p = _payments(s, d)
    fee = processing_fee("amount")
    return p.select("payment_intent_id", "amount", fee.alias("payment_processing_fees"),
                    (F.col("amount") - fee).alias("net_amount"))


def q_state_name(s, d):
    p = _payments(s, d)
    st = F.coalesce(F.col("state"), F.lit("NULL"))
    return p.select("payment_intent_id", st.alias("state"), state_name(st).alias("state_name"))


# --- user-level pipelines ------------------------------------------------------

def q_normalize_purchases(s, d):
    return _purchases(s, d, _payments(s, d), tb.RUN_TS)


def q_normalize_refunds(s, d):
    return _norm_refunds(s, d, "R", tb.RUN_TS)


def q_normalize_disputes(s, d):
    return nd.normalize_disputes(_disputes(s, d), _payments(s, d), tb.RUN_TS)


def q_run_metrics(s, d):
    """Rows of each output, counted as it is written: every plan runs once."""
    counts = []
    for name, plan in (("purchases", q_normalize_purchases), ("refunds", q_normalize_refunds), ("disputes", q_normalize_disputes)):
        rows, figures = metrics.observed(plan(s, d), name, n=F.count(F.lit(1)))
        materialize(rows, f"out-{name}")
        counts.append((name, figures()["n"]))
    return s.createDataFrame(counts, "output string, n long")


# --- files and streaming -----------------------------------------------------

_CDC_COLUMNS = ["Op", *schemas.PAYMENT_COLUMNS]


def q_read_cdc(s, d):
    path = shared_dir(s, "cdc-files")
    cdc_files.write_cdc_batches(_cdc_rows(s, d), path)
    return cdc_files.read_cdc(s, path, _CDC_COLUMNS, schemas.CDC_COERCE["payment"] | {"created_at": "timestamp_ntz"})


PENDING_SINCE = "2024-01-15 00:00:00"


def q_pending_batches(s, d):
    path = shared_dir(s, "cdc-pending")
    cdc_files.write_cdc_batches(_cdc_rows(s, d), path)
    return cdc_files.pending_batches(s, path, since=PENDING_SINCE)


def q_initial_load(s, d):
    path = shared_dir(s, "cdc-full")
    cdc_files.write_full_load(_payments(s, d).drop("created_at"), path)
    cols = [c for c in schemas.PAYMENT_COLUMNS if c != "created_at"]
    return cdc_files.initial_load(s, path, cols, schemas.CDC_COERCE["payment"], run_ts=tb.RUN_TS)


def q_cdc_stream(s, d):
    from ledgerline.streaming.cdc_stream import cdc_stream, read_table, start_table
    src, tgt, ck = shared_dir(s, "cdc-src"), shared_dir(s, "cdc-tgt"), shared_dir(s, "cdc-ckpt")
    cdc_files.write_cdc_batches(_cdc_rows(s, d), src)
    start_table(_payments(s, d), tgt, merge.PAYMENT_MERGE, buckets=tb.lake_buckets(s, d))
    q = cdc_stream(s, src, _CDC_COLUMNS, schemas.CDC_COERCE["payment"] | {"created_at": "timestamp_ntz"},
                   tgt, merge.PAYMENT_MERGE, "payment_updated_at", ck, buckets=tb.lake_buckets(s, d))
    q.awaitTermination()
    return read_table(s, tgt)


# --- jobs: each run in two parts, against the one-shot result ------------------

def q_merge_into_table(s, d):
    path = shared_dir(s, "merge-table")
    buckets = tb.lake_buckets(s, d)
    merge.write_table(_payments(s, d), path, merge.PAYMENT_MERGE.on, buckets)
    merge.merge_into_table(s, path, tb.lake_table(s, d, "payment_updates"), merge.PAYMENT_MERGE, buckets)
    return merge.read_table(s, path).drop(merge.BUCKET_COL)


def q_stage1_job(s, d):
    """Files as the replication tool leaves them (no load time), half of the batches at a time."""
    from ledgerline.plans.jobs import CdcSpec, run_cdc_merge
    from ledgerline.streaming import cdc_stream
    files, table = shared_dir(s, "job-files"), shared_dir(s, "job-table")
    store = watermark.WatermarkStore(s, shared_dir(s, "job-watermarks"))
    cdc_files.write_full_load(_payments(s, d).drop("created_at"), files)
    spec = CdcSpec("stripe_payment", files, tuple(_CDC_COLUMNS), schemas.CDC_COERCE["payment"],
                   merge.PAYMENT_MERGE, "payment_updated_at")
    log = _cdc_rows(s, d).drop("created_at")
    run_cdc_merge(s, spec, table, store, "merge", tb.lake_buckets(s, d), run_ts=tb.RUN_TS)  # no batches yet
    first = F.col("file_time") <= F.lit(PENDING_SINCE).cast("timestamp_ntz")
    for part in (first, ~first):
        cdc_files.write_cdc_batches(log.where(part), files, mode="append")
        run_cdc_merge(s, spec, table, store, "merge", tb.lake_buckets(s, d), run_ts=tb.RUN_TS)
    return cdc_stream.read_table(s, table)


INCREMENT_CUT = "1998-01-01 00:00:00"


def _two_runs(s, rows, run):
    """``run(rows, path, store)`` on the rows loaded until the cut, then on all."""
    path, store = shared_dir(s, "job-out"), watermark.WatermarkStore(s, shared_dir(s, "job-watermarks"))
    run(rows.where(F.col("created_at") <= F.lit(INCREMENT_CUT).cast("timestamp_ntz")), path, store)
    run(rows, path, store)
    return merge.read_table(s, path).drop(merge.BUCKET_COL)


#: Client billing is loaded until here at the first run, behind the payments: it holds the watermark back.
BILLING_CUT = "1997-12-01 00:00:00"


def q_incremental_purchases(s, d):
    from ledgerline.plans.jobs import run_normalize_purchases
    billing = tb.lake_table(s, d, "client_billing")
    loaded = iter((billing.where(F.col("created_at") <= F.lit(BILLING_CUT).cast("timestamp_ntz")), billing))
    got = _two_runs(s, _payments(s, d), lambda rows, path, store: run_normalize_purchases(
        s, payments=rows, refunds=_refunds(s, d), versions=_versions(s, d), events=_events(s, d),
        client_billing=next(loaded), target_path=path, store=store,
        dataset="purchases", job="norm", buckets=tb.lake_buckets(s, d), run_ts=tb.RUN_TS))
    return got.drop("id")


def q_incremental_refunds(s, d):
    from ledgerline.plans.jobs import run_normalize_refunds
    return _two_runs(s, _refunds(s, d), lambda rows, path, store: run_normalize_refunds(
        s, refunds=rows, payments=_payments(s, d), versions=_versions(s, d),
        exclude_patterns=tb.TEST_INTERNAL_EMAIL_PATTERNS, target_path=path, store=store,
        dataset="refunds", job="norm", buckets=tb.lake_buckets(s, d), run_ts=tb.RUN_TS))


def q_incremental_disputes(s, d):
    from ledgerline.plans.jobs import run_normalize_disputes
    return _two_runs(s, _disputes(s, d), lambda rows, path, store: run_normalize_disputes(
        s, disputes=rows, payments=_payments(s, d), target_path=path, store=store,
        dataset="disputes", job="norm", buckets=tb.lake_buckets(s, d), run_ts=tb.RUN_TS))


def q_watermark_get(s, d):
    store = watermark.WatermarkStore(s, shared_dir(s, "watermarks"))
    for name, rows in (("stripe_payment", _payments(s, d)), ("stripe_refund", _refunds(s, d))):
        for when in (F.min, F.max):
            t = watermark.watermark_rows(rows.agg(when("created_at").alias("t")), name, "merge", "delta merge", "t")
            store.put(name, "merge", "delta merge", t.first()["ts"])
    got = [(n, store.get(n, "merge")) for n in ("stripe_payment", "stripe_refund", "stripe_dispute")]
    return s.createDataFrame(got, "dataset string, ts string")


def q_is_initial(s, d):
    from ledgerline.plans.jobs import is_initial
    path, store = shared_dir(s, "initial-table"), watermark.WatermarkStore(s, shared_dir(s, "watermarks"))
    seen = [is_initial(s, store, "stripe_payment", "merge", path)]
    for rows in (_payments(s, d).limit(0), _payments(s, d)):
        merge.write_table(rows, path, merge.PAYMENT_MERGE.on, tb.lake_buckets(s, d))
        seen.append(is_initial(s, store, "stripe_payment", "merge", path))
    return merge.read_table(s, path).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(seen[0]).alias("without_table"), F.lit(seen[1]).alias("empty_table"), F.lit(seen[2]).alias("loaded"), "n")


# --- files of several layouts, inferred types, late batches, pruned scans ----------

def q_read_cdc_layouts(s, d):
    """Earlier batches lack a column and have another order, later ones have one more."""
    path, rows = shared_dir(s, "cdc-layouts"), _cdc_rows(s, d)
    first = F.col("file_time") <= F.lit(PENDING_SINCE).cast("timestamp_ntz")
    early = rows.where(first).drop("phone")
    cdc_files.write_cdc_batches(early.select("Op", *sorted(c for c in early.columns if c != "Op")), path)
    cdc_files.write_cdc_batches(rows.where(~first).withColumn("channel", F.upper("status")), path, mode="append")
    return cdc_files.read_cdc(s, path, [*_CDC_COLUMNS, "channel"], schemas.CDC_COERCE["payment"] | {"created_at": "timestamp_ntz"})


def q_read_cdc_split(s, d):
    """Files with line breaks inside values, read by splits."""
    path = shared_dir(s, "cdc-split")
    cdc_files.write_cdc_batches(_cdc_rows(s, d).withColumn("payment_data", F.replace("payment_data", F.lit(","), F.lit(",\n"))), path)
    return cdc_files.read_cdc(s, path, _CDC_COLUMNS, schemas.CDC_COERCE["payment"] | {"created_at": "timestamp_ntz"}, multiline="split")


def q_infer_cdc(s, d):
    """The type of each column of all CDC files, one pass."""
    path = shared_dir(s, "cdc-infer")
    cdc_files.write_cdc_batches(_cdc_rows(s, d), path)
    rows, types = cdc_files.infer_cdc(s, path, _CDC_COLUMNS)
    n = rows.agg(*[F.count(c).alias(c) for c in types]).first()
    return s.createDataFrame([(c, t, n[c]) for c, t in types.items()], "column string, type string, n_values long")


def q_late_batches(s, d):
    """The newer batches are delivered and applied first.  The replication tool packs its files."""
    from ledgerline.plans.jobs import CdcSpec, run_cdc_merge
    from ledgerline.streaming import cdc_stream
    files, table = shared_dir(s, "late-files"), shared_dir(s, "late-table")
    store = watermark.WatermarkStore(s, shared_dir(s, "late-watermarks"))
    cdc_files.write_full_load(_payments(s, d).drop("created_at"), files, compression="gzip")
    spec = CdcSpec("stripe_payment", files, tuple(_CDC_COLUMNS), schemas.CDC_COERCE["payment"],
                   merge.PAYMENT_MERGE, "payment_updated_at", late_seconds=366 * 86400, by_load=True)
    log = _cdc_rows(s, d).drop("created_at")
    first = F.col("file_time") <= F.lit(PENDING_SINCE).cast("timestamp_ntz")
    for part in (~first, first):
        cdc_files.write_cdc_batches(log.where(part), files, mode="append", compression="gzip")
        run_cdc_merge(s, spec, table, store, "merge", tb.lake_buckets(s, d), run_ts=tb.RUN_TS)
    return cdc_stream.read_table(s, table)


def q_scan_incremental_pruned(s, d):
    """The watermark prunes folders of load months."""
    path = shared_dir(s, "by-load")
    merge.write_table(_payments(s, d), path, merge.PAYMENT_MERGE.on, 4, by_load=True)
    return watermark.scan_incremental(merge.read_table(s, path), "created_at", INCREMENTAL_WATERMARK).drop(merge.BUCKET_COL)


def q_restricted_join(s, d):
    """Payments picked out by a Bloom filter of the refunds' keys, as for increments of many keys."""
    payments, refunds = _payments(s, d), _refunds(s, d)
    found = joins.restrict_to(payments, refunds, "payment_intent_id", most=0)
    j = joins.join_refund_payment(refunds, found)
    return j.select("payment_intent_id", "amount_refunded", "payment_created_at", "email", "payment_amount")


def q_normalize_purchases_sql(s, d):
    return npur.normalize_purchases_sql(_payments(s, d), _refunds(s, d), _versions(s, d), _events(s, d), tb.RUN_TS)


def q_payload_dead_letters(s, d):
    """Typed rows and dead letters of payments whose payload is damaged in three ways, by the last digit of their id."""
    last = F.right("payment_intent_id", F.lit(1))
    damaged = (F.when(last == "7", F.left("payment_data", F.lit(40))).when(last == "3", F.lit("[1, 2]"))
               .when(last == "5", F.lit('{"amount": "many"}')).otherwise(F.col("payment_data")))
    good, dead = split_payloads(_payments(s, d).withColumn("payment_data", damaged), "payment_data", "payment_intent_id")
    return (good.select("payment_intent_id", F.lit(True).alias("fits"), F.lit(None).cast("string").alias("reason"), F.col("payload.amount").alias("amount_cents"))
            .unionByName(dead.select("payment_intent_id", F.lit(False).alias("fits"), "reason", F.lit(None).cast("int").alias("amount_cents"))))


QUERIES: dict[str, Query] = {
    "read_cdc_layouts": q_read_cdc_layouts,
    "infer_cdc": q_infer_cdc,
    "read_cdc_split": q_read_cdc_split,
    "late_batches": q_late_batches,
    "scan_incremental_pruned": q_scan_incremental_pruned,
    "restricted_join": q_restricted_join,
    "normalize_purchases_sql": q_normalize_purchases_sql,
    "payload_dead_letters": q_payload_dead_letters,
    "merge_into_table": q_merge_into_table,
    "stage1_job": q_stage1_job,
    "incremental_purchases": q_incremental_purchases,
    "incremental_refunds": q_incremental_refunds,
    "incremental_disputes": q_incremental_disputes,
    "watermark_get": q_watermark_get,
    "is_initial": q_is_initial,
    "scan_full": q_scan_full,
    "scan_incremental": q_scan_incremental,
    "cdc_split": q_cdc_split,
    "latest_per_key": q_latest_per_key,
    "apply_delta": q_apply_delta,
    "cdc_fold": q_cdc_fold,
    "append_by_name": q_append_by_name,
    "merge_payment": q_merge_payment,
    "merge_refund": q_merge_refund,
    "merge_dispute": q_merge_dispute,
    "merge_purchase": q_merge_purchase,
    "merge_norm_refund": q_merge_norm_refund,
    "merge_norm_dispute": q_merge_norm_dispute,
    "holdback_watermark": q_holdback_watermark,
    "latest_ts": q_latest_ts,
    "watermark_put": q_watermark_put,
    "repair_quotes": q_repair_quotes,
    "strip_outer_quote": q_strip_outer_quote,
    "parse_payload": q_parse_payload,
    "extract_payload": q_extract_payload,
    "parse_refund": q_parse_refund,
    "epoch_to_ts": q_epoch_to_ts,
    "coerce_types": q_coerce_types,
    "join_payment_refund": q_join_payment_refund,
    "is_fully_refunded_short_term": q_is_fully_refunded_short_term,
    "join_asof": q_join_asof,
    "attribute_first_event": q_attribute_first_event,
    "join_refund_payment": q_join_refund_payment,
    "join_dispute_payment": q_join_dispute_payment,
    "product_history_view": q_product_history_view,
    "exclude_accounts": q_exclude_accounts,
    "purchase_flags": q_purchase_flags,
    "operational_costs": q_operational_costs,
    "processing_fee": q_processing_fee,
    "state_name": q_state_name,
    "normalize_purchases": q_normalize_purchases,
    "normalize_refunds": q_normalize_refunds,
    "normalize_disputes": q_normalize_disputes,
    "run_metrics": q_run_metrics,
    "read_cdc": q_read_cdc,
    "pending_batches": q_pending_batches,
    "initial_load": q_initial_load,
    "cdc_stream": q_cdc_stream,
}
