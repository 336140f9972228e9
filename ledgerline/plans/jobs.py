"""The pipeline's jobs: stage 1 (CDC batch files -> lake table) and stage 2
(lake tables -> normalised purchases / refunds / disputes), each an
incremental run driven by a watermark and persisted to a bucket-partitioned
parquet table.

Per run each job makes a bounded number of actions: the watermark lookup
(one row), one small aggregate for progress (new watermark, emptiness),
the merge (touched-bucket listing + staging write + swap) and the watermark
write (one row).  No data passes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.operators.commit import recover
from ledgerline.operators.joins import restrict_to
from ledgerline.operators.merge import (NORM_DISPUTE_MERGE, NORM_REFUND_MERGE, PURCHASE_MERGE,
                                        MergeSpec, load_table, merge_into_table, write_table)
from ledgerline.operators.watermark import (NO_WATERMARK, WatermarkStore, holdback_watermark, latest_ts,
                                            scan_incremental)
from ledgerline.plans.disputes import normalize_disputes
from ledgerline.plans.purchases import normalize_purchases
from ledgerline.plans.refunds import normalize_refunds
from ledgerline.session import missing
from ledgerline.sources.cdc_files import initial_load, read_cdc
from ledgerline.streaming.cdc_stream import merge_log, with_places

LOAD_TIME = "created_at"


@dataclass(frozen=True)
class RunResult:
    """Outcome of one incremental run: the new watermark (None when there
    was nothing to do) and the number of rows merged (counted on the merge
    source already written by ``merge_into_table``)."""

    watermark: str | None
    rows: int = 0


@dataclass(frozen=True)
class CdcSpec:
    """One replicated table: where its batch files are, their columns and
    the types to force, the merge rule and the latest-by column."""

    dataset: str
    files_path: str
    columns: tuple[str, ...]
    types: dict[str, str]
    merge: MergeSpec
    latest_by: str
    # False where no value contains a line break: large files are then split; "split" splits them in any case.
    multiline: bool | str = True
    # How far behind the watermark batches may still arrive: these are read again (applying twice changes nothing).
    late_seconds: int = 0
    # Whether the table has a level of load months below its buckets, by which downstream watermarks prune.
    by_load: bool = False


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds a table (listing only); any other failure than
    missing files is raised, not taken for a new table."""
    try:
        spark.read.parquet(path).schema  # noqa: B018 - listing only
        return True
    except AnalysisException as e:
        if not missing(e):
            raise
        return False


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` (or a glob) holds any files (listing only, no job)."""
    try:
        spark.read.format("text").load(path).schema  # noqa: B018
        return True
    except AnalysisException as e:
        if not missing(e):
            raise
        return False


def is_initial(spark: SparkSession, store: WatermarkStore, dataset: str, job: str, table_path: str) -> bool:
    """No watermark yet and the target table is missing or empty."""
    if store.get(dataset, job) != NO_WATERMARK:
        return False
    return not table_exists(spark, table_path) or spark.read.parquet(table_path).isEmpty()


def _iso(ts) -> str | None:
    return ts.isoformat() if ts is not None else None


def run_cdc_merge(spark: SparkSession, spec: CdcSpec, table_path: str, store: WatermarkStore,
                  job: str, buckets: int, run_ts: str | None = None) -> RunResult:
    """Stage 1: initial load when the table is new, then fold every batch
    newer than the watermark (less ``late_seconds``) into the table in one
    merge, and advance the watermark to the newest batch applied.  Rows keep
    their place in the log, so late and repeated batches may be applied after
    newer ones."""
    recover(spark, table_path)
    data_cols = [c for c in spec.columns if c not in ("Op", LOAD_TIME)]
    if is_initial(spark, store, spec.dataset, job, table_path) and \
            path_exists(spark, f"{spec.files_path.rstrip('/')}/LOAD*"):
        snapshot = initial_load(spark, spec.files_path, data_cols, spec.types, run_ts)
        load_table(spark, with_places(snapshot), table_path, spec.merge.on, buckets, by_load=spec.by_load)
    since = store.get(spec.dataset, job)
    before = None if since == NO_WATERMARK else datetime.fromisoformat(since)
    since = None if before is None else (before - timedelta(seconds=spec.late_seconds)).isoformat(sep=" ")
    log = read_cdc(spark, spec.files_path, [c for c in spec.columns if c != LOAD_TIME], spec.types, since=since,
                   multiline=spec.multiline, optional=(LOAD_TIME,) if LOAD_TIME in spec.columns else ())
    # Progress: one aggregate over the (pruned) batch-time column.
    newest = log.agg(F.max("file_time")).collect()[0][0]
    if newest is None:
        return RunResult(None)
    like = None
    if not table_exists(spark, table_path):
        # No full load: the table starts empty, with the batches' columns.
        like = with_places(log.select(*data_cols, F.lit(None).cast("timestamp_ntz").alias(LOAD_TIME)))
        _ensure_table(spark, table_path, like, spec.merge.on, buckets)
    n = merge_log(spark, log, table_path, spec.merge, spec.latest_by, buckets, like=like, run_ts=run_ts, by_load=spec.by_load)
    newest = newest if before is None else max(newest, before)
    store.put(spec.dataset, job, "delta merge", _iso(newest))
    return RunResult(_iso(newest), n)


def _ensure_table(spark: SparkSession, path: str, like: DataFrame, on: tuple[str, ...], buckets: int) -> None:
    if not table_exists(spark, path):
        write_table(like.limit(0), path, on, buckets)


def run_normalize_purchases(spark: SparkSession, *, payments: DataFrame, refunds: DataFrame,
                            versions: DataFrame, events: DataFrame, client_billing: DataFrame,
                            target_path: str, store: WatermarkStore, dataset: str, job: str,
                            buckets: int, run_ts: str | None = None,
                            progress_col: str = "created_at") -> RunResult:
    """Stage 2, purchases: payments loaded after the watermark -> purchase
    rows -> merge.  The new watermark is the hold-back minimum of the
    increment's latest ``progress_col`` (load time by default, so filter
    and watermark use one clock) and the other sources' latest load."""
    increment = scan_incremental(payments, "created_at", store.get(dataset, job))
    # One job: increment size and the hold-back watermark together.
    sizes = increment.agg(F.count(F.lit(1)).alias("n"))
    progress = holdback_watermark((increment, progress_col), (client_billing, "created_at"),
                                  (events, "inserted_at"))
    progress = (progress.unionByName(sizes, allowMissingColumns=True)
                .agg(F.max("created_at").alias("created_at"), F.max("n").alias("n")).collect()[0])
    if not progress["n"]:
        return RunResult(None)
    # What a small increment needs of the whole tables is picked out where it lies, not shuffled.
    refunds = restrict_to(refunds, increment, "payment_intent_id")
    events = restrict_to(events, increment, "user_email", "email")
    rows = normalize_purchases(increment, refunds, versions, events, run_ts=run_ts)
    target = rows.select(*[F.lit(None).cast("bigint").alias("id") if c == "id" else F.col(c)
                           for c in _purchase_columns()])
    _ensure_table(spark, target_path, target, PURCHASE_MERGE.on, buckets)
    n = merge_into_table(spark, target_path, rows, PURCHASE_MERGE, buckets, like=target)
    store.put(dataset, job, "incremental etl", _iso(progress["created_at"]))
    return RunResult(_iso(progress["created_at"]), n)


def _purchase_columns() -> list[str]:
    from ledgerline.schemas import PURCHASE_COLUMNS
    return PURCHASE_COLUMNS


def run_normalize_refunds(spark: SparkSession, *, refunds: DataFrame, payments: DataFrame,
                          versions: DataFrame, exclude_patterns: Sequence[str], target_path: str,
                          store: WatermarkStore, dataset: str, job: str, buckets: int,
                          run_ts: str | None = None, threshold: float = K.FULL_REFUND_THRESHOLD) -> RunResult:
    """Stage 2, refunds: refunds loaded after the watermark -> merge; the
    watermark advances to the increment's latest load time even when every
    row is filtered out."""
    increment = scan_incremental(refunds, "created_at", store.get(dataset, job))
    newest = latest_ts(increment).collect()[0][0]
    if newest is None:
        return RunResult(None)
    # The payments of a small increment are picked out where they lie, not shuffled.
    payments = restrict_to(payments, increment, "payment_intent_id")
    rows = normalize_refunds(increment, payments, versions, exclude_patterns, run_ts=run_ts, threshold=threshold)
    from ledgerline.schemas import NORM_REFUND_COLUMNS
    like = rows.select(*NORM_REFUND_COLUMNS)
    _ensure_table(spark, target_path, like, NORM_REFUND_MERGE.on, buckets)
    n = merge_into_table(spark, target_path, rows, NORM_REFUND_MERGE, buckets, like=like)
    store.put(dataset, job, "incremental etl", _iso(newest))
    return RunResult(_iso(newest), n)


def run_normalize_disputes(spark: SparkSession, *, disputes: DataFrame, payments: DataFrame,
                           target_path: str, store: WatermarkStore, dataset: str, job: str,
                           buckets: int, run_ts: str | None = None) -> RunResult:
    """Stage 2, disputes: disputes loaded after the watermark -> merge."""
    increment = scan_incremental(disputes, "created_at", store.get(dataset, job))
    newest = latest_ts(increment).collect()[0][0]
    if newest is None:
        return RunResult(None)
    rows = normalize_disputes(increment, restrict_to(payments, increment, "charge_id"), run_ts=run_ts)
    _ensure_table(spark, target_path, rows, NORM_DISPUTE_MERGE.on, buckets)
    n = merge_into_table(spark, target_path, rows, NORM_DISPUTE_MERGE, buckets, like=rows)
    store.put(dataset, job, "incremental etl", _iso(newest))
    return RunResult(_iso(newest), n)
