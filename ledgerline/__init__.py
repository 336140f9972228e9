"""Spark-native CDC merge and payment normalisation.

Public API (all functions take and return DataFrames / Columns):

* CDC: ``read_cdc``, ``initial_load``, ``cdc_split``, ``apply_delta``,
  ``fold_log``, ``cdc_fold``, ``latest_per_key``
* MERGE: ``MergeSpec``, ``merge_upsert``, ``merge_into_table``, ``merge_sql``,
  ``append_by_name`` and the pipeline specs in ``ledgerline.operators.merge``
* joins: ``join_asof``, ``join_next`` (linear forms)
* watermarks: ``scan_incremental``, ``holdback_watermark``, ``latest_ts``,
  ``WatermarkStore``
* pipelines: ``normalize_purchases``, ``normalize_refunds``,
  ``normalize_disputes`` and the incremental jobs in ``ledgerline.plans.jobs``
* streaming: ``cdc_stream``
"""

from ledgerline.operators.cdc import apply_delta, cdc_fold, cdc_split, fold_log
from ledgerline.operators.dedup import latest_per_key
from ledgerline.operators.joins import join_asof, join_next
from ledgerline.operators.merge import MergeSpec, append_by_name, merge_into_table, merge_sql, merge_upsert
from ledgerline.operators.watermark import WatermarkStore, holdback_watermark, latest_ts, scan_incremental
from ledgerline.plans.disputes import normalize_disputes
from ledgerline.plans.purchases import normalize_purchases
from ledgerline.plans.refunds import normalize_refunds
from ledgerline.sources.cdc_files import initial_load, read_cdc
from ledgerline.streaming.cdc_stream import cdc_stream

__all__ = [
    "apply_delta", "cdc_fold", "cdc_split", "fold_log", "latest_per_key", "join_asof",
    "join_next", "MergeSpec", "append_by_name",
    "merge_into_table", "merge_sql", "merge_upsert", "WatermarkStore", "holdback_watermark",
    "latest_ts", "scan_incremental", "normalize_disputes", "normalize_purchases", "normalize_refunds",
    "initial_load", "read_cdc", "cdc_stream",
]
