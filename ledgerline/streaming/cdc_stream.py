"""Structured Streaming form of the CDC merge: new batch files are picked up
by the file source, and each micro-batch is folded into the target table
by ``foreachBatch``.  Progress lives in the streaming checkpoint, which
replaces the external merge-history and file-tracking stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.coerce import load_time, stamp_load_time
from ledgerline.operators.cdc import APPLIED, APPLIED_TYPE, any_order_merge, fold_in_any_order
from ledgerline.operators.commit import recover
from ledgerline.operators.merge import BUCKET_COL, LOAD_COL, MergeSpec, merge_into_table, write_table
from ledgerline.sources.cdc_files import batch_glob, read_files


def cdc_stream(spark: SparkSession, source_path: str, columns: list[str], types: dict[str, str],
               table_path: str, spec: MergeSpec, ts: str, checkpoint: str, buckets: int,
               like: DataFrame | None = None, run_ts: str | None = None):
    """Start an ``availableNow`` query that folds every pending batch file
    into the bucket-partitioned parquet table at ``table_path`` (see
    :func:`ledgerline.operators.merge.write_table`); returns the handle.

    All files that are there at the start form one micro-batch (only their
    paths are collected).  Its rows are reduced
    to one row per key with ``fold_in_any_order`` (batches inside it ordered by
    their batch time) and merged with ``merge_into_table``: only the hash
    buckets it touches are rewritten.  Each row keeps its place in the log
    (column ``_applied``), so files of a batch that arrive late, after newer
    batches were applied, or arrive twice, change just what they would have
    changed in order.  A micro-batch that runs again after a crash is known by
    its id; a swap that the crash cut short is finished first.  ``like`` gives
    the table's columns when the table may still be empty; files without a
    load time get the run's.
    """
    # The stream carries paths alone: the file source keeps the log of those seen, and a micro-batch's
    # files are read like any CDC files, whatever their headers.
    stream = (spark.readStream.format("binaryFile").schema(PATHS).option("recursiveFileLookup", "true")
              .load(batch_glob(source_path)).select("path"))

    def apply(batch: DataFrame, batch_id: int) -> None:
        files = [r[0] for r in batch.collect()]
        log = read_files(spark, files, [c for c in columns if c != LOAD_TIME], types, optional=(LOAD_TIME,) if LOAD_TIME in columns else ())
        merge_log(spark, log, table_path, spec, ts, buckets, like=like, run_ts=run_ts, token=f"{checkpoint}/{batch_id}")

    return (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


LOAD_TIME = "created_at"
PATHS = "path string, modificationTime timestamp, length long, content binary"


def merge_log(spark: SparkSession, log: DataFrame, table_path: str, spec: MergeSpec, ts: str, buckets: int,
              like: DataFrame | None = None, run_ts: str | None = None, token: str | None = None, by_load: bool = False) -> int:
    """Fold CDC rows (with ``file_time``) and merge them into the table,
    whatever batches have been merged before; returns the keys merged.  Rows
    without a load time of their own get the run's.  Inserts without a key
    match nothing: each is appended."""
    recover(spark, table_path)
    stamped = LOAD_TIME not in log.columns
    log = stamp_load_time(log, run_ts, LOAD_TIME) if stamped else log.withColumn(LOAD_TIME, F.coalesce(LOAD_TIME, load_time(run_ts)))
    base = like if like is not None else spark.read.parquet(table_path)
    like = with_places(base.drop(BUCKET_COL, LOAD_COL))
    cols = [c for c in like.columns if c != APPLIED]
    merge, choose = any_order_merge(spec, [c for c in cols if c in log.columns], LOAD_TIME if stamped else None)
    return merge_into_table(spark, table_path, fold_in_any_order(log, spec, ts, cols), merge, buckets,
                            validate=False, like=like, token=token, choose=choose, by_load=by_load)


def with_places(df: DataFrame) -> DataFrame:
    """The table's columns with the places of applied rows (NULL: there before the log)."""
    return df if APPLIED in df.columns else df.withColumn(APPLIED, F.lit(None).cast(APPLIED_TYPE))


def start_table(df: DataFrame, table_path: str, spec: MergeSpec, buckets: int) -> None:
    """Create the stream's target table from a snapshot (e.g. a full load)."""
    write_table(df, table_path, spec.on, buckets)


def read_table(spark: SparkSession, table_path: str) -> DataFrame:
    """The table's own columns."""
    return spark.read.parquet(table_path).drop(BUCKET_COL, LOAD_COL, APPLIED)
