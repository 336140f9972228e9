"""Swapping staged buckets into a bucket-partitioned table, safe against a crash.

A merge first writes whole new buckets to a stage folder beside the table.
Before the table is touched, a redo record names the stage and its buckets;
after the swap a second record closes it.  :func:`recover` replays an open
record, so a job that was killed between removing a bucket and putting the new
one in place loses nothing: the staged copy is swapped in by the next run.

The swap replaces each bucket's folder as a whole, with all that lies in it.
Where the file system renames folders atomically, the staged folder becomes the
bucket's folder (a replay finds it moved or not moved).  Elsewhere the buckets
are removed and the stage is copied by a Spark job, again as a whole on replay.

One writer per table at a time, as with any overwrite of parquet folders.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from ledgerline.session import missing

BUCKET_COL = "key_bucket"
#: One row when a swap begins, a second one when it is done; the next merge starts the log anew.
RECORD = "merge_id string, stage string, buckets array<int>, rows long, token string, done boolean, at long"
#: File systems whose rename of a folder is one step.
ATOMIC_RENAME = ("file", "hdfs", "viewfs")


def stage_path(path: str) -> str:
    """A fresh stage folder beside the table, on the table's own storage."""
    return f"{path.rstrip('/')}_stage/{uuid.uuid4().hex[:12]}"


class RedoLog:
    def __init__(self, spark: SparkSession, table_path: str):
        self.spark, self.path = spark, f"{table_path.rstrip('/')}_redo"

    def last(self) -> dict | None:
        """The newest merge's record (its closing one, if there is one); at most two rows are collected."""
        try:
            rows = self.spark.read.schema(RECORD).parquet(self.path).collect()
        except AnalysisException as e:
            if not missing(e):
                raise
            return None
        return max((r.asDict() for r in rows), key=lambda r: (r["done"], r["at"]), default=None)

    def _write(self, record: dict, mode: str) -> None:
        row = tuple(record[c.split()[0]] for c in RECORD.split(", "))
        self.spark.createDataFrame([row], RECORD).coalesce(1).write.mode(mode).parquet(self.path)

    def begin(self, stage: str, buckets: list[int], rows: int, token: str | None) -> dict:
        record = {"merge_id": stage.rsplit("/", 1)[-1], "stage": stage, "buckets": buckets, "rows": rows, "token": token, "done": False, "at": time.time_ns()}
        self._write(record, "overwrite")
        return record

    def end(self, record: dict) -> None:
        self._write({**record, "done": True, "at": time.time_ns()}, "append")


def _files(spark: SparkSession, path: str):
    """(Hadoop path, its file system), or (None, None) in a session without a JVM gateway."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        return None, None
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _drop_folder(fs, folder) -> None:
    if fs.exists(folder) and not fs.delete(folder, True):
        raise OSError(f"could not remove {folder}")


def swap(spark: SparkSession, path: str, stage: str, buckets: list[int]) -> None:
    """Put the staged buckets in place of the table's.  May be repeated after a crash at any point."""
    table, fs = _files(spark, path)
    if table is None:  # Spark Connect: Spark's own overwrite of the partitions that the stage holds
        (spark.read.parquet(stage).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET_COL).parquet(path))
        return
    child = spark._jvm.org.apache.hadoop.fs.Path
    if fs.getScheme() in ATOMIC_RENAME:
        fs.mkdirs(table)
        for b in buckets:
            new, old = child(stage, f"{BUCKET_COL}={b}"), child(table, f"{BUCKET_COL}={b}")
            if not fs.exists(new):
                continue  # moved before a crash
            _drop_folder(fs, old)
            if not fs.rename(new, old):
                raise OSError(f"could not move {new} to {old}")
        return
    for b in buckets:
        _drop_folder(fs, child(table, f"{BUCKET_COL}={b}"))
    staged = spark.read.parquet(stage)
    levels = [c for c in staged.columns if c in partition_columns(spark, stage)]
    staged.write.mode("append").partitionBy(*levels).parquet(path)


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns that a partitioned folder keeps in folder names, outermost first."""
    try:
        files = spark.read.parquet(path).inputFiles()
    except AnalysisException as e:
        if not missing(e):
            raise
        return []
    return [part.split("=", 1)[0] for part in (files[0].split("/") if files else []) if "=" in part]


def commit(spark: SparkSession, path: str, stage: str, buckets: list[int], rows: int = 0, token: str | None = None) -> None:
    """Record, swap, close.  ``token`` names the input, so that the same input can be known when it comes again."""
    log = RedoLog(spark, path)
    record = log.begin(stage, buckets, rows, token)
    _finish(spark, path, log, record)


def _finish(spark: SparkSession, path: str, log: RedoLog, record: dict) -> None:
    swap(spark, path, record["stage"], record["buckets"])
    log.end(record)
    stage, fs = _files(spark, record["stage"])
    if stage is not None:
        _drop_folder(fs, stage)


def recover(spark: SparkSession, path: str) -> dict | None:
    """Replays a swap that was cut short; returns the newest merge's record, now done."""
    log = RedoLog(spark, path)
    record = log.last()
    if record is None or record["done"]:
        return record
    _finish(spark, path, log, record)
    return {**record, "done": True}
