"""Incremental-load progress: watermark scans, hold-back and the store."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.merge import LOAD_COL, WATERMARK_MERGE, merge_upsert
from ledgerline.session import missing

NO_WATERMARK = "NA"
LOAD_TIME = "created_at"

WATERMARK_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType()), T.StructField("job", T.StringType()),
    T.StructField("kind", T.StringType()), T.StructField("ts", T.StringType()),
])


def watermark_floor(iso_ts: str | None) -> str | None:
    """ISO watermark text -> ``yyyy-MM-dd HH:mm:ss`` (fraction dropped).
    ``None`` or ``"NA"`` mean no watermark."""
    if not iso_ts or iso_ts == NO_WATERMARK:
        return None
    return datetime.fromisoformat(iso_ts).strftime("%Y-%m-%d %H:%M:%S")


def scan_incremental(df: DataFrame, ts_col: str, watermark: str | None) -> DataFrame:
    """Rows loaded strictly after the watermark (whole seconds; rows of the
    watermark's own second are read again, which the keyed MERGE absorbs).
    The predicate is a bare column comparison, so it reaches the parquet
    scan as a pushed filter; in a table with the level of load months (of
    ``created_at``) the watermark's month prunes older folders, whose files are
    not opened."""
    floor = watermark_floor(watermark)
    if floor is None:
        return df
    rows = df.where(F.col(ts_col) > F.to_timestamp_ntz(F.lit(floor), F.lit("yyyy-MM-dd HH:mm:ss")))
    if LOAD_COL in df.columns and ts_col == LOAD_TIME:
        rows = rows.where(F.col(LOAD_COL) >= int(floor[:4]) * 100 + int(floor[5:7])).drop(LOAD_COL)
    return rows


def holdback_watermark(*sources: tuple[DataFrame, str], alias: str = "created_at") -> DataFrame:
    """One row: the smallest of the sources' latest times.  An empty source
    (NULL maximum) is ignored.  Each maximum is a partially aggregated
    global aggregate, so only one value per task is shuffled."""
    maxes = [df.agg(F.max(F.col(c).cast("timestamp_ntz")).alias("ts")) for df, c in sources]
    u = maxes[0]
    for m in maxes[1:]:
        u = u.unionByName(m)
    return u.agg(F.min("ts").alias(alias))


def latest_ts(df: DataFrame, col: str = "created_at") -> DataFrame:
    """Latest value of ``col`` (NULL when empty or all NULL)."""
    return df.agg(F.max(col).alias(col))


def watermark_rows(df: DataFrame, dataset: str, job: str, kind: str, ts_col: str) -> DataFrame:
    """Watermark-table rows from a one-row frame holding the new time."""
    return df.select(F.lit(dataset).alias("dataset"), F.lit(job).alias("job"), F.lit(kind).alias("kind"),
                     F.date_format(F.col(ts_col), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"))


def watermark_put(store: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Store after upserting ``new_rows`` on (dataset, job); a NULL time
    keeps the previous watermark."""
    return merge_upsert(store, new_rows.where(F.col("ts").isNotNull()), WATERMARK_MERGE)


class WatermarkStore:
    """Watermarks kept in a small parquet table: a log of puts.

    Every ``put`` appends one row; nothing is read or rewritten, so jobs that
    overlap cannot lose each other's watermark and a crash leaves the row
    whole or not there.  ``get`` takes the newest row of its (dataset, job);
    it collects that one row.  Only a store without files counts as empty:
    any other failure to read is raised.
    """

    SCHEMA = T.StructType([*WATERMARK_SCHEMA.fields, T.StructField("put_at", T.LongType())])

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def rows(self) -> DataFrame:
        """The newest row of every (dataset, job), in WATERMARK_SCHEMA."""
        try:
            log = self.spark.read.schema(self.SCHEMA).parquet(self.path)
        except AnalysisException as e:
            if not missing(e):
                raise
            return self.spark.createDataFrame([], WATERMARK_SCHEMA)
        newest = log.groupBy("dataset", "job").agg(F.max(F.struct("put_at", "ts", "kind")).alias("x"))
        return newest.select("dataset", "job", "x.kind", "x.ts")

    def get(self, dataset: str, job: str) -> str:
        rows = self.rows().where((F.col("dataset") == dataset) & (F.col("job") == job)).select("ts").collect()
        return rows[0][0] if rows and rows[0][0] else NO_WATERMARK

    def put(self, dataset: str, job: str, kind: str, iso_ts: str | None) -> None:
        if not iso_ts:
            return
        import time
        row = self.spark.createDataFrame([(dataset, job, kind, iso_ts, time.time_ns())], self.SCHEMA)
        row.coalesce(1).write.mode("append").parquet(self.path)
