"""MERGE semantics on plain DataFrames, plus lake-table persistence.

``merge_upsert`` returns the post-merge table: one full-outer join on the
merge key, then per column a choice between target value, source value or
insert value.  Key equality is SQL ``=`` (a NULL key never matches, so such
a source row is inserted on every run) unless ``null_safe`` is set.

``merge_into_table`` applies a merge to a parquet table that is partitioned
by a hash bucket of the key: only buckets the source touches are read,
merged, staged beside the table and swapped in under a redo record
(:mod:`ledgerline.operators.commit`), so a small increment never rewrites the
whole table and an interrupted swap is finished by the next run.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.operators.commit import BUCKET_COL, commit, partition_columns, recover, stage_path
from ledgerline.session import CODEC, materialize

_T, _S, _N = "__t_present", "__s_present", "__s_rows"
SEVERAL = "MERGE source has several rows for one key of"


@dataclass(frozen=True)
class MergeSpec:
    """``on``: key columns; ``update``: columns set from the source when a
    key matches; ``insert``: columns taken from the source for a new row.
    Target columns in neither list keep their value on update and are NULL
    (or ``insert_values[c]``) on insert."""

    on: tuple[str, ...]
    update: tuple[str, ...]
    insert: tuple[str, ...]
    insert_values: dict[str, Column] = field(default_factory=dict)
    # Source column that feeds a target column of another name.
    source_alias: dict[str, str] = field(default_factory=dict)

    def source_col(self, c: str) -> str:
        return self.source_alias.get(c, c)


def source_name(c: str) -> str:
    """The name of a source column in the joined rows of ``merge_upsert``."""
    return f"__s__{c}"


_s = source_name


def merge_upsert(target: DataFrame, source: DataFrame, spec: MergeSpec,
                 validate: bool = True, null_safe: bool = False,
                 dedupe_by: str | None = None,
                 choose: Callable[[str, Column, Column], Column] | None = None) -> DataFrame:
    """Post-merge table (target's columns, in target order).

    The join is on the key columns alone, so inputs that are bucketed alike
    meet without a shuffle.  Rows with an incomplete key never match (unless
    ``null_safe``): they stay out of the join and are kept or inserted as
    they are, so a NULL key is no hot key.

    Duplicate source keys: by default the merge fails when it is executed and
    a target row is matched by several source rows, as standard MERGE does (a
    key that is only inserted may occur more than once).  The rows per source
    key are counted over the partitioning and order that the join needs
    anyway, so neither side is read twice.  ``validate=False`` skips it for a
    source that is unique by construction; ``dedupe_by=<time column>`` instead
    keeps, per key, the source row that is latest in that column and then in
    the remaining columns (a total order, one partially aggregated ``groupBy``).

    ``choose(column, target value, source value)`` may replace the rule for
    the updated columns of a matched row.
    """
    if dedupe_by is not None:
        from ledgerline.operators.dedup import latest_per_key
        source = latest_per_key(source, [spec.source_col(k) for k in spec.on], dedupe_by, ties="one")
    validate = validate and dedupe_by is None
    needed = sorted({spec.source_col(c) for c in (*spec.on, *spec.update, *spec.insert)})
    s = source.select(*[F.col(c).alias(_s(c)) for c in needed])
    source_keys = [_s(spec.source_col(k)) for k in spec.on]
    types = dict(target.dtypes)

    def inserted(c: str) -> Column:
        return F.col(_s(spec.source_col(c))) if c in spec.insert else spec.insert_values.get(c, F.lit(None))

    keyed_t, keyed_s, rest = target, s, []
    if not null_safe:
        t_null, s_null = _any_null(spec.on), _any_null(source_keys)
        keyed_t, keyed_s = target.where(~t_null), s.where(~s_null)
        rest = [target.where(t_null),
                s.where(s_null).select(*[inserted(c).cast(types[c]).alias(c) for c in target.columns])]
    t, s = keyed_t.withColumn(_T, F.lit(True)), keyed_s.withColumn(_S, F.lit(True))
    if validate:
        s = s.withColumn(_N, F.count(F.lit(1)).over(W.partitionBy(*source_keys)))
    cond = F.lit(True)
    for k, sk in zip(spec.on, source_keys, strict=True):
        one = t[k].eqNullSafe(s[sk]) if null_safe else t[k] == s[sk]
        cond = one if k == spec.on[0] else cond & one
    j = t.join(s, cond, "full_outer")
    matched = F.col(_T).isNotNull() & F.col(_S).isNotNull()
    target_only = F.col(_S).isNull()
    if validate:  # a filter, so no column pruning drops it
        fails = F.raise_error(F.lit(f"{SEVERAL} {spec.on}")).cast("boolean")
        j = j.where(F.when(matched & (F.col(_N) > 1), fails).otherwise(True))
    out = []
    for c in target.columns:
        on_match = F.col(c)
        if choose is not None and (c in spec.update or c in spec.insert) and c not in spec.on:
            on_match = choose(c, F.col(c), F.col(_s(spec.source_col(c))))
        elif c in spec.update:
            on_match = F.col(_s(spec.source_col(c)))
        out.append(F.when(target_only, F.col(c)).when(matched, on_match)
                   .otherwise(inserted(c)).cast(types[c]).alias(c))
    merged = j.select(*out)
    for rows in rest:
        merged = merged.unionByName(rows)
    return merged


def merge_sql(spec: MergeSpec, target_table: str, source_view: str) -> str:
    """The same merge as a standard ``MERGE INTO`` statement, for sessions
    whose catalog has a row-level table format (Iceberg, Delta): run it
    with ``spark.sql``.  Columns outside ``spec.insert`` get
    ``spec.insert_values`` only in the DataFrame form; here they are left
    to the table default (NULL)."""
    on = " AND ".join(f"t.{k} = s.{spec.source_col(k)}" for k in spec.on)
    sets = ", ".join(f"{c} = s.{spec.source_col(c)}" for c in spec.update)
    cols = ", ".join(spec.insert)
    vals = ", ".join(f"s.{spec.source_col(c)}" for c in spec.insert)
    return (f"MERGE INTO {target_table} t USING {source_view} s ON {on} "
            f"WHEN MATCHED THEN UPDATE SET {sets} "
            f"WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({vals})")


def _any_null(cols) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def append_by_name(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Append with columns matched by name (missing source columns -> NULL)."""
    missing = [c for c in target.columns if c not in rows.columns]
    rows = rows.withColumns({c: F.lit(None) for c in missing}) if missing else rows
    types = dict(target.dtypes)
    return target.unionByName(rows.select(*[F.col(c).cast(types[c]).alias(c) for c in target.columns]))


# ---------------------------------------------------------------------------
# The six merges of the pipeline.  FIXED VALUES: key, update and insert columns.
# ---------------------------------------------------------------------------

_PAYMENT_UPDATE = ("status", "charge_id", "email", "phone", "name", "state", "amount", "is_refunded",
                   "is_dispute", "payment_created_at", "payment_updated_at", "payment_refunded_at",
                   "payment_disputed_at", "created_at")

# Payment rows: the payload is written once, on insert.
PAYMENT_MERGE = MergeSpec(
    on=("payment_intent_id",), update=_PAYMENT_UPDATE,
    insert=("payment_intent_id", *_PAYMENT_UPDATE[:13], "payment_data", "created_at"))

_REFUND_UPDATE = ("dispute_id", "charge_id", "amount_refunded", "is_partially_refunded",
                  "is_fully_refunded", "is_dispute", "dispute_created_at", "payment_refunded_at",
                  "refund_data", "reason", "created_at")
REFUND_MERGE = MergeSpec(on=("payment_intent_id",), update=_REFUND_UPDATE,
                         insert=("payment_intent_id", *_REFUND_UPDATE))

_DISPUTE_UPDATE = ("dispute_id", "charge_id", "dispute_amount", "dispute_created_at",
                   "record_created_at", "dispute_data", "reason", "created_at")
# Keyed by the payment, not by the dispute id.
DISPUTE_MERGE = MergeSpec(on=("payment_intent_id",), update=_DISPUTE_UPDATE,
                          insert=("payment_intent_id", *_DISPUTE_UPDATE))

_PURCHASE_UPDATE = ("q", "amount", "refunded_amount", "is_fully_refunded_short_term", "product",
                    "product_tag", "is_full_fare", "is_renewal", "is_renewal_new", "is_other",
                    "is_addon", "email", "phone_number", "name", "state", "operational_costs",
                    "new_operational_costs", "product_history_id", "product_name", "provider",
                    "provider_id", "payment_processing_fees", "net_amount", "processed_at",
                    "campaign_id", "campaign_name", "is_referral_purchase", "state_name")
# Surrogate ``id`` is never supplied by the job: NULL on insert, kept on update.
PURCHASE_MERGE = MergeSpec(
    on=("external_id", "payment_processor", "created_at", "product_tag"),
    update=_PURCHASE_UPDATE,
    insert=("q", "payment_processor", "external_id", "created_at", *_PURCHASE_UPDATE[1:]))

_NORM_REFUND_ALL = ("q", "payment_processor", "payment_created_at", "created_at", "refund_created_at",
                    "charge_id", "purchase_external_id", "email", "payment_amount", "refund_amount",
                    "is_full_refund", "product_history_id", "product_name", "processed_at")
NORM_REFUND_MERGE = MergeSpec(
    on=("purchase_external_id", "payment_processor", "payment_created_at", "charge_id"),
    update=_NORM_REFUND_ALL, insert=_NORM_REFUND_ALL,
    source_alias={"created_at": "payment_created_at"})

_NORM_DISPUTE_ALL = ("payment_processor", "payment_created_at", "charge_id", "email", "dispute_id",
                     "dispute_created_at", "dispute_response_required_by", "disputed_amount",
                     "dispute_status", "dispute_reason", "processed_at")
NORM_DISPUTE_MERGE = MergeSpec(on=("charge_id", "dispute_id", "payment_processor"),
                               update=_NORM_DISPUTE_ALL, insert=_NORM_DISPUTE_ALL)

WATERMARK_MERGE = MergeSpec(on=("dataset", "job"), update=("kind", "ts"),
                            insert=("dataset", "job", "kind", "ts"))


# ---------------------------------------------------------------------------
# Persistence: bucket-partitioned parquet tables.
# ---------------------------------------------------------------------------

def key_bucket(on: tuple[str, ...], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in on]), F.lit(buckets)).cast("int")


#: Second level of folders, below the bucket: year * 100 + month of the load time.
LOAD_COL = "load_month"


def load_month(ts_col: str) -> Column:
    return F.year(ts_col) * 100 + F.month(ts_col)


def _by_bucket(df: DataFrame, order_by: str | None, by_load: bool = False, placed: bool = False):
    """A writer of one bucket per task (adaptive execution splits a bucket
    that is too big), sorted by ``order_by`` inside, so that row-group
    statistics prune a filter on it.  ``by_load`` adds the level of load
    months, by which a watermark prunes whole folders.  Rows that are
    ``placed`` lie by bucket already and are not moved."""
    levels = [BUCKET_COL]
    if by_load:
        df, levels = df.withColumn(LOAD_COL, load_month(order_by)), [BUCKET_COL, LOAD_COL]
    order = levels + ([order_by] if order_by and order_by in df.columns else [])
    df = df if placed else df.hint("rebalance", BUCKET_COL)
    return df.sortWithinPartitions(*order).write.mode("overwrite").option("compression", CODEC).partitionBy(*levels)


def _in_bucket(df: DataFrame, keys: tuple[str, ...], buckets: int, tasks: int) -> DataFrame:
    """Rows dealt to tasks by the bucket of their key, which is their column ``BUCKET_COL``."""
    return df.withColumn(BUCKET_COL, key_bucket(keys, buckets)).repartition(tasks, BUCKET_COL)


@contextmanager
def _met_by_bucket(spark: SparkSession):
    """A join on the bucket and the key meets rows that lie by the bucket alone."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def write_table(df: DataFrame, path: str, on: tuple[str, ...], buckets: int,
                order_by: str | None = "created_at", by_load: bool = False) -> None:
    """Write a table partitioned by the hash bucket of its key (``by_load``:
    and below it by the month of ``order_by``)."""
    _by_bucket(df.withColumn(BUCKET_COL, key_bucket(on, buckets)), order_by, by_load).parquet(path)


def load_table(spark: SparkSession, df: DataFrame, path: str, on: tuple[str, ...], buckets: int,
               order_by: str | None = "created_at", token: str | None = None, by_load: bool = False) -> int:
    """``write_table`` through a stage and a redo record: a load that is cut
    short leaves no table, or one that the next run completes, never a part
    that passes for the whole.  Returns the number of rows."""
    seen = Observation("load")
    stage = stage_path(path)
    bucket = key_bucket(on, buckets)
    _by_bucket(df.withColumn(BUCKET_COL, bucket).observe(seen, F.collect_set(BUCKET_COL).alias("buckets")), order_by, by_load).parquet(stage)
    touched = sorted(seen.get.get("buckets") or [])
    rows = spark.read.parquet(stage).count() if touched else 0
    commit(spark, path, stage, touched, rows, token)
    return rows


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merge_into_table(spark: SparkSession, path: str, source: DataFrame, spec: MergeSpec,
                     buckets: int, validate: bool = True, like: DataFrame | None = None,
                     order_by: str | None = "created_at", token: str | None = None,
                     choose: Callable[[str, Column, Column], Column] | None = None, by_load: bool = False) -> int:
    """Apply ``merge_upsert`` to a bucket-partitioned parquet table in place;
    returns the number of source rows.

    An earlier merge that was cut short is finished first.  The source is
    written once to the shared folder, its keys in the table's types; the same
    job counts its rows and observes which buckets it touches (at most
    ``buckets`` small integers), which prune the target scan.  The merged
    buckets are staged beside the table and swapped in whole under a redo
    record, so the table is never read and overwritten by the same job and a
    crash loses nothing.  A staged bucket outside the touched ones would
    replace rows that were not read: that raises and leaves the table as it is.

    ``token`` names the source: if the newest finished merge has the same one,
    the source has been merged before and nothing is done.  A table with the
    level of load months keeps it (``by_load`` starts it): a bucket's folder is
    replaced with all its months, so rows that move to another month leave
    nothing behind.
    """
    last = recover(spark, path)
    if token is not None and last is not None and last["token"] == token:
        return last["rows"]
    if like is not None:
        # Table schema given explicitly: a new, still empty table has no
        # files to infer it from.
        target = spark.read.schema(like.withColumn(BUCKET_COL, F.lit(0).cast("int")).schema).parquet(path)
        by_load = by_load or LOAD_COL in partition_columns(spark, path)
    else:
        target = read_table(spark, path)
        by_load = by_load or LOAD_COL in target.columns
    types = dict(target.dtypes)
    # One cast per source column, to the type of the key it feeds.
    casts = {spec.source_col(k): F.col(spec.source_col(k)).cast(types[k]) for k in spec.on}
    key = key_bucket(tuple(spec.source_col(k) for k in spec.on), buckets)
    seen = Observation("merge-source")
    # Observed in the writing stage itself: each task's figures count once.
    source = materialize(source.withColumns(casts).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.collect_set(key).alias("buckets")), "merge-source")
    rows, touched = seen.get.get("rows") or 0, sorted(seen.get.get("buckets") or [])
    if not touched:
        return 0
    target = target.where(F.col(BUCKET_COL).isin(touched)).drop(BUCKET_COL, LOAD_COL)
    # Both sides are moved once, by the bucket: there they are joined and written.
    tasks = max(len(touched), int(spark.conf.get("spark.sql.shuffle.partitions")))
    target = _in_bucket(target, spec.on, buckets, tasks)
    source = _in_bucket(source, tuple(spec.source_col(k) for k in spec.on), buckets, tasks)
    spec = replace(spec, on=(BUCKET_COL, *spec.on), insert=(*spec.insert, BUCKET_COL))
    merged = merge_upsert(target, source, spec, validate=validate, choose=choose)
    stage, written = stage_path(path), Observation("merge-stage")
    merged = merged.observe(written, F.collect_set(BUCKET_COL).alias("buckets"))
    try:
        with _met_by_bucket(spark):
            _by_bucket(merged, order_by, by_load, placed=True).parquet(stage)
    except PySparkException as e:
        if SEVERAL in str(e):
            raise ValueError(f"{SEVERAL} {spec.on[1:]}") from e
        raise
    strays = set(written.get["buckets"]) - set(touched)
    if strays:
        raise ValueError(f"merge staged buckets {sorted(strays)} that the source does not touch")
    commit(spark, path, stage, touched, rows, token)
    return rows
