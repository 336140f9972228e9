"""Change-data-capture batches: routing, per-batch apply, multi-batch fold and
apply in any order."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.dedup import latest_per_key
from ledgerline.operators.merge import MergeSpec, append_by_name, merge_upsert

OP = "Op"
#: What of a row has been applied: the place in the log of the row that gave its updated
#: columns, and of the one that created it (NULL where the row was there before the log).
APPLIED = "_applied"
APPLIED_TYPE = ("struct<last:struct<file_time:timestamp_ntz,op:int,at:timestamp_ntz>,"
                "first:struct<file_time:timestamp_ntz,op:int,to_end:bigint>>")


def cdc_split(batch: DataFrame, op_col: str = OP) -> tuple[DataFrame, DataFrame]:
    """(inserts, updates) of a CDC batch, ``Op`` dropped.  Other operations
    (deletes) are ignored, as in the pipeline."""
    inserts = batch.where(F.col(op_col) == "I").drop(op_col)
    updates = batch.where(F.col(op_col) == "U").drop(op_col)
    return inserts, updates


def apply_delta(target: DataFrame, batch: DataFrame, spec: MergeSpec, ts: str,
                validate: bool = True) -> DataFrame:
    """Target after one CDC batch: inserts are appended first, then the
    latest update per key (ties kept) is merged.  An insert and an update of
    one key in one batch therefore end as the update's values with the
    insert's insert-only columns.  Different rows that tie at the latest
    time of a key raise, as in standard MERGE (``validate=False`` skips the
    check: each of them is then a row of the result)."""
    inserts, updates = cdc_split(batch)
    key = list(spec.on)
    appended = append_by_name(target, inserts.select(*[c for c in inserts.columns if c in target.columns]))
    latest = latest_per_key(updates.select(*[c for c in updates.columns if c in target.columns]), key, ts)
    return merge_upsert(appended, latest, spec, validate=validate)


def cdc_fold(target: DataFrame, log: DataFrame, spec: MergeSpec, ts: str,
             file_col: str = "file_time") -> DataFrame:
    """Target after applying every batch of ``log`` in ``file_col`` order;
    see :func:`fold_log` for the per-key rule."""
    # The fold has one row per key by construction.
    return merge_upsert(target, fold_log(log, spec, ts, [c for c in target.columns], file_col), spec, validate=False)


def fold_log(log: DataFrame, spec: MergeSpec, ts: str, columns: list[str],
             file_col: str = "file_time") -> DataFrame:
    """One source row per key that, merged into the target, gives the
    target after applying every batch of ``log`` in ``file_col`` order:
    one pass instead of one job per file.

    Per key, with sequence (file time, insert before update, update time):
    columns in ``spec.update`` come from the last row of the sequence (a
    later file wins even with an older update time); insert-only columns
    come from the row that created the key (the insert, or else the latest
    update of the first file), unless the key already exists in the target.
    Updates with a NULL update time are skipped, as the per-batch path does.

    Valid when a key has at most one insert, no update before it, and no
    row in the target when the insert arrives; ties of update time within
    one file are resolved by the remaining columns.  Everything is one
    partially aggregated ``groupBy`` (skew-proof) plus the merge join.
    """
    key = list(spec.on)
    cols = [c for c in columns if c in log.columns and c not in key]
    rows, keyless_inserts, last_seq, first_seq = _places(log, spec, ts, cols, file_col)
    payload = F.struct(*[F.col(c) for c in cols])
    folded = rows.groupBy(*key).agg(
        F.max(F.struct(last_seq.alias("seq"), payload.alias("row"))).alias("__last"),
        F.min(F.struct(first_seq.alias("seq"), payload.alias("row"))).alias("__first"),
    )
    insert_only = _insert_only(spec)
    return folded.select(
        *key,
        *[F.col(f"__last.row.{c}").alias(c) for c in cols if c not in insert_only],
        *[F.col(f"__first.row.{c}").alias(c) for c in cols if c in insert_only],
    ).unionByName(keyless_inserts.select(*key, *cols))


def _insert_only(spec: MergeSpec) -> list[str]:
    return [c for c in spec.insert if c not in spec.update and c not in spec.on]


def _places(log: DataFrame, spec: MergeSpec, ts: str, cols: list[str], file_col: str):
    """(rows with a key, inserts without one, a row's place as the last of its
    key, its place as the first)."""
    rows = log.where((F.col(OP) == "I") | ((F.col(OP) == "U") & F.col(ts).isNotNull()))
    # Rows without a complete key never match: every such insert is
    # appended as it is and such updates are dropped, as per batch.
    has_key = F.lit(True)
    for k in spec.on:
        has_key = has_key & F.col(k).isNotNull()
    keyless_inserts = rows.where(~has_key & (F.col(OP) == "I"))
    op_rank = F.when(F.col(OP) == "I", 0).otherwise(1)
    last_seq = F.struct(F.col(file_col).alias("file_time"), op_rank.alias("op"), F.col(ts).alias("at"))
    # Within the first file the latest update creates the key: order update
    # time descending via its distance to a far-future instant.
    to_end = F.timestamp_diff("MICROSECOND", F.col(ts), F.lit("9999-12-31 00:00:00").cast("timestamp_ntz"))
    first_seq = F.struct(F.col(file_col).alias("file_time"), op_rank.alias("op"), to_end.alias("to_end"))
    return rows.where(has_key), keyless_inserts, last_seq, first_seq


def fold_in_any_order(log: DataFrame, spec: MergeSpec, ts: str, columns: list[str],
                      file_col: str = "file_time") -> DataFrame:
    """:func:`fold_log` with the places of its rows in the log kept in the
    column ``_applied``, for :func:`any_order_merge`."""
    key = list(spec.on)
    cols = [c for c in columns if c in log.columns and c not in key]
    rows, keyless_inserts, last_seq, first_seq = _places(log, spec, ts, cols, file_col)
    created = [c for c in cols if c in _insert_only(spec)]
    updated = [c for c in cols if c in spec.update]
    folded = rows.groupBy(*key).agg(
        F.max(F.struct(last_seq.alias("seq"), *updated)).alias("__last"),
        F.min(F.struct(first_seq.alias("seq"), *created)).alias("__first"),
    )
    places = F.struct(F.col("__last.seq").alias("last"), F.col("__first.seq").alias("first")).cast(APPLIED_TYPE)
    out = folded.select(*key, *[F.col(f"__last.{c}").alias(c) for c in updated],
                        *[F.col(f"__first.{c}").alias(c) for c in created], places.alias(APPLIED))
    alone = F.struct(last_seq.alias("last"), first_seq.alias("first")).cast(APPLIED_TYPE)
    return out.unionByName(keyless_inserts.select(*key, *updated, *created, alone.alias(APPLIED)))


def any_order_merge(spec: MergeSpec, columns: list[str], stamped: str | None = None) -> tuple[MergeSpec, Callable[[str, Column, Column], Column]]:
    """(spec, choose) for ``merge_upsert``, so that folds of batches may be
    merged in any order and more than once.

    A matched row takes the source's updated columns only if the source's last
    row lies later in the log than the one applied (equal places: the larger
    values), and its insert-only columns only if the source's first row lies
    earlier than the one that created the row.  Rows that were there before
    the log keep their insert-only columns.  Taking the larger place is
    commutative, associative and idempotent, so every order of the batches,
    late and repeated ones included, ends in the result of the ordered run.
    ``stamped`` names a load-time column that the run itself stamps: it also
    moves on when only insert-only columns change.
    """
    from ledgerline.operators.merge import source_name as s

    # In the order of the fold, which its comparison of equal places goes by.
    created = [c for c in columns if c in _insert_only(spec)]
    updated = [c for c in columns if c in spec.update and c not in spec.on]
    mine, theirs = F.col(APPLIED), F.col(s(APPLIED))
    newer = mine.isNull() | (F.struct(theirs["last"], *[F.col(s(c)) for c in updated]) > F.struct(mine["last"], *[F.col(c) for c in updated]))
    older = mine["first"].isNotNull() & (F.struct(theirs["first"], *[F.col(s(c)) for c in created]) < F.struct(mine["first"], *[F.col(c) for c in created]))

    def choose(c: str, target: Column, source: Column) -> Column:
        if c == APPLIED:
            return F.struct(F.when(newer, source["last"]).otherwise(target["last"]).alias("last"),
                            F.when(older, source["first"]).otherwise(target["first"]).alias("first"))
        if c in created:
            return F.when(older, source).otherwise(target)
        if c == stamped:
            return F.when(newer | older, F.greatest(source, target)).otherwise(target)
        return F.when(newer, source).otherwise(target)

    return replace(spec, update=(*spec.update, APPLIED), insert=(*spec.insert, APPLIED)), choose
