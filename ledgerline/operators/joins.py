"""Joins of the payment pipeline.

Plain equi joins (payment/refund, refund/payment, dispute/payment) are left
to Catalyst/AQE.  The two time-conditioned joins have a *definition* form
(equi join + range condition, every matching pair) and a *linear* form used
by the pipelines:

* ``join_asof``: latest right row at or before the left row's time.
* ``join_next``: first right row strictly after the left row's time, ranked
  by a caller-given order (e.g. whole-second distance, then event id).

The linear forms never emit all pairs of a key.  Both sides are tagged and
unioned, then one window per (key, time bucket) carries a running max/min of
the right rows' struct past each left row (an incremental frame, O(n) per
partition).  Buckets split a hot key into bounded partitions; the best
right row from *other* buckets comes from a small per-(key, bucket) summary
with a prefix/suffix window, joined back on (key, bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_payment_refund(payments: DataFrame, refunds: DataFrame) -> DataFrame:
    """Payments with the refunded amount and refund time of their refund row
    (if any), on ``payment_intent_id``."""
    r = refunds.select("payment_intent_id", "amount_refunded",
                       F.col("payment_refunded_at").alias("refunded_at"))
    return payments.join(r, "payment_intent_id", "left")


def join_refund_payment(refunds: DataFrame, payments: DataFrame) -> DataFrame:
    """Refunds with payment time, e-mail, amount and payload of their payment."""
    p = payments.select("payment_intent_id", "payment_created_at", "email",
                        F.col("amount").alias("payment_amount"), "payment_data")
    return refunds.join(p, "payment_intent_id", "left")


def join_dispute_payment(disputes: DataFrame, payments: DataFrame) -> DataFrame:
    """Disputes with payment time and e-mail, matched on ``charge_id``."""
    p = payments.select("charge_id", "payment_created_at", "email")
    return disputes.join(p, "charge_id", "left")


#: Keys of an increment that are broadcast as they are; beyond that, as a Bloom filter.
MAX_KEYS = 1_000_000
#: Words of 64 bits of a Bloom filter (proven bound of what is broadcast), keys per word while there
#: are few enough, keys per word from which on a filter lets too much through, and bits per key.
BLOOM_WORDS, KEYS_PER_WORD, CROWDED, BLOOM_BITS = 2_000_000, 2, 16, 6


def restrict_to(rows: DataFrame, increment: DataFrame, key: str, increment_key: str | None = None,
                most: int = MAX_KEYS, words: int = BLOOM_WORDS) -> DataFrame:
    """``rows`` whose key occurs in an increment, found without moving
    ``rows``.

    Up to ``most`` different keys are broadcast, after their number has been
    checked.  Beyond that a Bloom filter of at most ``words`` words is: some
    rows without a match pass (about 1 in 5,000 with two keys to a word, 1 in
    20 with eight), which the join that follows drops.  An increment with over
    ``CROWDED`` keys per word leaves ``rows`` as they are.
    """
    keys = increment.select(F.col(increment_key or key).alias(key)).where(F.col(key).isNotNull()).distinct()
    n = keys.limit(most + 1).count()
    if n <= most:
        return rows.join(F.broadcast(keys), key, "left_semi")
    n = keys.count()
    if n > words * CROWDED:
        return rows
    size = min(-(-n // KEYS_PER_WORD), words)
    kind = rows.schema[key].dataType
    found = bloom_words(keys.select(F.col(key).cast(kind).alias(key)), key, size)
    word, mask = _bloom_place(F.col(key), size)
    return (rows.withColumn("__word", word).join(F.broadcast(found), (F.col("__word") == F.col("__at")) & (F.col("__bits").bitwiseAND(mask) == mask), "left_semi")
            .drop("__word"))


def _bloom_place(key: Column, size: int) -> tuple[Column, Column]:
    """A key's word, and its bits in it."""
    h = F.xxhash64(key, F.lit(1))
    mask = F.lit(0).cast("bigint")
    for k in range(BLOOM_BITS):
        mask = mask.bitwiseOR(_bit(h, 6 * k))
    return F.pmod(F.xxhash64(key), F.lit(size)), mask


def _bit(h: Column, at: int) -> Column:
    """One of 64 bits, by six bits of the hash."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, at).bitwiseAND(F.lit(63)).cast("int"))


def bloom_words(keys: DataFrame, key: str, size: int) -> DataFrame:
    """(__at, __bits): the words of a Bloom filter of ``size`` words whose keys
    set all their bits in one word (one partially aggregated ``groupBy``)."""
    word, mask = _bloom_place(F.col(key), size)
    return keys.select(word.alias("__at"), mask.alias("__bits")).groupBy("__at").agg(F.bit_or("__bits").alias("__bits"))


def _epoch_bucket(t: Column, seconds: int | None) -> Column:
    if not seconds:
        return F.lit(0).cast("bigint")
    return F.floor(F.unix_timestamp(t) / F.lit(seconds)).cast("bigint")


# At most this many heavy keys are broadcast as a list (proven bound: a
# key is heavy only with more than ``hot_key_rows`` rows).
MAX_HOT_KEYS = 100_000
# Partitions over which rows with a NULL join key are spread.
NULL_KEY_SPREAD = 4096


def _nearest(left: DataFrame, right: DataFrame, *, left_key: str, right_key: str,
             left_time: str, right_time: str, pick: list[Column], payload: dict[str, Column],
             forward: bool, strict: bool, bucket_seconds: int | None,
             hot_key_rows: int | None = None) -> DataFrame:
    """Shared engine of ``join_asof`` / ``join_next``; see module doc.

    Backward (as-of): best = max of ``pick`` over rights with
    ``t_r <= t_l`` (``<`` if strict).  Forward: best = min of ``pick`` over
    rights with ``t_r > t_l`` (``>=`` if not strict).

    With ``hot_key_rows``, only keys holding more rows than that (found by a
    partially aggregated count; their number is bounded by rows /
    threshold and checked before the list is broadcast) are split into
    ``bucket_seconds`` time buckets; every other key stays one partition and
    skips the cross-bucket summary.  Without it every key is bucketed.
    """
    lcols = left.columns
    rstruct = F.struct(F.struct(*pick).alias("k"), F.struct(*[c.alias(n) for n, c in payload.items()]).alias("v"))
    # Left key and time travel once, beside the other columns, where the union leaves their types alone.
    sides = ((left_key, right_key, "__k"), (left_time, right_time, "__t"))
    beside = {lc: u for lc, rc, u in sides if left.schema[lc].dataType == right.schema[rc].dataType}
    lstruct = F.struct(F.lit(True).alias("__row"), *[F.col(c) for c in lcols if c not in beside])
    null_r = F.lit(None).cast(right.select(rstruct.alias("r")).schema["r"].dataType)
    null_l = F.lit(None).cast(left.select(lstruct.alias("l")).schema["l"].dataType)
    # Rights at the bound's own time are included unless strict: included
    # rights sort before the left row at equal time in the walk order.
    r_side, l_side = (0, 1) if not strict else (1, 0)
    L = left.select(F.col(left_key).alias("__k"), F.col(left_time).alias("__t"), F.lit(l_side).alias("__side"),
                    lstruct.alias("__l"), null_r.alias("__r"))
    R = right.where(F.col(right_key).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(right_key).alias("__k"), F.col(right_time).alias("__t"), F.lit(r_side).alias("__side"),
        null_l.alias("__l"), rstruct.alias("__r"))
    u = L.unionByName(R)
    hot = None
    if bucket_seconds and hot_key_rows:
        heavy = u.groupBy("__k").count().where(F.col("count") > hot_key_rows).select(
            "__k", F.lit(True).alias("__hot"))
        n_heavy = heavy.limit(MAX_HOT_KEYS + 1).count()
        if n_heavy == 0:
            bucket_seconds = None  # no hot key: one partition per key, no summary
        elif n_heavy <= MAX_HOT_KEYS:
            u = u.join(F.broadcast(heavy), "__k", "left")
            hot = F.coalesce(F.col("__hot"), F.lit(False))
    if hot is not None:
        u = (u.withColumn("__hotrow", hot)
             .withColumn("__b", F.when(F.col("__hotrow"), _epoch_bucket(F.col("__t"), bucket_seconds))
                         .otherwise(F.lit(0).cast("bigint"))).drop("__hot"))
    else:
        u = u.withColumn("__b", _epoch_bucket(F.col("__t"), bucket_seconds))
    # Left rows without a key have no partner; a deterministic row hash
    # spreads them (a NULL key could hold a third of all rows).
    u = u.withColumn("__b", F.when(F.col("__k").isNull(),
                                   F.lit(-1) - F.pmod(F.xxhash64("__l", "__t"), F.lit(NULL_KEY_SPREAD)))
                     .otherwise(F.col("__b")))
    # Walk forwards in time for as-of, backwards for "next".
    t_order = F.col("__t").desc_nulls_last() if forward else F.col("__t").asc_nulls_first()
    order = [t_order, F.col("__side").asc()]
    agg = F.min if forward else F.max
    w = Window.partitionBy("__k", "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    windowed = u.withColumn("__best", agg("__r").over(w))
    within = windowed.where(F.col("__l").isNotNull())
    if bucket_seconds:
        # Best right row of the other buckets: per (key, bucket) summary of
        # rights and left buckets, then a prefix (as-of) or suffix (forward)
        # running extreme over buckets, excluding the own bucket.  The
        # summary is aggregated from the windowed rows, which are already
        # partitioned by (key, bucket): the input shuffle is reused, not redone.
        summary_in = windowed.where(F.col("__hotrow")) if hot is not None else windowed
        summary = summary_in.groupBy("__k", "__b").agg(agg("__r").alias("__r"))
        bo = F.col("__b").desc() if forward else F.col("__b").asc()
        ws = Window.partitionBy("__k").orderBy(bo).rowsBetween(Window.unboundedPreceding, -1)
        carry = summary.select("__k", "__b", agg("__r").over(ws).alias("__carry"))
        within = within.join(carry, ["__k", "__b"], "left")
        pick_best = F.least if forward else F.greatest
        best = pick_best(F.col("__best"), F.col("__carry"))
    else:
        best = F.col("__best")
    # A left row without a time has no partner.
    best = F.when(F.col("__t").isNotNull(), best)
    rows = [F.col(beside[c]).alias(c) if c in beside else F.col("__l").getField(c).alias(c) for c in lcols]
    return within.select(*rows, *[best.getField("v").getField(n).alias(n) for n in payload])


def version_intervals(right: DataFrame, right_key: str, right_time: str, tiebreak: list[str],
                      payload: dict[str, Column], bucket_seconds: int) -> tuple[DataFrame, DataFrame]:
    """Validity intervals of a versioned dimension.

    Version i of a key is valid on ``[start_i, start_(i+1))`` in the order
    (time, tiebreak...): of versions starting at the same time only the last
    gets a non-empty interval, i.e. the as-of winner.  Returns the closed
    intervals exploded over the time buckets they touch (key, bucket) and
    the open last interval of every key (one row per key).
    """
    v = right.where(F.col(right_key).isNotNull() & F.col(right_time).isNotNull())
    w = Window.partitionBy(right_key).orderBy(F.col(right_time), *[F.col(c) for c in tiebreak])
    iv = v.select(F.col(right_key).alias("__k"), F.col(right_time).alias("__start"),
                  F.lead(right_time).over(w).alias("__end"),
                  F.struct(*[c.alias(n) for n, c in payload.items()]).alias("__v"))
    closed = (iv.where(F.col("__end").isNotNull() & (F.col("__end") > F.col("__start")))
              .withColumn("__b", F.explode(F.sequence(_epoch_bucket(F.col("__start"), bucket_seconds),
                                                      _epoch_bucket(F.col("__end"), bucket_seconds)))))
    open_ = iv.where(F.col("__end").isNull()).select(
        F.col("__k").alias("__ko"), F.col("__start").alias("__starto"), F.col("__v").alias("__vo"))
    return closed, open_


def join_asof(left: DataFrame, right: DataFrame, *, left_key: str, right_key: str,
              left_time: str, right_time: str, tiebreak: list[str], columns: dict[str, str],
              bucket_seconds: int | None = None, broadcast_max_rows: int = 0,
              hot_key_rows: int | None = None) -> DataFrame:
    """Left rows with ``columns`` of the latest right row of the same key
    whose time is at or before the left time (ties on time -> largest
    ``tiebreak``); NULL when none.

    When ``broadcast_max_rows`` is set and the right side's bucketed
    validity intervals number at most that many rows (checked with a
    bounded count on the right side only), the join is two broadcast hash
    joins: the left side is not shuffled at all and every left row meets
    only the intervals of its (key, bucket), one of which matches.
    Otherwise the windowed form below is used.
    """
    payload = {alias: F.col(c) for c, alias in columns.items()}
    if broadcast_max_rows and bucket_seconds:
        closed, open_ = version_intervals(right, right_key, right_time, tiebreak, payload, bucket_seconds)
        rows = closed.select(F.lit(1).alias("n")).unionByName(open_.select(F.lit(1).alias("n")))
        if rows.limit(broadcast_max_rows + 1).count() <= broadcast_max_rows:
            t = F.col(left_time)
            j = left.join(F.broadcast(closed), (F.col(left_key) == F.col("__k"))
                          & (_epoch_bucket(t, bucket_seconds) == F.col("__b"))
                          & (F.col("__start") <= t) & (t < F.col("__end")), "left")
            j = j.join(F.broadcast(open_), (F.col(left_key) == F.col("__ko")) & (F.col("__starto") <= t), "left")
            best = F.coalesce(F.col("__v"), F.col("__vo"))
            return j.select(*[F.col(c) for c in left.columns],
                            *[best.getField(n).alias(n) for n in payload])
    pick = [F.col(right_time)] + [F.col(c) for c in tiebreak]
    return _nearest(left, right, left_key=left_key, right_key=right_key, left_time=left_time,
                    right_time=right_time, pick=pick, payload=payload, forward=False, strict=False,
                    bucket_seconds=bucket_seconds, hot_key_rows=hot_key_rows)


def join_next(left: DataFrame, right: DataFrame, *, left_key: str, right_key: str,
              left_time: str, right_time: str, rank: list[Column], columns: dict[str, str],
              bucket_seconds: int | None = None, hot_key_rows: int | None = None) -> DataFrame:
    """Left rows with ``columns`` of the first right row of the same key
    strictly after the left time, where "first" is the smallest ``rank``
    (a list of right-side columns); NULL when none."""
    payload = {alias: F.col(c) for c, alias in columns.items()}
    return _nearest(left, right, left_key=left_key, right_key=right_key, left_time=left_time,
                    right_time=right_time, pick=rank, payload=payload, forward=True, strict=True,
                    bucket_seconds=bucket_seconds, hot_key_rows=hot_key_rows)
