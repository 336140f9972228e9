"""Normalised refunds: refunds + their payment + product versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import extract_payment_fields, is_full_refund, parse_payload, strip_outer_quote
from ledgerline.functions.coerce import load_time
from ledgerline.operators.joins import join_asof, join_refund_payment
from ledgerline.plans.purchases import HOT_KEY_ROWS, VERSION_BROADCAST_MAX_ROWS, VERSION_BUCKET_SECONDS


def exclude_accounts(email: Column | str, patterns: Sequence[str]) -> Column:
    """True for addresses matching none of the (case-insensitive LIKE)
    patterns.  A NULL address is *not* kept (NULL predicate)."""
    e = F.col(email) if isinstance(email, str) else email
    keep = F.lit(True)
    for p in patterns:
        keep = keep & ~e.ilike(p)
    return keep


def enrich_refunds(refunds: DataFrame, payments: DataFrame) -> DataFrame:
    """Refunds with their payment (time, e-mail, amount) and the product
    tag of the payment's payload."""
    j = join_refund_payment(refunds, payments)
    parsed = parse_payload(strip_outer_quote("payment_data"), "payment")
    return j.withColumn("productTag", extract_payment_fields(parsed)["productTag"]).drop("payment_data")


def normalize_refunds(refunds: DataFrame, payments: DataFrame, versions: DataFrame,
                      exclude_patterns: Sequence[str], run_ts: str | None = None,
                      threshold: float = K.FULL_REFUND_THRESHOLD,
                      processor: str = K.PAYMENT_PROCESSOR) -> DataFrame:
    """Refund rows ready to merge into the normalised refund table."""
    r = enrich_refunds(refunds, payments)
    r = r.where(F.col("payment_refunded_at").isNotNull() & exclude_accounts("email", exclude_patterns))
    r = join_asof(r, versions, left_key="productTag", right_key="tag", left_time="payment_created_at",
                  right_time="starting_at", tiebreak=["id"],
                  columns={"id": "product_history_id", "name": "product_name"},
                  bucket_seconds=VERSION_BUCKET_SECONDS,
                      broadcast_max_rows=VERSION_BROADCAST_MAX_ROWS, hot_key_rows=HOT_KEY_ROWS)
    return r.select(
        F.lit(1).alias("q"),
        F.lit(processor).alias("payment_processor"),
        "payment_created_at",
        F.col("payment_created_at").alias("created_at"),
        F.col("payment_refunded_at").alias("refund_created_at"),
        "charge_id",
        F.col("payment_intent_id").alias("purchase_external_id"),
        "email", "payment_amount",
        F.col("amount_refunded").alias("refund_amount"),
        is_full_refund("amount_refunded", threshold).alias("is_full_refund"),
        "product_history_id", "product_name",
        load_time(run_ts).alias("processed_at"),
    )
