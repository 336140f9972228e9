"""Normalised disputes: disputes + their payment (by charge)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import dispute_fields, parse_payload, strip_outer_quote
from ledgerline.functions.coerce import load_time
from ledgerline.operators.joins import join_dispute_payment
from ledgerline.schemas import DISPUTE_USED_DDL


def enrich_disputes(disputes: DataFrame, payments: DataFrame) -> DataFrame:
    j = join_dispute_payment(disputes, payments)
    parsed = parse_payload(strip_outer_quote("dispute_data"), ddl=DISPUTE_USED_DDL)
    return j.withColumn("dispute_data", parsed).withColumns(dispute_fields("dispute_data"))


def normalize_disputes(disputes: DataFrame, payments: DataFrame, run_ts: str | None = None,
                       processor: str = K.PAYMENT_PROCESSOR) -> DataFrame:
    """Dispute rows ready to merge into the normalised dispute table."""
    d = enrich_disputes(disputes, payments)
    return d.select(
        F.lit(processor).alias("payment_processor"),
        "payment_created_at", "charge_id", "email", "dispute_id", "dispute_created_at",
        "dispute_response_required_by",
        F.col("dispute_amount").alias("disputed_amount"),
        "dispute_status",
        F.col("reason").alias("dispute_reason"),
        load_time(run_ts).alias("processed_at"),
    )
