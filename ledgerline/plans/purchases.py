"""Normalised purchases: payments + refunds + product versions + referral
events -> one purchase row per payment (the MERGE source of the purchase
table)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import (extract_payment_fields, is_fully_refunded_short_term,
                                  operational_costs, parse_payload, processing_fee,
                                  purchase_flags, register_sql_functions, state_name, strip_outer_quote)
from ledgerline.functions.coerce import load_time
from ledgerline.operators.joins import join_asof, join_next, join_payment_refund
from ledgerline.schemas import PAYMENT_USED_DDL
from ledgerline.session import materialize

# Time buckets of the version intervals (broadcast path) and of heavy
# product tags (windowed path).
VERSION_BUCKET_SECONDS = 90 * 86400
# Keys (e-mails) with more rows than HOT_KEY_ROWS are split into hourly
# buckets; all other keys are one partition each.
EVENT_BUCKET_SECONDS = 3600
HOT_KEY_ROWS = 1_000_000
# Product versions are broadcast (as bucketed validity intervals) up to
# this many interval rows; a larger dimension takes the windowed path.
VERSION_BROADCAST_MAX_ROWS = 1_000_000


def product_history_view(versions: DataFrame) -> DataFrame:
    """Product versions with their purchase-channel and renewal flags."""
    return versions.withColumns({
        "is_in_app_purchase": F.col("purchase_location") == "In-App",
        "is_renewal": F.col("type") == "Renewal",
        "is_website_purchase": F.col("purchase_location") == "Website",
    })


def prepare_payments(payments: DataFrame) -> DataFrame:
    """Strip the outer quotes of the payload, parse it and pull the product
    tag, provider name and provider id (``''`` when missing)."""
    parsed = parse_payload(strip_outer_quote("payment_data"), ddl=PAYMENT_USED_DDL)
    fields = extract_payment_fields(parsed)
    return payments.withColumns(fields).drop("payment_data")


def payments_with_versions(payments: DataFrame, refunds: DataFrame, versions: DataFrame) -> DataFrame:
    """Payments with their refund and the latest product version at or before
    the payment (one row per payment)."""
    j = join_payment_refund(prepare_payments(payments), refunds) \
        .withColumnRenamed("amount_refunded", "refunded_amount")
    vcols = {"operational_costs": "new_operational_costs", "id": "product_history_id",
             "name": "product_name", "category": "product_category"}
    return join_asof(j, versions, left_key="productTag", right_key="tag",
                     left_time="payment_created_at", right_time="starting_at", tiebreak=["id"],
                     columns=vcols, bucket_seconds=VERSION_BUCKET_SECONDS,
                     broadcast_max_rows=VERSION_BROADCAST_MAX_ROWS, hot_key_rows=HOT_KEY_ROWS)


def purchase_base(payments: DataFrame, refunds: DataFrame, versions: DataFrame) -> DataFrame:
    """Payment facts with refund, flags, fee and product version."""
    j = payments_with_versions(payments, refunds, versions)
    flags = purchase_flags("productTag", "product_category")
    return j.select(
        F.col("payment_intent_id").alias("external_id"),
        F.col("payment_created_at").alias("created_at"),
        "amount", "refunded_amount",
        is_fully_refunded_short_term("amount", "refunded_amount", "payment_created_at",
                                     "refunded_at").alias("is_fully_refunded_short_term"),
        F.col("productTag").alias("product"),
        F.col("productTag").alias("product_tag"),
        *[c.alias(n) for n, c in flags.items()],
        "email", "phone", "name", "state",
        "new_operational_costs", "product_history_id", "product_name", "provider", "provider_id",
        processing_fee("amount").alias("payment_processing_fees"),
    )


def attribute_referrals(base: DataFrame, events: DataFrame,
                        qualifying_type: str = K.QUALIFYING_EVENT_TYPE) -> DataFrame:
    """Campaign attribution from the nearest following referral event of the
    buyer (any type, ranked by whole-second distance, then event id); only a
    qualifying nearest event on a full-fare purchase counts.

    Only id, e-mail and time of the purchases travel to their buyer's events,
    and only qualifying events travel back to the id: the purchases themselves
    are not moved by e-mail, and not at all where they lie by id already.
    """
    found = qualifying_events(base, events, qualifying_type)
    on_id = (F.col("external_id") == F.col("__id")) & _equal("email", "__email") & _equal("created_at", "__time")
    on_buyer = (F.col("email") == F.col("__email")) & (F.col("created_at") == F.col("__time"))
    j = (base.where(F.col("external_id").isNotNull()).join(found.where(F.col("__id").isNotNull()), on_id, "left")
         .unionByName(base.where(F.col("external_id").isNull()).join(found.where(F.col("__id").isNull()), on_buyer, "left")))
    hit = F.coalesce(F.col("is_full_fare") & F.col("__time").isNotNull(), F.lit(False))
    return j.select(*base.columns,
                    F.when(hit, F.col("__campaign_id")).otherwise(F.lit("")).alias("campaign_id"),
                    F.when(hit, F.col("__campaign_name")).otherwise(F.lit("")).alias("campaign_name"),
                    hit.alias("is_referral_purchase"))


def qualifying_events(base: DataFrame, events: DataFrame, qualifying_type: str) -> DataFrame:
    """(__id, __email, __time, __campaign_id, __campaign_name), one row per
    purchase id, e-mail and time whose nearest following event is of the
    qualifying type; written once."""
    buyers = (base.where(F.col("email").isNotNull() & F.col("created_at").isNotNull())
              .select(F.col("external_id").alias("__id"), F.col("email").alias("__email"), F.col("created_at").alias("__time")).distinct())
    nearest = join_next(buyers, events, left_key="__email", right_key="user_email", left_time="__time",
                        right_time="event_date", rank=[F.unix_timestamp("event_date"), F.col("event_id")],
                        columns={"event_type": "__event_type", "campaign_id": "__campaign_id",
                                 "campaign_name": "__campaign_name"},
                        bucket_seconds=EVENT_BUCKET_SECONDS, hot_key_rows=HOT_KEY_ROWS)
    return materialize(nearest.where(F.col("__event_type") == qualifying_type).drop("__event_type"), "purchase-referrals")


def _equal(a: str, b: str) -> Column:
    """Equality that a join tests beside its key, so that rows meet by the key alone."""
    return (F.col(a) <= F.col(b)) & (F.col(a) >= F.col(b))


BASE_SQL = """
SELECT payment_intent_id AS external_id, payment_created_at AS created_at, amount, refunded_amount,
       is_fully_refunded_short_term(amount, refunded_amount, payment_created_at, refunded_at) AS is_fully_refunded_short_term,
       productTag AS product, productTag AS product_tag,
       is_full_fare(productTag) AS is_full_fare, is_renewal(productTag) AS is_renewal, is_renewal_new(productTag) AS is_renewal_new,
       is_other(productTag) AS is_other, is_addon(product_category) AS is_addon, has_appointment(productTag) AS has_appointment,
       email, phone, name, state, new_operational_costs, product_history_id, product_name, provider, provider_id,
       processing_fee(amount) AS payment_processing_fees
FROM {payments}"""

PURCHASE_SQL = """
SELECT 1 AS q, :processor AS payment_processor, external_id, created_at, amount, refunded_amount, is_fully_refunded_short_term,
       product, product_tag, is_full_fare, is_renewal, is_renewal_new, is_other, is_addon, email, phone AS phone_number, name,
       coalesce(state, 'NULL') AS state,
       operational_costs(has_appointment, is_full_fare, is_renewal, is_addon, created_at) AS operational_costs,
       new_operational_costs, product_history_id, product_name, provider, provider_id, payment_processing_fees,
       amount - payment_processing_fees AS net_amount, CAST(:run_ts AS TIMESTAMP_NTZ) AS processed_at,
       campaign_id, campaign_name, is_referral_purchase, state_name(coalesce(state, 'NULL')) AS state_name
FROM {purchases}"""


def normalize_purchases_sql(payments: DataFrame, refunds: DataFrame, versions: DataFrame, events: DataFrame,
                            run_ts: str, processor: str = K.PAYMENT_PROCESSOR) -> DataFrame:
    """:func:`normalize_purchases` as SQL text that calls the registered
    functions; the two time-conditioned joins are the library's."""
    spark = payments.sparkSession
    register_sql_functions(spark)
    base = spark.sql(BASE_SQL, payments=payments_with_versions(payments, refunds, versions))
    return spark.sql(PURCHASE_SQL, {"processor": processor, "run_ts": run_ts}, purchases=attribute_referrals(base, events))


def normalize_purchases(payments: DataFrame, refunds: DataFrame, versions: DataFrame,
                        events: DataFrame, run_ts: str | None = None,
                        processor: str = K.PAYMENT_PROCESSOR) -> DataFrame:
    """Purchase rows ready to merge into the purchase table (no ``id``)."""
    # The referral join takes three columns of the payments and gives few rows, which are
    # written; the enriched increment is then computed once and needs no copy.
    base = purchase_base(payments, refunds, versions)
    p = attribute_referrals(base, events)
    state = F.coalesce(F.col("state"), F.lit("NULL"))
    return p.select(
        F.lit(1).alias("q"),
        F.lit(processor).alias("payment_processor"),
        "external_id", "created_at", "amount", "refunded_amount", "is_fully_refunded_short_term",
        "product", "product_tag", "is_full_fare", "is_renewal", "is_renewal_new", "is_other",
        "is_addon", "email", F.col("phone").alias("phone_number"), "name",
        state.alias("state"),
        operational_costs("has_appointment", "is_full_fare", "is_renewal", "is_addon",
                          "created_at").alias("operational_costs"),
        "new_operational_costs", "product_history_id", "product_name", "provider", "provider_id",
        "payment_processing_fees",
        (F.col("amount") - F.col("payment_processing_fees")).alias("net_amount"),
        load_time(run_ts).alias("processed_at"),
        "campaign_id", "campaign_name", "is_referral_purchase",
        state_name(state).alias("state_name"),
    )
