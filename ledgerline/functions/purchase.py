"""Purchase-level derived facts: flags, refund timing, fees, costs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline import constants as K


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def purchase_flags(tag: Column | str, category: Column | str) -> dict[str, Column]:
    """Flags derived from the product tag and the product category.

    Three-valued logic is kept: a NULL tag gives NULL for the flags that
    compare it without a default.
    """
    t = _c(tag)
    return {
        "is_full_fare": ~F.coalesce(t, F.lit(K.TAG_RENEWAL_PREFIX)).startswith(K.TAG_RENEWAL_PREFIX),
        "is_renewal": F.coalesce(t, F.lit("")).ilike(K.TAG_RENEW_PATTERN),
        "is_renewal_new": t == F.lit(K.TAG_RENEWAL_NEW),
        "is_other": F.coalesce(t, F.lit(K.TAG_RENEWAL_NEW)) == F.lit(K.TAG_RENEWAL_NEW),
        "is_addon": F.coalesce(_c(category) == F.lit(K.ADDON_CATEGORY), F.lit(False)),
        "has_appointment": ~t.ilike(K.TAG_NO_APPOINTMENT_PATTERN),
    }


def is_fully_refunded_short_term(amount: Column | str, refunded: Column | str,
                                 paid_at: Column | str, refunded_at: Column | str,
                                 hours: int = K.SHORT_TERM_REFUND_HOURS) -> Column:
    """Refund of the whole amount at most ``hours`` after the payment
    (inclusive; a refund stamped before the payment also qualifies).
    Anything unknown is false."""
    within = (_c(refunded_at) - _c(paid_at)) <= F.make_dt_interval(F.lit(0), F.lit(hours))
    return F.coalesce((_c(amount) == _c(refunded)) & within, F.lit(False))


def processing_fee(amount: Column | str) -> Column:
    """Card fee, rounded half-up to cents (double arithmetic)."""
    return F.round(_c(amount) * K.FEE_PERCENT / 100 + K.FEE_FIXED, 2)


def operational_costs(has_appointment: Column | str, is_full_fare: Column | str,
                      is_renewal: Column | str, is_addon: Column | str,
                      created_at: Column | str) -> Column:
    """Operational cost decision list; the first matching rule wins."""
    cutover = F.lit(K.ADDON_COST_CUTOVER_DATE).cast("date")
    return (
        F.when(~_c(has_appointment), F.lit(K.COST_NO_APPOINTMENT))
        .when(_c(is_full_fare) | _c(is_renewal), F.lit(K.COST_FULL_FARE_OR_RENEWAL))
        .when(_c(is_addon) & (_c(created_at) < cutover), F.lit(K.COST_ADDON_BEFORE_CUTOVER))
        .when(_c(is_addon), F.lit(K.COST_ADDON))
        .otherwise(F.lit(K.COST_DEFAULT))
    )


def is_full_refund(refund_amount: Column | str, threshold: float = K.FULL_REFUND_THRESHOLD) -> Column:
    return _c(refund_amount) >= F.lit(threshold)
