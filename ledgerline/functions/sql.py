"""The derived facts as functions that SQL text can call.

Each is a temporary SQL function (an expression that Spark inlines), built from
the same fixed values as the column functions; none runs in Python.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerline import constants as K
from ledgerline.functions.states import lookup_keys


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _states() -> str:
    return "map(" + ", ".join(f"{_text(k)}, {_text(v)}" for k, v in lookup_keys().items()) + ")"


def sql_functions() -> dict[str, tuple[str, str, str]]:
    """Name -> (parameters, result type, expression)."""
    prefix, new = _text(K.TAG_RENEWAL_PREFIX), _text(K.TAG_RENEWAL_NEW)
    return {
        "state_name": ("state STRING", "STRING",
                       f"coalesce(try_element_at({_states()}, upper(replace(state, ' ', ''))), {_text(K.UNKNOWN_STATE)})"),
        "processing_fee": ("amount DOUBLE", "DOUBLE", f"round(amount * {K.FEE_PERCENT}D / 100 + {K.FEE_FIXED}D, 2)"),
        "is_full_fare": ("tag STRING", "BOOLEAN", f"NOT startswith(coalesce(tag, {prefix}), {prefix})"),
        "is_renewal": ("tag STRING", "BOOLEAN", f"coalesce(tag, '') ILIKE {_text(K.TAG_RENEW_PATTERN)}"),
        "is_renewal_new": ("tag STRING", "BOOLEAN", f"tag = {new}"),
        "is_other": ("tag STRING", "BOOLEAN", f"coalesce(tag, {new}) = {new}"),
        "is_addon": ("category STRING", "BOOLEAN", f"coalesce(category = {_text(K.ADDON_CATEGORY)}, false)"),
        "has_appointment": ("tag STRING", "BOOLEAN", f"NOT (tag ILIKE {_text(K.TAG_NO_APPOINTMENT_PATTERN)})"),
        "operational_costs": (
            "has_appointment BOOLEAN, is_full_fare BOOLEAN, is_renewal BOOLEAN, is_addon BOOLEAN, created_at TIMESTAMP_NTZ", "INT",
            f"CASE WHEN NOT has_appointment THEN {K.COST_NO_APPOINTMENT} "
            f"WHEN is_full_fare OR is_renewal THEN {K.COST_FULL_FARE_OR_RENEWAL} "
            f"WHEN is_addon AND created_at < DATE'{K.ADDON_COST_CUTOVER_DATE}' THEN {K.COST_ADDON_BEFORE_CUTOVER} "
            f"WHEN is_addon THEN {K.COST_ADDON} ELSE {K.COST_DEFAULT} END"),
        "is_fully_refunded_short_term": (
            "amount DOUBLE, refunded DOUBLE, paid_at TIMESTAMP_NTZ, refunded_at TIMESTAMP_NTZ", "BOOLEAN",
            f"coalesce(amount = refunded AND refunded_at - paid_at <= make_dt_interval(0, {K.SHORT_TERM_REFUND_HOURS}), false)"),
        "is_full_refund": ("amount DOUBLE", "BOOLEAN", f"amount >= {K.FULL_REFUND_THRESHOLD}D"),
        "strip_outer_quote": ("value STRING", "STRING", "regexp_replace(value, \"^'|'$\", '')"),
        "epoch_to_ts": ("seconds BIGINT", "TIMESTAMP_NTZ", "timestampadd(SECOND, seconds, TIMESTAMP_NTZ'1970-01-01 00:00:00')"),
    }


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) the functions in the session; returns their names."""
    found = sql_functions()
    for name, (parameters, kind, body) in found.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    return list(found)
