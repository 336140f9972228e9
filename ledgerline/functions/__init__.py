"""Column-level functions (all built from ``pyspark.sql.functions``)."""

from ledgerline.functions.coerce import coerce_types, load_time, stamp_load_time
from ledgerline.functions.payload import (dispute_fields, epoch_to_ts, extract_payment_fields,
                                          field_or_empty, parse_payload, payload_defect, split_payloads)
from ledgerline.functions.purchase import (is_full_refund, is_fully_refunded_short_term,
                                           operational_costs, processing_fee, purchase_flags)
from ledgerline.functions.sql import register_sql_functions
from ledgerline.functions.states import state_name
from ledgerline.functions.text import repair_quotes, strip_outer_quote

__all__ = [
    "coerce_types", "load_time", "stamp_load_time", "dispute_fields", "epoch_to_ts",
    "extract_payment_fields", "field_or_empty", "parse_payload", "is_full_refund",
    "is_fully_refunded_short_term", "operational_costs", "processing_fee", "purchase_flags",
    "payload_defect", "split_payloads", "register_sql_functions", "state_name", "repair_quotes", "strip_outer_quote",
]
