"""Payload and table schemas.

The payload schemas are given as Spark DDL strings so that ``from_json``
parses them on the JVM side (no Python schema objects on the hot path).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: the JSON payload layouts of charge, dispute and refund
# documents (field names, nesting and types must stay exactly as below for
# payloads to parse into the same values).  Fields are in document order.
# ---------------------------------------------------------------------------

_CARD_DETAILS = """struct<
    brand: string, last4: string,
    checks: struct<cvc_check: string, address_line1_check: string, address_postal_code_check: string>,
    wallet: string, country: string, funding: string, mandate: string, network: string,
    exp_year: int, exp_month: int, fingerprint: string,
    overcapture: struct<status: string, maximum_amount_capturable: int>,
    installments: string, multicapture: string,
    network_token: struct<used: boolean>,
    capture_before: bigint, three_d_secure: string, amount_authorized: int,
    extended_authorization: struct<status: string>,
    incremental_authorization: struct<status: string>>"""

_OUTCOME = """struct<type: string, reason: string, risk_level: string, risk_score: int,
    network_status: string, seller_message: string>"""

_BILLING_DETAILS = """struct<name: string, email: string, phone: string,
    address: struct<city: string, line1: string, line2: string, state: string, country: string, postal_code: string>>"""

_PAYMENT_METADATA = """struct<
    user: struct<email: string, state: string,
                 consent: struct<timestamp: string, idempotencyKey: string>,
                 lastName: string, firstName: string>,
    email: string,
    provider: struct<fullName: string, providerId: string>,
    packageTag: string,
    appointmentSlot: struct<date: string, user: struct<userId: string, full_name: string>,
                            user_id: string, appointment_id: string,
                            is_fully_booked: boolean, has_waitlist_enabled: boolean>,
    {package_field}: struct<next_steps: string, package_id: int, package_tag: string, provider_id: string,
                            total_price: int, package_name: string, appointment_type_id: string,
                            package_description: string, primary_product_tag: string,
                            requires_scheduling: boolean, {offering_field}: string>>"""

# Fields shared by charge and refund documents after `application_fee`.
_CHARGE_TAIL = f"""
    billing_details: {_BILLING_DETAILS},
    failure_message: string, source_transfer: string, balance_transaction: string,
    statement_descriptor: string, application_fee_amount: string,
    payment_method_details: struct<card: {_CARD_DETAILS}, type: string>,
    failure_balance_transaction: string, statement_descriptor_suffix: string,
    calculated_statement_descriptor: string"""

_CHARGE_MIDDLE = """
    refunded: boolean, shipping: string, application: string, description: string,
    destination: string, receipt_url: string, failure_code: string, on_behalf_of: string,
    fraud_details: string, radar_options: string, receipt_email: string, transfer_data: string,
    payment_intent: string, payment_method: string, receipt_number: string, transfer_group: string,
    amount_captured: int, amount_refunded: int, application_fee: string,"""

def payment_payload_ddl(package_field: str = "vendorPackage", offering_field: str = "offering_id") -> str:
    """Charge document layout.  The names of the seller-specific package
    object inside ``metadata`` and of its offering id are deployment
    parameters."""
    metadata = _PAYMENT_METADATA.replace("{package_field}", package_field).replace("{offering_field}", offering_field)
    return f"""struct<
    id: string, paid: boolean, `order`: string, amount: int, object: string, review: string,
    source: string, status: string, created: bigint, dispute: string, invoice: string,
    outcome: {_OUTCOME},
    captured: boolean, currency: string, customer: string, disputed: boolean, livemode: boolean,
    metadata: {metadata},{_CHARGE_MIDDLE}{_CHARGE_TAIL}>"""


PAYMENT_PAYLOAD_DDL = payment_payload_ddl()

REFUND_PAYLOAD_DDL = f"""struct<
    id: string, paid: boolean, `order`: string, amount: int, object: string, review: string,
    source: string, status: string, created: bigint, dispute: string, invoice: string,
    outcome: {_OUTCOME},
    refunds: struct<url: string, data: string, object: string, has_more: boolean, total_count: int>,
    captured: boolean, currency: string, customer: string, disputed: boolean, livemode: boolean,
    metadata: string,{_CHARGE_MIDDLE}{_CHARGE_TAIL}>"""

DISPUTE_PAYLOAD_DDL = """struct<
    id: string, amount: double, charge: string, object: string, reason: string, status: string,
    created: bigint, currency: string,
    evidence: struct<receipt: string, service_date: string, customer_name: string, refund_policy: string,
        shipping_date: string, billing_address: string, shipping_address: string, shipping_carrier: string,
        customer_signature: string, uncategorized_file: string, uncategorized_text: string,
        access_activity_log: string, cancellation_policy: string, duplicate_charge_id: string,
        product_description: string, customer_purchase_ip: string, cancellation_rebuttal: string,
        service_documentation: string, customer_communication: string, customer_email_address: string,
        shipping_documentation: string, refund_policy_disclosure: string, shipping_tracking_number: string,
        refund_refusal_explanation: string, duplicate_charge_explanation: string,
        cancellation_policy_disclosure: string, duplicate_charge_documentation: string>,
    livemode: boolean,
    metadata: struct<>,
    payment_intent: string,
    evidence_details: struct<due_by: bigint, past_due: boolean, has_evidence: boolean, submission_count: int>,
    balance_transaction: string,
    balance_transactions: array<string>,
    is_charge_refundable: boolean,
    payment_method_details: struct<card: struct<brand: string, network_reason_code: string>, type: string>>"""

# What the normalising plans read of a charge and of a dispute: from_json does
# the work of the whole layout it is given, so they give it only this much.
PAYMENT_USED_DDL = "struct<metadata: struct<packageTag: string, provider: struct<fullName: string, providerId: string>>>"
DISPUTE_USED_DDL = "struct<status: string, evidence_details: struct<due_by: bigint>>"

PAYLOAD_DDL = {
    "payment": PAYMENT_PAYLOAD_DDL,
    "refund": REFUND_PAYLOAD_DDL,
    "dispute": DISPUTE_PAYLOAD_DDL,
}

# ---------------------------------------------------------------------------
# Lake tables written by stage 1 (CDC merge) and stage 2 (normalise).
# Column name -> Spark SQL type, in table order.
# ---------------------------------------------------------------------------

PAYMENT_COLUMNS = {
    "payment_intent_id": "string", "status": "string", "charge_id": "string",
    "email": "string", "phone": "string", "name": "string", "state": "string",
    "amount": "double", "is_refunded": "boolean", "is_dispute": "boolean",
    "payment_created_at": "timestamp_ntz", "payment_updated_at": "timestamp_ntz",
    "payment_refunded_at": "timestamp_ntz", "payment_disputed_at": "timestamp_ntz",
    "payment_data": "string", "created_at": "timestamp_ntz",
}

REFUND_COLUMNS = {
    "payment_intent_id": "string", "dispute_id": "string", "charge_id": "string",
    "amount_refunded": "double", "is_partially_refunded": "boolean",
    "is_fully_refunded": "boolean", "is_dispute": "boolean",
    "dispute_created_at": "timestamp_ntz", "payment_refunded_at": "timestamp_ntz",
    "refund_data": "string", "reason": "string", "created_at": "timestamp_ntz",
}

DISPUTE_COLUMNS = {
    "payment_intent_id": "string", "dispute_id": "string", "charge_id": "string",
    "dispute_amount": "double", "dispute_created_at": "timestamp_ntz",
    "record_created_at": "timestamp_ntz", "dispute_data": "string", "reason": "string",
    "created_at": "timestamp_ntz",
}

# Columns force-typed after CSV ingest (the rest stay as read).
CDC_COERCE = {
    "payment": {
        "amount": "double", "payment_created_at": "timestamp_ntz",
        "payment_updated_at": "timestamp_ntz", "payment_refunded_at": "timestamp_ntz",
        "payment_disputed_at": "timestamp_ntz", "is_refunded": "boolean", "is_dispute": "boolean",
    },
    "refund": {
        "amount_refunded": "double", "is_partially_refunded": "boolean",
        "is_fully_refunded": "boolean", "is_dispute": "boolean",
        "dispute_created_at": "timestamp_ntz", "payment_refunded_at": "timestamp_ntz",
    },
    "dispute": {"dispute_amount": "double", "dispute_created_at": "timestamp_ntz"},
}

PURCHASE_COLUMNS = [
    "q", "payment_processor", "id", "external_id", "created_at", "amount", "refunded_amount",
    "is_fully_refunded_short_term", "product", "product_tag", "is_full_fare", "is_renewal",
    "is_renewal_new", "is_other", "is_addon", "email", "phone_number", "name", "state",
    "operational_costs", "new_operational_costs", "product_history_id", "product_name",
    "provider", "provider_id", "payment_processing_fees", "net_amount", "processed_at",
    "campaign_id", "campaign_name", "is_referral_purchase", "state_name",
]

NORM_REFUND_COLUMNS = [
    "q", "payment_processor", "payment_created_at", "created_at", "refund_created_at",
    "charge_id", "purchase_external_id", "email", "payment_amount", "refund_amount",
    "is_full_refund", "product_history_id", "product_name", "processed_at",
]

NORM_DISPUTE_COLUMNS = [
    "payment_processor", "payment_created_at", "charge_id", "email", "dispute_id",
    "dispute_created_at", "dispute_response_required_by", "disputed_amount",
    "dispute_status", "dispute_reason", "processed_at",
]
