"""Business constants of the payment normalisation.

Everything in the FIXED VALUES block must equal the values the original
jobs use, otherwise derived facts (flags, costs, fees, state names) change.
Organisation-specific literals (e-mail exclusion patterns, bucket names,
vendor field names) are *not* here: they are parameters of the operators.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES
# ---------------------------------------------------------------------------

PAYMENT_PROCESSOR = "Stripe"

# Product tag conventions.
TAG_RENEWAL_PREFIX = "homeRenewal"        # not full fare when the tag starts with it
TAG_RENEWAL_NEW = "homeRenewalNew"        # renewal-new / "other" marker
TAG_RENEW_PATTERN = "%renew%"             # renewal test, case-insensitive
TAG_NO_APPOINTMENT_PATTERN = "psdTrain%"  # no appointment, case-insensitive
ADDON_CATEGORY = "Add-on"

# Operational cost decision list (first match wins).
COST_NO_APPOINTMENT = 0
COST_FULL_FARE_OR_RENEWAL = 38
COST_ADDON_BEFORE_CUTOVER = 18
COST_ADDON = 25
COST_DEFAULT = 0
ADDON_COST_CUTOVER_DATE = "2022-10-31"

# Card processing fee: percent of the amount plus a fixed part, 2 decimals.
FEE_PERCENT = 2.9
FEE_FIXED = 0.30

# Refund of at least this amount counts as a full refund.
FULL_REFUND_THRESHOLD = 99.0

# A full refund within this many hours of the payment is "short term".
SHORT_TERM_REFUND_HOURS = 24

# Referral event type that qualifies a purchase for the campaign.
QUALIFYING_EVENT_TYPE = "user_qualified"

UNKNOWN_STATE = "UNKNOWN"

# US states, DC and Puerto Rico: abbreviation -> name.
US_STATES = {
    "AL": "Alabama",
    "AK": "Alaska",
    "AZ": "Arizona",
    "AR": "Arkansas",
    "CA": "California",
    "CO": "Colorado",
    "CT": "Connecticut",
    "DE": "Delaware",
    "DC": "District of Columbia",
    "FL": "Florida",
    "GA": "Georgia",
    "HI": "Hawaii",
    "ID": "Idaho",
    "IL": "Illinois",
    "IN": "Indiana",
    "IA": "Iowa",
    "KS": "Kansas",
    "KY": "Kentucky",
    "LA": "Louisiana",
    "ME": "Maine",
    "MD": "Maryland",
    "MA": "Massachusetts",
    "MI": "Michigan",
    "MN": "Minnesota",
    "MS": "Mississippi",
    "MO": "Missouri",
    "MT": "Montana",
    "NE": "Nebraska",
    "NV": "Nevada",
    "NH": "New Hampshire",
    "NJ": "New Jersey",
    "NM": "New Mexico",
    "NY": "New York",
    "NC": "North Carolina",
    "ND": "North Dakota",
    "OH": "Ohio",
    "OK": "Oklahoma",
    "OR": "Oregon",
    "PR": "Puerto Rico",
    "PA": "Pennsylvania",
    "RI": "Rhode Island",
    "SC": "South Carolina",
    "SD": "South Dakota",
    "TN": "Tennessee",
    "TX": "Texas",
    "UT": "Utah",
    "VT": "Vermont",
    "VA": "Virginia",
    "WA": "Washington",
    "WV": "West Virginia",
    "WI": "Wisconsin",
    "WY": "Wyoming",
}
