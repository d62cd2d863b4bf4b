"""Fixed values the results depend on.

Everything here must keep exactly these values for the outputs to match the
behaviour being reproduced (decision labels, static conversion rates,
masking roles, product reference rows, date-dimension bounds).
"""

from __future__ import annotations

import datetime as _dt

# --- fixed values: decision labels -------------------------------------------
ACCEPTED = "ACCEPTED"
REJECTED = "REJECTED"

SUPERSEDED_IN_BATCH = "SUPERSEDED_IN_BATCH"
MATURITY_DATE_IN_PAST = "MATURITY_DATE_IN_PAST"
STALE_VERSION_LOWER_THAN_EXISTING = "STALE_VERSION_LOWER_THAN_EXISTING"
REPLACED_SAME_VERSION = "REPLACED_SAME_VERSION"
NEW_TRADE_ACCEPTED = "NEW_TRADE_ACCEPTED"

REJECT_REASONS = (SUPERSEDED_IN_BATCH, MATURITY_DATE_IN_PAST, STALE_VERSION_LOWER_THAN_EXISTING)

# --- fixed values: deal status -------------------------------------------------
ACTIVE = "ACTIVE"
EXPIRED = "EXPIRED"

# --- fixed values: static conversion rates to USD ------------------------------
STATIC_RATES_TO_USD = {
    "USD": 1.0,
    "EUR": 1.08,
    "GBP": 1.27,
    "JPY": 0.0067,
    "CHF": 1.12,
    "AUD": 0.65,
}

# --- fixed values: masking ------------------------------------------------------
# Roles that see real values; every other role sees masked ones.
FULL_ACCESS_ROLES = ("BUILDER", "COMPLIANCE", "ADMIN")
PSEUDONYM_PREFIX = "CPTY_"
PSEUDONYM_HEX_CHARS = 6
MASK_ROUND_DIGITS = -6

# Which serving objects each role may read.
ROLE_TABLES = {
    "COMPLIANCE": "*",
    "ADMIN": "*",
    "BUILDER": "*",
    "ANALYST": ("deal_status", "deal_report"),
}

# --- fixed values: product reference seed (5 rows) ------------------------------
PRODUCT_REFERENCE_COLUMNS = (
    "product_type", "product_name", "asset_class", "trade_date_meaning",
    "maturity_date_meaning", "notes",
)
PRODUCT_REFERENCE_ROWS = (
    ("FX_SPOT", "FX Spot", "FX", "Deal execution date", "T+1 or T+2 settlement date",
     "Very short gap -- maturity here is really just settlement"),
    ("FX_FORWARD", "FX Forward", "FX", "Deal execution date",
     "Agreed future settlement date -- days to years out",
     "The trade-to-maturity gap is the whole point of the product"),
    ("IRS", "Interest Rate Swap", "Rates", "Execution/trade date",
     "Swap termination date -- often 1-30 years out",
     "Long-dated with periodic reset/payment dates in between -- not just one cash flow"),
    ("FX_OPTION", "FX Option", "FX", "Trade date",
     "Expiry date -- when the option can be or is exercised",
     "Exercise style (American/European) affects whether maturity is the last exercisable date or a single date"),
    ("BOND", "Bond", "Rates", "Trade (transaction) date",
     "The bond's fixed maturity date -- coupon and principal redemption",
     "A fixed attribute of the bond itself -- not negotiated per trade; every trade on the same CUSIP/ISIN shares one maturity date"),
)

# --- fixed values: SCD-2 check columns -------------------------------------------
SCD_CHECK_COLUMNS = (
    "version", "maturity_date", "notional", "price", "currency",
    "counterparty", "trader", "book", "product_type",
)

# --- fixed values: incremental watermark seed ------------------------------------
EPOCH = _dt.datetime(1900, 1, 1, 0, 0, 0)

# --- fixed values: money formatting thresholds ----------------------------------
MONEY_SUFFIXES = ((1e12, "T"), (1e9, "B"), (1e6, "M"), (1e3, "K"))

# Surrogate-key sentinel for NULL parts (free to choose: every use is non-null).
SURROGATE_NULL = "__null__"
