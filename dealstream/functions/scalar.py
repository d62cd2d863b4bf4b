"""Column-expression helpers (all JVM-side, no Python UDFs).

F3 to_usd, F4 deal_status, F5 days_to, F6 surrogate_key, F8 date parts,
F9 mask_amount, F10 mask_name, F11 format_money, F12 age_text,
F14 minutes_between, F15 safe_ratio, F16 to_gib / to_seconds, P7 contains_ci.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lit_date(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, dt.datetime):
        d = d.date()
    return F.lit(d)


def lit_ts(t) -> Column:
    """TIMESTAMP_NTZ literal (inputs carry NTZ timestamps), the same in every session zone."""
    if isinstance(t, Column):
        return t
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def instant(ntz) -> Column:
    """The TIMESTAMP of a TIMESTAMP_NTZ that holds UTC wall-clock time, whatever the session's zone."""
    c = _c(ntz)
    return F.make_timestamp_ltz(F.year(c), F.month(c), F.day(c), F.hour(c), F.minute(c), F.date_part(F.lit("SECOND"), c), F.lit("UTC"))


# --- F6 -----------------------------------------------------------------------
def surrogate_key(*cols) -> Column:
    """md5 of the '-'-joined string forms, NULL parts replaced by a sentinel."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(K.SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


# --- F3 -----------------------------------------------------------------------
def to_usd(amount, currency, rates: dict[str, float] | None = None) -> Column:
    """Static-rate conversion; unknown currency -> NULL (a CASE, folded by codegen)."""
    rates = rates or K.STATIC_RATES_TO_USD
    amount, currency = _c(amount), _c(currency)
    expr = None
    for code, rate in rates.items():
        branch = (currency == F.lit(code))
        expr = F.when(branch, amount * F.lit(float(rate))) if expr is None else expr.when(branch, amount * F.lit(float(rate)))
    return expr.otherwise(F.lit(None).cast("double"))


def to_usd_exact(amount, currency, rates: dict[str, float] | None = None) -> Column:
    """Decimal form of :func:`to_usd` for sums: notional (2 dp) times the rate,
    exact, so totals do not depend on summation order (hazard H14)."""
    rates = rates or K.STATIC_RATES_TO_USD
    amount = _c(amount).cast("decimal(18,2)")
    currency = _c(currency)
    expr = None
    for code, rate in rates.items():
        r = F.lit(Decimal(str(rate)))
        expr = F.when(currency == F.lit(code), amount * r) if expr is None else expr.when(currency == F.lit(code), amount * r)
    return expr


# --- F4 / F5 -------------------------------------------------------------------
def deal_status(maturity, as_of) -> Column:
    return F.when(_c(maturity) < lit_date(as_of), F.lit(K.EXPIRED)).otherwise(F.lit(K.ACTIVE))


def days_to(maturity, as_of) -> Column:
    return F.datediff(_c(maturity), lit_date(as_of))


# --- F7 / F8 -------------------------------------------------------------------
def date_key(d) -> Column:
    return F.date_format(_c(d), "yyyyMMdd").cast("int")


def in_bounds(d, start: dt.date, end_exclusive: dt.date) -> Column:
    d = _c(d)
    return (d >= F.lit(start)) & (d < F.lit(end_exclusive))


def month_abbr(d) -> Column:
    return F.date_format(_c(d), "MMM")


def day_abbr(d) -> Column:
    return F.date_format(_c(d), "EEE")


# --- F9 / F10 --------------------------------------------------------------------
def mask_amount(x) -> Column:
    """Round to the nearest million (half away from zero)."""
    return F.round(_c(x), K.MASK_ROUND_DIGITS)


def mask_name(x, salt: str | None = None) -> Column:
    """Deterministic pseudonym ``CPTY_`` + 6 upper hex of md5; NULL stays NULL."""
    v = _c(x)
    src = v if salt is None else F.concat(F.lit(salt), v)
    return F.when(v.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit(K.PSEUDONYM_PREFIX), F.upper(F.substring(F.md5(src), 1, K.PSEUDONYM_HEX_CHARS))))


# --- F11 ---------------------------------------------------------------------------
def format_money(x) -> Column:
    """Compact money text: $1.23T/B/M/K with two decimals, else $1,234; sign first.

    Halves round away from zero (format_number is HALF_EVEN on the decimal
    value; we round HALF_UP first so both agree)."""
    v = _c(x).cast("double")
    a = F.abs(v)
    sign = F.when(v < 0, F.lit("-")).otherwise(F.lit(""))
    expr = None
    for threshold, suffix in K.MONEY_SUFFIXES:
        txt = F.concat(sign, F.lit("$"), F.format_number(F.round(a / F.lit(threshold), 2), 2), F.lit(suffix))
        expr = F.when(a >= threshold, txt) if expr is None else expr.when(a >= threshold, txt)
    return expr.otherwise(F.concat(sign, F.lit("$"), F.format_number(F.round(a, 0), 0)))


# --- F12 / F14 -------------------------------------------------------------------------
def age_seconds(ts, now) -> Column:
    return (F.unix_micros(lit_ts(now).cast("timestamp")) - F.unix_micros(_c(ts).cast("timestamp"))) / F.lit(1e6)


def age_text(ts, now) -> Column:
    """'N min ago' under an hour (truncated), else 'x.x hours ago'; NULL -> 'No data yet'."""
    secs = age_seconds(ts, now)
    hours = secs / F.lit(3600.0)
    return (F.when(_c(ts).isNull(), F.lit("No data yet"))
             .when(hours < 1, F.concat(F.floor(secs / 60).cast("bigint").cast("string"), F.lit(" min ago")))
             .otherwise(F.format_string("%.1f hours ago", F.round(hours, 1))))


def minutes_between(a, b) -> Column:
    """Minute boundaries crossed from ``a`` to ``b`` (b - a)."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", _c(a)), F.date_trunc("minute", _c(b)))


# --- F15 / F16 ---------------------------------------------------------------------------
def safe_ratio(x, y, digits: int | None = None) -> Column:
    r = F.try_divide(_c(x).cast("double"), F.when(_c(y) != 0, _c(y).cast("double")))
    return F.round(r, digits) if digits is not None else r


def to_gib(x) -> Column:
    return _c(x).cast("double") / F.lit(float(1024 ** 3))


def to_seconds(ms) -> Column:
    return _c(ms).cast("double") / F.lit(1000.0)


# --- P7 ---------------------------------------------------------------------------------
def contains_ci(x, needle: str) -> Column:
    """Case-insensitive contains (``ilike '%needle%'``)."""
    return _c(x).ilike(f"%{needle}%")
