"""Star schema over the decision log: dimensions, facts, status and report.

Dimension keys
--------------
Every dimension key is a pure function of its natural value (md5 surrogate
key; ``yyyyMMdd`` for dates inside the date-dimension bounds). When the
dimensions are built from the same decision log as the facts (the normal
case: :func:`build_dims`), every non-NULL natural value of a fact row is in
its dimension, so the seven lookups of the star reduce to computing the key
in place (``mode="derive"``): no join, no shuffle, no broadcast whose size
grows with the data. ``mode="lookup"`` performs the literal left joins for
dimensions maintained elsewhere; those joins are left to the optimizer (AQE
broadcasts a side only when its measured size is under the threshold).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S

DIM_SPECS = {
    # dim name: (natural column in decisions, key column, name column)
    "trader": ("trader", "trader_key", "trader_name"),
    "book": ("book", "book_key", "book_name"),
    "counterparty": ("counterparty", "counterparty_key", "counterparty_name"),
    "currency": ("currency", "currency_key", "currency_code"),
}

VALID_FACT_COLUMNS = (
    "trade_id", "version", "message_id", "source_system", "event_timestamp", "trade_date",
    "trade_date_key", "maturity_date", "maturity_date_key", "product_key", "product_type",
    "counterparty_key", "counterparty", "trader_key", "trader", "book_key", "book",
    "currency_key", "currency", "notional", "price", "file_name", "source_loaded_at",
    "evaluated_at", "processed_at",
)

REJECTED_FACT_COLUMNS = (
    "trade_id", "version", "message_id", "source_system", "event_timestamp", "trade_date",
    "trade_date_key", "maturity_date", "maturity_date_key", "product_key", "product_type",
    "counterparty_key", "counterparty", "trader_key", "trader", "book_key", "book",
    "currency_key", "currency", "notional", "price", "file_name", "source_loaded_at",
    "existing_version", "reject_reason", "evaluated_at", "logged_at",
)

STATUS_COLUMNS = (
    "trade_id", "version", "product_key", "product_type", "counterparty_key", "counterparty",
    "trader_key", "trader", "book_key", "book", "currency_key", "currency", "notional",
    "notional_usd", "price", "trade_date", "trade_date_key", "maturity_date",
    "maturity_date_key", "trade_status", "processed_at",
)

REPORT_COLUMNS = (
    "trade_id", "version", "trader", "book", "counterparty", "product_type", "currency",
    "notional", "notional_usd", "price", "trade_date", "trade_year", "trade_quarter",
    "trade_month_name", "maturity_date", "maturity_year", "maturity_quarter",
    "maturity_month_name", "days_to_maturity", "trade_status", "processed_at",
)


class DateBounds:
    """Date-dimension range ``[start, end)`` (a day spine, end exclusive)."""

    def __init__(self, start: dt.date, end: dt.date):
        self.start, self.end = start, end


# --- dimensions (A1, F6, J4, F7, F8) --------------------------------------------
def build_dim(decisions: DataFrame, natural: str, key_col: str, name_col: str) -> DataFrame:
    """Distinct non-NULL values of one column, with an md5 surrogate key."""
    d = decisions.select(F.col(natural).alias(name_col)).filter(F.col(name_col).isNotNull()).distinct()
    return d.select(S.surrogate_key(name_col).alias(key_col), name_col)


def product_reference(spark: SparkSession) -> DataFrame:
    """The static 5-row product reference seed."""
    schema = ", ".join(f"{c} string" for c in K.PRODUCT_REFERENCE_COLUMNS)
    return spark.createDataFrame(list(K.PRODUCT_REFERENCE_ROWS), schema)


def load_reference(spark: SparkSession, path: str) -> DataFrame:
    """The seed from a CSV file with a header (all columns strings)."""
    schema = ", ".join(f"{c} string" for c in K.PRODUCT_REFERENCE_COLUMNS)
    return spark.read.schema(schema).option("header", True).csv(path)


def build_dim_product(decisions: DataFrame, reference: DataFrame) -> DataFrame:
    """Distinct products, *left* joined to the reference (unknown products keep
    a row with NULL attributes). The seed is a fixed handful of rows, so it is
    broadcast."""
    d = decisions.select("product_type").filter(F.col("product_type").isNotNull()).distinct()
    ref = F.broadcast(reference)
    j = d.join(ref, "product_type", "left")
    return j.select(S.surrogate_key("product_type").alias("product_key"), "product_type",
                    "product_name", "asset_class", "trade_date_meaning", "maturity_date_meaning", "notes")


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day in ``[start, end)``; generated by ``spark.range`` so the
    rows are produced in parallel (no single-row explode)."""
    n = (end - start).days
    return spark.range(0, n).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_day"))


def dim_date(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    return date_attributes(date_spine(spark, start, end))


def dim_date_for(df: DataFrame, cols) -> DataFrame:
    """Date dimension over whole calendar years spanning ``cols`` of ``df``.
    One aggregate finds the range; the spine's size is bounded by the
    calendar span, not by the row count."""
    lo = F.least(*[F.min(c) for c in cols])
    hi = F.greatest(*[F.max(c) for c in cols])
    b = df.agg(lo.alias("lo"), hi.alias("hi"))
    spine = b.select(F.explode(F.sequence(F.make_date(F.year("lo"), F.lit(1), F.lit(1)),
                                          F.make_date(F.year("hi"), F.lit(12), F.lit(31)))).alias("date_day"))
    return date_attributes(spine)


def date_attributes(spine: DataFrame) -> DataFrame:
    d = F.col("date_day")
    return spine.select(
        S.date_key(d).alias("date_key"), d,
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        S.month_abbr(d).alias("month_name"), F.dayofmonth(d).alias("day_of_month"),
        S.day_abbr(d).alias("day_name"),
        S.day_abbr(d).isin("Sat", "Sun").alias("is_weekend"))


def build_dims(decisions: DataFrame) -> dict[str, DataFrame]:
    dims = {name: build_dim(decisions, *spec) for name, spec in DIM_SPECS.items()}
    dims["product"] = build_dim_product(decisions, product_reference(decisions.sparkSession))
    return dims


# --- dimension keys on facts (J2) ------------------------------------------------
def _derived_date_key(col: str, bounds: DateBounds) -> Column:
    return F.when(S.in_bounds(col, bounds.start, bounds.end), S.date_key(col))


def attach_dim_keys(df: DataFrame, bounds: DateBounds, dims: dict[str, DataFrame] | None = None,
                    date_dim: DataFrame | None = None, mode: str = "derive") -> DataFrame:
    """Add product/counterparty/trader/book/currency keys and the two date keys."""
    if mode == "derive":
        keyed = [F.when(F.col("product_type").isNotNull(), S.surrogate_key("product_type")).alias("product_key")]
        for _, (nat, key, _name) in DIM_SPECS.items():
            keyed.append(F.when(F.col(nat).isNotNull(), S.surrogate_key(nat)).alias(key))
        keyed += [_derived_date_key("trade_date", bounds).alias("trade_date_key"),
                  _derived_date_key("maturity_date", bounds).alias("maturity_date_key")]
        return df.select("*", *keyed)
    if dims is None or date_dim is None:
        raise ValueError("lookup mode needs dims and date_dim")
    out = df
    p = dims["product"].select(F.col("product_type").alias("_p_type"), "product_key")
    out = out.join(p, out.product_type == p._p_type, "left").drop("_p_type")
    for name, (nat, key, name_col) in DIM_SPECS.items():
        d = dims[name].select(F.col(name_col).alias(f"_{name}_n"), key)
        out = out.join(d, out[nat] == d[f"_{name}_n"], "left").drop(f"_{name}_n")
    # the date dimension is bounded by its configured range: a proven size
    td = F.broadcast(date_dim.select(F.col("date_day").alias("_td"), F.col("date_key").alias("trade_date_key")))
    md = F.broadcast(date_dim.select(F.col("date_day").alias("_md"), F.col("date_key").alias("maturity_date_key")))
    out = out.join(td, out.trade_date == td._td, "left").drop("_td")
    out = out.join(md, out.maturity_date == md._md, "left").drop("_md")
    return out


# --- facts (C2, C3, P10) ----------------------------------------------------------
def latest_accepted(decisions: DataFrame) -> DataFrame:
    """One row per trade: its last accepted message (latest batch, hazard H4).

    ``row_number() = 1`` per trade gets a partial WindowGroupLimit before the
    shuffle, so a trade with very many accepted rows is cut map-side."""
    acc = decisions.filter(F.col("decision") == K.ACCEPTED)
    w = Window.partitionBy("trade_id").orderBy(F.col("batch_id").desc(), F.col("evaluated_at").desc(),
                                               F.col("message_id").asc())
    return acc.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def build_valid_fact(decisions: DataFrame, bounds: DateBounds, processed_at: Column | None = None,
                     dims=None, date_dim=None, mode: str = "derive") -> DataFrame:
    """Current book: last accepted version per trade with dimension keys.
    ``processed_at`` defaults to the row's evaluation time (merged in that run)."""
    cur = latest_accepted(decisions)
    cur = cur.withColumn("processed_at", processed_at if processed_at is not None else F.col("evaluated_at"))
    return attach_dim_keys(cur, bounds, dims, date_dim, mode).select(*VALID_FACT_COLUMNS)


def build_rejected_fact(decisions: DataFrame, bounds: DateBounds, logged_at: Column | None = None,
                        dims=None, date_dim=None, mode: str = "derive") -> DataFrame:
    """Reject audit log with dimension keys; map-only (no shuffle) in derive mode."""
    rej = decisions.filter(F.col("decision") == K.REJECTED).withColumnRenamed("decision_reason", "reject_reason")
    rej = rej.withColumn("logged_at", logged_at if logged_at is not None else F.col("evaluated_at"))
    return attach_dim_keys(rej, bounds, dims, date_dim, mode).select(*REJECTED_FACT_COLUMNS)


# --- status view and report (C4, C5, F3-F5, J3) ------------------------------------
def build_status(valid: DataFrame, as_of, rates: dict[str, float] | None = None) -> DataFrame:
    return valid.select(
        *[c for c in STATUS_COLUMNS if c not in ("notional_usd", "trade_status")],
        S.to_usd("notional", "currency", rates).alias("notional_usd"),
        S.deal_status("maturity_date", as_of).alias("trade_status"),
    ).select(*STATUS_COLUMNS)


def build_report(status: DataFrame, as_of, bounds: DateBounds, date_dim: DataFrame | None = None,
                 mode: str = "derive") -> DataFrame:
    """Flat report: status plus year / quarter / month name of both dates and
    days to maturity. The date attributes come from the date dimension; in
    derive mode they are computed in place for dates inside its bounds."""
    if mode == "derive":
        def attrs(col, prefix):
            ok = S.in_bounds(col, bounds.start, bounds.end)
            return [F.when(ok, F.year(col)).alias(f"{prefix}_year"),
                    F.when(ok, F.quarter(col)).alias(f"{prefix}_quarter"),
                    F.when(ok, S.month_abbr(col)).alias(f"{prefix}_month_name")]
        out = status.select("*", *attrs("trade_date", "trade"), *attrs("maturity_date", "maturity"))
    else:
        dd = F.broadcast(date_dim)  # bounded by its configured range
        td = dd.select(F.col("date_day").alias("_td"), F.col("year").alias("trade_year"),
                       F.col("quarter").alias("trade_quarter"), F.col("month_name").alias("trade_month_name"))
        md = dd.select(F.col("date_day").alias("_md"), F.col("year").alias("maturity_year"),
                       F.col("quarter").alias("maturity_quarter"), F.col("month_name").alias("maturity_month_name"))
        out = (status.join(td, status.trade_date == td._td, "left").drop("_td")
               .join(md, F.col("maturity_date") == md._md, "left").drop("_md"))
    out = out.withColumn("days_to_maturity", S.days_to("maturity_date", as_of))
    return out.select(*REPORT_COLUMNS)
