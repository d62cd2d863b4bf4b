"""Report analytics over the flat report and the reject log.

Everything aggregates inside Spark; only tiny results (a KPI row, a few
groups) are meant to reach the driver (S14 ``collect_report``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S


def _exact_sum_to_double(x: Column) -> Column:
    return F.sum(x).cast("double")


def side_by_side(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Columns of several one-row aggregates in one row. ``first`` is the row;
    every other frame becomes one scalar subquery (a struct of its columns)
    that runs once -- no join and no cartesian product. Each frame must be a
    global aggregate (exactly one row)."""
    out = first.select("*", *[o.select(F.struct(*o.columns)).scalar().alias(f"_one{i}")
                              for i, o in enumerate(others)])
    return out.select(*[first[c] for c in first.columns],
                      *[F.col(f"_one{i}.{c}").alias(c) for i, o in enumerate(others) for c in o.columns])


# --- P5 / P6 ------------------------------------------------------------------------
def report_filter(df: DataFrame, traders: Sequence[str] | None = None, books=None, counterparties=None,
                  products=None, currencies=None, statuses=None, trade_range=None,
                  maturity_range=None) -> DataFrame:
    """AND of optional IN-lists (an empty or missing list = no filter) and two
    inclusive date ranges, each applied only when both ends are set.
    Filters are plain predicates: on the stored fact they pass the report's
    projections and reach the Parquet scan, whose files are sorted by maturity
    date; on a report derived from the replay they sit above its joins."""
    cond = F.lit(True)
    for col, values in (("trader", traders), ("book", books), ("counterparty", counterparties),
                        ("product_type", products), ("currency", currencies), ("trade_status", statuses)):
        if values:
            cond = cond & F.col(col).isin(list(values))
    for col, rng in (("trade_date", trade_range), ("maturity_date", maturity_range)):
        if rng is not None and len(rng) == 2 and rng[0] is not None and rng[1] is not None:
            cond = cond & F.col(col).between(S.lit_date(rng[0]), S.lit_date(rng[1]))
    return df.filter(cond)


# --- A3 ----------------------------------------------------------------------------------
def rejects_by_reason(rejected: DataFrame) -> DataFrame:
    return (rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("reject_count"))
            .orderBy(F.col("reject_count").desc(), F.col("reject_reason")))


# --- A5 / A7 ------------------------------------------------------------------------------
def _notional_by_exact(report: DataFrame, dim: str) -> DataFrame:
    return (report.filter(F.col(dim).isNotNull())
            .groupBy(dim)
            .agg(F.coalesce(F.sum(S.to_usd_exact("notional", "currency")), F.lit(0).cast("decimal(38,6)"))
                 .alias("notional_usd_exact")))


def notional_by(report: DataFrame, dim: str) -> DataFrame:
    """USD notional per group, largest first. NULL groups are dropped and an
    all-NULL group sums to 0 (the report's pandas semantics); sums are exact."""
    return (_notional_by_exact(report, dim)
            .select(dim, F.col("notional_usd_exact").cast("double").alias("notional_usd"))
            .orderBy(F.col("notional_usd").desc(), F.col(dim)))


def top_share(report: DataFrame, dim: str) -> DataFrame:
    """Largest group by USD notional and its share of the total (0 when the
    total is 0). Ties go to the smallest group name."""
    g = _notional_by_exact(report, dim)
    best = F.min_by(F.struct(F.col(dim).alias("top_value"), F.col("notional_usd_exact").alias("top_exact")),
                    F.struct(-F.col("notional_usd_exact"), F.col(dim)))
    out = g.agg(best.alias("b"), F.sum("notional_usd_exact").alias("total_exact"))
    top = F.col("b.top_exact").cast("double")
    total = F.col("total_exact").cast("double")
    share = F.when(total != 0, top / total * 100).otherwise(F.lit(0.0))
    return out.select(F.col("b.top_value").alias(f"top_{dim}"), top.alias("top_notional_usd"),
                      total.alias("total_notional_usd"), F.round(share, 6).alias("top_pct"))


def top_reject_share(rejected: DataFrame) -> DataFrame:
    g = rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("reject_count"))
    best = F.min_by(F.struct(F.col("reject_reason").alias("top_reason"), F.col("reject_count").alias("top_count")),
                    F.struct(-F.col("reject_count"), F.col("reject_reason")))
    out = g.agg(best.alias("b"), F.sum("reject_count").alias("total_rejects"))
    return out.select("b.top_reason", "b.top_count", "total_rejects",
                      F.round(F.col("b.top_count") / F.col("total_rejects") * 100, 6).alias("top_pct"))


# --- A6 ----------------------------------------------------------------------------------------
def kpis(report: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row: trades, active, expired, USD notional, active %, all-time rejects."""
    k = report.agg(
        F.count(F.lit(1)).alias("trade_count"),
        F.count_if(F.col("trade_status") == K.ACTIVE).alias("active_count"),
        F.coalesce(_exact_sum_to_double(S.to_usd_exact("notional", "currency")), F.lit(0.0)).alias("total_notional_usd"),
    )
    r = rejected.agg(F.count(F.lit(1)).alias("rejected_all_time"))
    return side_by_side(k, r).select(
        "trade_count", "active_count",
        (F.col("trade_count") - F.col("active_count")).alias("expired_count"),
        "total_notional_usd",
        F.when(F.col("trade_count") > 0,
               F.col("active_count").cast("double") / F.col("trade_count").cast("double") * 100)
        .alias("active_pct_raw"),
        "rejected_all_time",
    ).select("trade_count", "active_count", "expired_count", "total_notional_usd",
             F.round(F.col("active_pct_raw"), 6).alias("active_pct"), "rejected_all_time")


# --- A8 / A9 / A10 ---------------------------------------------------------------------------------
def count_by(df: DataFrame, col: str, alias: str = "count") -> DataFrame:
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(alias))


def by_day(report: DataFrame) -> DataFrame:
    return (report.filter(F.col("trade_date").isNotNull()).groupBy(F.col("trade_date").alias("trade_day"))
            .agg(F.count(F.lit(1)).alias("trade_count")).orderBy("trade_day"))


def busiest_day(report: DataFrame) -> DataFrame:
    """Busiest trade day (first on ties) and the number of days in view."""
    d = by_day(report)
    best = F.min_by(F.struct(F.col("trade_day").alias("busiest_day"), F.col("trade_count").alias("busiest_count")),
                    F.struct(-F.col("trade_count"), F.col("trade_day")))
    return d.agg(best.alias("b"), F.count(F.lit(1)).alias("days_in_view")).select(
        "b.busiest_day", "b.busiest_count", "days_in_view")


FILTER_COLUMNS = ("trader", "book", "counterparty", "product_type", "currency")


def filter_options(report: DataFrame, columns: Sequence[str] = FILTER_COLUMNS) -> DataFrame:
    """Distinct sorted options of every filter column, as (filter_column, option)."""
    stacked = report.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("filter_column"), F.col(c).cast("string").alias("option")) for c in columns
    ])).alias("o")).select("o.*")
    return stacked.filter(F.col("option").isNotNull()).distinct().orderBy("filter_column", "option")


def filter_bounds(report: DataFrame) -> DataFrame:
    return report.agg(F.min("trade_date").alias("min_trade_date"), F.max("trade_date").alias("max_trade_date"),
                      F.min("maturity_date").alias("min_maturity_date"),
                      F.max("maturity_date").alias("max_maturity_date"))


# --- C12 -----------------------------------------------------------------------------------------
def headline(report: DataFrame, rejected: DataFrame) -> DataFrame:
    """The numbers of the summary sentence and captions in one row."""
    k = kpis(report, rejected)
    p = top_share(report, "product_type").select("top_product_type", F.col("top_pct").alias("top_product_pct"),
                                                 F.col("top_notional_usd").alias("top_product_notional_usd"))
    c = top_share(report, "currency").select("top_currency", F.col("top_pct").alias("top_currency_pct"))
    r = top_reject_share(rejected).select("top_reason", F.col("top_pct").alias("top_reason_pct"))
    d = busiest_day(report)
    return (side_by_side(k, p, c, r, d)
            .select("trade_count", "total_notional_usd", "active_pct", "top_product_type",
                    "top_product_notional_usd", F.round("top_product_pct", 6).alias("top_product_pct"),
                    "top_currency", F.round("top_currency_pct", 6).alias("top_currency_pct"),
                    "top_reason", F.round("top_reason_pct", 6).alias("top_reason_pct"),
                    "days_in_view", "busiest_day", "busiest_count"))


def collect_report(df: DataFrame, limit: int = 10000) -> list:
    """The rows of an already-aggregated result, refusing more than
    ``limit`` instead of silently truncating."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"result has more than {limit} rows; aggregate further before collecting")
    return rows
