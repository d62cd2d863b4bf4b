"""Registered queries: star schema, status/report views and report analytics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S
from ..operators import report as R
from ..operators import star as ST
from ..sources import tables as T
from . import oracle as O
from .catalog import query
from .queries_core import decision_log, decisions
from .store import BOUNDS, store

# Filter values for the report-filter queries (parameters, not data caps).
FILTER_CURRENCIES = ("EUR", "GBP", "XXX")
FILTER_STATUSES = (K.ACTIVE,)
TRADE_RANGE = (dt.date(1996, 1, 1), dt.date(1997, 12, 31))
MATURITY_RANGE = (dt.date(1998, 7, 1), dt.date(1999, 6, 30))


def valid(spark, sf_dir):
    """The stored book of valid deals, sorted by maturity date inside its files."""
    return store(spark, sf_dir).valid()


def rejected(spark, sf_dir):
    """The stored reject log."""
    return store(spark, sf_dir).rejected()


def status(spark, sf_dir):
    return store(spark, sf_dir).status(T.REPORT_AS_OF)


def report(spark, sf_dir):
    return store(spark, sf_dir).report(T.REPORT_AS_OF)


for _name, (_nat, _key, _label) in ST.DIM_SPECS.items():
    def _make(nat=_nat, key=_key, label=_label):
        def fn(spark, sf_dir):
            return ST.build_dim(decision_log(spark, sf_dir), nat, key, label)
        return fn
    query(f"dim_{_name}", O.with_star(f"SELECT * FROM dim_{_name}"))(_make())


@query("dim_product", O.with_star("SELECT * FROM dim_product"))
def q_dim_product(spark, sf_dir):
    """Products of the feed left-joined to the reference seed, loaded from its
    CSV file (S7)."""
    from ..session import unique_dir

    seed = unique_dir(spark, "seeds", "product_reference")
    ST.product_reference(spark).coalesce(1).write.option("header", True).csv(seed)
    return ST.build_dim_product(decision_log(spark, sf_dir), ST.load_reference(spark, seed))


@query("dim_date", O.with_decisions(
    """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date_day,
         CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
         CAST(month(d) AS INTEGER) AS month, strftime(d, '%b') AS month_name,
         CAST(day(d) AS INTEGER) AS day_of_month, strftime(d, '%a') AS day_name,
         strftime(d, '%a') IN ('Sat', 'Sun') AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
        FROM (SELECT make_date(CAST(min(least(trade_date, maturity_date)) AS DATE).year(), 1, 1)::TIMESTAMP AS lo,
                     make_date(CAST(max(greatest(trade_date, maturity_date)) AS DATE).year(), 12, 31)::TIMESTAMP AS hi
              FROM decisions))"""))
def q_dim_date(spark, sf_dir):
    """Calendar of whole years spanning every trade and maturity date of the feed."""
    return ST.dim_date_for(decision_log(spark, sf_dir), ("trade_date", "maturity_date"))


@query("valid_fact", O.with_star("SELECT * FROM valid_fact"))
def q_valid_fact(spark, sf_dir):
    """Full build from the replay (S11); ``valid_fact_incremental`` merges it run by run."""
    return ST.build_valid_fact(decisions(spark, sf_dir), BOUNDS)


@query("valid_fact_lookup", O.with_star("SELECT * FROM valid_fact"))
def q_valid_fact_lookup(spark, sf_dir):
    """Same fact through literal dimension joins (J2 as written)."""
    dec = decision_log(spark, sf_dir)
    dims = ST.build_dims(dec)
    dd = ST.dim_date(spark, BOUNDS.start, BOUNDS.end)
    return ST.build_valid_fact(dec, BOUNDS, dims=dims, date_dim=dd, mode="lookup")


@query("rejected_fact", O.with_star("SELECT * FROM rejected_fact"))
def q_rejected_fact(spark, sf_dir):
    return ST.build_rejected_fact(decisions(spark, sf_dir), BOUNDS)


@query("deal_status", O.with_star("SELECT * FROM status"))
def q_deal_status(spark, sf_dir):
    return status(spark, sf_dir)


@query("notional_usd", O.with_star(
    "SELECT trade_id, currency, notional, notional_usd FROM status"))
def q_notional_usd(spark, sf_dir):
    return status(spark, sf_dir).select("trade_id", "currency", "notional", "notional_usd")


@query("deal_report", O.with_star("SELECT * FROM report"))
def q_deal_report(spark, sf_dir):
    return report(spark, sf_dir)


@query("deal_report_lookup", O.with_star("SELECT * FROM report"))
def q_deal_report_lookup(spark, sf_dir):
    """Report with the date dimension joined twice (J3 as written)."""
    dd = ST.dim_date(spark, BOUNDS.start, BOUNDS.end)
    return ST.build_report(status(spark, sf_dir), T.REPORT_AS_OF, BOUNDS, date_dim=dd, mode="lookup")


@query("rejects_by_reason", O.with_star(
    "SELECT reject_reason, count(*) AS reject_count FROM rejected_fact GROUP BY reject_reason"))
def q_rejects_by_reason(spark, sf_dir):
    return R.rejects_by_reason(rejected(spark, sf_dir))


@query("reject_detail", O.with_star(
    "SELECT trade_id, version, trader, book, counterparty, product_type, currency, notional, price, "
    "trade_date, maturity_date, existing_version, reject_reason, logged_at FROM rejected_fact"))
def q_reject_detail(spark, sf_dir):
    cols = ["trade_id", "version", "trader", "book", "counterparty", "product_type", "currency", "notional",
            "price", "trade_date", "maturity_date", "existing_version", "reject_reason", "logged_at"]
    rej = rejected(spark, sf_dir)
    return rej.orderBy(F.col("logged_at").desc(), F.col("message_id")).select(*cols)


def _by_sql(dim: str) -> str:
    return O.with_star(
        f"SELECT {dim}, CAST(coalesce(sum({O.usd_exact()}), 0) AS DOUBLE) AS notional_usd "
        f"FROM report WHERE {dim} IS NOT NULL GROUP BY {dim}")


@query("notional_by_product", _by_sql("product_type"))
def q_notional_by_product(spark, sf_dir):
    return R.notional_by(report(spark, sf_dir), "product_type")


@query("notional_by_currency", _by_sql("currency"))
def q_notional_by_currency(spark, sf_dir):
    return R.notional_by(report(spark, sf_dir), "currency")


def _top_select(dim: str) -> str:
    return (
        f"""SELECT arg_min({dim}, (-s, {dim})) AS top_{dim}, CAST(arg_min(s, (-s, {dim})) AS DOUBLE) AS top_notional_usd,
               CAST(sum(s) AS DOUBLE) AS total_notional_usd,
               round(CASE WHEN CAST(sum(s) AS DOUBLE) <> 0
                          THEN CAST(arg_min(s, (-s, {dim})) AS DOUBLE) / CAST(sum(s) AS DOUBLE) * 100
                          ELSE 0.0 END, 6) AS top_pct
        FROM (SELECT {dim}, coalesce(sum({O.usd_exact()}), 0) AS s FROM report
              WHERE {dim} IS NOT NULL GROUP BY {dim})""")


def _top_sql(dim: str) -> str:
    return O.with_star(_top_select(dim))


@query("top_product_share", _top_sql("product_type"))
def q_top_product_share(spark, sf_dir):
    return R.top_share(report(spark, sf_dir), "product_type")


@query("top_currency_share", _top_sql("currency"))
def q_top_currency_share(spark, sf_dir):
    return R.top_share(report(spark, sf_dir), "currency")


@query("top_reject_share", O.with_star(
    """SELECT arg_min(reject_reason, (-n, reject_reason)) AS top_reason,
              arg_min(n, (-n, reject_reason)) AS top_count, sum(n) AS total_rejects,
              round(arg_min(n, (-n, reject_reason)) / sum(n) * 100, 6) AS top_pct
       FROM (SELECT reject_reason, count(*) AS n FROM rejected_fact GROUP BY reject_reason)"""))
def q_top_reject_share(spark, sf_dir):
    return R.top_reject_share(rejected(spark, sf_dir))


KPI_SQL = f"""SELECT k.trade_count, k.active_count, k.trade_count - k.active_count AS expired_count,
       k.total_notional_usd,
       round(CASE WHEN k.trade_count > 0 THEN CAST(k.active_count AS DOUBLE) / CAST(k.trade_count AS DOUBLE) * 100 END, 6) AS active_pct,
       r.rejected_all_time
FROM (SELECT count(*) AS trade_count, count_if(trade_status = 'ACTIVE') AS active_count,
             CAST(coalesce(sum({O.usd_exact()}), 0) AS DOUBLE) AS total_notional_usd FROM report) k,
     (SELECT count(*) AS rejected_all_time FROM rejected_fact) r"""


@query("kpi_summary", O.with_star(KPI_SQL))
def q_kpi_summary(spark, sf_dir):
    return R.kpis(report(spark, sf_dir), rejected(spark, sf_dir))


@query("status_counts", O.with_star(
    "SELECT trade_status, count(*) AS trade_count FROM report WHERE trade_status IS NOT NULL GROUP BY trade_status"))
def q_status_counts(spark, sf_dir):
    return R.count_by(report(spark, sf_dir), "trade_status", "trade_count")


@query("deals_by_day", O.with_star(
    "SELECT trade_date AS trade_day, count(*) AS trade_count FROM report GROUP BY trade_date"))
def q_deals_by_day(spark, sf_dir):
    return R.by_day(report(spark, sf_dir))


BUSIEST_SQL = """SELECT arg_min(trade_day, (-trade_count, trade_day)) AS busiest_day,
       arg_min(trade_count, (-trade_count, trade_day)) AS busiest_count, count(*) AS days_in_view
FROM (SELECT trade_date AS trade_day, count(*) AS trade_count FROM report GROUP BY trade_date)"""


@query("busiest_day", O.with_star(BUSIEST_SQL))
def q_busiest_day(spark, sf_dir):
    return R.busiest_day(report(spark, sf_dir))


@query("collected_totals", _by_sql("product_type"))
def q_collected_totals(spark, sf_dir):
    """The totals by product brought to the driver under a stated bound, as a page of the report does."""
    totals = R.notional_by(report(spark, sf_dir), "product_type")
    return spark.createDataFrame(R.collect_report(totals, limit=1000), totals.schema)


@query("filter_options", O.with_star(
    " UNION ".join(f"SELECT '{c}' AS filter_column, CAST({c} AS VARCHAR) AS option FROM report WHERE {c} IS NOT NULL"
                   for c in R.FILTER_COLUMNS)))
def q_filter_options(spark, sf_dir):
    return R.filter_options(report(spark, sf_dir))


@query("filter_bounds", O.with_star(
    "SELECT min(trade_date) AS min_trade_date, max(trade_date) AS max_trade_date, "
    "min(maturity_date) AS min_maturity_date, max(maturity_date) AS max_maturity_date FROM report"))
def q_filter_bounds(spark, sf_dir):
    return R.filter_bounds(report(spark, sf_dir))


@query("report_filter_in", O.with_star(
    "SELECT * FROM report WHERE currency IN ('EUR', 'GBP', 'XXX') AND trade_status IN ('ACTIVE')"))
def q_report_filter_in(spark, sf_dir):
    # traders/books/... lists empty: no filter on those columns
    return R.report_filter(report(spark, sf_dir), traders=[], books=None,
                           currencies=FILTER_CURRENCIES, statuses=FILTER_STATUSES)


@query("report_filter_range", O.with_star(
    f"SELECT * FROM report WHERE trade_date BETWEEN DATE '{TRADE_RANGE[0]}' AND DATE '{TRADE_RANGE[1]}' "
    f"AND maturity_date BETWEEN DATE '{MATURITY_RANGE[0]}' AND DATE '{MATURITY_RANGE[1]}'"))
def q_report_filter_range(spark, sf_dir):
    # a half-open range (one end None) is ignored, as in the report
    return R.report_filter(report(spark, sf_dir), trade_range=TRADE_RANGE, maturity_range=MATURITY_RANGE,
                           statuses=[])


@query("headline", O.with_star(
    "SELECT k.trade_count, k.total_notional_usd, k.active_pct, p.top_product_type, "
    "p.top_notional_usd AS top_product_notional_usd, p.top_pct AS top_product_pct, "
    "c.top_currency, c.top_pct AS top_currency_pct, r.top_reason, r.top_pct AS top_reason_pct, "
    "d.days_in_view, d.busiest_day, d.busiest_count "
    "FROM kpi k, top_p p, top_c c, top_r r, busiest d",
    "kpi AS (" + KPI_SQL + ")",
    "top_p AS (" + _top_select("product_type") + ")",
    "top_c AS (" + _top_select("currency") + ")",
    """top_r AS (SELECT arg_min(reject_reason, (-n, reject_reason)) AS top_reason,
              round(arg_min(n, (-n, reject_reason)) / sum(n) * 100, 6) AS top_pct
       FROM (SELECT reject_reason, count(*) AS n FROM rejected_fact GROUP BY reject_reason))""",
    "busiest AS (" + BUSIEST_SQL + ")"))
def q_headline(spark, sf_dir):
    return R.headline(report(spark, sf_dir), rejected(spark, sf_dir))


@query("format_money", O.with_star(
    """SELECT product_type, notional_usd,
         CASE WHEN abs(notional_usd) >= 1e12 THEN (CASE WHEN notional_usd < 0 THEN '-' ELSE '' END) || '$' || printf('%,.2f', round(abs(notional_usd) / 1e12, 2)) || 'T'
              WHEN abs(notional_usd) >= 1e9 THEN (CASE WHEN notional_usd < 0 THEN '-' ELSE '' END) || '$' || printf('%,.2f', round(abs(notional_usd) / 1e9, 2)) || 'B'
              WHEN abs(notional_usd) >= 1e6 THEN (CASE WHEN notional_usd < 0 THEN '-' ELSE '' END) || '$' || printf('%,.2f', round(abs(notional_usd) / 1e6, 2)) || 'M'
              WHEN abs(notional_usd) >= 1e3 THEN (CASE WHEN notional_usd < 0 THEN '-' ELSE '' END) || '$' || printf('%,.2f', round(abs(notional_usd) / 1e3, 2)) || 'K'
              ELSE (CASE WHEN notional_usd < 0 THEN '-' ELSE '' END) || '$' || printf('%,.0f', round(abs(notional_usd), 0)) END AS notional_text
       FROM (SELECT product_type, CAST(coalesce(sum(""" + O.usd_exact() + """), 0) AS DOUBLE) AS notional_usd
             FROM report WHERE product_type IS NOT NULL GROUP BY product_type
             UNION ALL
             SELECT 'TRADE:' || CAST(trade_id AS VARCHAR), notional_usd FROM report WHERE notional_usd IS NOT NULL)"""))
def q_format_money(spark, sf_dir):
    """Compact money text for every group total and every deal's USD notional."""
    rep = report(spark, sf_dir)
    groups = R.notional_by(rep, "product_type")
    deals = rep.filter(F.col("notional_usd").isNotNull()).select(
        F.concat(F.lit("TRADE:"), F.col("trade_id").cast("string")).alias("product_type"), "notional_usd")
    both = groups.unionByName(deals)
    return both.select("product_type", "notional_usd", S.format_money("notional_usd").alias("notional_text"))
