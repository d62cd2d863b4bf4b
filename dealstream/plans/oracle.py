"""Reference SQL (DuckDB dialect) for every registered query.

Each text is self-contained: it starts from the raw views ``lineitem``,
``orders`` ... ``events`` and rebuilds the adapter and every intermediate
table with plain SQL windows and joins, independently of the DataFrame code.
"""

from __future__ import annotations

from ..sources import tables as T

LOAD_BASE = f"TIMESTAMP '{T.LOAD_BASE:%Y-%m-%d %H:%M:%S}'"
AS_OF = f"DATE '{T.AS_OF:%Y-%m-%d}'"
REPORT_AS_OF = f"DATE '{T.REPORT_AS_OF:%Y-%m-%d}'"
NOW = f"TIMESTAMP '{T.RUN_LOG_NOW:%Y-%m-%d %H:%M:%S}'"

_CURRENCY = "CASE l_suppkey % 7 " + " ".join(
    f"WHEN {i} THEN '{c}'" for i, c in enumerate(T.CURRENCY_BY_SUPPLIER_MOD7[:-1])
) + f" ELSE '{T.CURRENCY_BY_SUPPLIER_MOD7[-1]}' END"

CTE_MESSAGES = f"""
msg AS (
  SELECT md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
             CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
             CAST(CAST(l_shipdate AS DATE) AS VARCHAR))) AS message_id,
         l_orderkey AS trade_id,
         CAST(l_linenumber AS BIGINT) AS version,
         '{T.SOURCE_SYSTEM}' AS source_system,
         o_orderdate + to_minutes(l_suppkey) AS event_timestamp,
         CAST(o_orderdate AS DATE) AS trade_date,
         CAST(l_shipdate AS DATE) AS maturity_date,
         p_type AS product_type, n_name AS counterparty, s_name AS trader, c_mktsegment AS book,
         {_CURRENCY} AS currency,
         l_extendedprice AS notional, l_quantity AS price,
         CAST(l_partkey % {T.N_BATCHES} AS BIGINT) AS batch_id,
         l_returnflag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey
       JOIN part ON l_partkey = p_partkey
       JOIN supplier ON l_suppkey = s_suppkey
),
deliveries AS (
  SELECT * EXCLUDE (l_returnflag),
         'deals_b' || CAST(batch_id AS VARCHAR) || '.jsonl' AS file_name,
         {LOAD_BASE} + to_hours(batch_id) AS loaded_at
  FROM msg
  UNION ALL
  SELECT * EXCLUDE (l_returnflag),
         'redelivery_b' || CAST(batch_id AS VARCHAR) || '.jsonl' AS file_name,
         {LOAD_BASE} + to_hours(batch_id) + to_minutes({T.REDELIVERY_DELAY_MINUTES}) AS loaded_at
  FROM msg WHERE l_returnflag = 'R'
),
staged AS (
  SELECT * FROM deliveries
  QUALIFY row_number() OVER (PARTITION BY message_id ORDER BY loaded_at ASC NULLS LAST, file_name ASC NULLS LAST) = 1
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY trade_id, batch_id
             ORDER BY version DESC NULLS FIRST, event_timestamp DESC NULLS FIRST,
                      loaded_at DESC NULLS FIRST, message_id ASC) AS rank_in_batch
  FROM staged
),
with_existing AS (
  SELECT *, max(CASE WHEN rank_in_batch = 1 AND NOT coalesce(maturity_date < {AS_OF}, false)
                     THEN version END)
            OVER (PARTITION BY trade_id ORDER BY batch_id
                  RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS existing_version
  FROM ranked
),
ruled AS (
  SELECT *, list_position([rank_in_batch > 1, coalesce(maturity_date < {AS_OF}, false), coalesce(version < existing_version, false),
                           coalesce(version = existing_version, false), true], true) AS rule
  FROM with_existing
),
decisions AS (
  SELECT * EXCLUDE (rank_in_batch, rule, loaded_at) REPLACE (CAST(existing_version AS BIGINT) AS existing_version),
         loaded_at AS source_loaded_at,
         CASE WHEN rule <= 3 THEN 'REJECTED' ELSE 'ACCEPTED' END AS decision,
         ['SUPERSEDED_IN_BATCH', 'MATURITY_DATE_IN_PAST', 'STALE_VERSION_LOWER_THAN_EXISTING',
          'REPLACED_SAME_VERSION', 'NEW_TRADE_ACCEPTED'][rule] AS decision_reason,
         loaded_at + to_minutes({T.EVALUATION_DELAY_MINUTES}) AS evaluated_at
  FROM ruled
)"""


def with_decisions(select_sql: str, *extra_ctes: str) -> str:
    """``WITH <adapter + decisions> [, extra] <select>``."""
    ctes = CTE_MESSAGES
    for e in extra_ctes:
        ctes += ",\n" + e
    return f"WITH {ctes}\n{select_sql}"


DECISION_COLS = ("trade_id, version, message_id, source_system, event_timestamp, trade_date, "
                 "maturity_date, product_type, counterparty, trader, book, currency, notional, "
                 "price, file_name, source_loaded_at, batch_id, existing_version, decision, "
                 "decision_reason, evaluated_at")


# --- star schema -------------------------------------------------------------
_START = f"DATE '{T.DATE_DIM_START:%Y-%m-%d}'"
_END = f"DATE '{T.DATE_DIM_END:%Y-%m-%d}'"


def _usd(amount: str = "notional", ccy: str = "currency") -> str:
    from .. import constants as K
    return "CASE " + ccy + " " + " ".join(
        f"WHEN '{c}' THEN {amount} * CAST({r!r} AS DOUBLE)" for c, r in K.STATIC_RATES_TO_USD.items()
    ) + " ELSE NULL END"


def usd_exact(amount: str = "notional", ccy: str = "currency") -> str:
    from .. import constants as K
    return "CASE " + ccy + " " + " ".join(
        f"WHEN '{c}' THEN CAST({amount} AS DECIMAL(18,2)) * CAST('{r}' AS DECIMAL(10,4))"
        for c, r in K.STATIC_RATES_TO_USD.items()
    ) + " END"


def _dim(name: str, nat: str, key: str, label: str) -> str:
    return (f"dim_{name} AS (SELECT md5(coalesce(CAST({label} AS VARCHAR), '__null__')) AS {key}, {label} "
            f"FROM (SELECT DISTINCT {nat} AS {label} FROM decisions WHERE {nat} IS NOT NULL))")


def _product_ref() -> str:
    from .. import constants as K
    rows = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in r) + ")"
                     for r in K.PRODUCT_REFERENCE_ROWS)
    return f"product_reference AS (SELECT * FROM (VALUES {rows}) AS t({', '.join(K.PRODUCT_REFERENCE_COLUMNS)}))"


#: Output columns of the facts that come straight from a decision.
_FACT_COLUMNS = ("trade_id, version, message_id, source_system, event_timestamp, trade_date, maturity_date, product_type, "
                 "counterparty, trader, book, currency, notional, price, file_name, source_loaded_at")
_KEYED = ("product", "product_type"), ("counterparty", "counterparty"), ("trader", "trader"), ("book", "book"), ("currency", "currency")


def _fact_select(src: str, tail: str) -> str:
    """Keys are looked up in one stacked (dimension, value) -> key table, as scalar subqueries."""
    keys = ", ".join(f"(SELECT key FROM key_of WHERE dimension = '{d}' AND value = {col}) AS {d}_key" for d, col in _KEYED)
    dates = ", ".join(f"(SELECT date_key FROM dim_date WHERE date_day = {c}) AS {c}_key" for c in ("trade_date", "maturity_date"))
    return f"SELECT {_FACT_COLUMNS}, {keys}, {dates}, {tail} FROM {src}"


STAR_CTES = [
    f"""dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date_day,
         CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
         CAST(month(d) AS INTEGER) AS month, strftime(d, '%b') AS month_name,
         CAST(day(d) AS INTEGER) AS day_of_month, strftime(d, '%a') AS day_name,
         strftime(d, '%a') IN ('Sat', 'Sun') AS is_weekend
  FROM (SELECT CAST(range AS DATE) AS d FROM range({_START}, {_END}, INTERVAL 1 DAY)))""",
    _dim("trader", "trader", "trader_key", "trader_name"),
    _dim("book", "book", "book_key", "book_name"),
    _dim("counterparty", "counterparty", "counterparty_key", "counterparty_name"),
    _dim("currency", "currency", "currency_key", "currency_code"),
    _product_ref(),
    """dim_product AS (
  SELECT md5(coalesce(CAST(d.product_type AS VARCHAR), '__null__')) AS product_key, d.product_type,
         r.product_name, r.asset_class, r.trade_date_meaning, r.maturity_date_meaning, r.notes
  FROM (SELECT DISTINCT product_type FROM decisions WHERE product_type IS NOT NULL) d
  LEFT JOIN product_reference r ON d.product_type = r.product_type)""",
    """latest_accepted AS (
  SELECT * FROM decisions WHERE decision = 'ACCEPTED'
  QUALIFY row_number() OVER (PARTITION BY trade_id ORDER BY batch_id DESC, evaluated_at DESC, message_id) = 1)""",
    """key_of AS (SELECT 'product' AS dimension, product_type AS value, product_key AS key FROM dim_product
  UNION ALL SELECT 'counterparty', counterparty_name, counterparty_key FROM dim_counterparty
  UNION ALL SELECT 'trader', trader_name, trader_key FROM dim_trader
  UNION ALL SELECT 'book', book_name, book_key FROM dim_book
  UNION ALL SELECT 'currency', currency_code, currency_key FROM dim_currency)""",
    "valid_fact AS (" + _fact_select("latest_accepted", "evaluated_at, evaluated_at AS processed_at") + ")",
    "rejected_fact AS (" + _fact_select(
        "(SELECT * FROM decisions WHERE decision = 'REJECTED')",
        "existing_version, decision_reason AS reject_reason, evaluated_at, evaluated_at AS logged_at") + ")",
    f"""status AS (
  SELECT trade_id, version, product_key, product_type, counterparty_key, counterparty, trader_key, trader,
         book_key, book, currency_key, currency, notional, {_usd()} AS notional_usd, price, trade_date,
         trade_date_key, maturity_date, maturity_date_key,
         CASE WHEN maturity_date < {REPORT_AS_OF} THEN 'EXPIRED' ELSE 'ACTIVE' END AS trade_status, processed_at
  FROM valid_fact)""",
    f"""report AS (
  SELECT s.trade_id, s.version, s.trader, s.book, s.counterparty, s.product_type, s.currency, s.notional,
         s.notional_usd, s.price, s.trade_date, td.year AS trade_year, td.quarter AS trade_quarter,
         td.month_name AS trade_month_name, s.maturity_date, md.year AS maturity_year,
         md.quarter AS maturity_quarter, md.month_name AS maturity_month_name,
         CAST(datediff('day', {REPORT_AS_OF}, s.maturity_date) AS INTEGER) AS days_to_maturity,
         s.trade_status, s.processed_at
  FROM status s LEFT JOIN dim_date td ON s.trade_date = td.date_day
       LEFT JOIN dim_date md ON s.maturity_date = md.date_day)""",
]


def with_star(select_sql: str, *extra_ctes: str) -> str:
    return with_decisions(select_sql, *STAR_CTES, *extra_ctes)


def _fx_base() -> str:
    from .. import constants as K
    return "CASE " + _CURRENCY + " " + " ".join(
        f"WHEN '{c}' THEN CAST({r!r} AS DOUBLE)" for c, r in K.STATIC_RATES_TO_USD.items()) + " END"


FX_RAW_CTE = f"""fx_raw AS (
  SELECT * FROM (
    SELECT CAST(l_shipdate AS DATE) AS as_of_date, {_CURRENCY} AS currency,
           ({_fx_base()}) * (CAST(0.95 AS DOUBLE) + l_discount) AS rate_to_usd,
           'fx_rates_' || strftime(CAST(l_shipdate AS DATE), '%Y%m%d') || '_v' || CAST(l_linenumber AS VARCHAR) || '.csv' AS file_name,
           CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + to_hours(6) + to_minutes(l_linenumber * 10) AS loaded_at
    FROM lineitem) WHERE rate_to_usd IS NOT NULL)"""

FX_LATEST_CTE = """fx_latest AS (
  SELECT as_of_date, currency, rate_to_usd, file_name, loaded_at FROM fx_raw
  QUALIFY row_number() OVER (PARTITION BY as_of_date, currency
                             ORDER BY loaded_at DESC NULLS LAST, file_name DESC NULLS LAST, rate_to_usd DESC NULLS LAST) = 1)"""


RUN_LOG_CTE = """run_log AS (
  SELECT event_id AS run_id, 'TASK_' || CAST(user_id % 5 AS VARCHAR) AS object_name,
         CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'SKIPPED' ELSE 'SUCCEEDED' END AS state,
         ts AS scheduled_time, value AS elapsed,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS parts_scanned,
         CASE WHEN user_id % 10 = 0 THEN 0 ELSE 100 END AS parts_total,
         event_type, user_id, props
  FROM events)"""


def window_pred(hours: float, col: str = "scheduled_time") -> str:
    return (f"{col} > {NOW} - INTERVAL '{int(hours * 60)} minutes' AND {col} <= {NOW}")


def with_log(select_sql: str, *extra: str) -> str:
    ctes = RUN_LOG_CTE
    for e in extra:
        ctes += ",\n" + e
    return f"WITH {ctes}\n{select_sql}"
