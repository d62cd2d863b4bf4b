"""Registered queries: data quality, serving, SCD-2 history, keyed state,
as-of views and diffs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S
from ..operators import quality as Q
from ..operators import scd as SCD
from ..operators import serve as SV
from ..operators import star as ST
from ..operators import state as STT
from ..session import unique_dir
from ..sources import tables as T
from . import oracle as O
from .catalog import query
from .queries_core import decision_log, decisions, deliveries
from .queries_star import BOUNDS, rejected, report, status, valid

# --- fixed values: snapshot schedule (after batch 1 and after batch 3) -------
SNAPSHOTS = ((1, T.LOAD_BASE + dt.timedelta(hours=2)), (3, T.LOAD_BASE + dt.timedelta(hours=4)))
AS_OF_BATCH = 1                      # state "just before" the later batches
TODAY = T.AS_OF                      # the day the reject log is inspected
FX_SPLIT = dt.datetime(1997, 1, 1)   # FX loads before this form the prior state


# --- data quality ---------------------------------------------------------------------
@query("dq_not_null", O.with_star("SELECT * FROM report WHERE notional_usd IS NULL"))
def q_dq_not_null(spark, sf_dir):
    """notional_usd is declared not NULL: deals in a currency without a rate fail."""
    return Q.check_not_null(report(spark, sf_dir), "notional_usd")


@query("dq_unique", O.with_decisions(
    "SELECT message_id, count(*) AS n_records FROM deliveries WHERE message_id IS NOT NULL "
    "GROUP BY message_id HAVING count(*) > 1"))
def q_dq_unique(spark, sf_dir):
    """message_id uniqueness on the raw landing: every redelivery is reported."""
    return Q.check_unique(deliveries(spark, sf_dir), "message_id")


@query("dq_accepted_values", O.with_star(
    "SELECT * FROM report WHERE currency IS NOT NULL AND currency NOT IN ("
    + ", ".join(f"'{c}'" for c in K.STATIC_RATES_TO_USD) + ")"))
def q_dq_accepted_values(spark, sf_dir):
    return Q.check_accepted(report(spark, sf_dir), "currency", list(K.STATIC_RATES_TO_USD))


@query("dq_relationships", O.with_star(
    "SELECT f.* FROM valid_fact f WHERE f.trader_key IS NOT NULL "
    "AND NOT EXISTS (SELECT 1 FROM dim_trader d WHERE d.trader_key = f.trader_key)"))
def q_dq_relationships(spark, sf_dir):
    dec = decision_log(spark, sf_dir)
    return Q.check_relationship(valid(spark, sf_dir), "trader_key", ST.build_dim(dec, *ST.DIM_SPECS["trader"]),
                                "trader_key")


@query("dq_relationships_missing", O.with_star(
    "SELECT f.trade_id, f.trader FROM valid_fact f WHERE f.trader_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_trader d "
    "WHERE d.trader_key = f.trader_key AND d.trader_name <> (SELECT min(trader_name) FROM dim_trader))"))
def q_dq_relationships_missing(spark, sf_dir):
    """The same check against a dimension that lacks its first trader."""
    dec = decision_log(spark, sf_dir)
    dim = ST.build_dim(dec, *ST.DIM_SPECS["trader"])
    first = dim.agg(F.min("trader_name")).first()[0]
    return Q.check_relationship(valid(spark, sf_dir), "trader_key", dim.filter(F.col("trader_name") != first),
                                "trader_key").select("trade_id", "trader")


@query("dq_unique_combo", O.with_decisions(
    "SELECT as_of_date, currency, count(*) AS n_records FROM fx_raw GROUP BY as_of_date, currency "
    "HAVING count(*) > 1", O.FX_RAW_CTE))
def q_dq_unique_combo(spark, sf_dir):
    """(as_of_date, currency) on the FX landing, before latest-wins."""
    return Q.check_unique_combo(T.fx_rates_raw(spark, sf_dir), ("as_of_date", "currency"))


_STALE = "'STALE_VERSION_LOWER_THAN_EXISTING'"


@query("invariant_stale_reject", O.with_star(
    f"SELECT v.trade_id, v.version AS valid_version, r.version AS rejected_version, r.reject_reason "
    f"FROM valid_fact v JOIN rejected_fact r ON v.trade_id = r.trade_id "
    f"WHERE r.reject_reason = {_STALE} AND r.version >= v.version"))
def q_invariant_stale_reject(spark, sf_dir):
    return Q.stale_reject_violations(valid(spark, sf_dir), rejected(spark, sf_dir), ">=")


@query("theta_join_versions", O.with_star(
    f"SELECT v.trade_id, v.version AS valid_version, r.version AS rejected_version, r.reject_reason "
    f"FROM valid_fact v JOIN rejected_fact r ON v.trade_id = r.trade_id "
    f"WHERE r.reject_reason = {_STALE} AND r.version < v.version"))
def q_theta_join_versions(spark, sf_dir):
    return Q.stale_reject_violations(valid(spark, sf_dir), rejected(spark, sf_dir), "<")


def suite_spec():
    dims = [Q.TableChecks(f"dim_{n}", not_null=(k, nm), unique=(k, nm)) for n, (_, k, nm) in ST.DIM_SPECS.items()]
    dims.append(Q.TableChecks("dim_product", not_null=("product_key", "product_type"),
                              unique=("product_key", "product_type")))
    dims.append(Q.TableChecks("dim_date", not_null=("date_key", "date_day"), unique=("date_key", "date_day")))
    fk = {"trader_key": ("dim_trader", "trader_key"), "book_key": ("dim_book", "book_key"),
          "counterparty_key": ("dim_counterparty", "counterparty_key"),
          "product_key": ("dim_product", "product_key"), "currency_key": ("dim_currency", "currency_key"),
          "trade_date_key": ("dim_date", "date_key"), "maturity_date_key": ("dim_date", "date_key")}
    return dims + [
        Q.TableChecks("stg", not_null=("message_id", "trade_id", "version", "maturity_date"), unique=("message_id",)),
        Q.TableChecks("fx_rates", not_null=("as_of_date", "currency", "rate_to_usd"),
                      unique_combos=(("as_of_date", "currency"),)),
        Q.TableChecks("product_reference", not_null=("product_type",), unique=("product_type",)),
        Q.TableChecks("valid_fact", not_null=("trade_id", "version", "maturity_date") + tuple(fk),
                      unique=("trade_id",), relationships=fk),
        Q.TableChecks("rejected_fact", not_null=("message_id", "reject_reason"), unique=("message_id",),
                      accepted={"reject_reason": sorted(K.REJECT_REASONS)},
                      relationships={"trader_key": ("dim_trader", "trader_key")}),
        Q.TableChecks("deal_status", not_null=("trade_id", "trade_status", "notional_usd"),
                      accepted={"trade_status": [K.ACTIVE, K.EXPIRED]}),
        Q.TableChecks("deal_report", not_null=("trade_id", "trade_status", "notional_usd", "days_to_maturity"),
                      accepted={"trade_status": [K.ACTIVE, K.EXPIRED]}),
    ]


def _suite_sql() -> str:
    parts = []
    view = {"stg": "staged", "fx_rates": "fx_latest", "deal_status": "status", "deal_report": "report"}
    for t in suite_spec():
        v = view.get(t.table, t.table)
        for c in t.not_null:
            parts.append(f"SELECT '{t.table}' AS table_name, 'not_null' AS check_name, '{c}' AS column_name, "
                         f"CAST(count_if({c} IS NULL) AS BIGINT) AS failures FROM {v}")
        for c, vals in t.accepted.items():
            lst = ", ".join(f"'{x}'" for x in vals)
            parts.append(f"SELECT '{t.table}', 'accepted_values', '{c}', "
                         f"CAST(count_if({c} IS NOT NULL AND {c} NOT IN ({lst})) AS BIGINT) FROM {v}")
        for c in t.unique:
            parts.append(f"SELECT '{t.table}', 'unique', '{c}', CAST(count(*) AS BIGINT) FROM "
                         f"(SELECT {c} FROM {v} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
        for c, (pt, pk) in t.relationships.items():
            parts.append(f"SELECT '{t.table}', 'relationships', '{c}', CAST(count(*) AS BIGINT) FROM {v} x "
                         f"WHERE x.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {pt} p WHERE p.{pk} = x.{c})")
        for cols in t.unique_combos:
            cl = ", ".join(cols)
            parts.append(f"SELECT '{t.table}', 'unique_combination', '{','.join(cols)}', CAST(count(*) AS BIGINT) "
                         f"FROM (SELECT {cl} FROM {v} GROUP BY {cl} HAVING count(*) > 1)")
    return O.with_star("\nUNION ALL\n".join(parts), O.FX_RAW_CTE, O.FX_LATEST_CTE)


@query("dq_report", _suite_sql())
def q_dq_report(spark, sf_dir):
    dec = decision_log(spark, sf_dir)
    tables = {f"dim_{n}": ST.build_dim(dec, *spec) for n, spec in ST.DIM_SPECS.items()}
    tables["dim_product"] = ST.build_dim_product(dec, ST.product_reference(spark))
    tables["dim_date"] = ST.dim_date(spark, BOUNDS.start, BOUNDS.end)
    # staging = one row per first-arrived message: exactly the decision log's message columns
    tables["stg"] = dec.withColumnRenamed("source_loaded_at", "loaded_at")
    # The FX state, which several checks read, is written once; the facts are stored tables.
    tables["fx_rates"] = STT.materialize(STT.latest_rate(T.fx_rates_raw(spark, sf_dir)),
                                         unique_dir(spark, "tables", "fx_rates"))
    tables["product_reference"] = ST.product_reference(spark)
    tables["valid_fact"] = valid(spark, sf_dir)
    tables["rejected_fact"] = rejected(spark, sf_dir)
    tables["deal_status"] = status(spark, sf_dir)
    tables["deal_report"] = report(spark, sf_dir)
    return Q.run_suite(suite_spec(), tables)


# --- serving -----------------------------------------------------------------------------
def _masked_report_sql() -> str:
    return O.with_star(
        "SELECT trade_id, version, trader, book, "
        "CASE WHEN counterparty IS NULL THEN NULL ELSE 'CPTY_' || upper(substr(md5(counterparty), 1, 6)) END AS counterparty, "
        "product_type, currency, round(notional, -6) AS notional, round(notional_usd, -6) AS notional_usd, price, "
        "trade_date, trade_year, trade_quarter, trade_month_name, maturity_date, maturity_year, maturity_quarter, "
        "maturity_month_name, days_to_maturity, trade_status, processed_at FROM report")


def _serving(spark, sf_dir):
    return {"deal_status": status(spark, sf_dir), "deal_report": report(spark, sf_dir),
            "valid_fact": valid(spark, sf_dir), "rejected_fact": rejected(spark, sf_dir)}


@query("masked_report", _masked_report_sql())
def q_masked_report(spark, sf_dir):
    return SV.serve(_serving(spark, sf_dir), "deal_report", "ANALYST")


@query("full_report", O.with_star("SELECT * FROM report"))
def q_full_report(spark, sf_dir):
    return SV.serve(_serving(spark, sf_dir), "deal_report", "COMPLIANCE")


# --- SCD-2 -------------------------------------------------------------------------------------
def _scd_sql_ctes() -> list[str]:
    sb = " ".join(f"WHEN batch_id <= {b} THEN {b}" for b, _ in SNAPSHOTS)
    sa = " ".join(f"WHEN batch_id <= {b} THEN TIMESTAMP '{t:%Y-%m-%d %H:%M:%S}'" for b, t in SNAPSHOTS)
    chk = ", ".join(K.SCD_CHECK_COLUMNS)
    cols = ", ".join(SCD.SNAPSHOT_COLUMNS)
    return [
        f"""scd_rows AS (
  SELECT *, evaluated_at AS processed_at, CASE {sb} END AS sb, CASE {sa} END AS sa FROM decisions WHERE decision = 'ACCEPTED')""",
        """scd_per_snap AS (
  SELECT * FROM scd_rows WHERE sb IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY trade_id, sb ORDER BY batch_id DESC, message_id) = 1)""",
        f"""scd_changed AS (
  SELECT * FROM (SELECT *, lag(struct_pack({chk})) OVER (PARTITION BY trade_id ORDER BY sb) AS prev,
                        struct_pack({chk}) AS cur FROM scd_per_snap)
  WHERE prev IS DISTINCT FROM cur)""",
        f"""scd_history AS (
  SELECT {cols}, sa AS valid_from,
         lead(sa) OVER (PARTITION BY trade_id ORDER BY sa) AS valid_to,
         md5(CAST(trade_id AS VARCHAR) || '|' || strftime(sa, '%Y-%m-%d %H:%M:%S')) AS scd_id,
         sa AS updated_at
  FROM scd_changed)""",
    ]


def history(spark, sf_dir, dec=None):
    acc = (dec if dec is not None else decisions(spark, sf_dir)).filter(F.col("decision") == K.ACCEPTED)
    acc = acc.withColumn("processed_at", F.col("evaluated_at"))
    return SCD.scd2_history(acc, SNAPSHOTS)


@query("scd2_history", O.with_star("SELECT * FROM scd_history", *_scd_sql_ctes()))
def q_scd2_history(spark, sf_dir):
    return history(spark, sf_dir)


@query("scd2_snapshot", O.with_star("SELECT * FROM scd_history", *_scd_sql_ctes()))
def q_scd2_snapshot(spark, sf_dir):
    """Two snapshot runs appended to the change log (C6), merged when read; equals the one-pass history."""
    dec = decision_log(spark, sf_dir)
    hist = SCD.HistoryLog(spark, unique_dir(spark, "tables", "scd_log"), buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    for b, t in SNAPSHOTS:
        hist.run(ST.build_valid_fact(STT.state_as_of(dec, batch_id=b), BOUNDS), S.lit_ts(t), b)
    return hist.read()


@query("amendment_counts", O.with_star(
    "SELECT trade_id, count(*) AS recorded_versions, count(*) - 1 AS amendments, "
    "arg_max(version, valid_from) AS current_version, arg_max(notional, valid_from) AS current_notional, "
    "arg_max(currency, valid_from) AS current_currency FROM scd_history GROUP BY trade_id", *_scd_sql_ctes()))
def q_amendment_counts(spark, sf_dir):
    return SCD.amendments(history(spark, sf_dir))


@query("deal_history", O.with_star(
    "SELECT trade_id, version, product_type, counterparty, trader, book, currency, notional, price, "
    "trade_date, maturity_date, valid_from, valid_to FROM scd_history WHERE trade_id IN ("
    "SELECT arg_min(trade_id, (-n, trade_id)) FROM (SELECT trade_id, count(*) AS n FROM scd_history GROUP BY trade_id))",
    *_scd_sql_ctes()))
def q_deal_history(spark, sf_dir):
    """History of the most amended deal (ties: smallest id), found in Spark."""
    h = history(spark, sf_dir)
    top = (h.groupBy("trade_id").agg(F.count(F.lit(1)).alias("n"))
           .agg(F.min_by("trade_id", F.struct(-F.col("n"), F.col("trade_id"))).alias("trade_id")))
    return SCD.deals_history(h, top)


@query("deal_lookup", O.with_star(
    "SELECT trade_id, version, product_type, counterparty, trader, book, currency, notional, price, "
    "trade_date, maturity_date, valid_from, valid_to FROM scd_history WHERE trade_id = (SELECT max(trade_id) FROM scd_history)",
    *_scd_sql_ctes()))
def q_deal_lookup(spark, sf_dir):
    """Point lookup (P9): the history of one deal given by its id."""
    h = history(spark, sf_dir)
    return SCD.deal_history(h, h.agg(F.max("trade_id")).first()[0])


# --- keyed state, as-of, diff -------------------------------------------------------------------
@query("upsert_trades", O.with_star("SELECT * FROM valid_fact"))
def q_upsert_trades(spark, sf_dir):
    """Current book of batches <= 1 upserted with the accepted rows of later batches."""
    dec = decision_log(spark, sf_dir)
    before = ST.build_valid_fact(STT.state_as_of(dec, batch_id=AS_OF_BATCH), BOUNDS)
    later = ST.build_valid_fact(dec.filter(F.col("batch_id") > AS_OF_BATCH), BOUNDS)
    order = (F.col("evaluated_at").desc(), F.col("message_id"))
    return STT.upsert_latest(before, later, ("trade_id",), order).select(*ST.VALID_FACT_COLUMNS)


@query("latest_rate", O.with_decisions("SELECT * FROM fx_latest", O.FX_RAW_CTE, O.FX_LATEST_CTE))
def q_latest_rate(spark, sf_dir):
    return STT.latest_rate(T.fx_rates_raw(spark, sf_dir))


@query("upsert_fx_rates", O.with_decisions("SELECT * FROM fx_latest", O.FX_RAW_CTE, O.FX_LATEST_CTE))
def q_upsert_fx_rates(spark, sf_dir):
    """FX state from the loads before a cut-off, then the later loads merged in
    through the high-water mark (C11); equals one latest-wins pass."""
    raw = T.fx_rates_raw(spark, sf_dir)
    prior = STT.fx_state(raw.filter(F.col("loaded_at") < S.lit_ts(FX_SPLIT)), None)
    return STT.fx_state(raw, prior)


@query("incremental_watermark", O.with_decisions(
    f"SELECT {O.DECISION_COLS} FROM decisions WHERE evaluated_at > "
    f"(SELECT coalesce(max(evaluated_at), TIMESTAMP '1900-01-01') FROM decisions WHERE batch_id <= {AS_OF_BATCH})"))
def q_incremental_watermark(spark, sf_dir):
    """Decisions newer than the high-water mark of a target built from batches <= 1."""
    dec = decision_log(spark, sf_dir)
    target = STT.state_as_of(dec, batch_id=AS_OF_BATCH)
    return STT.new_since(dec, "evaluated_at", target, "evaluated_at")


@query("state_as_of", O.with_star(
    "SELECT * FROM valid_fact_before",
    """latest_before AS (SELECT * FROM decisions WHERE decision = 'ACCEPTED' AND batch_id <= 1
  QUALIFY row_number() OVER (PARTITION BY trade_id ORDER BY batch_id DESC, evaluated_at DESC, message_id) = 1)""",
    "valid_fact_before AS (" + O._fact_select("latest_before", "evaluated_at, evaluated_at AS processed_at") + ")"))
def q_state_as_of(spark, sf_dir):
    return ST.build_valid_fact(STT.state_as_of(decisions(spark, sf_dir), batch_id=AS_OF_BATCH), BOUNDS)


@query("state_diff", O.with_star(
    "SELECT trade_id, version FROM valid_fact EXCEPT SELECT trade_id, version FROM valid_fact_before",
    """latest_before AS (SELECT * FROM decisions WHERE decision = 'ACCEPTED' AND batch_id <= 1
  QUALIFY row_number() OVER (PARTITION BY trade_id ORDER BY batch_id DESC, evaluated_at DESC, message_id) = 1)""",
    "valid_fact_before AS (" + O._fact_select("latest_before", "evaluated_at, evaluated_at AS processed_at") + ")"))
def q_state_diff(spark, sf_dir):
    dec = decision_log(spark, sf_dir)
    before = ST.build_valid_fact(STT.state_as_of(dec, batch_id=AS_OF_BATCH), BOUNDS)
    return STT.state_diff(valid(spark, sf_dir), before, ("trade_id", "version"))


# --- scratch extract (S13 / A4) --------------------------------------------------------------------
_TODAY_SQL = (f"SELECT trade_id, version, reject_reason, count(*) AS message_count FROM rejected_fact "
              f"WHERE CAST(logged_at AS DATE) = DATE '{TODAY}' GROUP BY trade_id, version, reject_reason")


def todays(spark, sf_dir):
    rej = rejected(spark, sf_dir)
    t = (rej.filter(F.to_date("logged_at") == F.lit(TODAY))
         .groupBy("trade_id", "version", "reject_reason").agg(F.count(F.lit(1)).alias("message_count")))
    return scratch(t, "tmp_todays_rejects")


def scratch(df, name):
    """A session-scoped extract (temp view) to iterate on."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


@query("todays_rejects", O.with_star(_TODAY_SQL))
def q_todays_rejects(spark, sf_dir):
    return todays(spark, sf_dir)


@query("repeated_rejects", O.with_star(f"SELECT * FROM ({_TODAY_SQL}) WHERE message_count > 1"))
def q_repeated_rejects(spark, sf_dir):
    return todays(spark, sf_dir).filter(F.col("message_count") > 1)
