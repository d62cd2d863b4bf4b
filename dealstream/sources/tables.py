"""Readers for the given parquet tables and the adapter views built on them.

The inputs are TPC-H-like tables; the engine works on deal messages and run
logs. The adapters below derive both from the given tables with one
declarative plan each, so every operator's work grows with the input.

Deal feed (one row per *delivery* of a message):

* ``trade_id`` = order key, ``version`` = line number (natural repeats of
  the pair give same-version replays),
* ``maturity_date`` = ship date, ``trade_date`` = order date,
* batch (drain) = part key mod 4, loaded one hour apart,
* messages of returned lines (``l_returnflag = 'R'``) are delivered a second
  time half an hour later from a second file (duplicate delivery).

Run log: one row per event, ``object_name`` = ``TASK_<user mod 5>``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: adapter parameters ----------------------------------------
AS_OF = dt.date(1998, 7, 1)                       # as-of date for decisions
REPORT_AS_OF = dt.date(1999, 1, 1)                # as-of date the status/report views are read at
LOAD_BASE = dt.datetime(1998, 7, 1, 0, 0, 0)      # batch 0 load time; batch b at +b hours
REDELIVERY_DELAY_MINUTES = 30
EVALUATION_DELAY_MINUTES = 5                      # evaluated_at = loaded_at + 5 min
N_BATCHES = 4
DATE_DIM_START = dt.date(1995, 1, 1)
DATE_DIM_END = dt.date(2002, 12, 31)              # exclusive end, as a date spine
RUN_LOG_NOW = dt.datetime(2024, 1, 31, 0, 0, 0)   # "now" for run-log analytics
SOURCE_SYSTEM = "LINEITEM_FEED"
CURRENCY_BY_SUPPLIER_MOD7 = ("USD", "EUR", "GBP", "JPY", "CHF", "AUD", "XXX")  # XXX has no rate

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ts_ntz(value: dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal (the given tables carry NTZ timestamps)."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _currency(suppkey: Column) -> Column:
    m = suppkey % 7
    expr = None
    for i, code in enumerate(CURRENCY_BY_SUPPLIER_MOD7):
        expr = F.when(m == i, F.lit(code)) if expr is None else expr.when(m == i, F.lit(code))
    return expr


def deal_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivery of every deal message, with ``batch_id``, ``file_name`` and
    ``loaded_at`` as the landing would record them.

    Joins follow the star: lineitem→orders is the only large-large join
    (sort-merge on the order key) and the last, so the rows lie by trade;
    ``nation`` is broadcast (25 rows by definition of the schema); customer,
    part and supplier grow with the data and are left to the optimizer's
    size-checked choice.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_returnflag")  # the day alone is shuffled
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = F.broadcast(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")

    # lineitem x orders is the one large-large join: keep it a shuffle join
    # (at scale neither side fits a broadcast; AQE still splits skewed keys).
    # It comes last, so that the messages lie by trade for the steps after it,
    # and customers meet the orders, which are fewer than the lines.
    oc = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    lps = (li.filter(F.col("l_orderkey").isNotNull())
             .join(p, li.l_partkey == p.p_partkey)
             .join(s, li.l_suppkey == s.s_suppkey))
    j = lps.join(oc.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))

    ship_date = F.col("l_shipdate")
    batch = (F.col("l_partkey") % N_BATCHES).cast("bigint")
    msg = j.select(
        F.md5(F.concat_ws("|", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                          F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
                          ship_date.cast("string"))).alias("message_id"),
        F.col("l_orderkey").alias("trade_id"),
        F.col("l_linenumber").cast("bigint").alias("version"),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        F.expr("timestampadd(MINUTE, l_suppkey, o_orderdate)").alias("event_timestamp"),
        F.col("o_orderdate").cast("date").alias("trade_date"),
        ship_date.alias("maturity_date"),
        F.col("p_type").alias("product_type"),
        F.col("n_name").alias("counterparty"),
        F.col("s_name").alias("trader"),
        F.col("c_mktsegment").alias("book"),
        _currency(F.col("l_suppkey")).alias("currency"),
        F.col("l_extendedprice").alias("notional"),
        F.col("l_quantity").alias("price"),
        batch.alias("batch_id"),
        F.col("l_returnflag"),
    )
    # One scan and one join for both deliveries: each message row is
    # generated once, or twice when it is redelivered.
    copies = F.when(F.col("l_returnflag") == "R", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    out = msg.select("*", F.explode(copies).alias("_copy")).drop("l_returnflag")
    prefix = F.when(F.col("_copy") == 0, F.lit("deals_b")).otherwise(F.lit("redelivery_b"))
    loaded = F.expr(f"timestampadd(MINUTE, _copy * {REDELIVERY_DELAY_MINUTES}, "
                    f"timestampadd(HOUR, batch_id, TIMESTAMP_NTZ '{LOAD_BASE:%Y-%m-%d %H:%M:%S}'))")
    return out.select(
        *[c for c in out.columns if c != "_copy"],
        F.concat(prefix, F.col("batch_id").cast("string"), F.lit(".jsonl")).alias("file_name"),
        loaded.alias("loaded_at"))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task-run log derived from ``events`` (one row per event)."""
    ev = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return ev.select(
        F.col("event_id").alias("run_id"),
        F.concat(F.lit("TASK_"), (F.col("user_id") % 5).cast("string")).alias("object_name"),
        F.when(F.col("event_type") == "error", "FAILED")
         .when(F.col("event_type") == "signup", "SKIPPED")
         .otherwise("SUCCEEDED").alias("state"),
        F.col("ts").alias("scheduled_time"),
        F.col("value").alias("elapsed"),
        k.alias("parts_scanned"),
        F.when(F.col("user_id") % 10 == 0, F.lit(0)).otherwise(F.lit(100)).alias("parts_total"),
        F.col("event_type"),
        F.col("user_id"),
        F.col("props"),
    )


def fx_rates_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX landing derived from ``lineitem``: one rate row per line for the ship
    date and the supplier's currency (no rows for the rate-less currency).
    Each line number is a separate file version loaded ten minutes after the
    previous one, so most (date, currency) pairs are loaded many times and
    the latest load must win."""
    from ..constants import STATIC_RATES_TO_USD

    li = read_table(spark, sf_dir, "lineitem").select("l_shipdate", "l_suppkey", "l_linenumber", "l_discount")
    ccy = _currency(F.col("l_suppkey"))
    base = None
    for code, rate in STATIC_RATES_TO_USD.items():
        base = (F.when(ccy == code, F.lit(float(rate))) if base is None
                else base.when(ccy == code, F.lit(float(rate))))
    d = F.col("l_shipdate").cast("date")
    out = li.select(
        d.alias("as_of_date"), ccy.alias("currency"),
        (base * (F.lit(0.95) + F.col("l_discount"))).alias("rate_to_usd"),
        F.concat(F.lit("fx_rates_"), F.date_format(d, "yyyyMMdd"), F.lit("_v"),
                 F.col("l_linenumber").cast("string"), F.lit(".csv")).alias("file_name"),
        F.expr("timestampadd(MINUTE, l_linenumber * 10, timestampadd(HOUR, 6, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP_NTZ)))")
        .alias("loaded_at"))
    return out.filter(F.col("rate_to_usd").isNotNull())
