"""Registered queries: file ingest, sinks and the streaming jobs.

Each query lands data derived from the given tables into a fresh folder
under the shared ``spark.checkpoint.dir``, runs the job (batch or
availableNow stream) and returns the job's output read back, so the result
can be compared with the same SQL as its batch twin.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import decide as D
from ..operators import star as ST
from ..session import unique_dir
from ..sources import ingest as I
from ..sources import tables as T
from ..streaming import jobs as J
from . import oracle as O
from .catalog import query
from .queries_core import decisions, deliveries
from .queries_ops import FX_SPLIT
from .queries_star import valid

# --- fixed values: the corrupt-line rule of the event landing ------------------
BAD_VALUE_OVER = 300.0
FIRST_DRAIN_BATCHES = (0, 1)
EVENT_SPLIT = dt.datetime(2024, 1, 15)

_BAD_SQL = f"(event_type = 'error' AND value > {BAD_VALUE_OVER})"
_FILE_SQL = "'events_' || strftime(CAST(ts AS DATE), '%Y%m%d') || '.jsonl'"
_LOADED_SQL = "CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY"


def _bad():
    return (F.col("event_type") == "error") & (F.col("value") > BAD_VALUE_OVER)


def events_landing(spark, sf_dir):
    """Write the events as JSON-lines files, one file per day; lines of the
    rule above are corrupt. Returns the folder."""
    path = unique_dir(spark, "landing", "events_json")
    ev = T.read_table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    I.write_json_lines(ev, path, I.events_json_line(_bad()), ["day"])
    return path


def events_ingested(spark, sf_dir, path=None):
    path = path or events_landing(spark, sf_dir)
    fn = F.concat(F.lit("events_"), F.date_format("day", "yyyyMMdd"), F.lit(".jsonl"))
    la = F.expr("timestampadd(DAY, 1, CAST(day AS TIMESTAMP_NTZ))")
    return I.ingest_json(spark, path, loaded_at=la, file_name=fn)


@query("raw_json_ingest", O.with_log(
    f"SELECT {_FILE_SQL} AS file_name, event_id AS line_no, NOT {_BAD_SQL} AS parsed_ok, "
    f"{_LOADED_SQL} AS loaded_at FROM events"))
def q_raw_json_ingest(spark, sf_dir):
    land = events_ingested(spark, sf_dir)
    return land.select("file_name", I.line_number(F.col("line")).alias("line_no"),
                       F.col("raw").isNotNull().alias("parsed_ok"), "loaded_at")


_EVENT_TYPED_SQL = ("event_id, ts, user_id, event_type, value, "
                    "CAST(json_extract_string(props, '$.k') AS INTEGER) AS k")


@query("flatten_messages", O.with_log(
    f"SELECT {_EVENT_TYPED_SQL}, {_FILE_SQL} AS file_name FROM events WHERE NOT {_BAD_SQL}"))
def q_flatten_messages(spark, sf_dir):
    land = events_ingested(spark, sf_dir).filter(F.col("raw").isNotNull())
    return land.select(*I.flatten(F.col("raw"), I.EVENT_FIELDS, strict=False), "file_name")


@query("skip_bad_files", O.with_log(
    f"SELECT {_EVENT_TYPED_SQL}, {_FILE_SQL} AS file_name FROM events WHERE CAST(ts AS DATE) NOT IN "
    f"(SELECT DISTINCT CAST(ts AS DATE) FROM events WHERE {_BAD_SQL})"))
def q_skip_bad_files(spark, sf_dir):
    good, _ = I.split_bad_files(events_ingested(spark, sf_dir))
    return good.select(*I.flatten(F.col("raw"), I.EVENT_FIELDS, strict=True), "file_name")


@query("load_report", O.with_log(
    f"SELECT {_FILE_SQL} AS file_name, count(*) AS row_count, count_if(NOT {_BAD_SQL}) AS row_parsed, "
    f"count_if({_BAD_SQL}) AS error_count, "
    f"'malformed JSON at line ' || CAST(min(CASE WHEN {_BAD_SQL} THEN event_id END) AS VARCHAR) AS first_error_message, "
    f"max({_LOADED_SQL}) AS last_load_time, 'LOAD_SKIPPED' AS status "
    f"FROM events GROUP BY 1 HAVING count_if({_BAD_SQL}) > 0"))
def q_load_report(spark, sf_dir):
    land = events_ingested(spark, sf_dir)
    return I.load_report(land, I.line_number(F.col("line")))


@query("raw_csv_ingest", O.with_decisions(
    "SELECT as_of_date, currency, rate_to_usd, 'fx_rates_' || CAST(year(as_of_date) AS VARCHAR) || '.csv' AS file_name, "
    "CAST(make_date(CAST(year(as_of_date) AS INTEGER) + 1, 1, 1) AS TIMESTAMP) AS loaded_at FROM fx_raw",
    O.FX_RAW_CTE))
def q_raw_csv_ingest(spark, sf_dir):
    """Rate files as CSV (one per year, with a header) read back positionally
    with an explicit schema."""
    path = unique_dir(spark, "landing", "fx_csv")
    fx = T.fx_rates_raw(spark, sf_dir).select("as_of_date", "currency", "rate_to_usd",
                                              F.year("as_of_date").alias("year"))
    fx.write.mode("overwrite").partitionBy("year").option("header", True).csv(path)
    fn = F.concat(F.lit("fx_rates_"), F.col("year").cast("string"), F.lit(".csv"))
    la = F.make_date(F.col("year") + 1, F.lit(1), F.lit(1)).cast("timestamp_ntz")
    raw = I.ingest_rates_csv(spark, path, loaded_at=la, file_name=fn)
    good, _ = I.split_bad_files(raw, F.col("_corrupt_record").isNotNull())
    return good.select("as_of_date", "currency", "rate_to_usd", "file_name", "loaded_at")


BAD_FX_YEAR = 1995


@query("csv_skip_bad_files", O.with_decisions(
    "SELECT as_of_date, currency, rate_to_usd, 'fx_rates_' || CAST(year(as_of_date) AS VARCHAR) || '.csv' AS file_name "
    f"FROM fx_raw WHERE year(as_of_date) <> {BAD_FX_YEAR}", O.FX_RAW_CTE))
def q_csv_skip_bad_files(spark, sf_dir):
    """One rate of one year's file does not parse: that file is skipped whole, the others load."""
    path = unique_dir(spark, "landing", "fx_csv_bad")
    year = F.year("as_of_date")
    rate = F.when((year == BAD_FX_YEAR) & (F.col("currency") == "EUR"), F.lit("n/a")).otherwise(F.col("rate_to_usd").cast("string"))
    T.fx_rates_raw(spark, sf_dir).select("as_of_date", "currency", rate.alias("rate_to_usd"), year.alias("year")).write.partitionBy(
        "year").option("header", True).csv(path)
    fn = F.concat(F.lit("fx_rates_"), F.col("year").cast("string"), F.lit(".csv"))
    raw = I.ingest_rates_csv(spark, path, loaded_at=F.lit(EVENT_SPLIT).cast("timestamp_ntz"), file_name=fn)
    good, _ = I.split_bad_files(raw, F.col("_corrupt_record").isNotNull())
    return good.select("as_of_date", "currency", "rate_to_usd", "file_name")


@query("reference_messages", O.with_decisions(
    "SELECT 'TRD-' || upper(printf('%010x', trade_id)) AS trade_id, version, message_id, event_timestamp, maturity_date, notional, file_name FROM deliveries"))
def q_reference_messages(spark, sf_dir):
    """Messages with text ids and event times in another zone, flattened: ids stay text, times become UTC."""
    tid = F.concat(F.lit("TRD-"), F.lpad(F.hex("trade_id"), 10, "0"))
    local = F.concat(F.date_format(F.expr("event_timestamp + INTERVAL '05:30' HOUR TO MINUTE"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+05:30"))
    dl = deliveries(spark, sf_dir).withColumn("trade_id", tid).withColumn("event_timestamp", local)
    raw = F.parse_json(F.to_json(F.struct(*[F.col(n) for n, _ in I.MESSAGE_FIELDS])))
    flat = I.flatten_messages(dl.select(raw.alias("raw"), "file_name"))
    return flat.select("trade_id", "version", "message_id", "event_timestamp", "maturity_date", "notional", "file_name")


@query("raw_passthrough", O.with_decisions("SELECT * FROM deliveries"))
def q_raw_passthrough(spark, sf_dir):
    return I.base_view(deliveries(spark, sf_dir), "base_trades_raw")


def _written_decisions(spark, sf_dir):
    path = unique_dir(spark, "tables", "decisions_once")
    decisions(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


@query("append_sink", O.with_decisions(f"SELECT {O.DECISION_COLS} FROM decisions"))
def q_append_sink(spark, sf_dir):
    """Runs appended one by one (a batch may come in two), then run 2 replayed: the
    replay replaces its own folder only, so the table is unchanged."""
    dec = _written_decisions(spark, sf_dir)
    path = unique_dir(spark, "tables", "decisions_appended")
    half = F.pmod(F.col("trade_id"), F.lit(2))
    runs = [dec.filter((F.col("batch_id") == b) & (half == h)) for b in range(T.N_BATCHES) for h in (0, 1)]
    for epoch, part in enumerate([*runs, runs[2]]):
        I.append(part, path, epoch if epoch < len(runs) else 2)
    out = I.read_appended(spark, path)
    return out.select(*[F.col(c).cast("bigint").alias(c) if c == "batch_id" else F.col(c)
                        for c in D.DECISION_COLUMNS])


def _landing(spark, sf_dir, batches=None, extra=None):
    path = unique_dir(spark, "landing", "deals")
    dl = deliveries(spark, sf_dir)
    J.land_messages(dl if batches is None else dl.filter(F.col("batch_id").isin(list(batches))), path)
    return path, dl


@query("rebuild_equals_stream", O.with_decisions(f"SELECT {O.DECISION_COLS} FROM decisions"))
def q_rebuild_equals_stream(spark, sf_dir):
    """Recovery path: the landing table read as one batch through the same
    staging transform as the stream, then decided in one pass."""
    path, _ = _landing(spark, sf_dir)
    raw = spark.read.schema(J.LANDING_SCHEMA).parquet(path)
    staged = J.stage_batch(raw, held=unique_dir(spark, "tables", "rebuild"))
    return D.evaluate_drain(staged, None, T.AS_OF, by_trade=True).select(*D.DECISION_COLUMNS)


@query("clustered_write", O.with_star("SELECT * FROM valid_fact"))
def q_clustered_write(spark, sf_dir):
    path = unique_dir(spark, "tables", "valid_clustered")
    I.write_clustered(valid(spark, sf_dir), path, "maturity_date")
    return spark.read.parquet(path)


def _two_drains(spark, sf_dir, run, reupload=False):
    """Land the first batches, drain, land the rest (plus an optional
    re-upload of an already drained file), drain again."""
    landing = unique_dir(spark, "landing", "deals_stream")
    # batch and trade filters reach the scan of the lines, so each part is derived when it lands and no feed is written
    dl = deliveries(spark, sf_dir)
    J.land_messages(dl.filter(F.col("batch_id").isin(list(FIRST_DRAIN_BATCHES))), landing)
    run(landing)
    later = dl.filter(~F.col("batch_id").isin(list(FIRST_DRAIN_BATCHES)))
    J.land_messages(later, landing)
    if reupload:
        # the first drain's batch-1 file delivered again within the last batch: its lines as they landed
        landed = spark.read.schema(J.LANDING_SCHEMA).parquet(landing)
        again = landed.filter((F.col("batch_id") == 1) & (F.col("file_name") == "deals_b1.jsonl")).select(
            "raw", F.lit(T.N_BATCHES - 1).cast("bigint").alias("batch_id"),
            F.lit("reupload_b1.jsonl").alias("file_name"),
            F.expr("timestampadd(HOUR, 3, loaded_at)").alias("loaded_at"))
        J.land_lines(again, landing)
    run(landing)


@query("cdc_drain", O.with_decisions(
    "SELECT trade_id, version, message_id, source_system, event_timestamp, trade_date, maturity_date, "
    "product_type, counterparty, trader, book, currency, notional, price, file_name, loaded_at, batch_id FROM staged"))
def q_cdc_drain(spark, sf_dir):
    staging = unique_dir(spark, "tables", "stg")
    ckpt = unique_dir(spark, "streams", "cdc_drain")
    _two_drains(spark, sf_dir, lambda landing: J.cdc_drain(spark, landing, staging, ckpt))
    out = I.read_appended(spark, staging)
    return out.withColumn("batch_id", F.col("batch_id").cast("bigint"))


def _stream_decisions(spark, sf_dir, reupload):
    out = unique_dir(spark, "tables", "decisions_stream")
    ckpt = unique_dir(spark, "streams", "decisions")
    _two_drains(spark, sf_dir, lambda landing: J.stream_decisions(spark, landing, out, ckpt, T.AS_OF), reupload)
    return _decided(spark, out)


def _decided(spark, path):
    d = I.read_appended(spark, path)
    return d.select(*[F.col(c).cast("bigint").alias(c) if c == "batch_id" else F.col(c)
                      for c in D.DECISION_COLUMNS])


def _late_sql(late: str, drains: str) -> str:
    """One-pass decisions when the rows ``late`` are decided in the order ``drains`` instead of by batch."""
    moved = O.CTE_MESSAGES.replace("OVER (PARTITION BY trade_id ORDER BY batch_id\n", f"OVER (PARTITION BY trade_id ORDER BY {drains}\n").replace(
        "PARTITION BY trade_id, batch_id\n", f"PARTITION BY trade_id, {drains}\n")
    return f"WITH {moved}\nSELECT {O.DECISION_COLS} FROM decisions"


_LATE = "batch_id = 1 AND trade_id % 2 = 1"


def _late_file(spark, sf_dir, max_files=None):
    """Batch 1 in two files over two drains: the odd trades come with the later batches."""
    landing, out, ckpt = (unique_dir(spark, *x) for x in (("landing", "late"), ("tables", "late"), ("streams", "late")))
    dl = deliveries(spark, sf_dir)
    late = F.expr(_LATE)
    for part in (dl.filter((F.col("batch_id") <= 1) & ~late), dl.filter(late | (F.col("batch_id") > 1))):
        J.land_messages(part, landing)
        J.stream_decisions(spark, landing, out, ckpt, T.AS_OF, max_files=max_files)
    return _decided(spark, out)


@query("stream_late_file", _late_sql(_LATE, f"(batch_id * 2 + CASE WHEN {_LATE} THEN 1 ELSE 0 END)"))
def q_stream_late_file(spark, sf_dir):
    """A batch that arrives in two drains keeps every decision of the first."""
    return _late_file(spark, sf_dir)


BAD_DEAL_FILE = "deals_b1.jsonl"


_SKIP_SQL = O.with_decisions(f"SELECT {O.DECISION_COLS} FROM decisions").replace(
    "SELECT * FROM deliveries\n", f"SELECT * FROM deliveries WHERE file_name <> '{BAD_DEAL_FILE}'\n")


def _bad_file(spark, sf_dir, max_files=None):
    landing, out, ckpt, aside = (unique_dir(spark, *x) for x in (
        ("landing", "bad_deals"), ("tables", "bad_deals"), ("streams", "bad_deals"), ("tables", "quarantine")))
    dl, bad = deliveries(spark, sf_dir), (F.col("file_name") == BAD_DEAL_FILE) & (F.col("trade_id") % 3 == 0)
    if not max_files:
        J.land_messages(dl, landing, cut=F.when(bad, F.lit(2)).otherwise(F.lit(0)))
    else:  # the bad parts last: the feed is derived once and landed in two parts
        feed = unique_dir(spark, "tables", "deliveries")
        dl.write.parquet(feed)
        dl, parts = spark.read.parquet(feed), spark.sparkContext.defaultParallelism  # micro-batches of a file each: as many, however large the feed
        J.land_messages(dl.filter((F.col("file_name") != BAD_DEAL_FILE) | (F.col("trade_id") % 3 > 0)), landing, parts=parts)
        J.land_messages(dl.filter(bad), landing, cut=2, parts=parts)
    J.stream_decisions(spark, landing, out, ckpt, T.AS_OF, quarantine=aside, max_files=max_files)
    return _decided(spark, out)


@query("stream_skip_bad_files", _SKIP_SQL)
def q_stream_skip_bad_files(spark, sf_dir):
    """A landed file with malformed lines is skipped whole and put aside; the stream goes on with the others."""
    return _bad_file(spark, sf_dir)


@query("stream_skip_bad_parts", _SKIP_SQL)
def q_stream_skip_bad_parts(spark, sf_dir):
    """The same file in parts that reach the stream one a micro-batch, the bad ones last: rows already staged are withdrawn."""
    return _bad_file(spark, sf_dir, max_files=1)


@query("stream_decisions", O.with_decisions(f"SELECT {O.DECISION_COLS} FROM decisions"))
def q_stream_decisions(spark, sf_dir):
    return _stream_decisions(spark, sf_dir, reupload=False)


@query("stream_dedup", O.with_decisions(f"SELECT {O.DECISION_COLS} FROM decisions"))
def q_stream_dedup(spark, sf_dir):
    """A drained file delivered again in a later drain changes nothing."""
    return _stream_decisions(spark, sf_dir, reupload=True)


@query("stream_fx", O.with_decisions("SELECT * FROM fx_latest", O.FX_RAW_CTE, O.FX_LATEST_CTE))
def q_stream_fx(spark, sf_dir):
    landing = unique_dir(spark, "landing", "fx")
    state = unique_dir(spark, "tables", "fx_state")
    ckpt = unique_dir(spark, "streams", "fx")
    raw = T.fx_rates_raw(spark, sf_dir)
    split = F.lit(FX_SPLIT).cast("timestamp_ntz")
    for n, part in ((0, raw.filter(F.col("loaded_at") < split)), (1, raw.filter(F.col("loaded_at") >= split))):
        part.withColumn("load_no", F.lit(n).cast("bigint")).write.mode("append").partitionBy("load_no").parquet(landing)
        J.stream_fx(spark, landing, state, ckpt)
    return I.read_current(spark, state)


@query("stream_hourly", O.with_log(
    f"""SELECT date_trunc('hour', scheduled_time) AS hour, count(*) AS rows_loaded FROM run_log
        GROUP BY 1"""))
def q_stream_hourly(spark, sf_dir):
    """Hourly run counts from a stream of run-log files; some rows of the first
    hours arrive a drain late and still count in their hour."""
    return _streamed_hours(spark, sf_dir)


@query("stream_hourly_failures", O.with_log(
    """SELECT date_trunc('hour', scheduled_time) AS hour, object_name, count(*) AS rows_loaded FROM run_log
        WHERE state = 'FAILED' GROUP BY ALL"""))
def q_stream_hourly_failures(spark, sf_dir):
    """Failures per hour and object, streamed: what the failure alert reads."""
    return _streamed_hours(spark, sf_dir, ("object_name",), F.col("state") == "FAILED")


def _streamed_hours(spark, sf_dir, keys=(), condition=None):
    landing = unique_dir(spark, "landing", "run_log")
    out = unique_dir(spark, "tables", "hourly")
    ckpt = unique_dir(spark, "streams", "hourly")
    lg = T.run_log(spark, sf_dir).select("run_id", "object_name", "state", "scheduled_time")
    split = F.lit(EVENT_SPLIT).cast("timestamp_ntz")
    schema = "run_id bigint, object_name string, state string, scheduled_time timestamp_ntz, part int"
    # a seventh of the early rows comes with the second drain, when their hours are closed
    early = (F.col("scheduled_time") < split) & (F.col("run_id") % 7 != 0)
    for n, part in ((0, lg.filter(early)), (1, lg.filter(~early))):
        part.withColumn("part", F.lit(n)).write.mode("append").partitionBy("part").parquet(landing)
        J.stream_hourly(spark, landing, schema, "scheduled_time", out, ckpt, keys, condition)
    return J.read_hourly(spark, out, ckpt, keys)


@query("load_once", O.with_log(
    "SELECT 1 AS run, count(*) AS rows_drained FROM events UNION ALL SELECT 2 AS run, 0 AS rows_drained"))
def q_load_once(spark, sf_dir):
    """The same landing drained twice with one checkpoint: the second run loads nothing."""
    path = events_landing(spark, sf_dir)
    ckpt = unique_dir(spark, "streams", "load_once")
    counts = unique_dir(spark, "tables", "load_once_counts")
    for run in (1, 2):
        src = J.ingest_stream(spark, path, "text")

        def process(df, epoch, run=run):
            df.agg(F.lit(run).alias("run"), F.count(F.lit(1)).alias("rows_drained")).write.mode(
                "append").parquet(counts)
        J.drain(src, ckpt, process)
    runs = spark.createDataFrame([(1,), (2,)], "run int")
    got = J.read_if_exists(spark, counts)
    if got is None:
        return runs.select("run", F.lit(0).cast("bigint").alias("rows_drained"))
    per_run = got.groupBy("run").agg(F.sum("rows_drained").alias("rows_drained"))
    return runs.join(per_run, "run", "left").select(
        "run", F.coalesce(F.col("rows_drained"), F.lit(0)).cast("bigint").alias("rows_drained"))
