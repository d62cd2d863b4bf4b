"""Registered queries: run-log analytics and feed health."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import runlog as RL
from ..sources import tables as T
from . import oracle as O
from .catalog import query
from .queries_core import decision_log, decisions, deliveries
from .queries_ops import _scd_sql_ctes, history
from .queries_star import rejected, valid

NOW = T.RUN_LOG_NOW
W = O.window_pred

# --- fixed values: the objects the health page expects, and query parameters --
EXPECTED_OBJECTS = ("TASK_0", "TASK_1", "TASK_2", "TASK_3", "TASK_4", "TASK_5", "TASK_6")
HISTORY_OBJECTS = ("TASK_1", "TASK_2")
ALERT_OBJECTS = ("TASK_0", "TASK_1", "TASK_2", "TASK_3", "TASK_4")
TAG_TEXT = '"K": 7'
SCAN_TEXT = "task_1"


def log(spark, sf_dir):
    return T.run_log(spark, sf_dir)


def expected(spark):
    return spark.createDataFrame([(n,) for n in EXPECTED_OBJECTS], "object_name string")


_EXPECTED_SQL = "expected AS (SELECT * FROM (VALUES " + ", ".join(f"('{n}')" for n in EXPECTED_OBJECTS) + \
    ") AS t(object_name))"


@query("recent_failures", O.with_log(
    f"SELECT run_id, object_name, state, scheduled_time, elapsed FROM run_log "
    f"WHERE {W(24 * 7)} AND state = 'FAILED' ORDER BY scheduled_time DESC, run_id LIMIT 100"))
def q_recent_failures(spark, sf_dir):
    return RL.recent_failures(log(spark, sf_dir), NOW, 24 * 7, 100)


@query("run_by_id", O.with_log(
    "SELECT * FROM run_log WHERE run_id IN (SELECT arg_min(run_id, (-elapsed, run_id)) FROM run_log)"))
def q_run_by_id(spark, sf_dir):
    """The slowest run, looked up by id (id found in Spark, semi join)."""
    lg = log(spark, sf_dir)
    ids = lg.agg(F.min_by("run_id", F.struct(-F.col("elapsed"), F.col("run_id"))).alias("run_id"))
    return RL.run_by_id(lg, ids)


@query("run_history", O.with_log(
    f"SELECT run_id, object_name, state, scheduled_time, elapsed FROM run_log "
    f"WHERE {W(24 * 3)} AND object_name IN ('TASK_1', 'TASK_2')"))
def q_run_history(spark, sf_dir):
    return RL.run_history(log(spark, sf_dir), HISTORY_OBJECTS, NOW, 3)


_LAST_RUN_SQL = ("SELECT object_name, max(scheduled_time) AS last_run, "
                 "arg_max(state, (scheduled_time, run_id)) AS last_state FROM run_log GROUP BY object_name")


@query("last_run_state", O.with_log(_LAST_RUN_SQL))
def q_last_run_state(spark, sf_dir):
    return RL.last_run(log(spark, sf_dir))


@query("not_running", O.with_log(f"SELECT * FROM ({_LAST_RUN_SQL}) WHERE last_state <> 'SUCCEEDED'"))
def q_not_running(spark, sf_dir):
    return RL.not_running(log(spark, sf_dir))


_LATEST_STATUS_SQL = """SELECT e.object_name, coalesce(l.state, 'UNKNOWN') AS last_state,
       l.scheduled_time AS last_scheduled, l.elapsed AS last_elapsed
FROM expected e LEFT JOIN (
  SELECT object_name, arg_max(state, (scheduled_time, run_id)) AS state,
         max(scheduled_time) AS scheduled_time, arg_max(elapsed, (scheduled_time, run_id)) AS elapsed
  FROM run_log GROUP BY object_name) l ON e.object_name = l.object_name"""


@query("latest_run_status", O.with_log(_LATEST_STATUS_SQL, _EXPECTED_SQL))
def q_latest_run_status(spark, sf_dir):
    return RL.latest_status(expected(spark), log(spark, sf_dir))


@query("age_text", O.with_log(
    f"""SELECT object_name, last_scheduled,
       CASE WHEN last_scheduled IS NULL THEN 'No data yet'
            WHEN epoch_us({O.NOW}) - epoch_us(last_scheduled) < CAST(3600000000 AS BIGINT)
              THEN CAST(floor((epoch_us({O.NOW}) - epoch_us(last_scheduled)) / 1e6 / 60) AS BIGINT) || ' min ago'
            ELSE printf('%.1f', round((epoch_us({O.NOW}) - epoch_us(last_scheduled)) / 1e6 / 3600.0, 1)) || ' hours ago'
       END AS age
FROM ({_LATEST_STATUS_SQL})""", _EXPECTED_SQL))
def q_age_text(spark, sf_dir):
    st = RL.latest_status(expected(spark), log(spark, sf_dir))
    return st.select("object_name", "last_scheduled", S.age_text("last_scheduled", NOW).alias("age"))


@query("tagged_failures", O.with_log(
    f"SELECT run_id, object_name, props, scheduled_time FROM run_log "
    f"WHERE {W(24 * 7)} AND props ILIKE '%\"K\": 7%' AND state = 'FAILED'"))
def q_tagged_failures(spark, sf_dir):
    return RL.tagged_failures(log(spark, sf_dir), TAG_TEXT, NOW)


@query("queued_runs", O.with_log(
    f"SELECT run_id, object_name, elapsed, parts_scanned, scheduled_time FROM run_log "
    f"WHERE {W(24)} AND (elapsed - 400.0 > 0 OR parts_scanned - 95 > 0)"))
def q_queued_runs(spark, sf_dir):
    return RL.queued_runs(log(spark, sf_dir), NOW)


@query("slowest_runs", O.with_log(
    f"SELECT run_id, object_name, elapsed, parts_scanned, parts_total, scheduled_time FROM run_log "
    f"WHERE {W(24)} ORDER BY elapsed DESC, run_id LIMIT 20"))
def q_slowest_runs(spark, sf_dir):
    return RL.slowest(log(spark, sf_dir), NOW, 24, 20)


@query("scan_ratio", O.with_log(
    f"SELECT run_id, object_name, parts_scanned, parts_total, scheduled_time, "
    f"round(parts_scanned / nullif(parts_total, 0), 3) AS scan_ratio FROM run_log "
    f"WHERE {W(24)} AND object_name ILIKE '%task_1%' ORDER BY scheduled_time DESC, run_id LIMIT 20"))
def q_scan_ratio(spark, sf_dir):
    return RL.scan_ratio(log(spark, sf_dir), SCAN_TEXT, NOW)


@query("cache_hit_rate", O.with_log(
    f"SELECT count(*) AS total_runs, count_if(parts_scanned = 0) AS fully_cached, "
    f"round(count_if(parts_scanned = 0) / nullif(count(*), 0) * 100, 1) AS cache_hit_pct "
    f"FROM run_log WHERE {W(24)}"))
def q_cache_hit_rate(spark, sf_dir):
    return RL.cache_hit_rate(log(spark, sf_dir), NOW)


@query("task_success_rate", O.with_log(
    f"SELECT object_name, count(*) AS total_runs, count_if(state = 'SUCCEEDED') AS succeeded, "
    f"round(count_if(state = 'SUCCEEDED') / nullif(count(*), 0) * 100, 1) AS success_pct "
    f"FROM run_log WHERE {W(24 * 7)} GROUP BY object_name"))
def q_task_success_rate(spark, sf_dir):
    return RL.success_rate(log(spark, sf_dir), NOW, 7)


@query("hourly_cost", O.with_log(
    f"SELECT object_name, date_trunc('hour', scheduled_time) AS hour, "
    f"CAST(sum(CAST(elapsed AS DECIMAL(18,2))) AS DOUBLE) AS cost "
    f"FROM run_log WHERE {W(24 * 7)} GROUP BY ALL"))
def q_hourly_cost(spark, sf_dir):
    return RL.hourly_cost(log(spark, sf_dir), NOW, 7)


@query("hourly_volume", O.with_decisions(
    "SELECT date_trunc('hour', loaded_at) AS hour, count(*) AS rows_loaded FROM deliveries "
    "GROUP BY 1 ORDER BY 1 DESC LIMIT 48"))
def q_hourly_volume(spark, sf_dir):
    return RL.volume_trend(deliveries(spark, sf_dir), "loaded_at", 48)


@query("hourly_rejects", O.with_star(
    "SELECT date_trunc('hour', logged_at) AS hour, reject_reason, count(*) AS rejects "
    "FROM rejected_fact GROUP BY ALL"))
def q_hourly_rejects(spark, sf_dir):
    return RL.reject_trend(rejected(spark, sf_dir))


_SIZES_SQL = """sizes AS (
  SELECT object_name AS table_name, CAST(sum(parts_scanned) AS BIGINT) * 1048576 AS active_bytes,
         CAST(sum(parts_total) AS BIGINT) * 1048576 AS time_travel_bytes,
         count(*) * 4096 AS failsafe_bytes
  FROM run_log GROUP BY object_name)"""


def sizes(spark, sf_dir):
    """Per-object byte footprint derived from the run log (parts of 1 MiB)."""
    return log(spark, sf_dir).groupBy(F.col("object_name").alias("table_name")).agg(
        (F.sum("parts_scanned").cast("bigint") * 1048576).alias("active_bytes"),
        (F.sum("parts_total").cast("bigint") * 1048576).alias("time_travel_bytes"),
        (F.count(F.lit(1)) * 4096).alias("failsafe_bytes"))


@query("storage_footprint", O.with_log(
    "SELECT table_name, active_bytes / power(1024, 3) AS active_gb, time_travel_bytes / power(1024, 3) AS time_travel_gb, "
    "failsafe_bytes / power(1024, 3) AS failsafe_gb FROM sizes", _SIZES_SQL))
def q_storage_footprint(spark, sf_dir):
    return RL.storage_footprint(sizes(spark, sf_dir))


@query("failure_alert", O.with_log(
    f"SELECT count(*) > 0 AS alert FROM (SELECT 1 FROM run_log WHERE {W(1)} AND "
    f"object_name IN ('TASK_0', 'TASK_1', 'TASK_2', 'TASK_3', 'TASK_4') AND state = 'FAILED' LIMIT 1)"))
def q_failure_alert(spark, sf_dir):
    return RL.failure_alert(log(spark, sf_dir), ALERT_OBJECTS, NOW, 60)


@query("log_predicates", O.with_log(
    f"SELECT run_id, object_name, state, scheduled_time, elapsed FROM run_log "
    f"WHERE state <> 'SUCCEEDED' AND (object_name IN ('TASK_0', 'TASK_3') OR elapsed > 450) "
    f"AND parts_scanned IS NOT NULL AND scheduled_time >= {O.NOW} - INTERVAL 7 DAY"))
def q_log_predicates(spark, sf_dir):
    """NOT NULL, equality, inequality, IN, OR and a trailing-window bound together."""
    lg = log(spark, sf_dir)
    cond = ((F.col("state") != "SUCCEEDED")
            & (F.col("object_name").isin("TASK_0", "TASK_3") | (F.col("elapsed") > 450))
            & F.col("parts_scanned").isNotNull()
            & (F.col("scheduled_time") >= S.lit_ts(NOW - dt.timedelta(days=7))))
    return lg.filter(cond).select("run_id", "object_name", "state", "scheduled_time", "elapsed")


@query("text_search_ilike", O.with_log(
    "SELECT run_id, object_name, props FROM run_log WHERE CAST(json(props) AS VARCHAR) ILIKE '%\"K\":7%' "
    "ORDER BY scheduled_time DESC, run_id LIMIT 20"))
def q_text_search_ilike(spark, sf_dir):
    """Case-insensitive search in a semi-structured value serialised to text."""
    lg = log(spark, sf_dir)
    txt = F.to_json(F.parse_json("props"))
    return (lg.filter(S.contains_ci(txt, '"K":7')).orderBy(F.col("scheduled_time").desc(), "run_id")
            .limit(20).select("run_id", "object_name", "props"))


_EDGES_SQL = ("edges AS (SELECT DISTINCT 'TASK_' || CAST(user_id % 5 AS VARCHAR) AS source, "
              "'EVENT_' || upper(event_type) AS target FROM events)")


def edges(spark, sf_dir):
    ev = T.read_table(spark, sf_dir, "events")
    return ev.select(F.concat(F.lit("TASK_"), (F.col("user_id") % 5).cast("string")).alias("source"),
                     F.concat(F.lit("EVENT_"), F.upper("event_type")).alias("target")).distinct()


@query("lineage_neighbours", O.with_log(
    "SELECT source, target FROM edges WHERE source = 'TASK_1' OR target = 'TASK_1'", _EDGES_SQL))
def q_lineage_neighbours(spark, sf_dir):
    return RL.lineage_neighbours(edges(spark, sf_dir), "TASK_1")


@query("union_status", O.with_log(
    "SELECT 'TASK_0' AS object_name, max(scheduled_time) AS last_run, arg_max(state, (scheduled_time, run_id)) AS last_state "
    "FROM run_log WHERE object_name = 'TASK_0' UNION ALL "
    "SELECT 'TASK_1', max(scheduled_time), arg_max(state, (scheduled_time, run_id)) FROM run_log WHERE object_name = 'TASK_1'"))
def q_union_status(spark, sf_dir):
    return RL.union_status(log(spark, sf_dir), ("TASK_0", "TASK_1"))


@query("freshness", O.with_star(
    "SELECT (SELECT max(processed_at) FROM valid_fact) AS last_valid_trade_processed, "
    "(SELECT max(logged_at) FROM rejected_fact) AS last_rejected_trade_logged, "
    "(SELECT max(loaded_at) FROM fx_latest) AS last_fx_rate_loaded, "
    "(SELECT max(updated_at) FROM scd_history) AS last_snapshot_update",
    O.FX_RAW_CTE, O.FX_LATEST_CTE, *_scd_sql_ctes()))
def q_freshness(spark, sf_dir):
    from ..operators import state as STT
    dec = decision_log(spark, sf_dir)
    return RL.freshness({
        "last_valid_trade_processed": (valid(spark, sf_dir), "processed_at"),
        "last_rejected_trade_logged": (rejected(spark, sf_dir), "logged_at"),
        "last_fx_rate_loaded": (STT.latest_rate(T.fx_rates_raw(spark, sf_dir)), "loaded_at"),
        "last_snapshot_update": (history(spark, sf_dir, dec), "updated_at"),
    })


@query("pipeline_lag", O.with_star(
    "SELECT b AS latest_bronze_row, g AS latest_gold_row, "
    "datediff('minute', g, b) AS gold_lag_minutes "
    "FROM (SELECT (SELECT max(loaded_at) FROM deliveries) AS b, (SELECT max(processed_at) FROM valid_fact) AS g)"))
def q_pipeline_lag(spark, sf_dir):
    return RL.lag_minutes(deliveries(spark, sf_dir), "loaded_at", valid(spark, sf_dir), "processed_at")


@query("backlog", O.with_decisions(
    "SELECT EXISTS (SELECT 1 FROM deliveries d WHERE NOT EXISTS "
    "(SELECT 1 FROM decisions x WHERE x.batch_id <= 2 AND x.message_id = d.message_id)) AS has_backlog"))
def q_backlog(spark, sf_dir):
    """Landed messages not yet decided when only batches <= 2 have run."""
    done = decisions(spark, sf_dir).filter(F.col("batch_id") <= 2)
    return RL.has_backlog(deliveries(spark, sf_dir), done)


@query("layout_overlap", O.with_decisions(
    """SELECT a.file_name, a.lo, a.hi, CAST(count(*) - 1 AS BIGINT) AS overlapping_groups
       FROM (SELECT file_name, min(maturity_date) AS lo, max(maturity_date) AS hi FROM decisions GROUP BY file_name) a
       JOIN (SELECT file_name, min(maturity_date) AS lo, max(maturity_date) AS hi FROM decisions GROUP BY file_name) b
         ON a.lo <= b.hi AND b.lo <= a.hi
       GROUP BY a.file_name, a.lo, a.hi"""))
def q_layout_overlap(spark, sf_dir):
    """Clustering depth of the decision log's files on maturity date."""
    return RL.layout_overlap(decisions(spark, sf_dir), "file_name", "maturity_date")
