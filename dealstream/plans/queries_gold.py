"""Registered queries: stored gold tables merged by watermark, the stream's backlog,
schema evolution and the raw landing by load date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import gold as G
from ..session import unique_dir
from ..sources import committed as C
from ..sources import ingest as I
from ..sources import tables as T
from ..streaming import jobs as J
from . import oracle as O
from .catalog import query
from .queries_core import deliveries
from .store import BOUNDS

# --- fixed values: batches per drain, load times between FX refreshes, the day read back -------
DRAINS = ((0,), (1, 2), (3,))
FX_CUTS = (dt.datetime(1994, 6, 1), dt.datetime(1997, 1, 1), dt.datetime(2100, 1, 1))
RAW_DAYS = (dt.date(2024, 1, 10), dt.date(2024, 1, 12))


def _three_drains(spark, sf_dir):
    """Three landings, each drained, decided and merged into the gold tables."""
    landing, out, ckpt, gold = (unique_dir(spark, *x) for x in (("landing", "gold"), ("tables", "gold_log"), ("streams", "gold"), ("tables", "gold")))
    # a filter on the batch reaches the scan of the lines: each landing derives its own, no feed is written
    dl, facts = deliveries(spark, sf_dir), G.Gold(spark, gold, out, BOUNDS, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    for batches in DRAINS:
        J.land_messages(dl.filter(F.col("batch_id").isin(list(batches))), landing)
        J.stream_decisions(spark, landing, out, ckpt, T.AS_OF)
        facts.refresh()
        facts.refresh()  # nothing newer than the marks: no version is written
    return facts


@query("valid_fact_incremental", O.with_star("SELECT * FROM valid_fact"))
def q_valid_fact_incremental(spark, sf_dir):
    """C2 merged by trade after each of three drains."""
    return _three_drains(spark, sf_dir).valid()


@query("rejected_fact_incremental", O.with_star("SELECT * FROM rejected_fact"))
def q_rejected_fact_incremental(spark, sf_dir):
    """C3 appended to after each of three drains."""
    return _three_drains(spark, sf_dir).rejected()


@query("fx_rates_incremental", O.with_decisions("SELECT * FROM fx_latest", O.FX_RAW_CTE, O.FX_LATEST_CTE))
def q_fx_rates_incremental(spark, sf_dir):
    """C11 merged three times from loads newer than the stored mark."""
    raw = T.fx_rates_raw(spark, sf_dir)
    rates = G.Rates(spark, unique_dir(spark, "tables", "fx_gold"))
    for cut in FX_CUTS:
        rates.refresh(raw.filter(F.col("loaded_at") < S.lit_ts(cut)))
    return rates.read().select("as_of_date", "currency", "rate_to_usd", "file_name", "loaded_at")


@query("stream_backlog", O.with_decisions(
    "SELECT phase, phase <> 2 AND (SELECT count(*) FROM deliveries) > 0 AS has_backlog FROM (SELECT unnest([1, 2, 3]) AS phase)"))
def q_stream_backlog(spark, sf_dir):
    """A18 of a stream, from the landing's listing and the checkpoint: before a drain, after it, after the next landing."""
    landing, out, ckpt = (unique_dir(spark, *x) for x in (("landing", "backlog"), ("tables", "backlog"), ("streams", "backlog")))
    dl = deliveries(spark, sf_dir)
    found = []
    for phase in (1, 2, 3):
        if phase == 2:
            J.cdc_drain(spark, landing, out, ckpt)
        else:
            J.land_messages(dl.filter((F.col("batch_id") < 2) == F.lit(phase == 1)), landing)
        found.append((phase, C.stream_backlog(spark, landing, ckpt).first()["has_backlog"]))
    return spark.createDataFrame(found, "phase int, has_backlog boolean")


@query("append_schema_evolution", O.with_decisions(
    "SELECT message_id, trade_id, CASE WHEN batch_id >= 2 THEN book END AS book, CASE WHEN batch_id >= 3 THEN price END AS price FROM deliveries"))
def q_append_schema_evolution(spark, sf_dir):
    """Later runs bring a column more each; rows of earlier runs read NULL in it."""
    path = unique_dir(spark, "tables", "evolving")
    dl = deliveries(spark, sf_dir)
    for run, (keep, columns) in enumerate(((F.col("batch_id") < 2, []), (F.col("batch_id") == 2, ["book"]), (F.col("batch_id") > 2, ["book", "price"]))):
        I.append(dl.filter(keep).select("message_id", "trade_id", *columns), path, run)
    return I.read_appended(spark, path)


@query("raw_by_load_date", O.with_log(
    f"SELECT run_id, object_name, state, scheduled_time FROM run_log WHERE CAST(scheduled_time AS DATE) BETWEEN DATE '{RAW_DAYS[0]}' AND DATE '{RAW_DAYS[1]}'"))
def q_raw_by_load_date(spark, sf_dir):
    """The raw run log landed by load date, three days of it read back from their folders."""
    path = unique_dir(spark, "landing", "raw_by_date")
    I.land_by_date(T.run_log(spark, sf_dir).select("run_id", "object_name", "state", "scheduled_time"), path, "scheduled_time")
    days = I.read_landed(spark, path, "run_id bigint, object_name string, state string, scheduled_time timestamp_ntz", *RAW_DAYS)
    return days.select("run_id", "object_name", "state", "scheduled_time")
