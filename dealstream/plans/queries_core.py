"""Registered queries over the deal feed: the decision core."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import decide as D
from ..session import configure
from ..sources import tables as T
from . import oracle as O
from .catalog import query

EVAL_BATCH = T.N_BATCHES - 1  # the batch evaluated against the state of the earlier ones


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return T.deal_deliveries(spark, sf_dir)


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision log of all batches (W4 replay)."""
    return D.evaluate_replay(deliveries(spark, sf_dir), T.AS_OF, by_trade=True)


def decision_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored decision log (a table in its own right; a lost executor
    re-reads files instead of replaying the whole derivation)."""
    from .store import log

    return log(spark, sf_dir)


@query("evaluate_replay", O.with_decisions(f"SELECT {O.DECISION_COLS} FROM decisions"))
def q_evaluate_replay(spark, sf_dir):
    return decisions(spark, sf_dir)


@query("decision_counts", O.with_decisions(
    "SELECT batch_id, decision, decision_reason, count(*) AS message_count "
    "FROM decisions GROUP BY ALL"))
def q_decision_counts(spark, sf_dir):
    return D.decision_counts(decisions(spark, sf_dir))


@query("dedup_first_arrival", O.with_decisions(
    "SELECT message_id, trade_id, batch_id, file_name, loaded_at FROM staged"))
def q_dedup_first_arrival(spark, sf_dir):
    d = D.dedup_first(deliveries(spark, sf_dir), "message_id", ("loaded_at", "file_name"))
    return d.select("message_id", "trade_id", "batch_id", "file_name", "loaded_at")


@query("rank_in_batch", O.with_decisions(
    "SELECT message_id, trade_id, batch_id, version, rank_in_batch = 1 AS is_batch_winner FROM ranked"))
def q_rank_in_batch(spark, sf_dir):
    # what rank and first arrival are found from; the rows lie by trade
    ranked_by = ("message_id", "trade_id", "batch_id", "version", "event_timestamp", "maturity_date", "loaded_at", "file_name")
    msgs = D.dedup_by_trade(deliveries(spark, sf_dir).select(*ranked_by))
    return D.rank_in_batch(msgs, by_trade=True).select("message_id", "trade_id", "batch_id", "version", "is_batch_winner")


@query("known_state", O.with_decisions(
    "SELECT trade_id, max(version) AS existing_version FROM decisions "
    "WHERE decision = 'ACCEPTED' GROUP BY trade_id"))
def q_known_state(spark, sf_dir):
    return D.known_state(decisions(spark, sf_dir))


def _prior_and_batch(spark, sf_dir):
    dec = decision_log(spark, sf_dir)
    prior = dec.filter(F.col("batch_id") < EVAL_BATCH)
    batch = deliveries(spark, sf_dir).filter(F.col("batch_id") == EVAL_BATCH)
    return prior, batch


@query("existing_version_join", O.with_decisions(
    f"SELECT message_id, trade_id, version, known AS existing_version FROM (SELECT message_id, trade_id, version, batch_id, "
    f"max(CASE WHEN decision = 'ACCEPTED' AND batch_id < {EVAL_BATCH} THEN version END) OVER (PARTITION BY trade_id) AS known "
    f"FROM decisions) WHERE batch_id = {EVAL_BATCH}"))
def q_existing_version_join(spark, sf_dir):
    prior, batch = _prior_and_batch(spark, sf_dir)
    msgs = D.dedup_first(batch)
    return (D.attach_existing_version(msgs, D.known_state(prior))
            .select("message_id", "trade_id", "version", "existing_version"))


@query("evaluate_batch", O.with_decisions(f"SELECT {O.DECISION_COLS} FROM decisions"))
def q_evaluate_batch(spark, sf_dir):
    """C1 run the way the scheduled job runs: batch after batch, each decided
    against the decision log on file and appended to it (one written
    partition per batch); the result is the whole log."""
    from ..session import unique_dir
    from ..sources import ingest as I

    feed_path = unique_dir(spark, "tables", "deliveries")
    deliveries(spark, sf_dir).write.parquet(feed_path)
    feed = spark.read.parquet(feed_path)
    log_path = unique_dir(spark, "tables", "decision_log_batches")
    from ..streaming import jobs as J

    state_path = unique_dir(spark, "tables", "decision_state")
    batch_ids = [r[0] for r in feed.select("batch_id").distinct().orderBy("batch_id").collect()]  # run ids
    gate, ids = J.version_gate(spark, state_path), J.decided_ids(spark, state_path)
    for b in batch_ids:
        # version gate and decided ids: runs in levels, of which a run reads the
        # buckets it needs (the log is neither aggregated nor scanned)
        batch = feed.filter(F.col("batch_id") == b)
        seen = J.on_file(ids.lookup(b, batch.select("message_id")), f"{state_path}/seen")
        out = D.evaluate_batch(batch, seen, T.AS_OF, state=gate.lookup(b, batch.select("trade_id")), by_trade=True)
        I.append(out.select(*D.DECISION_COLUMNS), log_path, b)
        done = I.read_appended(spark, log_path, since=b, before=b + 1)
        gate.add(D.known_state(done), b)
        ids.add(done.select("message_id"), b)
    return I.read_appended(spark, log_path)


@query("accepted_messages", O.with_decisions(
    f"SELECT {O.DECISION_COLS} FROM decisions WHERE decision = 'ACCEPTED'"))
def q_accepted(spark, sf_dir):
    return decisions(spark, sf_dir).filter(F.col("decision") == K.ACCEPTED)


@query("rejected_messages", O.with_decisions(
    f"SELECT {O.DECISION_COLS} FROM decisions WHERE decision = 'REJECTED'"))
def q_rejected(spark, sf_dir):
    return decisions(spark, sf_dir).filter(F.col("decision") == K.REJECTED)
