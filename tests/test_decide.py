"""Decision rules: the hand-made truth table, and replay == sequential fold."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from dealstream import constants as K
from dealstream.operators import decide as D

AS_OF = dt.date(2026, 1, 10)
LOADED = dt.datetime(2026, 1, 10, 12, 0)

SCHEMA = ("trade_id string, version bigint, message_id string, source_system string, "
          "event_timestamp timestamp_ntz, trade_date date, maturity_date date, product_type string, "
          "counterparty string, trader string, book string, currency string, notional double, price double, "
          "file_name string, loaded_at timestamp_ntz, batch_id bigint")


def msg(mid, trade, version, hour, maturity, batch=1, loaded=LOADED, file_name="f.jsonl"):
    return (trade, version, mid, "SYS", dt.datetime(2026, 1, 10, hour, 0), dt.date(2026, 1, 10), maturity,
            "IRS", "CP", "TR", "BK", "USD", 1000.0, 1.0, file_name, loaded, batch)


def prior_decisions(spark):
    """State before the batch: T1 -> 3, T2 -> 1, T5 -> 2 (accepted rows)."""
    rows = [msg("p1", "T1", 3, 9, dt.date(2026, 6, 1), batch=0),
            msg("p2", "T2", 1, 9, dt.date(2026, 6, 1), batch=0),
            msg("p5", "T5", 2, 9, dt.date(2026, 6, 1), batch=0)]
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F
    return df.select(*[c for c in df.columns if c != "loaded_at"],
                     F.col("loaded_at").alias("source_loaded_at"),
                     F.lit(None).cast("bigint").alias("existing_version"),
                     F.lit(K.ACCEPTED).alias("decision"), F.lit(K.NEW_TRADE_ACCEPTED).alias("decision_reason"),
                     F.col("loaded_at").alias("evaluated_at"))


TRUTH = [
    # id, trade, ver, hour, maturity, expected existing, decision, reason
    ("m1", "T1", 2, 10, dt.date(2026, 6, 1), 3, K.REJECTED, K.STALE_VERSION_LOWER_THAN_EXISTING),
    ("m2", "T2", 1, 10, dt.date(2026, 6, 1), 1, K.ACCEPTED, K.REPLACED_SAME_VERSION),
    ("m3", "T3", 1, 10, dt.date(2026, 6, 1), None, K.ACCEPTED, K.NEW_TRADE_ACCEPTED),
    ("m4", "T4", 2, 10, dt.date(2026, 1, 9), None, K.REJECTED, K.MATURITY_DATE_IN_PAST),
    ("m5", "T4", 1, 11, dt.date(2026, 6, 1), None, K.REJECTED, K.SUPERSEDED_IN_BATCH),
    ("m6", "T5", 3, 10, dt.date(2026, 6, 1), 2, K.ACCEPTED, K.NEW_TRADE_ACCEPTED),
    ("m7", "T6", 1, 10, dt.date(2026, 6, 1), None, K.REJECTED, K.SUPERSEDED_IN_BATCH),
    ("m8", "T6", 1, 11, dt.date(2026, 6, 1), None, K.ACCEPTED, K.NEW_TRADE_ACCEPTED),
    ("m9", "T7", 1, 10, dt.date(2026, 1, 10), None, K.ACCEPTED, K.NEW_TRADE_ACCEPTED),
    ("m10", "T1", 1, 10, dt.date(2025, 12, 1), 3, K.REJECTED, K.SUPERSEDED_IN_BATCH),
]


def test_truth_table(spark):
    batch = spark.createDataFrame([msg(r[0], r[1], r[2], r[3], r[4]) for r in TRUTH], SCHEMA)
    out = D.evaluate_batch(batch, prior_decisions(spark), AS_OF).collect()
    got = {r.message_id: (r.existing_version, r.decision, r.decision_reason) for r in out}
    assert len(got) == len(TRUTH)
    for mid, *_, existing, decision, reason in TRUTH:
        assert got[mid] == (existing, decision, reason), mid


def test_truth_table_as_drain(spark):
    """The multi-batch drain evaluator gives the same answers."""
    batch = spark.createDataFrame([msg(r[0], r[1], r[2], r[3], r[4]) for r in TRUTH], SCHEMA)
    out = D.evaluate_drain(batch, prior_decisions(spark), AS_OF).collect()
    got = {r.message_id: (r.decision, r.decision_reason) for r in out}
    for mid, *_, decision, reason in TRUTH:
        assert got[mid] == (decision, reason), mid


def test_duplicate_delivery_keeps_first_arrival(spark):
    rows = [msg("a", "T1", 1, 10, dt.date(2026, 6, 1), loaded=LOADED, file_name="x.jsonl"),
            msg("a", "T1", 1, 10, dt.date(2026, 6, 1), loaded=LOADED + dt.timedelta(hours=1), file_name="y.jsonl")]
    out = D.dedup_first(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == 1 and out[0].file_name == "x.jsonl"


def test_redelivery_in_later_drain_keeps_first_decision(spark):
    first = spark.createDataFrame([msg("a", "T1", 2, 10, dt.date(2026, 6, 1), batch=0)], SCHEMA)
    d0 = D.evaluate_batch(first, None, AS_OF, batch_id=0)
    again = spark.createDataFrame([msg("a", "T1", 2, 10, dt.date(2026, 6, 1), batch=1)], SCHEMA)
    assert D.evaluate_batch(again, d0, AS_OF).count() == 0


# --- replay == sequential fold -------------------------------------------------------
def fold(messages, as_of):
    """Brute force: batch after batch, exactly the written rules."""
    known = {}
    out = {}
    for b in sorted({m["batch_id"] for m in messages}):
        batch = [m for m in messages if m["batch_id"] == b]
        by_trade = {}
        for m in batch:
            by_trade.setdefault(m["trade_id"], []).append(m)
        accepted_now = {}
        for trade, ms in by_trade.items():
            ms = sorted(ms, key=lambda m: (-m["version"], -m["event_timestamp"].timestamp(),
                                           -m["loaded_at"].timestamp(), m["message_id"]))
            existing = known.get(trade)
            for rank, m in enumerate(ms, 1):
                if rank > 1:
                    d, r = K.REJECTED, K.SUPERSEDED_IN_BATCH
                elif m["maturity_date"] < as_of:
                    d, r = K.REJECTED, K.MATURITY_DATE_IN_PAST
                elif existing is not None and m["version"] < existing:
                    d, r = K.REJECTED, K.STALE_VERSION_LOWER_THAN_EXISTING
                elif existing is not None and m["version"] == existing:
                    d, r = K.ACCEPTED, K.REPLACED_SAME_VERSION
                else:
                    d, r = K.ACCEPTED, K.NEW_TRADE_ACCEPTED
                out[m["message_id"]] = (existing, d, r)
                if d == K.ACCEPTED:
                    accepted_now[trade] = max(accepted_now.get(trade, m["version"]), m["version"])
        for t, v in accepted_now.items():
            known[t] = max(known.get(t, v), v)
    return out


message_lists = st.lists(
    st.tuples(st.integers(0, 3), st.integers(1, 4), st.integers(0, 3), st.integers(-3, 3), st.integers(0, 2)),
    min_size=1, max_size=40)


@settings(max_examples=12, deadline=None)
@given(message_lists, st.randoms(use_true_random=False))
def test_replay_equals_sequential_fold(spark, specs, rnd):
    messages, rows = [], []
    for i, (trade, version, hour, mat_off, batch) in enumerate(specs):
        m = dict(message_id=f"m{i:03d}", trade_id=f"T{trade}", version=version,
                 event_timestamp=dt.datetime(2026, 1, 10, hour), maturity_date=AS_OF + dt.timedelta(days=mat_off),
                 loaded_at=LOADED + dt.timedelta(hours=batch), batch_id=batch)
        messages.append(m)
        rows.append(msg(m["message_id"], m["trade_id"], version, hour, m["maturity_date"], batch=batch,
                        loaded=m["loaded_at"]))
    rnd.shuffle(rows)  # input order must not matter
    expected = fold(messages, AS_OF)
    got = {r.message_id: (r.existing_version, r.decision, r.decision_reason)
           for r in D.evaluate_replay(spark.createDataFrame(rows, SCHEMA), AS_OF).collect()}
    assert got == expected


def test_null_version_and_maturity(spark):
    """DESC NULLS FIRST: a NULL version wins its batch; NULL compares to
    nothing, so the winner is accepted and the running maximum is unchanged."""
    rows = [msg("n1", "T9", None, 10, None, batch=0), msg("n2", "T9", 5, 10, dt.date(2026, 6, 1), batch=0),
            msg("n3", "T9", 1, 10, dt.date(2026, 6, 1), batch=1)]
    got = {r.message_id: (r.existing_version, r.decision, r.decision_reason)
           for r in D.evaluate_replay(spark.createDataFrame(rows, SCHEMA), AS_OF).collect()}
    assert got["n1"] == (None, K.ACCEPTED, K.NEW_TRADE_ACCEPTED)
    assert got["n2"] == (None, K.REJECTED, K.SUPERSEDED_IN_BATCH)
    assert got["n3"] == (None, K.ACCEPTED, K.NEW_TRADE_ACCEPTED)


def test_batch_loop_with_state_equals_fold(spark):
    """C1 run batch after batch with the compact version-gate state (advanced
    per run) gives the brute-force fold's decisions, with a redelivery of an
    already decided message in a later batch kept at its first decision."""
    import random

    rnd = random.Random(11)
    messages, rows = [], []
    for i in range(60):
        trade, version, hour = rnd.randint(0, 5), rnd.randint(1, 4), rnd.randint(0, 3)
        mat, batch = AS_OF + dt.timedelta(days=rnd.randint(-3, 3)), rnd.randint(0, 3)
        m = dict(message_id=f"m{i:03d}", trade_id=f"T{trade}", version=version,
                 event_timestamp=dt.datetime(2026, 1, 10, hour), maturity_date=mat,
                 loaded_at=LOADED + dt.timedelta(hours=batch), batch_id=batch)
        messages.append(m)
        rows.append(msg(m["message_id"], m["trade_id"], version, hour, mat, batch=batch, loaded=m["loaded_at"]))
    expected = fold(messages, AS_OF)
    # a redelivery of batch 0's first message inside batch 2
    first0 = next(r for r in rows if r[-1] == 0)
    rows.append(first0[:-2] + (LOADED + dt.timedelta(hours=2), 2))
    df = spark.createDataFrame(rows, SCHEMA)
    log = state = None
    for b in range(4):
        out = D.evaluate_batch(df.filter(df.batch_id == b), log, AS_OF, state=state)
        part = spark.createDataFrame(out.collect(), out.schema)  # a tiny fixture: keep plans short
        log = part if log is None else log.unionByName(part)
        state = spark.createDataFrame(D.advance_state(state, part).collect(), "trade_id string, existing_version bigint")
    got = {r.message_id: (r.existing_version, r.decision, r.decision_reason) for r in log.collect()}
    assert got == expected
