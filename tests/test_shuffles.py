"""What moves and what is written: whole rows lie by trade, facts are not dealt again."""

import datetime as dt
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paths import SF_SMALL

from dealstream.operators import decide as D
from dealstream.operators import state as STT
from dealstream.operators.gold import Gold
from dealstream.plans import queries_core as QC
from dealstream.plans.store import BOUNDS
from dealstream.session import unique_dir
from dealstream.sources import files
from dealstream.sources import ingest as I
from dealstream.sources import tables as T
from dealstream.sources.keyed import KeyedTable

T0 = dt.datetime(1998, 7, 1)


def test_dedup_by_trade_equals_dedup_first(spark):
    """Ids under several trades, NULL ids, NULL load times and copies inside a trade."""
    at = lambda m: T0 + dt.timedelta(minutes=m)
    rows = [(1, "a", at(0), "f"), (1, "a", at(5), "g"), (2, "a", at(3), "f"), (3, "a", None, "f"), (2, "b", at(9), "f"), (1, "b", at(9), "e"),
            (4, None, at(1), "f"), (5, None, at(2), "f"), (4, None, at(0), None), (6, "c", None, "h"), (6, "c", None, "g"), (7, "d", at(1), "f")]
    df = spark.createDataFrame(rows, "trade_id bigint, message_id string, loaded_at timestamp_ntz, file_name string")
    want = sorted(map(str, D.dedup_first(df).collect()))
    assert sorted(map(str, D.dedup_by_trade(df).collect())) == want and len(want) == 5
    tie = spark.createDataFrame([(2, "a", at(0), "f"), (1, "a", at(0), "f")], df.schema)
    assert [r.trade_id for r in D.dedup_by_trade(tie).collect()] == [1]


def test_replay_by_trade_equals_replay(spark):
    dl = QC.deliveries(spark, SF_SMALL)
    want = sorted(map(str, D.evaluate_replay(dl, T.AS_OF).collect()))
    assert sorted(map(str, D.evaluate_replay(dl, T.AS_OF, by_trade=True).collect())) == want


def test_replay_moves_no_whole_row_after_the_join(spark):
    df = QC.q_evaluate_replay(spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)", p)
    assert not [k for k in keys if "batch_id" in k or k.startswith("coalesce(trade_id")], keys
    assert {re.sub(r"#\w+", "", k.split(",")[0]) for k in keys} <= {"l_orderkey", "o_orderkey", "o_custkey", "c_custkey", "l_partkey", "p_partkey",
                                                                    "l_suppkey", "s_suppkey", "message_id", "_trade"}


def test_facts_are_sorted_where_they_lie(spark, monkeypatch):
    root = unique_dir(spark, "t", "facts")
    I.append(QC.decisions(spark, SF_SMALL), f"{root}/log", 0)

    def dealt(*_):
        raise AssertionError("rejects are shuffled")

    monkeypatch.setattr(DataFrame, "repartitionByRange", dealt)
    Gold(spark, root, f"{root}/log", BOUNDS, buckets=4).refresh()
    part = spark.read.parquet(f"{root}/rejected/epoch=0").select(F.input_file_name().alias("f"), "maturity_date", F.monotonically_increasing_id().alias("n"))
    seen: dict = {}
    for r in part.orderBy("n").collect():
        assert seen.get(r.f, dt.date.min) <= r.maturity_date
        seen[r.f] = r.maturity_date


def test_first_merge_ranks_once(spark, monkeypatch):
    t = KeyedTable(spark, unique_dir(spark, "t", "keyed"), ("k",), (F.col("v").desc(),), buckets=3)

    def again(*_):
        raise AssertionError("ranked against nothing")

    with monkeypatch.context() as m:
        m.setattr(STT, "upsert_latest", again)
        t.merge(spark.createDataFrame([(1, 1), (1, 2), (2, 5), (None, 7)], "k int, v int"), mark=1)
    assert sorted(map(str, t.read().collect())) == sorted(map(str, spark.createDataFrame([(1, 2), (2, 5), (None, 7)], "k int, v int").collect()))
    assert not files.exists(spark, f"{t.path}/changes")
    t.merge(spark.createDataFrame([(2, 6), (3, 1)], "k int, v int"), mark=2)
    assert t.mark() == "2" and sorted((r.k or 0, r.v) for r in t.read().collect()) == [(0, 7), (1, 2), (2, 6), (3, 1)]


def test_one_derivation_and_no_id_is_shuffled(spark):
    """The ids are compared by hash and trade, which come out of the same shuffle of the lines as the rows."""
    df = QC.q_evaluate_replay(spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    lines = {re.sub(r"#\w+", "", x) for x in re.findall(r"Exchange hashpartitioning\(l_orderkey[^\n]*\n[^\n]*Project \[([^\n]*)\]", p)}
    assert len(lines) == 1, lines
    ids = re.findall(r"Exchange hashpartitioning\(message_id[^\n]*\n[^\n]*Project \[([^\n]*)\]", p)
    assert any("xxhash64(message_id" in x for x in ids) and not any("loaded_at" in x and "_row" in x for x in ids), ids


def test_rank_shuffles_only_what_ranks(spark):
    p = QC.q_rank_in_batch(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.findall(r"p_type|s_name|c_mktsegment|l_extendedprice", p)
    keys = {re.sub(r"#\w+", "", k.split(",")[0]) for k in re.findall(r"Exchange hashpartitioning\(([^)]*)", p)}
    assert "batch_id" not in keys and not [k for k in keys if k.startswith("coalesce(trade_id")], keys


def test_ids_that_share_a_hash_stay_apart(spark, monkeypatch):
    """A hash of one value for all ids: every row is a suspect, and the ids decide."""
    at = lambda m: T0 + dt.timedelta(minutes=m)
    rows = [(1, "a", at(0), "f"), (2, "a", at(3), "f"), (3, "b", at(1), "f"), (4, None, at(1), "f"), (5, None, at(0), "f"), (1, "c", at(0), "f")]
    df = spark.createDataFrame(rows, "trade_id bigint, message_id string, loaded_at timestamp_ntz, file_name string")
    want = sorted(map(str, D.dedup_first(df).collect()))
    monkeypatch.setattr(D.F, "xxhash64", lambda *_: F.lit(7).cast("bigint"))
    assert sorted(map(str, D.dedup_by_trade(df).collect())) == want and len(want) == 4
