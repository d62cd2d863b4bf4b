"""A drain whose whole rows are shuffled once, by trade."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from paths import SF_SMALL

from dealstream.operators import decide as D
from dealstream.plans import queries_core as QC
from dealstream.plans import queries_io as QI
from dealstream.session import unique_dir
from dealstream.sources import ingest as I
from dealstream.sources import tables as T

SCHEMA = ("trade_id bigint, version bigint, message_id string, source_system string, event_timestamp timestamp_ntz, trade_date date, "
          "maturity_date date, product_type string, counterparty string, trader string, book string, currency string, notional double, "
          "price double, file_name string, loaded_at timestamp_ntz, batch_id bigint")
AS_OF = dt.date(2026, 1, 10)


def _rows(spark, seed, n=400):
    """Copies inside and across trades, rows without a trade, version or maturity; a load time each, so that first arrivals are unique."""
    rnd, at = random.Random(seed), dt.datetime(2026, 1, 1)
    rows = []
    for i in range(n):
        rows.append((rnd.choice([None, *range(12)]), rnd.choice([None, 1, 2, 3]), f"m{rnd.randrange(n // 2)}", "S", at + dt.timedelta(hours=rnd.randrange(9)),
                     at.date(), rnd.choice([None, dt.date(2026, 1, 9), dt.date(2026, 6, 1)]), "P", "C", "T", "B", "USD", float(i), 1.0, f"f{rnd.randrange(3)}",
                     at + dt.timedelta(seconds=rnd.randrange(n) * n + i), rnd.randrange(3)))
    return spark.createDataFrame(rows, SCHEMA)


def _sorted(df):
    return sorted(map(str, df.select(*D.DECISION_COLUMNS).collect()))


def test_laid_equals_drain(spark):
    for seed in (1, 2):
        rows = _rows(spark, seed)
        seen = spark.createDataFrame([(f"m{i}",) for i in range(0, 200, 7)], "message_id string")
        state = spark.createDataFrame([(None, 3), (1, 2), (2, 3), (5, 1)], "trade_id bigint, existing_version bigint")
        new = D.dedup_first(rows).join(seen, "message_id", "left_anti")
        assert _sorted(D.evaluate_drain(rows, seen, AS_OF, state=state, by_trade=True)) == _sorted(D.evaluate_drain(new, None, AS_OF, state=state, dedup=False))
        assert _sorted(D.evaluate_drain(rows, None, AS_OF, by_trade=True)) == _sorted(D.evaluate_drain(rows, None, AS_OF))
        one = rows.filter("batch_id = 1")
        assert _sorted(D.evaluate_batch(one, seen, AS_OF, state=state, by_trade=True)) == _sorted(D.evaluate_batch(one, seen, AS_OF, state=state))


def test_a_hot_trade_is_not_dealt_by_trade(spark, monkeypatch):
    rows = _rows(spark, 3)
    assert D.evenly_by_trade(rows) and D.evenly_by_trade(rows.limit(0))
    monkeypatch.setattr(D, "HOT_ROWS", 60)
    hot = rows.withColumn("trade_id", F.when(F.col("version").isNull(), F.col("trade_id")).otherwise(F.lit(7).cast("bigint")))
    assert not D.evenly_by_trade(hot)

    def dealt(*_):
        raise AssertionError("a hot trade is dealt to one task")

    monkeypatch.setattr(D, "evaluate_laid", dealt)
    assert _sorted(D.evaluate_drain(hot, None, AS_OF, by_trade=True)) == _sorted(D.evaluate_drain(hot, None, AS_OF))


def test_whole_rows_are_shuffled_once(spark):
    path = unique_dir(spark, "test", "staged")
    QC.deliveries(spark, SF_SMALL).write.parquet(path)
    out = D.evaluate_drain(spark.read.parquet(path), None, T.AS_OF, by_trade=True)
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    wide = {i for i in re.findall(r"(?:Exchange hashpartitioning\()([^\n]*)", final)}
    whole = [w for w in wide if "REPARTITION" in w]
    assert len(whole) == 1, final
    other = [w for w in wide if "REPARTITION" not in w]
    assert all("message_id" not in w and "batch_id" not in w for w in other), final


def test_streams_write_no_feed(spark, monkeypatch):
    made = []
    real = QI.unique_dir
    monkeypatch.setattr(QI, "unique_dir", lambda s, *parts: made.append(parts) or real(s, *parts))
    got = QI.q_stream_skip_bad_files(spark, SF_SMALL)
    assert got.filter(F.col("file_name") == QI.BAD_DEAL_FILE).isEmpty() and not got.isEmpty()
    assert ("tables", "deliveries") not in made


def test_odd_records_are_typed_field_by_field(spark):
    fields = (("a", "bigint"), ("d", "date"), ("s", "string"), ("event_timestamp", "timestamp"))
    lines = ['{"a": 1, "d": "2026-01-02", "s": "x", "event_timestamp": "2026-01-02T03:04:05Z"}', '{"a": "7", "d": "no", "s": 5}', '{"a": 2.5, "s": {"b": [1]}}',
             "[1, 2]", "3", "null", '{"a": true, "d": null}', '{"a": 1', "", '{"a": 1, "a": 2}', '{"a": 9999999999999999999999, "s": 1e2}', None]
    df = spark.createDataFrame([(x, i) for i, x in enumerate(lines)], "raw string, i int")
    got = I.flagged_messages(df, fields=fields)
    v = df.withColumn("_v", F.try_parse_json("raw"))
    typed = v.select("_v", *I.flatten(F.col("_v"), fields, strict=False), "i")
    bad = F.col("_v").isNull()
    for n, t in fields:
        if t != "string":
            bad = bad | (F.col(n).isNull() & F.try_variant_get("_v", f"$.{n}", "string").isNotNull())
    want = typed.withColumn("bad", bad).drop("_v").withColumn("event_timestamp", I.utc_time("event_timestamp"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_ids_travel_as_bytes_and_come_back_as_they_were(spark):
    ids = [None, "", "a", "ab", "AB", "aB", "0f", "0f1", "zz", "00ff00ff", "é0", " 0f", "0f\n", "0x0f"]
    df = spark.createDataFrame([(x, i) for i, x in enumerate(ids)], "message_id string, i int")
    packed = D._packed(df)
    assert {r.i for r in packed.filter("_bytes IS NOT NULL").collect()} == {i for i, x in enumerate(ids) if x in ("ab", "0f", "00ff00ff")}
    assert {r.i: r.message_id for r in D._unpacked(packed).collect()} == dict(enumerate(ids))


def test_hex_ids_seen_before_and_under_two_trades(spark):
    rows = _rows(spark, 5).withColumn("message_id", F.md5("message_id"))
    seen = spark.createDataFrame([(f"m{i}",) for i in range(0, 200, 5)] + [(None,)], "message_id string").select(F.md5("message_id").alias("message_id"))
    new = D.dedup_first(rows).join(seen, "message_id", "left_anti")
    none = spark.createDataFrame([], "trade_id bigint, existing_version bigint")
    assert _sorted(D.evaluate_drain(rows, seen, AS_OF, state=none, by_trade=True)) == _sorted(D.evaluate_drain(new, None, AS_OF, dedup=False))


def test_a_drain_with_seen_ids_deals_whole_rows_once(spark, monkeypatch):
    path = unique_dir(spark, "test", "staged")
    QC.deliveries(spark, SF_SMALL).write.parquet(path)
    rows = spark.read.parquet(path)
    seen = rows.filter("batch_id = 1").select("message_id").distinct()
    state = spark.createDataFrame([(1, 2)], "trade_id bigint, existing_version bigint")
    out = D.evaluate_drain(rows, seen, T.AS_OF, state=state, by_trade=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    dealt = [re.sub(r"#\w+", "", x) for x in re.findall(r"Exchange hashpartitioning\([^\n]*REPARTITION[^\n]*\n[^\n]*?(Project \[[^\n]*)", plan)]
    assert dealt and len(set(dealt)) == 1, set(dealt)


def test_the_rebuild_parses_once_and_deals_by_trade(spark, monkeypatch):
    laid, real = [], D.evaluate_laid
    monkeypatch.setattr(D, "evaluate_laid", lambda rows, *a, **k: laid.append(rows) or real(rows, *a, **k))
    QI.q_rebuild_equals_stream(spark, SF_SMALL)
    plan = laid[0]._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "try_parse_json" not in plan


def test_a_file_delivered_again_is_read_from_the_landing(spark, monkeypatch):
    derived, again = [], []
    land, lines = QI.J.land_messages, QI.J.land_lines
    monkeypatch.setattr(QI.J, "land_messages", lambda *a, **k: derived.append(a) or land(*a, **k))
    monkeypatch.setattr(QI.J, "land_lines", lambda rows, *a, **k: again.append(rows) or lines(rows, *a, **k))
    QI._two_drains(spark, SF_SMALL, lambda landing: None, reupload=True)
    assert len(derived) == 2 and len(again) == 3
    dl = QC.deliveries(spark, SF_SMALL).filter("file_name = 'deals_b1.jsonl'")
    got = again[-1]
    assert [r.n for r in got.groupBy("file_name").count().withColumnRenamed("count", "n").collect()] == [dl.count()]
    seen = got.select("batch_id", "file_name", F.get_json_object("raw", "$.message_id").alias("message_id"), "loaded_at")
    assert seen.select("batch_id", "file_name").distinct().collect() == [(T.N_BATCHES - 1, "reupload_b1.jsonl")]
    want = dl.select("message_id", F.expr("timestampadd(HOUR, 3, loaded_at)").alias("loaded_at"))
    assert seen.select(*want.columns).exceptAll(want).isEmpty()
