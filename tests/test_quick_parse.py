"""Lines are typed by a plain read; those it might type otherwise go through their variant. Costly steps fill all waves."""

import json

from pyspark.sql import functions as F

from dealstream.session import even_waves, unique_dir
from dealstream.sources import ingest as I
from dealstream.streaming import jobs as J

GOOD = {"trade_id": 20, "version": 2, "message_id": "22af042d", "source_system": "LF", "event_timestamp": "1996-08-27T14:11:00.000000Z",
        "trade_date": "1996-08-27", "maturity_date": "1998-03-06", "product_type": "MEDIUM", "counterparty": "N:1", "trader": "S", "book": "B",
        "currency": "CHF", "notional": 19379.42, "price": 7.0}
VALUES = ["null", "true", "5", "-5", "5.0", "1e2", "1e400", "-0.0", "-0", "9223372036854775808", "0.12345678901234567890123", "NaN", "2024", '"5"',
          '""', '"NaN"', '"12e5"', '"1996-8-7"', '"1996"', '"12:00:00"', '"1996-13-01"', '"99999-01-01"', '{"a": 1e2}', "[1, 2]", '"{x"', '"a\\"b"',
          '"\\u00e9"', '"a:b"', "'x'", '"x","book":"y"', '"x","extra":{"book":1.0}']
WHOLE = [None, "", "null", "[]", "5", "{", '{"trade_id":1}}', '{"trade_id":1} x', '[{"trade_id":1}]', ' {"trade_id":1}', '{"trade_id":1,}', "{'trade_id':1}",
         '{"trade_id":1,"trade_id":2}', '{"x":1,"x":2}', '{"\\u0062ook":1e2}', '{"trade_id" : 1 , "_corrupt":"z"}', '{"book":null,"price":2}', "{}"]


def _line(**over):
    return "{" + ",".join(f'"{k}":{over.get(k, json.dumps(v))}' for k, v in GOOD.items()) + "}"


def test_lines_are_typed_as_their_variant_casts(spark):
    lines = [*WHOLE, _line(), *(_line(**{k: v}) for k in ("trade_id", "book", "event_timestamp", "trade_date", "price") for v in VALUES)]
    df = spark.createDataFrame(list(enumerate(lines)), "n int, raw string").repartition(3)
    text = lambda d: {r.n: tuple(r) for r in d.select("n", *[F.col(n).cast("string") for n, _ in I.MESSAGE_FIELDS], "bad").collect()}
    for fields in (I.ADAPTER_FIELDS, I.MESSAGE_FIELDS):
        raw = df.select(F.try_parse_json("raw").alias("raw"), "n").withColumn("bad", I.unreadable(F.col("raw"), fields))
        want = text(I.flatten_messages(raw, strict=False, fields=fields))
        assert text(I.flagged_messages(df, fields=fields)) == want
        assert not want[len(WHOLE)][-1] and len({r[-1] for r in want.values()}) == 2


def test_a_plain_record_is_not_cast_from_its_variant(spark):
    plan = I.flagged_messages(spark.createDataFrame([(_line(), "f")], "raw string, file_name string"), fields=I.ADAPTER_FIELDS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_a_drain_and_its_landing_run_in_even_waves(spark, monkeypatch):
    keys = ("spark.sql.files.minPartitionNum", "spark.sql.adaptive.coalescePartitions.minPartitionNum")
    want = str(4 * spark.sparkContext.defaultParallelism)
    seen, take = [], J.Staging.stage
    monkeypatch.setattr(J.Staging, "stage", lambda self, df, epoch: (seen.append([df.sparkSession.conf.get(k, None) for k in keys]), take(self, df, epoch))[1])
    landing, out, ckpt = (unique_dir(spark, "test", n) for n in ("landing", "out", "ckpt"))
    spark.createDataFrame([(_line(), "f")], "raw string, file_name string").selectExpr("raw", "file_name", "CAST(NULL AS timestamp_ntz) AS loaded_at", "0L AS batch_id").write.partitionBy(
        "batch_id").parquet(landing)
    assert J.cdc_drain(spark, landing, out, ckpt) == 1
    assert seen == [[want, want]] and [spark.conf.get(k, None) for k in keys] == [None, None]
    assert [r.message_id for r in I.read_appended(spark, out).collect()] == ["22af042d"]
    spark.conf.set(keys[0], "3")
    try:
        with even_waves(spark):
            assert spark.conf.get(keys[0]) == "3"
        assert spark.conf.get(keys[0]) == "3"
    finally:
        spark.conf.unset(keys[0])
