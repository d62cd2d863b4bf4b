"""Stored tables: keyed merges, state in levels, the file log, schema evolution, retention, reports on the stored fact."""

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL

from dealstream.operators import gold as G
from dealstream.operators import report as R
from dealstream.operators import scd as SCD
from dealstream.operators import star as ST
from dealstream.plans import queries_star as QS
from dealstream.plans import store
from dealstream.plans.queries_core import deliveries
from dealstream.session import unique_dir
from dealstream.sources import committed as C
from dealstream.sources import files
from dealstream.sources import ingest as I
from dealstream.sources import tables as T
from dealstream.sources.keyed import KeyedTable
from dealstream.streaming import jobs as J
from dealstream.streaming import tiers


def local(path):
    return path.replace("file:", "")


def data_files(path):
    return sorted(p for p in glob.glob(f"{local(path)}/**/*.parquet", recursive=True))


# --- keyed table -------------------------------------------------------------------------
def keyed(spark, buckets=8):
    return KeyedTable(spark, unique_dir(spark, "test", "keyed"), ("k",), (F.col("at").desc(),), buckets, ("v",))


def test_merge_keeps_files_of_untouched_buckets(spark):
    t = keyed(spark)
    first = t.merge(spark.range(200).select(F.col("id").alias("k"), F.lit(1).alias("at"), F.col("id").alias("v")), mark=1)
    before = {p: os.stat(p).st_mtime_ns for p in data_files(f"{t.path}/data")}
    second = t.merge(spark.createDataFrame([(3, 2, -3), (3, 1, -4), (500, 2, 5)], "k long, at int, v long"), mark=2)
    changed = {b for b in second.folders if second.folders[b] != first.folders.get(b)}
    assert 1 <= len(changed) <= 2
    after = {p: os.stat(p).st_mtime_ns for p in data_files(f"{t.path}/data")}
    assert all(after[p] == before[p] for p in before)
    used = {f"{t.path}/{f}" for f in second.folders.values()}
    assert sum(any(os.path.dirname(p).endswith(u.split(t.path)[1]) for u in used) for p in before) == sum(
        os.path.basename(os.path.dirname(p)) not in {f"bucket={b}" for b in changed} for p in before)
    got = {r["k"]: r["v"] for r in t.read().collect()}
    assert got == {**{i: i for i in range(200)}, 3: -3, 500: 5} and t.mark() == "2"
    assert {r["k"]: r["v"] for r in t.read(first).collect()}[3] == 3  # the version before is still there


def test_merge_run_again_and_cut_short(spark):
    t = keyed(spark)
    t.merge(spark.createDataFrame([(1, 1, 1), (2, 1, 2)], "k long, at int, v long"), mark=0, number=0)
    # data written, no manifest: as a crash leaves it
    spark.createDataFrame([(9, 9, 9, 0)], "k long, at int, v long, bucket int").write.partitionBy("bucket").parquet(f"{t.path}/data/v=000000000001")
    assert {r["k"] for r in t.read().collect()} == {1, 2}
    for _ in range(2):
        t.merge(spark.createDataFrame([(1, 2, 7), (None, 2, 8)], "k long, at int, v long"), mark=1, number=1)
        assert {r["k"]: r["v"] for r in t.read().collect()} == {1: 7, 2: 2, None: 8}
    assert t.versions() == [0, 1]


def test_merge_adds_columns_and_vacuum_keeps_readers_versions(spark):
    t = keyed(spark, 2)
    for n in range(4):
        t.merge(spark.createDataFrame([(n, n, n, f"c{n}")] if n > 1 else [(n, n, n)], "k long, at int, v long" + (", c string" if n > 1 else "")), number=n)
    gone = t.vacuum(keep=2)
    assert gone and t.versions() == [2, 3]
    assert {r["k"]: r["c"] for r in t.read().collect()} == {0: None, 1: None, 2: "c2", 3: "c3"}
    assert {r["k"] for r in t.read(t.current(before=3)).collect()} == {0, 1, 2}
    assert t.merge(spark.createDataFrame([], "k long, at int, v long, c string"), number=4).folders == t.current(before=4).folders


# --- state in levels -----------------------------------------------------------------------
def test_levels_equal_a_dictionary_and_stay_flat(spark, monkeypatch):
    """64 drains of ten keys: look-ups equal a plain dictionary, folders stay few and rows written per drain do not grow."""
    monkeypatch.setattr(tiers, "ROWS", 20)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    gate = J.version_gate(spark, unique_dir(spark, "test", "levels"), fanout=4)
    known, written = {}, []
    write = gate.write

    def counted(rows, first, last, count=None):
        written[-1] += count or 10
        write(rows, first, last, count)

    monkeypatch.setattr(gate, "write", counted)
    for n in range(64):
        gate.trim(n)
        keys = [(n * 7 + i * 13) % 97 for i in range(10)]
        if n % 16 == 5:
            got = {r["trade_id"]: r["existing_version"] for r in gate.lookup(n, spark.createDataFrame([(k,) for k in keys], "trade_id long")).collect()}
            assert got == {k: known[k] for k in keys if k in known}
        written.append(0)
        gate.add(spark.createDataFrame([(k, n) for k in keys], "trade_id long, existing_version int"), n)
        known.update({k: n for k in keys})
        assert len(gate.runs()) <= 4 * 4 + 4
    assert {r["trade_id"]: r["existing_version"] for r in gate.lookup(64).collect()} == known
    assert sum(written[32:]) <= 2.5 * sum(written[:32])
    assert len(gate.before(64)) == 1
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_a_replayed_drain_sees_the_state_before_it(spark, monkeypatch):
    gate = J.version_gate(spark, unique_dir(spark, "test", "replay"), fanout=2)
    rows = [spark.createDataFrame([(1, v), (10 + v, v)], "trade_id long, existing_version int") for v in range(4)]
    for n in range(4):
        gate.trim(n)
        before = gate.lookup(n)
        seen = sorted(map(tuple, before.collect())) if before else []
        gate.add(rows[n], n)
        gate.trim(n)
        again = gate.lookup(n)
        assert (sorted(map(tuple, again.collect())) if again else []) == seen
        monkeypatch.setattr(tiers, "ROWS", 1 if n == 1 else 1 << 20)
        gate.add(rows[n], n)  # once more, now cut otherwise
    assert len({(r.first, r.last) for r in gate.runs()}) == len(gate.runs())
    assert dict(map(tuple, gate.lookup(4).collect())) == {1: 3, **{10 + v: v for v in range(4)}}


def test_a_small_drain_reads_few_buckets(spark, monkeypatch):
    monkeypatch.setattr(tiers, "ROWS", 100)
    ids = J.decided_ids(spark, unique_dir(spark, "test", "ids"))
    ids.add(spark.range(5000).select(F.concat(F.lit("m"), "id").alias("message_id")), 0)
    run = ids.before(1)[0]
    assert run.buckets == 50
    keys = spark.createDataFrame([("m3",), ("m4000",), ("new",)], "message_id string")
    found = ids.lookup(1, keys)
    assert sorted(r[0] for r in found.collect()) == ["m3", "m4000"]
    read = {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()}
    assert len(read) <= 50  # inputFiles ignores filters: the plan's partition filter is what prunes
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and plan.count("bucket#") and " IN (" in plan


# --- streams -------------------------------------------------------------------------------
def test_gold_marks_and_untouched_facts(spark):
    """A refresh without a newer run writes nothing; one with a small run leaves most buckets' files."""
    out, path = unique_dir(spark, "test", "log"), unique_dir(spark, "test", "gold")
    dec = store.log(spark, SF_SMALL).drop("epoch")
    few = dec.filter("batch_id = 3").orderBy("trade_id").limit(3)
    I.append(dec.filter("batch_id < 3"), out, 0)
    gold = G.Gold(spark, path, out, store.BOUNDS, buckets=16)
    assert gold.refresh() == 0 and gold.refresh() == 0 and gold.book.versions() == [0]
    first = gold.book.current()
    I.append(few, out, 5)
    assert gold.refresh() == 5 and gold.book.mark() == "5"
    same = [b for b, f in gold.book.current().folders.items() if first.folders.get(b) == f]
    assert len(same) >= 13
    want = ST.build_valid_fact(I.read_appended(spark, out), store.BOUNDS)
    key = lambda d: sorted(map(str, d.collect()))
    assert key(gold.valid()) == key(want)
    assert key(gold.rejected()) == key(ST.build_rejected_fact(I.read_appended(spark, out), store.BOUNDS))


def test_report_range_is_pushed_to_the_stored_fact(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    df = QS.q_report_filter_range(spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(maturity_date,1998-07-01)" in plan and "LessThanOrEqual(maturity_date,1999-06-30)" in plan
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "lineitem" not in plan and "Exchange" not in plan


def test_few_row_groups_hold_a_date_range(spark):
    """Files sorted by maturity date: a year's row groups are a small part of all."""
    gold = G.Gold(spark, unique_dir(spark, "test", "groups"), store.store(spark, SF_SMALL).decisions, store.BOUNDS, buckets=2, row_group_bytes=4096)
    spark.conf.set("parquet.block.size.row.check.min", "50")
    gold.refresh()
    lo, hi = dt.date(1998, 7, 1), dt.date(1998, 9, 30)
    every = hit = 0
    for p in data_files(f"{gold.book.path}/data"):
        meta = pq.ParquetFile(p).metadata
        at = next(i for i in range(meta.num_columns) if meta.schema.column(i).path == "maturity_date")
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            every, hit = every + 1, hit + (s.min <= hi and s.max >= lo)
    assert every >= 6 and hit <= every / 2
    rep = R.report_filter(gold.report(T.REPORT_AS_OF), maturity_range=(lo, hi))
    full = gold.report(T.REPORT_AS_OF).collect()
    assert rep.count() == sum(lo <= r["maturity_date"] <= hi for r in full)


def test_drain_that_was_cut_short_is_decided_again(spark, monkeypatch):
    """The stream has staged, the decision fails: the next run decides the same rows with what landed since."""
    landing, out, ckpt = (unique_dir(spark, "test", n) for n in ("landing", "log", "ckpt"))
    dl = deliveries(spark, SF_SMALL).filter("batch_id < 2")
    J.land_messages(dl.filter("batch_id = 0"), landing)
    with monkeypatch.context() as m:
        m.setattr(J.I, "append", lambda df, path, epoch, real=I.append, **k: (_ for _ in ()).throw(OSError("full")) if path == out else real(df, path, epoch, **k))
        with pytest.raises(OSError):
            J.stream_decisions(spark, landing, out, ckpt, T.AS_OF)
    J.land_messages(dl.filter("batch_id = 1"), landing)
    J.stream_decisions(spark, landing, out, ckpt, T.AS_OF)
    from dealstream.operators import decide as D

    want = sorted(map(str, D.evaluate_replay(dl, T.AS_OF).select(*D.DECISION_COLUMNS).collect()))
    got = I.read_appended(spark, out).withColumn("batch_id", F.col("batch_id").cast("bigint")).select(*D.DECISION_COLUMNS)
    assert sorted(map(str, got.collect())) == want


def test_run_without_its_mark_is_written_again_alike(spark, monkeypatch):
    """The run of a drain is on file, its ids are not: the next call decides the same rows as the same run, then the new ones."""
    landing, out, ckpt = (unique_dir(spark, "test", n) for n in ("landing", "log", "ckpt"))
    dl = deliveries(spark, SF_SMALL).filter("batch_id < 2")
    J.land_messages(dl.filter("batch_id = 0"), landing)
    with monkeypatch.context() as m:
        m.setattr(J, "decided_ids", lambda *a: type("Broken", (), {"trim": lambda *_: 0, "lookup": lambda *_: None, "add": lambda *_: 1 / 0})())
        with pytest.raises(ZeroDivisionError):
            J.stream_decisions(spark, landing, out, ckpt, T.AS_OF)
    first = sorted(map(str, I.read_appended(spark, out).collect()))
    J.land_messages(dl.filter("batch_id = 1"), landing)
    J.stream_decisions(spark, landing, out, ckpt, T.AS_OF)
    assert I.epochs(spark, out) == [0, 1]
    assert sorted(map(str, I.read_appended(spark, out, before=1).collect())) == first
    assert I.read_appended(spark, out).count() == dl.select("message_id").distinct().count()


def test_bad_file_is_skipped_in_later_drains_too(spark):
    landing, out, ckpt, aside = (unique_dir(spark, "test", n) for n in ("landing", "log", "ckpt", "aside"))
    dl = deliveries(spark, SF_SMALL).filter("batch_id = 1")
    one, two = "file_name = 'deals_b1.jsonl'", "file_name <> 'deals_b1.jsonl'"
    J.land_messages(dl.filter(one).filter("trade_id % 2 = 0").limit(5), landing, cut=2)
    J.stream_decisions(spark, landing, out, ckpt, T.AS_OF, quarantine=aside)
    J.land_messages(dl.filter(one).filter("trade_id % 2 = 1"), landing)
    J.land_messages(dl.filter(two), landing)
    J.stream_decisions(spark, landing, out, ckpt, T.AS_OF, quarantine=aside)
    assert {r[0] for r in I.read_appended(spark, out).select("file_name").distinct().collect()} == {"redelivery_b1.jsonl"}
    assert spark.read.parquet(f"{aside}/epoch=0").count() == 5


def test_hours_closed_late_and_open(spark):
    """Closed hours are appended once; rows behind the watermark count through the side table, open hours through the state."""
    landing, out, ckpt = (unique_dir(spark, "test", n) for n in ("landing", "hours", "ckpt"))
    at = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    schema = "n int, t timestamp_ntz"
    total = {}
    for rows in ([at(1), at(1, 30), at(2), at(9)], [at(1, 5), at(8, 30), at(10), at(0)], [at(9, 59), at(2, 1), at(2, 2)]):
        spark.createDataFrame([(1, t) for t in rows], schema).coalesce(1).write.mode("append").parquet(landing)
        J.stream_hourly(spark, landing, schema, "t", out, ckpt)
        for t in rows:
            total[t.replace(minute=0)] = total.get(t.replace(minute=0), 0) + 1
        got = {r["hour"]: r["rows_loaded"] for r in J.read_hourly(spark, out, ckpt).collect()}
        assert got == total
    late = I.read_appended(spark, f"{out}/late").agg(F.sum("rows_loaded")).first()[0]
    assert late == 4  # 01:05 and 00:00 in the second drain, 02:01 and 02:02 in the third
    closed = I.read_appended(spark, f"{out}/closed").groupBy("hour").count().filter("count > 1")
    assert closed.count() == 0


def test_committed_files_and_backlog(spark):
    landing, out, ckpt = (unique_dir(spark, "test", n) for n in ("a landing+1", "out", "ckpt"))
    dl = deliveries(spark, SF_SMALL).filter("batch_id = 0")
    J.land_messages(dl.limit(20).coalesce(1), landing)
    assert C.stream_backlog(spark, landing, ckpt).first()["pending_files"] == 1
    J.cdc_drain(spark, landing, out, ckpt)
    got = C.stream_backlog(spark, landing, ckpt).first()
    assert (got["has_backlog"], got["pending_files"], got["pending_bytes"], got["oldest_pending"]) == (False, 0, 0, None)
    J.land_messages(dl.limit(7).coalesce(1), landing)
    assert C.stream_backlog(spark, landing, ckpt).first()["has_backlog"]
    assert C.committed_files(spark, ckpt).count() == 1


# --- schema, landing, history ------------------------------------------------------------------
def test_schema_is_kept_beside_the_table(spark):
    path = unique_dir(spark, "test", "evolve")
    I.append(spark.createDataFrame([(1, "a")], "k long, old string"), path, 0)
    I.append(spark.createDataFrame([(2, 0.5)], "k long, new double"), path, 1)
    I.append(spark.createDataFrame([(3, 0.7)], "k long, new double"), path, 1)  # the same run again
    assert sorted(map(tuple, I.read_appended(spark, path).collect())) == [(1, "a", None), (3, None, 0.7)]
    with pytest.raises(ValueError, match="column k is bigint"):
        I.append(spark.createDataFrame([("x",)], "k string"), path, 2)
    assert len(files.names(spark, path, "_schema/v=*")) == 2
    assert I.read_appended(spark, path, since=1).columns == ["k", "old", "new"]


def test_one_day_of_the_landing_reads_one_folder_and_expiry_waits_for_readers(spark):
    path, ckpt = unique_dir(spark, "test", "raw"), unique_dir(spark, "test", "ckpt")
    schema = "n int, loaded_at timestamp_ntz"
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    for d in days[:2]:
        I.land_by_date(spark.createDataFrame([(d.day, dt.datetime(d.year, d.month, d.day, 5))], schema).coalesce(1), path)
    one = I.read_landed(spark, path, schema, days[1], days[1])
    plan = one._jdf.queryExecution().executedPlan()
    assert one.count() == 1 and "PartitionFilters: [isnotnull(load_date" in plan.toString()
    scan = [n for n in [plan] if "FileScan" in n.toString()]
    assert scan and one.select(F.input_file_name()).distinct().count() == 1

    def run():
        J.drain(spark.readStream.schema(schema + ", load_date date").parquet(path), ckpt, lambda df, epoch: df.count())

    assert C.expire_landing(spark, path, days[2], [ckpt]) == []  # not read yet
    run()
    I.land_by_date(spark.createDataFrame([(9, dt.datetime(2024, 1, 2, 9)), (3, dt.datetime(2024, 1, 3, 9)), (0, None)], schema).coalesce(1), path)
    assert C.expire_landing(spark, path, days[2], [ckpt]) == ["load_date=2024-01-01"]  # the second day has a new file
    run()
    assert C.expire_landing(spark, path, days[2], [ckpt]) == ["load_date=2024-01-02"]
    assert {r[0] for r in I.read_landed(spark, path, schema).select("n").collect()} == {3, 0}


def test_change_log_is_only_appended_to(spark):
    log = SCD.HistoryLog(spark, unique_dir(spark, "test", "scd"), buckets=4)
    dec = store.log(spark, SF_SMALL)
    from dealstream.functions import scalar as S

    whole, kept = None, {}
    for n in range(T.N_BATCHES):
        book = ST.build_valid_fact(dec.filter(F.col("batch_id") <= n), store.BOUNDS)
        now = S.lit_ts(T.LOAD_BASE + dt.timedelta(hours=n + 1))
        applied = SCD.scd2_apply(whole, book, now)
        whole = spark.createDataFrame(applied.collect(), applied.schema)
        log.run(book, now, n)
        if n == 2:
            log.run(book, now, n)  # repeated after a failure
        assert sorted(map(str, log.read().collect())) == sorted(map(str, whole.select(*SCD.HISTORY_COLUMNS).collect()))
        now_there = {p: os.stat(p).st_mtime_ns for p in data_files(log.log)}
        assert all(now_there[p] == t for p, t in kept.items() if p in now_there) and (n == 2 or set(kept) <= set(now_there))
        kept = now_there
    most = whole.groupBy("trade_id").count().orderBy(F.desc("count"), "trade_id").first()["trade_id"]
    assert [tuple(r) for r in log.deal(most).collect()] == [tuple(r) for r in SCD.deal_history(whole, most).collect()]


def test_event_times_keep_their_instant_in_a_zone_with_summer_time(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        raw = spark.createDataFrame([(f'{{"trade_id":"1","event_timestamp":"2024-11-03T{h}:30:00Z"}}',) for h in ("05", "06")] + [
            ('{"trade_id":"1","event_timestamp":"2024-03-10T02:30:00+00:00"}',)], "raw string")
        got = I.flatten_messages(raw.select(F.try_parse_json("raw").alias("raw"))).select(F.col("event_timestamp").cast("string").substr(6, 11)).collect()
        assert [r[0] for r in got] == ["11-03 05:30", "11-03 06:30", "03-10 02:30"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_collecting_refuses_what_is_not_small(spark):
    assert [r[0] for r in R.collect_report(spark.range(3), limit=3)] == [0, 1, 2]
    with pytest.raises(ValueError, match="more than 2 rows"):
        R.collect_report(spark.range(3), limit=2)


def test_the_log_is_read_without_building_facts(spark, tmp_path):
    import shutil

    for t in store.INPUTS:
        shutil.copy(f"{SF_SMALL}/{t}.parquet", tmp_path)
    assert not store.log(spark, str(tmp_path)).isEmpty()
    gold = store._built(spark, str(tmp_path))[1]
    assert gold.book.current() is None and not files.exists(spark, gold.rejects)
    assert store.store(spark, str(tmp_path)) is gold and gold.book.current() is not None and not gold.rejected().isEmpty()


def test_merge_ranks_and_writes_with_one_shuffle(spark, monkeypatch):
    t = KeyedTable(spark, unique_dir(spark, "test", "keyed"), ("k",), (F.col("at").desc(),), 4, ("v",))  # 8 shuffle partitions
    rows = spark.range(2000).select((F.col("id") % 300).alias("k"), F.col("id").cast("int").alias("at"), (F.col("id") * 7 % 11).alias("v"))

    def dealt(*_):
        raise AssertionError("ranked rows are dealt again")

    with monkeypatch.context() as m:
        m.setattr(type(rows), "repartition", dealt)
        t.merge(rows, mark=1)
        t.merge(spark.createDataFrame([(5, 9000, 1), (5, 9001, 2), (400, 1, 3), (None, 2, 4), (6, 0, 9)], "k long, at int, v long"), mark=2)
    got = {r.k: (r.at, r.v) for r in t.read().collect()}
    assert len(got) == 302 and got[5] == (9001, 2) and got[400] == (1, 3) and got[None] == (2, 4) and got[6][0] == 1806
    assert t.read().count() == 302
    assert all(len(glob.glob(f"{t.path}/data/v={0:012d}/bucket={b}/*.parquet")) <= 2 for b in range(4))
