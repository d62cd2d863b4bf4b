"""Streaming drains survive restarts: a second run drains nothing, and a
micro-batch replayed after a failure (its commit lost) rewrites the same
partitions instead of duplicating decisions."""

import glob
import os

from pyspark.sql import functions as F

from paths import SF_SMALL

from dealstream.operators import decide as D
from dealstream.plans.queries_core import deliveries
from dealstream.session import unique_dir
from dealstream.sources import tables as T
from dealstream.streaming import jobs as J


def _snapshot(spark, path):
    rows = spark.read.parquet(path).select(*D.DECISION_COLUMNS).collect()
    return sorted(tuple(str(v) for v in r) for r in rows)


def test_replayed_epoch_and_rerun_change_nothing(spark):
    landing = unique_dir(spark, "test", "landing")
    out = unique_dir(spark, "test", "decisions")
    ckpt = unique_dir(spark, "test", "ckpt")
    dl = deliveries(spark, SF_SMALL)
    J.land_messages(dl.filter(F.col("batch_id") <= 1), landing)
    assert J.stream_decisions(spark, landing, out, ckpt, T.AS_OF) == 1
    J.land_messages(dl.filter(F.col("batch_id") > 1), landing)
    assert J.stream_decisions(spark, landing, out, ckpt, T.AS_OF) == 1
    first = _snapshot(spark, out)
    replay_expected = sorted(tuple(str(v) for v in r) for r in
                             D.evaluate_replay(dl, T.AS_OF).select(*D.DECISION_COLUMNS).collect())
    assert first == replay_expected

    # nothing new landed: the checkpoint makes the next run a no-op
    assert J.stream_decisions(spark, landing, out, ckpt, T.AS_OF) == 0
    assert _snapshot(spark, out) == first

    # lose the commit of the last micro-batch: the restarted query replays it
    commits = sorted(glob.glob(os.path.join(ckpt.replace("file:", ""), "commits", "[0-9]*")),
                     key=lambda p: int(os.path.basename(p)))
    last = commits[-1]
    os.remove(last)
    crc = os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    assert J.stream_decisions(spark, landing, out, ckpt, T.AS_OF) == 1
    assert _snapshot(spark, out) == first


def test_state_in_levels_equals_replay(spark):
    """One drain per batch with a fold every two drains: the version gate
    read from its runs gives the one-pass replay's decisions."""
    landing = unique_dir(spark, "test", "landing")
    out = unique_dir(spark, "test", "decisions")
    ckpt = unique_dir(spark, "test", "ckpt")
    dl = deliveries(spark, SF_SMALL)
    for b in range(T.N_BATCHES):
        J.land_messages(dl.filter(F.col("batch_id") == b), landing)
        assert J.stream_decisions(spark, landing, out, ckpt, T.AS_OF, fanout=2) == 1
    runs = J.version_gate(spark, out.rstrip("/") + "_state").runs()
    assert any(r.last > r.first for r in runs), "runs were folded"
    replay_expected = sorted(tuple(str(v) for v in r) for r in
                             D.evaluate_replay(dl, T.AS_OF).select(*D.DECISION_COLUMNS).collect())
    assert _snapshot(spark, out) == replay_expected


def test_batch_in_many_files_and_drains_loses_nothing(spark, tmp_path):
    """Three files of one batch, one file a drain: every staged row and decision
    stays, and the batch's later rows are decided after its earlier ones."""
    dl = deliveries(spark, SF_SMALL).filter((F.col("batch_id") == 1) & (F.col("file_name") == "deals_b1.jsonl"))
    landing, out, staging = (unique_dir(spark, "test", n) for n in ("landing", "decisions", "staging"))
    for part in range(3):
        J.land_messages(dl.filter(F.pmod("trade_id", F.lit(3)) == part).coalesce(1), landing)
    assert J.stream_decisions(spark, landing, out, unique_dir(spark, "test", "ckpt"), T.AS_OF, max_files=1) == 3
    assert J.cdc_drain(spark, landing, staging, unique_dir(spark, "test", "ckpt"), max_files=1) == 3
    n = dl.select("message_id").distinct().count()
    assert spark.read.parquet(out).select("message_id").distinct().count() == spark.read.parquet(out).count() == n
    assert spark.read.parquet(staging).count() == n
    replay = sorted(tuple(str(v) for v in r) for r in D.evaluate_replay(dl, T.AS_OF).select(*D.DECISION_COLUMNS).collect())
    assert _snapshot(spark, out) == replay  # trades do not share files here, so the one-pass replay is the answer


def test_load_once_archives_or_deletes(spark, tmp_path):
    """After its load is committed a file is moved to the archive or deleted."""
    for mode in ("archive", "delete"):
        source, archive, seen = tmp_path / mode, tmp_path / f"{mode}_to", []
        source.mkdir()
        (source / "a.txt").write_text("one\ntwo\n")
        for turn in range(2):
            J.drain(J.ingest_stream(spark, f"file://{source}", "text", on_loaded=mode, archive_dir=f"file://{archive}"),
                    f"file://{tmp_path}/ckpt_{mode}", lambda df, epoch: seen.append(df.count()))
            (source / f"b{turn}.txt").write_text("three\n")
        assert seen == [2, 1] and not (source / "a.txt").exists()
        assert mode == "delete" or list(archive.rglob("a.txt"))


def test_broken_rate_state_write_keeps_the_old_version(spark, tmp_path):
    from dealstream.sources import ingest as I

    path = f"file://{tmp_path}/fx"
    I.rebuild(spark.range(3), path, "000000000001")
    (tmp_path / "fx" / "v=000000000002").mkdir()  # a crash before the write finished
    assert I.read_current(spark, path).count() == 3 and I.read_current(spark, path, before="000000000001") is None
