"""Structured Streaming jobs.

Every job reads a growing landing (files or the landing table's files),
runs with ``trigger(availableNow=True)`` so one call drains exactly what has
landed, and keeps its progress in a checkpoint under the cluster's shared
``spark.checkpoint.dir``. Every micro-batch and every drain writes one folder
of its own, so replaying it after a lost executor or a restarted driver rewrites
that folder and nothing else; a batch may arrive in any number of files and drains.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import decide as D
from ..functions import scalar as S
from ..operators import state as STT
from ..session import even_waves
from ..sources import committed as C
from ..sources import files
from ..sources import ingest as I
from .tiers import Tiers

PART_ROW_GROUP_BYTES = 16 << 20
LANDING_SCHEMA = "raw string, file_name string, loaded_at timestamp_ntz, batch_id bigint"
FX_LANDING_SCHEMA = ("as_of_date date, currency string, rate_to_usd double, file_name string, "
                     "loaded_at timestamp_ntz, load_no bigint")


def read_if_exists(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    if not files.exists(spark, path):
        return None
    r = spark.read
    if schema:
        r = r.schema(schema)
    return r.parquet(path)


def drain(source: DataFrame, checkpoint: str, process: Callable[[DataFrame, int], None]) -> int:
    """Run ``process`` over everything landed since the last run (availableNow),
    then stop. Returns the number of micro-batches run."""
    seen = []

    def fn(df, epoch):
        seen.append(epoch)
        process(df, epoch)

    q = (source.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(seen)


def landing_stream(spark: SparkSession, path: str, schema: str = LANDING_SCHEMA,
                   max_files: int | None = None) -> DataFrame:
    """New files of a parquet landing table as a stream (insert-only: every
    new file is an INSERT, so no change-type filter is needed)."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def ingest_stream(spark: SparkSession, path: str, fmt: str = "text", schema: str | None = None,
                  on_loaded: str = "keep", archive_dir: str | None = None) -> DataFrame:
    """A file source that loads every file once (the checkpoint remembers
    loaded files). ``on_loaded``: keep the file, ``archive`` it to
    ``archive_dir`` or ``delete`` it after it was committed."""
    r = spark.readStream.format(fmt)
    if schema:
        r = r.schema(schema)
    if on_loaded == "archive":
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    elif on_loaded == "delete":
        r = r.option("cleanSource", "delete")
    return r.load(path)


# --- landing writers -------------------------------------------------------------------
def land_messages(deliveries: DataFrame, landing: str, cut: int | Column = 0, parts: int | None = None) -> None:
    """Write deliveries (``cut``: without the last characters, as a broken transfer leaves them) into the landing table: the message as a JSON text
    (the raw payload), the file it came in and its load time; one partition
    per batch (a drain's unit). ``parts`` bounds the files of a batch (without a shuffle), for a stream that takes a
    few files a micro-batch: their number must not grow with the rows. Their row groups are small, so that one file still
    keeps every core busy."""
    payload = F.to_json(F.struct(*[F.col(n) for n, _ in I.MESSAGE_FIELDS]), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"})
    if isinstance(cut, Column) or cut:
        payload = F.substring(payload, 1, F.length(payload) - cut)
    land_lines(deliveries.select(payload.alias("raw"), "file_name", "loaded_at", "batch_id"), landing, parts)


def land_lines(rows: DataFrame, landing: str, parts: int | None = None) -> None:
    """Write lines (raw, file_name, loaded_at, batch_id) into the landing table."""
    writer = (rows.coalesce(parts) if parts else rows).write.mode("append").partitionBy("batch_id")
    if parts:
        writer = writer.option("parquet.block.size", PART_ROW_GROUP_BYTES)
    with even_waves(rows.sparkSession):
        writer.parquet(landing)


# --- S5: stream -> typed staging -------------------------------------------------------------
def stage_batch(df: DataFrame, quarantine: str | None = None, fields=I.ADAPTER_FIELDS, held: str | None = None) -> DataFrame:
    """Raw rows read as one batch: typed, files with an unreadable record skipped whole, first arrival per message kept.
    With ``held`` the typed rows are kept in that folder, so that each line is parsed once, and copies are left to the decision."""
    typed = _typed(df, fields, quarantine is not None)
    if held:
        with even_waves(df.sparkSession):
            typed = on_file(typed, held)
        return _without(typed, None if typed.filter("bad").isEmpty() else _bad_names(typed), quarantine)
    return D.dedup_first(_without(typed, _bad_names(typed), quarantine), "message_id", ("loaded_at", "file_name"))


def _typed(df: DataFrame, fields=I.ADAPTER_FIELDS, keep_line: bool = False) -> DataFrame:
    """One parse a line: typed fields, ``bad``, and the line itself where a quarantine wants it."""
    rows = df.select("raw", *([F.col("raw").alias("line")] if keep_line else []), "file_name", "loaded_at", "batch_id")
    return I.flagged_messages(rows, fields=fields)


def _bad_names(typed: DataFrame) -> DataFrame:
    return typed.filter("bad").select("file_name").distinct()


def _without(typed: DataFrame, bad: DataFrame | None, quarantine: str | None) -> DataFrame:
    """Rows of files not in ``bad``; with ``quarantine`` the rows of the others are written to that folder."""
    if bad is None:
        return typed.drop("bad", "line")
    if quarantine:
        aside = typed.join(bad, "file_name", "left_semi")
        aside.select("line", "file_name", "loaded_at", "batch_id").write.mode("overwrite").parquet(quarantine)
    return typed.join(bad, "file_name", "left_anti").drop("bad", "line")


class Staging:
    """Typed rows of a stream, one folder a micro-batch, taken over drain by drain.

    A file may land in several parts and reach the stream in several
    micro-batches, and its bad record may be in the last. So micro-batches only
    parse and stage, which shuffles nothing, and a file counts as loaded when the
    drain that took it is over: then the ledger of bad files (those flagged in
    this drain or any before) withdraws all staged rows of such files. The test
    reads one flag column whose statistics skip row groups without a bad record,
    and only if there is one are the rows joined with it."""

    def __init__(self, spark: SparkSession, root: str, quarantine: str | None = None):
        self.spark, self.root, self.quarantine = spark, root.rstrip("/"), quarantine

    def stage(self, df: DataFrame, epoch: int) -> None:
        I.append(_typed(df, keep_line=self.quarantine is not None), f"{self.root}/rows", epoch)

    def pending(self, last: int) -> list[int]:
        """Staged micro-batches after ``last``."""
        return [e for e in I.epochs(self.spark, f"{self.root}/rows") if e > last]

    def take(self, epochs: list[int]) -> DataFrame:
        """Rows of these micro-batches without bad files (not yet first arrivals only)."""
        first, last = epochs[0], epochs[-1]
        typed = I.read_appended(self.spark, f"{self.root}/rows", before=last + 1, since=first)
        ledger, known = f"{self.root}/bad_files", None
        new = _bad_names(typed)
        if [e for e in I.epochs(self.spark, ledger) if e < first]:
            known = I.read_appended(self.spark, ledger, before=first)
            new = new.join(known, "file_name", "left_anti")
        if not typed.filter("bad").isEmpty():
            I.append(new, ledger, last)
        bad = I.read_appended(self.spark, ledger, before=last + 1).distinct() if I.epochs(self.spark, ledger) else None
        return _without(typed, bad, f"{self.quarantine}/epoch={last}" if self.quarantine else None)

    def trim(self, before: int) -> int:
        """Remove staged micro-batches below ``before``, all of which have been taken and written on."""
        old = [e for e in I.epochs(self.spark, f"{self.root}/rows") if e < before]
        for e in old:
            files.remove(self.spark, f"{self.root}/rows/epoch={e}")
        return len(old)


def cdc_drain(spark: SparkSession, landing: str, staging: str, checkpoint: str, quarantine: str | None = None,
              max_files: int | None = None) -> int:
    """Drain unconsumed landing rows into the staging table, one run a
    drain: first arrivals of the drain, without files that hold a bad record."""
    held = Staging(spark, f"{staging.rstrip('/')}_landed", quarantine)
    with even_waves(spark):
        n = drain(landing_stream(spark, landing, max_files=max_files), checkpoint, held.stage)
        done = I.epochs(spark, staging)
        todo = held.pending(done[-1] if done else -1)
        if todo:
            I.append(D.dedup_first(held.take(todo), "message_id", ("loaded_at", "file_name")), staging, todo[-1])
            held.trim(todo[0])
    return n


# --- X1 / X2 / X3: decisions ------------------------------------------------------------------
def version_gate(spark: SparkSession, root: str, fanout: int | None = None) -> Tiers:
    """Trade -> highest accepted version, as runs in levels."""
    return Tiers(spark, f"{root.rstrip('/')}/versions", "trade_id",
                 lambda d: d.groupBy("trade_id").agg(F.max("existing_version").alias("existing_version")), fanout)


def decided_ids(spark: SparkSession, root: str, fanout: int | None = None) -> Tiers:
    """Ids of the messages decided so far, as runs in levels. An id is decided once, so runs share none."""
    return Tiers(spark, f"{root.rstrip('/')}/ids", "message_id", lambda d: d.select("message_id"), fanout)


def stream_decisions(spark: SparkSession, landing: str, decisions_path: str, checkpoint: str, as_of,
                     quarantine: str | None = None, max_files: int | None = None, fanout: int | None = None) -> int:
    """What has landed is staged by the stream and decided as one drain, in
    a run of its own. The version gate (X2) and the ids of decided messages
    (X3) are kept beside the log as runs in levels (:class:`Tiers`): a drain
    reads the buckets that its trades and ids fall in and never the log, and
    messages decided in an earlier drain, of this batch or another, are dropped,
    so a re-delivered file never changes a decision. Rows of a batch that arrive
    late are decided as part of their own drain. A file with an unreadable record
    is skipped whole, in however many micro-batches its parts came (:class:`Staging`).

    After a failure the stream replays its last micro-batch into the same folder.
    A drain is done when its mark is there, after its run, gate and ids; one whose
    run was written without the mark is decided again from the same staged rows,
    which gives the same run, before what has landed since is decided as the next."""
    root = decisions_path.rstrip("/")
    held = Staging(spark, f"{root}_staged", quarantine)
    n = drain(landing_stream(spark, landing, max_files=max_files), checkpoint, held.stage)
    done = sorted(int(x) for x in files.names(spark, f"{root}_state/done") if x.isdigit())
    last = done[-1] if done else -1
    cut_short = [e for e in I.epochs(spark, root) if e > last]
    todo = held.pending(last)
    for part in ([e for e in todo if e <= cut_short[-1]], [e for e in todo if e > cut_short[-1]]) if cut_short else (todo,):
        if part:
            _decide(spark, root, held.take(part), part[-1], len(done), as_of, fanout)
            held.trim(part[0])  # the micro-batches of the drains before
            done.append(part[-1])
    return n


def on_file(df: DataFrame | None, path: str) -> DataFrame | None:
    """``df`` written to ``path``, anew each time, so that its size decides the joins with it."""
    if df is None:
        return None
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _decide(spark: SparkSession, root: str, rows: DataFrame, epoch: int, number: int, as_of, fanout: int | None) -> None:
    """Decide drain ``number`` from its staged rows, append it as run ``epoch`` and take it into gate and ids.

    The staged rows are on file, so their size decides the joins with the state. Gate and ids of a drain are only
    read by later ones; what a failed attempt left of them is written anew."""
    gate, ids = (f(spark, f"{root}_state", fanout) for f in (version_gate, decided_ids))
    gate.trim(number), ids.trim(number)
    seen = ids.lookup(number, rows.select("message_id"))
    state = gate.lookup(number, rows.select("trade_id"))
    out = D.evaluate_drain(rows, on_file(seen, f"{root}_state/seen"), as_of, state=state, by_trade=True)
    I.append(out.select(*D.DECISION_COLUMNS), root, epoch)
    out = I.read_appended(spark, root, since=epoch, before=epoch + 1)
    gate.add(D.known_state(out), number)
    ids.add(out.select("message_id"), number)
    files.touch(spark, f"{root}_state/done/{epoch}")


# --- X4: hourly counts in event time ---------------------------------------------------------
def stream_hourly(spark: SparkSession, events_landing: str, schema: str, ts: str, out_path: str, checkpoint: str,
                  keys: tuple[str, ...] = (), condition=None, delay: str = "1 hour") -> int:
    """One-hour counts over event time ``ts`` (wall-clock time in UTC), in the stream's own state. The
    watermark follows ``delay`` behind the newest event; an hour it has passed is
    closed, appended once to ``closed`` and leaves the state. Rows for a closed
    hour, which the window drops, are counted into ``late``: the checkpoint says
    which files a batch takes and where the watermark stood, so exactly the dropped
    rows are read again (row groups of newer events are skipped).
    :func:`read_hourly` adds closed, late and still open hours."""
    root = out_path.rstrip("/")

    def kept(df: DataFrame) -> DataFrame:
        return df if condition is None else df.filter(condition)

    source = kept(spark.readStream.schema(schema).parquet(events_landing)).select(S.instant(ts).alias("_at"), *keys)  # a watermark wants an instant
    counts = source.withWatermark("_at", delay).groupBy(F.window("_at", "1 hour").alias("w"), *keys).agg(F.count(F.lit(1)).alias("rows_loaded"))

    def process(df: DataFrame, epoch: int) -> None:
        I.append(df.select(I.utc_time("w.start").alias("hour"), *keys, "rows_loaded"), f"{root}/closed", epoch)
        mark = C.closed_before(spark, checkpoint, epoch).replace(minute=0, second=0, microsecond=0)
        taken = C.batch_files(spark, checkpoint, epoch)
        if taken:
            late = kept(spark.read.schema(schema).option("basePath", events_landing).parquet(*taken)).filter(F.col(ts) < S.lit_ts(mark))
            at = F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour")
            I.append(late.groupBy(at, *keys).agg(F.count(F.lit(1)).alias("rows_loaded")), f"{root}/late", epoch)

    return drain(counts, checkpoint, process)


def read_hourly(spark: SparkSession, out_path: str, checkpoint: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Counts per hour over all drains so far: closed hours, rows that came late for them, and hours still open in the stream's state."""
    root = out_path.rstrip("/")
    parts = [I.read_appended(spark, f"{root}/{p}") for p in ("closed", "late") if I.epochs(spark, f"{root}/{p}")]
    if C.committed_epochs(spark, checkpoint) >= 0:
        state = spark.read.format("statestore").load(checkpoint)
        parts.append(state.select(I.utc_time("key.window.start").alias("hour"), *[F.col(f"key.{k}").alias(k) for k in keys],
                                  F.col("value.count").alias("rows_loaded")))
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy("hour", *keys).agg(F.sum("rows_loaded").alias("rows_loaded"))


# --- X5: FX latest-wins ---------------------------------------------------------------------------
def stream_fx(spark: SparkSession, fx_landing: str, state_path: str, checkpoint: str) -> int:
    """Each drain of FX loads is deduplicated and upserted into the rate
    state (keyed on date and currency; bounded by calendar x currencies).
    The new state is a version folder of its own and the newest finished one
    is current, so a failed write never corrupts the state."""
    def process(df, epoch):
        # one version per epoch: a replayed epoch starts again from the version before it
        version = f"{epoch:012d}"
        prior = I.read_current(spark, state_path, before=version)
        new = STT.upsert_latest(prior, STT.latest_rate(df), ("as_of_date", "currency"), STT.fx_order())
        I.rebuild(new.select("as_of_date", "currency", "rate_to_usd", "file_name", "loaded_at"), state_path, version)
    return drain(landing_stream(spark, fx_landing, FX_LANDING_SCHEMA), checkpoint, process)
