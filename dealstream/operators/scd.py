"""Type-2 history of the current book (W5, C6) and the per-deal views on it
(C7 amendment counts, P9 deal history).

Check strategy: a new history row opens only when one of the nine check
columns changes (NULL-safe); a change of ``trade_date`` or ``processed_at``
alone does not. A trade missing from the current state keeps its open row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as K

SNAPSHOT_COLUMNS = (
    "trade_id", "version", "product_type", "counterparty", "trader", "book", "currency",
    "notional", "price", "trade_date", "maturity_date", "processed_at",
)
HISTORY_COLUMNS = SNAPSHOT_COLUMNS + ("valid_from", "valid_to", "scd_id", "updated_at")


def _check_struct(prefix: str = "") -> Column:
    return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in K.SCD_CHECK_COLUMNS])


def _scd_id(trade: Column, valid_from: Column) -> Column:
    return F.md5(F.concat_ws("|", trade.cast("string"), valid_from.cast("string")))


def scd2_history(accepted: DataFrame, schedule: Sequence[tuple[int, object]],
                 batch_col: str = "batch_id") -> DataFrame:
    """The history that repeated check-strategy snapshots would build, in one pass.

    ``accepted``: accepted decisions (one row per accepted message, with the
    snapshot columns and ``batch_col``). ``schedule``: the snapshot runs as
    (last batch included, snapshot time), i.e. configuration.

    Each accepted row is mapped to the first snapshot at or after its batch
    (a CASE over the schedule -- no join), the last row per (trade, snapshot)
    is kept, rows equal to the previous kept row on the check columns are
    dropped, and ``valid_to`` is the next row's ``valid_from``. Windows run
    per trade over at most one row per snapshot, so a hot trade costs no more
    than the number of snapshots.
    """
    points = sorted((int(b), t) for b, t in schedule)
    sb = sa = None
    for b_, t_ in points:
        cond = F.col(batch_col) <= F.lit(b_)
        ts = F.lit(t_).cast("timestamp_ntz")
        sb = F.when(cond, F.lit(b_)) if sb is None else sb.when(cond, F.lit(b_))
        sa = F.when(cond, ts) if sa is None else sa.when(cond, ts)
    rows = accepted.select("*", sb.alias("_sb"), sa.alias("_sa")).filter(F.col("_sb").isNotNull())
    last = Window.partitionBy("trade_id", "_sb").orderBy(F.col(batch_col).desc(), F.col("message_id"))
    per_snap = rows.withColumn("_rn", F.row_number().over(last)).filter("_rn = 1").drop("_rn")
    by_trade = Window.partitionBy("trade_id").orderBy("_sb")
    changed = per_snap.withColumn("_prev", F.lag(_check_struct()).over(by_trade)).filter(
        ~F.col("_prev").eqNullSafe(_check_struct()))
    out = changed.select(*SNAPSHOT_COLUMNS, F.col("_sa").alias("valid_from"))
    return out.select(
        *SNAPSHOT_COLUMNS, "valid_from",
        F.lead("valid_from").over(Window.partitionBy("trade_id").orderBy("valid_from")).alias("valid_to"),
        _scd_id(F.col("trade_id"), F.col("valid_from")).alias("scd_id"),
        F.col("valid_from").alias("updated_at"))


def scd2_apply(history: DataFrame | None, current: DataFrame, now: Column) -> DataFrame:
    """One snapshot run. Returns the whole new history: open rows whose
    check columns changed are closed at ``now`` and a new open row is
    inserted; new trades get an open row; unchanged and missing trades keep
    theirs. ``current`` has one row per trade (the current book)."""
    cur = current.select(*SNAPSHOT_COLUMNS)
    if history is None:
        return cur.select(*SNAPSHOT_COLUMNS, now.alias("valid_from"), F.lit(None).cast(now_type(cur, now)).alias("valid_to"),
                          _scd_id(F.col("trade_id"), now).alias("scd_id"), now.alias("updated_at"))
    open_rows = history.filter(F.col("valid_to").isNull())
    closed = history.filter(F.col("valid_to").isNotNull())
    o = open_rows.select(F.col("trade_id").alias("_o_trade"), _check_struct().alias("_o_chk"))
    c = cur.alias("c").join(o, F.col("c.trade_id") == F.col("_o_trade"), "left")
    is_new = F.col("_o_trade").isNull()
    is_changed = F.col("_o_trade").isNotNull() & ~F.col("_o_chk").eqNullSafe(_check_struct("c."))
    inserts = c.filter(is_new | is_changed).select(
        *[F.col(f"c.{x}").alias(x) for x in SNAPSHOT_COLUMNS], now.alias("valid_from"),
        F.lit(None).cast(now_type(cur, now)).alias("valid_to"),
        _scd_id(F.col("c.trade_id"), now).alias("scd_id"), now.alias("updated_at"))
    to_close = c.filter(is_changed).select(F.col("c.trade_id").alias("_close"))
    kept_open = open_rows.join(to_close, open_rows.trade_id == to_close._close, "left_anti")
    newly_closed = (open_rows.join(to_close, open_rows.trade_id == to_close._close, "left_semi")
                    .withColumn("valid_to", now))
    return (closed.select(*HISTORY_COLUMNS).unionByName(newly_closed.select(*HISTORY_COLUMNS))
            .unionByName(kept_open.select(*HISTORY_COLUMNS)).unionByName(inserts.select(*HISTORY_COLUMNS)))


class HistoryLog:
    """C6 as a log that is only appended to, merged when it is read.

    A run compares the current book with the open rows in one join and appends
    the records of that run: the new open row of every new or changed trade, and
    for a changed one its old row again with ``valid_to`` set. No record is ever
    rewritten; of records with one ``scd_id`` the newest run's counts. The open
    rows are a keyed table beside the log, whose merge rewrites the buckets of
    the changed trades only. Both carry the run's number, so a run that is
    repeated after a failure writes the same folders again."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        from ..sources.keyed import KeyedTable

        self.spark, self.log = spark, f"{path.rstrip('/')}/log"
        self.open = KeyedTable(spark, f"{path.rstrip('/')}/open", ("trade_id",), (F.col("valid_from").desc(),), buckets)

    def run(self, current: DataFrame, now: Column, number: int) -> None:
        """Snapshot run ``number`` (rising): ``current`` has one row per trade."""
        from ..sources import ingest as I

        cur = current.select(*SNAPSHOT_COLUMNS)
        stamp = now_type(cur, now)
        fresh = F.struct(*[F.col(f"c.{c}").alias(c) for c in SNAPSHOT_COLUMNS], now.alias("valid_from"), F.lit(None).cast(stamp).alias("valid_to"),
                         _scd_id(F.col("c.trade_id"), now).alias("scd_id"), now.alias("updated_at"))
        before = self.open.current(before=number)
        if before is None:
            changes = cur.alias("c").select(F.array(fresh).alias("r"))
        else:
            o = self.open.read(before)
            j = cur.alias("c").join(o.alias("o"), F.col("c.trade_id") == F.col("o.trade_id"), "left")
            same = F.col("o.trade_id").isNotNull() & _check_struct("o.").eqNullSafe(_check_struct("c."))
            closed = F.struct(*[now.alias(c) if c == "valid_to" else F.col(f"o.{c}").alias(c) for c in HISTORY_COLUMNS])
            changes = j.filter(~same).select(F.when(F.col("o.trade_id").isNull(), F.array(fresh)).otherwise(F.array(closed, fresh)).alias("r"))
        I.append(changes.select(F.inline("r")).select(*HISTORY_COLUMNS, F.lit(number).alias("run")), self.log, number)
        mine = I.read_appended(self.spark, self.log, since=number, before=number + 1)
        self.open.merge(mine.filter(F.col("valid_to").isNull()).select(*HISTORY_COLUMNS), number=number)

    def read(self) -> DataFrame:
        """The history: the newest record of every row."""
        from ..sources import ingest as I

        rows = I.read_appended(self.spark, self.log)
        newest = F.max_by(F.struct(*[c for c in HISTORY_COLUMNS if c != "scd_id"]), "run").alias("r")
        return rows.groupBy("scd_id").agg(newest).select("scd_id", "r.*").select(*HISTORY_COLUMNS)

    def deal(self, trade_id) -> DataFrame:
        """One deal's history; the log's row groups of other deals are skipped where their statistics allow."""
        from ..sources import ingest as I

        rows = I.read_appended(self.spark, self.log).filter(F.col("trade_id") == trade_id)
        newest = Window.partitionBy("scd_id").orderBy(F.col("run").desc())
        return deal_history(rows.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn"), trade_id)


def now_type(df: DataFrame, now: Column) -> str:
    return df.select(now.alias("_n")).schema["_n"].dataType.simpleString()


def amendments(history: DataFrame) -> DataFrame:
    """C7 for every deal at once: recorded versions, amendments (= rows - 1)
    and the current (latest) row's version, notional and currency."""
    cur = F.max_by(F.struct("version", "notional", "currency"), F.col("valid_from"))
    return (history.groupBy("trade_id")
            .agg(F.count(F.lit(1)).alias("recorded_versions"), cur.alias("c"))
            .select("trade_id", "recorded_versions", (F.col("recorded_versions") - 1).alias("amendments"),
                    F.col("c.version").alias("current_version"), F.col("c.notional").alias("current_notional"),
                    F.col("c.currency").alias("current_currency")))


def deal_history(history: DataFrame, trade_id) -> DataFrame:
    """One deal's history, oldest first (a point lookup that prunes by
    ``trade_id`` when the history is clustered on it)."""
    cols = ["trade_id", "version", "product_type", "counterparty", "trader", "book", "currency",
            "notional", "price", "trade_date", "maturity_date", "valid_from", "valid_to"]
    t = trade_id if isinstance(trade_id, Column) else F.lit(trade_id)
    return history.filter(F.col("trade_id") == t).select(*cols).orderBy("valid_from")


def deals_history(history: DataFrame, trade_ids: DataFrame) -> DataFrame:
    """History of a *set* of deals given as a DataFrame (semi join)."""
    cols = ["trade_id", "version", "product_type", "counterparty", "trader", "book", "currency",
            "notional", "price", "trade_date", "maturity_date", "valid_from", "valid_to"]
    return history.join(trade_ids.select("trade_id"), "trade_id", "left_semi").select(*cols).orderBy(
        "trade_id", "valid_from")


