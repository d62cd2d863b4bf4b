"""The decision core: which message is accepted, which rejected, and why.

Rules, in order (first match wins):

1. not the winner of its trade within its batch  -> REJECTED, SUPERSEDED_IN_BATCH
2. maturity date before the as-of date           -> REJECTED, MATURITY_DATE_IN_PAST
3. version below the highest accepted so far     -> REJECTED, STALE_VERSION_LOWER_THAN_EXISTING
4. otherwise ACCEPTED: REPLACED_SAME_VERSION when the version equals the
   highest accepted so far, else NEW_TRADE_ACCEPTED (an amendment with a
   higher version keeps that label).

The batch winner is the message with the highest version, then the latest
event time, then the latest load time (NULLs rank first in all three, as in
the source warehouse), then the smallest ``message_id`` as a deterministic
tie-break.

Scale design
------------
A trade (or a trade within one batch) may hold a large share of all rows, so
no step puts one trade's messages through one window partition:

* the batch winner is an *aggregation* per (trade, batch) with map-side
  partial aggregation, so a hot key collapses to one row per map task before
  the shuffle;
* "highest accepted version in earlier batches" runs as a window over the
  per-(trade, batch) winners only (one row per batch a trade occurs in);
* messages meet their winner row with an equi-join on (trade, batch), which
  AQE either turns into a broadcast join (winners measured small) or splits
  when one key is skewed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K

MESSAGE_COLUMNS = (
    "trade_id", "version", "message_id", "source_system", "event_timestamp", "trade_date",
    "maturity_date", "product_type", "counterparty", "trader", "book", "currency",
    "notional", "price", "file_name",
)

DECISION_COLUMNS = MESSAGE_COLUMNS + (
    "source_loaded_at", "batch_id", "existing_version", "decision", "decision_reason", "evaluated_at",
)

TRADE_BUCKETS, HOT_ROWS = 4096, 1 << 20  # a bucket of trades with that many rows above four times the mean holds a hot one


def _date_col(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.col(value)
    if isinstance(value, dt.datetime):
        value = value.date()
    return F.lit(value)


def _desc_nulls_first(c: Column) -> list[Column]:
    """Sort-key parts that make ``min`` pick the DESC NULLS FIRST winner."""
    return [c.isNotNull(), F.when(c.isNotNull(), -c)]


def _ts_desc_nulls_first(c: Column) -> list[Column]:
    return [c.isNotNull(), F.when(c.isNotNull(), -F.unix_micros(c.cast("timestamp")))]


def dedup_first(df: DataFrame, key: str | Sequence[str] = "message_id",
                order: tuple[str, ...] = ("loaded_at", "file_name")) -> DataFrame:
    """First arrival per ``key`` (W1; one column or several): the row with the smallest ``order``
    (ascending, NULLs last), i.e. ``row_number() = 1``.

    Written as an aggregation (``min_by`` over the row as a struct) so each
    map task collapses a group of copies to one row before the shuffle: a
    message delivered a million times never reaches one reducer whole.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    sort_key = []
    for o in order:
        sort_key += [F.col(o).isNull(), F.col(o)]
    # Copies with equal load time and file come from one load of one file and
    # carry the same content, so any of them may be kept.
    best = F.min_by(F.struct(*rest), F.struct(*sort_key)).alias("_row")
    # The row is never NULL: the filter says so to no effect on the rows, but whoever reads only some columns
    # then reads the same shuffle as those who read all, and not a narrower one of its own.
    return df.groupBy(*keys).agg(best).filter("_row IS NOT NULL").select(*keys, "_row.*").select(*df.columns)


def dedup_by_trade(df: DataFrame, key: str = "message_id",
                   order: tuple[str, ...] = ("loaded_at", "file_name")) -> DataFrame:
    """:func:`dedup_first` for rows that already lie by trade, none of them NULL (they come out of a join on ``trade_id``).

    Copies of a message meet inside their trade, so the whole rows stay where they
    are. A ``key`` that occurs under several trades is found from its hash and trade
    alone (:func:`suspects`, the only rows that are shuffled); all but its first
    arrival leave through an anti join by trade, again without moving a whole row."""
    mine = dedup_first(df, ("trade_id", key), order).withColumn("_hash", F.xxhash64(key))
    firsts = _suspected(mine, suspects(mine, key), key).select("trade_id", key, *order)
    by_arrival = Window.partitionBy(key).orderBy(*[F.col(o).asc_nulls_last() for o in order], F.col("trade_id").asc_nulls_last())
    again = (firsts.withColumn("_rn", F.row_number().over(by_arrival)).filter("_rn > 1")
             .select(F.col("trade_id").alias("_trade"), F.col(key).alias("_key")))
    mine = mine.select(*df.columns)
    return mine.join(again, (mine.trade_id == again._trade) & mine[key].eqNullSafe(again._key), "left_anti")


def suspects(mine: DataFrame, key: str, seen: DataFrame | None = None) -> DataFrame:
    """``_trade`` and hash (under the name ``key``) of the rows, one a trade and ``key``, whose hash another row or an id in ``seen`` has too.

    Only hash and trade are shuffled, a third of what the ids take. Different ids may share a
    hash, so the ids of the few rows found here are compared afterwards, and no row is judged by its hash alone."""
    pairs = mine.select(F.col("trade_id").alias("_trade"), F.col("_hash").alias(key), F.lit(True).alias("_mine"))
    if seen is not None:
        none = F.lit(None).cast(mine.schema["trade_id"].dataType)
        pairs = pairs.unionByName(seen.select(none.alias("_trade"), F.xxhash64(key).alias(key), F.lit(False).alias("_mine")))
    several = pairs.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key))).filter("_n > 1 AND _mine")
    return several.select("_trade", key)


def _suspected(mine: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Rows of ``mine`` that :func:`suspects` has found, where they lie."""
    return mine.join(found, (mine.trade_id == found._trade) & (mine._hash == found[key]), "left_semi")


def dedup_first_window(df: DataFrame, key: str = "message_id",
                       order: tuple[str, ...] = ("loaded_at", "file_name")) -> DataFrame:
    """Window form of :func:`dedup_first`; the optimizer adds a partial
    WindowGroupLimit before the shuffle, so it is skew-safe as well."""
    w = Window.partitionBy(key).orderBy(*[F.col(o).asc_nulls_last() for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def rank_key(version="version", event_ts="event_timestamp", loaded="loaded_at",
             message_id="message_id") -> Column:
    """Struct whose minimum is the in-batch winner (W3 order, spelled out)."""
    parts = (_desc_nulls_first(F.col(version)) + _ts_desc_nulls_first(F.col(event_ts))
             + _ts_desc_nulls_first(F.col(loaded)) + [F.col(message_id)])
    return F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)])


def batch_winners(messages: DataFrame, batch_col: str = "batch_id",
                  loaded_col: str = "loaded_at") -> DataFrame:
    """One row per (trade, batch): the winning message id, version and maturity."""
    win = F.min_by(F.struct(F.col("message_id").alias("winner_id"),
                            F.col("version").alias("winner_version"),
                            F.col("maturity_date").alias("winner_maturity")),
                   rank_key(loaded=loaded_col))
    return (messages.groupBy("trade_id", batch_col).agg(win.alias("_w"))
            .select("trade_id", batch_col, "_w.*"))


def rank_in_batch(messages: DataFrame, batch_col: str = "batch_id",
                  loaded_col: str = "loaded_at", by_trade: bool = False) -> DataFrame:
    """W3 as a flag: ``is_batch_winner`` is true exactly for ``row_number() = 1``
    of (version desc, event time desc, load time desc, message id) per trade
    and batch. ``by_trade``: no trade is NULL and the messages lie by trade, where
    they meet their winner."""
    w = batch_winners(messages, batch_col, loaded_col).select("trade_id", batch_col, "winner_id")
    same = messages.trade_id == w.trade_id if by_trade else messages.trade_id.eqNullSafe(w.trade_id)
    j = messages.join(w, on=[same, messages[batch_col] == w[batch_col]])
    return j.select(messages["*"], (messages.message_id == w.winner_id).alias("is_batch_winner"))


def rank_in_batch_window(messages: DataFrame, batch_col: str = "batch_id",
                         loaded_col: str = "loaded_at") -> DataFrame:
    """Literal window form of W3 (full ``rank_in_batch`` number)."""
    w = Window.partitionBy("trade_id", batch_col).orderBy(
        F.col("version").desc_nulls_first(), F.col("event_timestamp").desc_nulls_first(),
        F.col(loaded_col).desc_nulls_first(), F.col("message_id").asc())
    return messages.withColumn("rank_in_batch", F.row_number().over(w))


def decision(is_winner: Column, matured: Column, version: Column, existing: Column) -> Column:
    """the ordered ACCEPTED / REJECTED rule."""
    return (F.when(~is_winner, F.lit(K.REJECTED))
             .when(matured, F.lit(K.REJECTED))
             .when(existing.isNotNull() & (version < existing), F.lit(K.REJECTED))
             .otherwise(F.lit(K.ACCEPTED)))


def reason(is_winner: Column, matured: Column, version: Column, existing: Column) -> Column:
    """the ordered reason rule (five labels)."""
    return (F.when(~is_winner, F.lit(K.SUPERSEDED_IN_BATCH))
             .when(matured, F.lit(K.MATURITY_DATE_IN_PAST))
             .when(existing.isNotNull() & (version < existing), F.lit(K.STALE_VERSION_LOWER_THAN_EXISTING))
             .when(existing.isNotNull() & (version == existing), F.lit(K.REPLACED_SAME_VERSION))
             .otherwise(F.lit(K.NEW_TRADE_ACCEPTED)))


def _matured(maturity: Column, as_of: Column) -> Column:
    # NULL maturity compares to NULL -> not matured (falls through to ACCEPTED)
    return F.coalesce(maturity < as_of, F.lit(False))


def _finish(messages: DataFrame, winners: DataFrame, as_of, batch_col: str, loaded_col: str,
            evaluated_at: Column | None, by_trade: bool = False) -> DataFrame:
    """Join messages to their (trade, batch) winner row and apply F1/F2."""
    m = messages.alias("m")
    w = winners.alias("w")
    # rows that lie by trade have no NULL trade, and a plain equality keeps them in place
    same = F.col("m.trade_id") == F.col("w.trade_id") if by_trade else F.col("m.trade_id").eqNullSafe(F.col("w.trade_id"))
    j = m.join(w, on=[same, F.col(f"m.{batch_col}") == F.col(f"w.{batch_col}")], how="inner")
    is_winner = F.col("m.message_id") == F.col("w.winner_id")
    as_of_c = _date_col(as_of) if not isinstance(as_of, str) else F.col(f"m.{as_of}")
    matured = _matured(F.col("m.maturity_date"), as_of_c)
    version = F.col("m.version")
    existing = F.col("w.existing_version")
    if evaluated_at is None:
        evaluated_at = F.expr(f"timestampadd(MINUTE, 5, m.{loaded_col})")
    cols = [F.col(f"m.{c}") for c in MESSAGE_COLUMNS] + [
        F.col(f"m.{loaded_col}").alias("source_loaded_at"),
        F.col(f"m.{batch_col}").alias("batch_id"),
        existing.cast("bigint").alias("existing_version"),
        decision(is_winner, matured, version, existing).alias("decision"),
        reason(is_winner, matured, version, existing).alias("decision_reason"),
        evaluated_at.alias("evaluated_at"),
    ]
    return j.select(*cols)


def evaluate_replay(deliveries: DataFrame, as_of, batch_col: str = "batch_id",
                    loaded_col: str = "loaded_at", evaluated_at: Column | None = None,
                    dedup: bool = True, by_trade: bool = False) -> DataFrame:
    """Decide every message of many batches in one pass.

    Equal to evaluating batch after batch, because the highest *accepted*
    version before a batch equals the highest *candidate* version (batch
    winner that is not matured) of the earlier batches: a candidate below the
    running maximum is rejected and leaves it unchanged, a candidate at or
    above it is accepted and becomes it.

    ``as_of`` is a date (or a column name holding a per-batch as-of date).
    ``by_trade``: the deliveries come out of a join on ``trade_id``, so none of
    it is NULL and they lie by trade; then no whole row is shuffled again.
    """
    first = dedup_by_trade if by_trade else dedup_first
    msgs = first(deliveries, "message_id", (loaded_col, "file_name")) if dedup else deliveries
    winners = batch_winners(msgs, batch_col, loaded_col)
    if isinstance(as_of, str):
        as_of_per_batch = msgs.select(batch_col, as_of).distinct()
        winners = winners.join(as_of_per_batch, batch_col)  # one row per batch; AQE sizes it
        as_of_w = F.col(as_of)
    else:
        as_of_w = _date_col(as_of)
    candidate = F.when(~_matured(F.col("winner_maturity"), as_of_w), F.col("winner_version"))
    earlier = (Window.partitionBy("trade_id").orderBy(F.col(batch_col))
               .rangeBetween(Window.unboundedPreceding, -1))
    winners = winners.select("trade_id", batch_col, "winner_id",
                             F.max(candidate).over(earlier).alias("existing_version"))
    return _finish(msgs, winners, as_of, batch_col, loaded_col, evaluated_at, by_trade)


def known_state(decisions: DataFrame) -> DataFrame:
    """A2: highest accepted version per trade."""
    return (decisions.filter(F.col("decision") == K.ACCEPTED)
            .groupBy("trade_id").agg(F.max("version").alias("existing_version")))


def attach_existing_version(batch: DataFrame, state: DataFrame) -> DataFrame:
    """Left equi-join of a batch to the known state (trade -> max version).

    The state has one row per trade (no skew on its side); a hot trade in the
    batch is split by AQE's skew-join handling. The state grows with every
    trade ever seen while a batch is small, so it is first cut to the batch's
    trades by a semi join whose build side is the batch (broadcast when AQE or
    the file sizes show it small): the state is scanned, not shuffled.
    """
    trades = batch.select(F.col("trade_id").alias("_st_trade"))
    s = (state.select(F.col("trade_id").alias("_st_trade"), "existing_version")
         .join(trades, "_st_trade", "left_semi"))
    return (batch.join(s, batch.trade_id == s._st_trade, "left").drop("_st_trade"))


def drop_decided(msgs: DataFrame, prior_decisions: DataFrame) -> DataFrame:
    """Messages not decided before (hazard H3: a redelivery keeps its first decision).

    The decision log grows with every drain while a drain stays small, so the
    log is first reduced to the drain's message ids that it already holds (a
    semi join whose build side is the drain: AQE broadcasts it when measured
    small, and the log is then scanned -- one pruned column -- but never
    shuffled); only that small remainder meets the drain in the anti join.
    """
    ids = msgs.select("message_id")
    seen = prior_decisions.select("message_id").join(ids, "message_id", "left_semi")
    return msgs.join(seen, "message_id", "left_anti")


def evaluate_batch(batch: DataFrame, prior_decisions: DataFrame | None, as_of,
                   batch_id: int | None = None, loaded_col: str = "loaded_at",
                   evaluated_at: Column | None = None, state: DataFrame | None = None, by_trade: bool = False) -> DataFrame:
    """Evaluate one drain against the decisions already on file.

    The batch is first reduced to the first arrival of each message and to
    messages not decided before (a redelivery in a later drain keeps its first
    decision, hazard H3). ``state`` (trade_id, existing_version), when given,
    is the version gate instead of aggregating the whole log (A2) each run.
    ``by_trade``: see :func:`evaluate_drain`.
    """
    if by_trade and evenly_by_trade(batch):
        if "batch_id" not in batch.columns:
            batch = batch.withColumn("batch_id", F.lit(batch_id if batch_id is not None else 0).cast("bigint"))
        known = state if state is not None or prior_decisions is None else known_state(prior_decisions)
        return evaluate_laid(batch, prior_decisions, as_of, loaded_col, evaluated_at, known, running=False)
    msgs = dedup_first(batch, "message_id", (loaded_col, "file_name"))
    if "batch_id" not in msgs.columns:
        msgs = msgs.withColumn("batch_id", F.lit(batch_id if batch_id is not None else 0).cast("bigint"))
    if prior_decisions is not None:
        msgs = drop_decided(msgs, prior_decisions)
    winners = batch_winners(msgs, "batch_id", loaded_col)
    known = state if state is not None else (known_state(prior_decisions) if prior_decisions is not None else None)
    if known is not None:
        winners = attach_existing_version(winners, known)
    else:
        winners = winners.withColumn("existing_version", F.lit(None).cast("bigint"))
    winners = winners.select("trade_id", "batch_id", "winner_id", "existing_version")
    return _finish(msgs, winners, as_of, "batch_id", loaded_col, evaluated_at)


def decision_counts(decisions: DataFrame) -> DataFrame:
    """Count per batch, decision and reason."""
    return (decisions.groupBy("batch_id", "decision", "decision_reason")
            .agg(F.count(F.lit(1)).alias("message_count")))


def evaluate_drain(drained: DataFrame, prior_decisions: DataFrame | None, as_of,
                   loaded_col: str = "loaded_at", evaluated_at: Column | None = None,
                   state: DataFrame | None = None, dedup: bool = True, by_trade: bool = False) -> DataFrame:
    """C1 generalised to one drain that may hold several whole batches.

    Messages are reduced to their first arrival and to those not decided
    before (H3); the highest accepted version before each batch is the
    larger of the known state (A2 over the prior decisions) and the running
    candidate maximum over the drain's earlier batches, so any grouping of
    whole batches into drains gives the same decisions as the one-pass replay.

    ``state`` (trade_id, existing_version), when given, replaces the
    aggregation over the whole decision log for the version gate: a compact
    table with one row per trade, kept up to date by :func:`advance_state`.
    ``dedup=False`` when ``drained`` is already one row per message (staged).
    ``by_trade``, for a drain and prior ids on file: :func:`evaluate_laid`, unless
    a trade is hot; a count over the drain's trades, run at once, tells.
    """
    if by_trade and evenly_by_trade(drained):
        known = state if state is not None or prior_decisions is None else known_state(prior_decisions)
        return evaluate_laid(drained, prior_decisions, as_of, loaded_col, evaluated_at, known)
    msgs = dedup_first(drained, "message_id", (loaded_col, "file_name")) if dedup else drained
    if prior_decisions is not None:
        msgs = drop_decided(msgs, prior_decisions)
    winners = batch_winners(msgs, "batch_id", loaded_col)
    candidate = F.when(~_matured(F.col("winner_maturity"), _date_col(as_of)), F.col("winner_version"))
    earlier = (Window.partitionBy("trade_id").orderBy(F.col("batch_id"))
               .rangeBetween(Window.unboundedPreceding, -1))
    winners = winners.select("trade_id", "batch_id", "winner_id",
                             F.max(candidate).over(earlier).alias("_running"))
    known = state if state is not None else (known_state(prior_decisions) if prior_decisions is not None else None)
    if known is not None:
        winners = attach_existing_version(winners, known)
        existing = F.greatest("existing_version", "_running")  # NULLs are skipped
    else:
        existing = F.col("_running")
    winners = winners.select("trade_id", "batch_id", "winner_id", existing.alias("existing_version"))
    return _finish(msgs, winners, as_of, "batch_id", loaded_col, evaluated_at)


def evenly_by_trade(rows: DataFrame) -> bool:
    """No trade is so hot that rows dealt by trade would leave one task with most of them (rows a hash bucket, counted)."""
    n = F.count(F.lit(1)).alias("n")
    per = rows.groupBy(F.pmod(F.xxhash64("trade_id"), F.lit(TRADE_BUCKETS)).alias("b")).agg(n)
    most, total = per.agg(F.max("n"), F.sum("n")).first()
    return (most or 0) <= HOT_ROWS + 4 * (total or 0) // TRADE_BUCKETS


def evaluate_laid(rows: DataFrame, seen: DataFrame | None, as_of, loaded_col: str = "loaded_at", evaluated_at: Column | None = None,
                  state: DataFrame | None = None, running: bool = True) -> DataFrame:
    """:func:`evaluate_drain` of rows that :func:`evenly_by_trade` holds for, with one shuffle of whole rows.

    Rows are dealt by trade once and lie so for every step: copies meet inside their
    trade, and winner and earlier versions are windows in place, as no trade is hot.
    Only hash and trade move again, to find an id under several trades or in
    ``seen`` (ids decided before; on file, so that its size decides how the ids meet it).
    The trade is wrapped in a struct, which is never NULL, so that rows without a trade
    lie together as well. ``state`` has a row a trade. ``running``: versions accepted
    in earlier batches of the rows count too."""
    laid = _unpacked(_packed(rows.withColumn("trade_id", F.struct("trade_id"))).repartition("trade_id"))
    mine = dedup_first(laid, ("trade_id", "message_id"), (loaded_col, "file_name")).withColumn("_hash", F.xxhash64("message_id"))
    firsts = _suspected(mine, suspects(mine, "message_id", seen), "message_id").select("trade_id", "message_id", loaded_col, "file_name")
    firsts = firsts.withColumn("_new", F.lit(True))
    if seen is not None:  # an id decided before stands before all its arrivals
        blank = [F.lit(None).cast(firsts.schema[c].dataType).alias(c) for c in ("trade_id", loaded_col, "file_name")]
        firsts = firsts.unionByName(seen.filter("message_id IS NOT NULL").select("message_id", *blank, F.lit(False).alias("_new")))
    by_arrival = Window.partitionBy("message_id").orderBy("_new", F.col(loaded_col).asc_nulls_last(), F.col("file_name").asc_nulls_last(), "trade_id")
    gone = firsts.withColumn("_rn", F.row_number().over(by_arrival)).filter("_rn > 1 AND _new")
    gone = gone.select(F.col("trade_id").alias("_trade"), F.col("message_id").alias("_id"))
    msgs = mine.join(gone, (mine.trade_id == gone._trade) & mine.message_id.eqNullSafe(gone._id), "left_anti").drop("_hash")
    in_batch = Window.partitionBy("trade_id", "batch_id").orderBy(rank_key(loaded=loaded_col))
    earlier = Window.partitionBy("trade_id").orderBy("batch_id").rangeBetween(Window.unboundedPreceding, -1)
    as_of_c = _date_col(as_of)
    ranked = msgs.withColumn("_winner", F.first("message_id").over(in_batch)).withColumn("_rn", F.row_number().over(in_batch))
    candidate = F.when((F.col("_rn") == 1) & ~_matured(F.col("maturity_date"), as_of_c), F.col("version"))
    out = ranked.withColumn("_running", F.max(candidate).over(earlier) if running else F.lit(None).cast("bigint")).filter("batch_id IS NOT NULL")
    existing = F.col("_running")
    if state is not None:  # rows without a trade have no state
        known = state.filter("trade_id IS NOT NULL").select(F.struct("trade_id").alias("_st_trade"), F.col("existing_version").alias("_known"))
        out = out.join(known, out.trade_id == known._st_trade, "left")
        existing = F.greatest("_known", "_running")  # NULLs are skipped
    facts = (F.col("message_id") == F.col("_winner"), _matured(F.col("maturity_date"), as_of_c), F.col("version"), F.col("_existing"))
    return out.withColumn("_existing", existing).select(
        F.col("trade_id.trade_id").alias("trade_id"), *MESSAGE_COLUMNS[1:], F.col(loaded_col).alias("source_loaded_at"), "batch_id",
        F.col("_existing").cast("bigint").alias("existing_version"), decision(*facts).alias("decision"), reason(*facts).alias("decision_reason"),
        (F.expr(f"timestampadd(MINUTE, 5, {loaded_col})") if evaluated_at is None else evaluated_at).alias("evaluated_at"))


def _packed(rows: DataFrame, key: str = "message_id") -> DataFrame:
    """Ids that are pairs of lower-case hex digits as bytes, half as long in a shuffle; others stay text."""
    digits = F.col(key).rlike("^([0-9a-f][0-9a-f])+$")
    return rows.withColumn("_bytes", F.when(digits, F.unhex(key))).withColumn(key, F.when(F.col("_bytes").isNull(), F.col(key)))


def _unpacked(rows: DataFrame, key: str = "message_id") -> DataFrame:
    return rows.withColumn(key, F.coalesce(F.lower(F.hex("_bytes")), F.col(key))).drop("_bytes")


def advance_state(state: DataFrame | None, new_decisions: DataFrame) -> DataFrame:
    """Known state after a drain: per trade the larger of the stored maximum
    and the drain's highest accepted version (one row per trade, so the state
    grows with the number of trades, not with the number of messages)."""
    add = known_state(new_decisions)
    both = add if state is None else state.select("trade_id", "existing_version").unionByName(add)
    return both.groupBy("trade_id").agg(F.max("existing_version").alias("existing_version"))
