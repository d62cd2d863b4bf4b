"""Keyed state over append-only logs: upserts, high-water marks, as-of views,
diffs and the FX latest-wins state.

Plain Parquet has no MERGE; a keyed upsert is expressed as
``state UNION changes`` reduced to one row per key by an ordering, which is a
single shuffle on the key (partial top-1 before the shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Top-1 row per key by ``order`` (T3 / W2). ``row_number() = 1`` gets a
    partial WindowGroupLimit before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def upsert_latest(state: DataFrame | None, changes: DataFrame, keys: Sequence[str],
                  order: Sequence[Column], whole: bool = False) -> DataFrame:
    """Replace rows with the same key, insert new keys; the winner per key
    is the first row by ``order`` (put the newest first).

    Only keys that occur in ``changes`` are ranked again: the state is split
    by a semi / anti join on the change keys (NULL-safe, so a NULL key is one
    key, as in the ranking) whose build side is the change set -- broadcast
    when it is measured small -- so rows of untouched keys are scanned and
    passed through, never shuffled. An upsert costs the size of the changes,
    not of the state. ``whole``: for a state of one row a key that is dealt
    out by key and written anew in any case, all of it is ranked, which takes one
    shuffle and no join."""
    if state is None:
        return latest_per_key(changes, keys, order)
    if whole:
        return latest_per_key(state.unionByName(changes, allowMissingColumns=True), keys, order)
    ck = changes.select(*[F.col(k).alias(f"_ck_{k}") for k in keys])
    on = [state[k].eqNullSafe(ck[f"_ck_{k}"]) for k in keys]
    touched = state.join(ck, on, "left_semi")
    untouched = state.join(ck, on, "left_anti")
    ranked = latest_per_key(touched.unionByName(changes, allowMissingColumns=True), keys, order)
    return untouched.unionByName(ranked, allowMissingColumns=True)


def resolve_watermark(target: DataFrame | None, col: str, epoch=K.EPOCH):
    """P3 helper: ``coalesce(max(col), epoch)`` resolved to a Python value with
    one aggregate, so the filter that uses it is a literal Parquet can skip on."""
    if target is None:
        return epoch
    v = target.agg(F.max(col).alias("m")).collect()[0]["m"]
    return epoch if v is None else v


def new_since(src: DataFrame, src_col: str, target: DataFrame | None, target_col: str,
              epoch=K.EPOCH) -> DataFrame:
    """Rows of ``src`` strictly newer than the target's high-water mark."""
    wm = resolve_watermark(target, target_col, epoch)
    return src.filter(F.col(src_col) > S.lit_ts(wm))


def state_as_of(decisions: DataFrame, *, batch_id: int | None = None, ts=None) -> DataFrame:
    """The decision log as it stood after ``batch_id`` (inclusive) or at
    time ``ts`` (evaluated at or before), for rebuilding a past state."""
    d = decisions
    if batch_id is not None:
        d = d.filter(F.col("batch_id") <= F.lit(batch_id))
    if ts is not None:
        d = d.filter(F.col("evaluated_at") <= S.lit_ts(ts))
    return d


def state_diff(now: DataFrame, before: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct rows of ``now`` not in ``before`` on ``cols`` (MINUS)."""
    return now.select(*cols).subtract(before.select(*cols))


def materialize(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write ``df`` to ``path`` (a shared folder) and return the written table,
    cutting the lineage."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- FX state (W2, C11) ---------------------------------------------------------------
def fx_order() -> tuple[Column, ...]:
    """Latest load first; file name and rate as deterministic tie-breaks."""
    return (F.col("loaded_at").desc_nulls_last(), F.col("file_name").desc_nulls_last(),
            F.col("rate_to_usd").desc_nulls_last())


def latest_rate(fx_raw: DataFrame) -> DataFrame:
    """One rate per (as_of_date, currency): the most recently loaded one
    (file name, then rate, as deterministic tie-breaks)."""
    return latest_per_key(fx_raw, ("as_of_date", "currency"), fx_order()).select(
        "as_of_date", "currency", "rate_to_usd", "file_name", "loaded_at")


def fx_state(fx_raw: DataFrame, prior: DataFrame | None) -> DataFrame:
    """C11: new loads since the prior state's high-water mark, deduplicated
    and upserted into the prior state."""
    new = new_since(fx_raw, "loaded_at", prior, "loaded_at")
    return upsert_latest(prior, latest_rate(new), ("as_of_date", "currency"), fx_order()).select(
        "as_of_date", "currency", "rate_to_usd", "file_name", "loaded_at")
