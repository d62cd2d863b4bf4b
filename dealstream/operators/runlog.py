"""Run-log analytics over user-supplied log tables.

Every function takes ``now`` explicitly instead of reading the clock, so a
result is repeatable. Log columns: run_id, object_name, state,
scheduled_time, elapsed, parts_scanned, parts_total.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S


def _since(now, hours: float) -> Column:
    return S.lit_ts(now - dt.timedelta(hours=hours))


def in_window(log: DataFrame, now, hours: float, col: str = "scheduled_time") -> DataFrame:
    """Trailing window ``(now - hours, now]`` (the upper bound keeps future rows out)."""
    return log.filter((F.col(col) > _since(now, hours)) & (F.col(col) <= S.lit_ts(now)))


def recent(df: DataFrame, ts: str, n: int | None = None, tie: str = "run_id") -> DataFrame:
    """Newest first with a unique tie-break, optional limit (a top-k report)."""
    out = df.orderBy(F.col(ts).desc(), F.col(tie))
    return out.limit(n) if n else out


def recent_failures(log: DataFrame, now, hours: float = 24 * 7, n: int | None = 100) -> DataFrame:
    """O1: failed runs in the trailing window, newest first."""
    f = in_window(log, now, hours).filter(F.col("state") == "FAILED")
    return recent(f.select("run_id", "object_name", "state", "scheduled_time", "elapsed"), "scheduled_time", n)


def run_by_id(log: DataFrame, run_ids: DataFrame) -> DataFrame:
    """O2: the runs whose id is in ``run_ids`` (semi join)."""
    return log.join(run_ids.select("run_id"), "run_id", "left_semi")


def run_history(log: DataFrame, names: Sequence[str], now, days: int = 3) -> DataFrame:
    """O3: history of a set of objects over the trailing days, newest first."""
    f = in_window(log, now, 24 * days).filter(F.col("object_name").isin(list(names)))
    return recent(f.select("run_id", "object_name", "state", "scheduled_time", "elapsed"), "scheduled_time")


def last_run(log: DataFrame) -> DataFrame:
    """Per object the latest scheduled time and the state at that time
    (ties on time: the largest run id). Hash aggregation, skew-safe."""
    return log.groupBy("object_name").agg(
        F.max("scheduled_time").alias("last_run"),
        F.max_by("state", F.struct("scheduled_time", "run_id")).alias("last_state"))


def not_running(log: DataFrame) -> DataFrame:
    """Objects whose latest state is not a success."""
    return last_run(log).filter(F.col("last_state") != "SUCCEEDED")


def latest_status(expected: DataFrame, log: DataFrame) -> DataFrame:
    """Every expected object with its latest run; an object
    that never ran shows ``UNKNOWN``. One aggregation, never a loop."""
    lr = log.groupBy("object_name").agg(
        F.max_by(F.struct("state", "scheduled_time", "elapsed"), F.struct("scheduled_time", "run_id")).alias("l"))
    j = expected.join(lr, "object_name", "left")
    return j.select("object_name", F.coalesce(F.col("l.state"), F.lit("UNKNOWN")).alias("last_state"),
                    F.col("l.scheduled_time").alias("last_scheduled"), F.col("l.elapsed").alias("last_elapsed"))


def tagged_failures(log: DataFrame, tag: str, now, hours: float = 24 * 7) -> DataFrame:
    """Failures whose tag text contains ``tag`` (case-insensitive)."""
    f = in_window(log, now, hours).filter(S.contains_ci("props", tag) & (F.col("state") == "FAILED"))
    return recent(f.select("run_id", "object_name", "props", "scheduled_time"), "scheduled_time")


def queued_runs(log: DataFrame, now, hours: float = 24, elapsed_over: float = 400.0,
                scanned_over: int = 95) -> DataFrame:
    """Runs that waited (either wait signal positive)."""
    f = in_window(log, now, hours).filter(
        ((F.col("elapsed") - F.lit(elapsed_over)) > 0) | ((F.col("parts_scanned") - F.lit(scanned_over)) > 0))
    return recent(f.select("run_id", "object_name", "elapsed", "parts_scanned", "scheduled_time"), "scheduled_time")


def slowest(log: DataFrame, now, hours: float = 24, n: int = 20) -> DataFrame:
    """Top-n by elapsed time (ties: smallest run id)."""
    f = in_window(log, now, hours)
    return (f.select("run_id", "object_name", "elapsed", "parts_scanned", "parts_total", "scheduled_time")
            .orderBy(F.col("elapsed").desc(), F.col("run_id")).limit(n))


def scan_ratio(log: DataFrame, text: str, now, hours: float = 24, n: int = 20) -> DataFrame:
    """Parts scanned over parts total (NULL when the total is 0)."""
    f = in_window(log, now, hours).filter(S.contains_ci("object_name", text))
    return recent(f.select("run_id", "object_name", "parts_scanned", "parts_total", "scheduled_time",
                           S.safe_ratio("parts_scanned", "parts_total", 3).alias("scan_ratio")),
                  "scheduled_time", n)


def cache_hit_rate(log: DataFrame, now, hours: float = 24) -> DataFrame:
    """Share of runs served without scanning (count_if + NULLIF guard)."""
    f = in_window(log, now, hours)
    a = f.agg(F.count(F.lit(1)).alias("total_runs"),
              F.count_if(F.col("parts_scanned") == 0).alias("fully_cached"))
    return a.select("total_runs", "fully_cached",
                    F.round(S.safe_ratio("fully_cached", "total_runs") * 100, 1).alias("cache_hit_pct"))


def success_rate(log: DataFrame, now, days: int = 7, names: Sequence[str] | None = None) -> DataFrame:
    """Per object total runs, successes and success %."""
    f = in_window(log, now, 24 * days)
    if names:
        f = f.filter(F.col("object_name").isin(list(names)))
    g = f.groupBy("object_name").agg(F.count(F.lit(1)).alias("total_runs"),
                                     F.count_if(F.col("state") == "SUCCEEDED").alias("succeeded"))
    return g.select("object_name", "total_runs", "succeeded",
                    F.round(S.safe_ratio("succeeded", "total_runs") * 100, 1).alias("success_pct"))


def hourly_cost(log: DataFrame, now, days: int = 7) -> DataFrame:
    """Sum per object and hour, newest hour first."""
    f = in_window(log, now, 24 * days)
    return (f.groupBy("object_name", F.date_trunc("hour", "scheduled_time").cast("timestamp_ntz").alias("hour"))
            .agg(F.sum(F.col("elapsed").cast("decimal(18,2)")).cast("double").alias("cost"))
            .orderBy(F.col("hour").desc(), "object_name"))


def volume_trend(df: DataFrame, ts: str, n: int | None = 48) -> DataFrame:
    """Rows per hour bucket, newest first, limited to the last ``n`` hours shown."""
    g = (df.groupBy(F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour"))
         .agg(F.count(F.lit(1)).alias("rows_loaded")).orderBy(F.col("hour").desc()))
    return g.limit(n) if n else g


def reject_trend(rejected: DataFrame, ts: str = "logged_at") -> DataFrame:
    """Rejects per hour and reason."""
    return (rejected.groupBy(F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour"), "reject_reason")
            .agg(F.count(F.lit(1)).alias("rejects")).orderBy(F.col("hour").desc(), "reject_reason"))


def storage_footprint(sizes: DataFrame) -> DataFrame:
    """Three byte columns in GiB, largest first."""
    return sizes.select("table_name", S.to_gib("active_bytes").alias("active_gb"),
                        S.to_gib("time_travel_bytes").alias("time_travel_gb"),
                        S.to_gib("failsafe_bytes").alias("failsafe_gb"),
                        "active_bytes").orderBy(F.col("active_bytes").desc(), "table_name").drop("active_bytes")


def failure_alert(log: DataFrame, names: Sequence[str], now, minutes: int = 15) -> DataFrame:
    """One row saying whether any listed object failed in the last minutes."""
    f = in_window(log, now, minutes / 60.0).filter(F.col("object_name").isin(list(names)) &
                                                   (F.col("state") == "FAILED"))
    return f.select(F.lit(1).alias("x")).limit(1).agg((F.count(F.lit(1)) > 0).alias("alert"))


def lineage_neighbours(edges: DataFrame, name: str) -> DataFrame:
    """Edges where the object is the source or the target."""
    return edges.filter((F.col("source") == name) | (F.col("target") == name))


def union_status(log: DataFrame, names: Sequence[str]) -> DataFrame:
    """One summary row per listed object, also for one without rows, from a
    single pass over the log."""
    last = log.filter(F.col("object_name").isin(list(names))).groupBy("object_name").agg(
        F.max("scheduled_time").alias("last_run"), F.max_by("state", F.struct("scheduled_time", "run_id")).alias("last_state"))
    listed = log.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, names))).alias("object_name"))
    return listed.join(last, "object_name", "left").select("object_name", "last_run", "last_state")


def freshness(maxima: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row with the scalar max of a column in each table
    (one-row aggregates placed side by side as scalar subqueries)."""
    from .report import side_by_side

    ones = [df.agg(F.max(col).alias(alias)) for alias, (df, col) in maxima.items()]
    return side_by_side(ones[0], *ones[1:])


def lag_minutes(raw: DataFrame, raw_col: str, gold: DataFrame, gold_col: str) -> DataFrame:
    """Latest raw row, latest gold row and the minute boundaries
    between them (raw - gold: a healthy feed is <= 0)."""
    f = freshness({"latest_bronze_row": (raw, raw_col), "latest_gold_row": (gold, gold_col)})
    return f.select("latest_bronze_row", "latest_gold_row",
                    S.minutes_between("latest_gold_row", "latest_bronze_row").alias("gold_lag_minutes"))


def has_backlog(landed: DataFrame, processed: DataFrame, key: str = "message_id") -> DataFrame:
    """Is any landed message not processed yet? (anti join, stops at one)."""
    pending = landed.select(key).join(processed.select(key), key, "left_anti").limit(1)
    return pending.agg((F.count(F.lit(1)) > 0).alias("has_backlog"))


def running_sums(df: DataFrame, order_col: str, cols: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Inclusive running sums of ``cols`` in ``order_col`` order (distinct
    values), computed without a global window.

    Rows are dealt into ranges of the value itself (one per shuffle partition)
    and written once with the number of their range; each range is summed in
    its own window partition, and the offset of a range is the running sum of
    the range totals -- a window over one row per range.
    """
    from pyspark.sql import Window

    from ..session import unique_dir

    spark, v = df.sparkSession, F.col(order_col)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = unique_dir(spark, "tables", "running_ranges")
    df.repartitionByRange(n, v).withColumn("_bucket", F.spark_partition_id()).write.parquet(path)
    b = spark.read.parquet(path)
    local_w = (Window.partitionBy("_bucket").orderBy(v.asc_nulls_first())
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = b.select(order_col, "_bucket", *[F.sum(c).over(local_w).alias(f"_l_{c}") for c in cols])
    totals = b.groupBy("_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    before_w = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = totals.select("_bucket", *[F.coalesce(F.sum(f"_t_{c}").over(before_w), F.lit(0)).alias(f"_o_{c}")
                                         for c in cols])
    return local.join(offsets, "_bucket").select(
        order_col, *[(F.col(f"_l_{c}") + F.col(f"_o_{c}")).alias(f"{c}_le") for c in cols])


def layout_overlap(df: DataFrame, group: str, key: str, buckets: int | None = None) -> DataFrame:
    """For every group (file) its key range and how many *other* groups'
    ranges overlap it -- the clustering depth of the layout.

    Instead of joining every pair of ranges, count by rank: the groups
    overlapping [lo, hi] are those with start <= hi minus those ending before
    lo. Both counts are running sums over a histogram of range endpoints
    (:func:`running_sums`, no global window), so nothing pairs up groups and
    no single task sees every endpoint. Groups whose key is all NULL have no
    range and overlap nothing; they are left out.
    """
    from ..session import unique_dir

    # One row per group, read several times below: written once to the shared
    # folder, so the input is scanned and reduced only once.
    path = unique_dir(df.sparkSession, "tables", "layout_ranges")
    (df.groupBy(group).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
       .filter(F.col("lo").isNotNull()).write.parquet(path))
    ranges = df.sparkSession.read.parquet(path)
    starts = ranges.groupBy(F.col("lo").alias("v")).agg(F.count(F.lit(1)).alias("n_start"))
    ends = ranges.groupBy(F.col("hi").alias("v")).agg(F.count(F.lit(1)).alias("n_end"))
    hist = starts.join(ends, "v", "full").na.fill(0, ["n_start", "n_end"])
    cum = running_sums(hist, "v", ("n_start", "n_end"), buckets)
    # groups with start <= hi: cumulative starts at hi
    a = ranges.join(cum.select(F.col("v").alias("_hv"), F.col("n_start_le").alias("starts_le")),
                    F.col("hi") == F.col("_hv"))
    # groups ending strictly before lo: cumulative ends at lo minus the ends at lo itself
    e_at = ends.select(F.col("v").alias("_lv2"), "n_end")
    b = (a.join(cum.select(F.col("v").alias("_lv"), F.col("n_end_le").alias("ends_le")), F.col("lo") == F.col("_lv"))
          .join(e_at, F.col("lo") == F.col("_lv2"), "left"))
    depth = F.col("starts_le") - (F.col("ends_le") - F.coalesce(F.col("n_end"), F.lit(0)))
    return b.select(group, "lo", "hi", (depth - 1).cast("bigint").alias("overlapping_groups"))
