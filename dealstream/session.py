"""Session helpers: one place for the SQL settings every job relies on.

Only runtime SQL settings are touched, and only when the cluster has not
set them already, so a production session keeps its own sizing.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the operators assume. Values are defaults, never overrides.
_DEFAULTS = {
    # Every timestamp in the model is an instant compared in UTC (hazard H1).
    "spark.sql.session.timeZone": "UTC",
    # AQE re-plans at shuffle boundaries: coalesces small partitions, turns
    # sort-merge joins into broadcast joins when the *measured* side is small,
    # and splits skewed partitions of joins on hot keys.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows that lie by trade stay in place for a join on trade and batch; if a trade
    # is so large that its join is split, the steps after it shuffle their partial results.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Logs, landings and facts are written once and read a few times: the smaller file is the cheaper one.
    "spark.sql.parquet.compression.codec": "zstd",
    # Decision rules rely on ANSI semantics (bad casts raise, x/0 raises).
    "spark.sql.ansi.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the defaults above where the session has no value yet."""
    for key, value in _DEFAULTS.items():
        if key == "spark.sql.session.timeZone":
            # The JVM always reports a time zone; pin UTC unless the user set
            # one explicitly through the builder / cluster config.
            if spark.conf.get(key, None) in (None, "", "Etc/UTC", "UTC", "GMT"):
                spark.conf.set(key, value)
            continue
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "dealstream") -> SparkSession:
    """Build (or reuse) a session with the UI off and the defaults applied."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    return configure(spark)


@contextmanager
def even_waves(spark: SparkSession, tasks: int = 4) -> Iterator[None]:
    """Steps whose rows cost much more than their bytes, cut into about ``tasks`` tasks a core.

    By their bytes such steps get a task a core and one or two left over, which then run alone.
    A setting that the session has is kept."""
    n = str(tasks * spark.sparkContext.defaultParallelism)
    mine = [k for k in ("spark.sql.files.minPartitionNum", "spark.sql.adaptive.coalescePartitions.minPartitionNum")
            if spark.conf.get(k, None) is None]
    for k in mine:
        spark.conf.set(k, n)
    try:
        yield
    finally:
        for k in mine:
            spark.conf.unset(k)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared ``spark.checkpoint.dir``.

    Streaming checkpoints, lineage cuts and written scratch tables live here
    so that a lost executor never loses them. The setting is read from the
    session; only when it is unset (local tests) a private folder is created
    and registered.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="dealstream-ckpt-")
        spark.sparkContext.setCheckpointDir(root)  # found by getCheckpointDir from now on
        root = spark.sparkContext.getCheckpointDir()
    path = root.rstrip("/")
    for p in parts:
        path = f"{path}/{p}"
    return path


def unique_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh, never reused sub-folder of :func:`shared_dir`."""
    import uuid

    return shared_dir(spark, *parts, uuid.uuid4().hex)
