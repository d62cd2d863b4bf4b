"""The log of a stream's file source, read as a table.

Structured Streaming keeps in its checkpoint which files each batch took
(``sources/0``, JSON lines, older batches folded into ``.compact`` files) and
which batches are committed (``commits``). Read together they say what of a
landing has been processed, without asking the target table.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files

SCHEMA = "path string, entry long"


def committed_epochs(spark: SparkSession, checkpoint: str) -> int:
    """The last committed batch, -1 if there is none."""
    return max((int(n) for n in files.names(spark, f"{checkpoint.rstrip('/')}/commits") if n.isdigit()), default=-1)


def batch_offsets(spark: SparkSession, checkpoint: str, epoch: int) -> tuple[int, int]:
    """What a batch wrote down when it was planned: (the watermark it starts with in ms, the last file-log entry it takes); (0, -1) before the first."""
    path = f"{checkpoint.rstrip('/')}/offsets/{epoch}"
    if epoch < 0 or not files.exists(spark, path):
        return 0, -1
    lines = spark.read.text(path, wholetext=True).first()[0].strip().split("\n")
    return json.loads(lines[1])["batchWatermarkMs"], json.loads(lines[2])["logOffset"] if lines[2] != "-" else -1


def logged_files(spark: SparkSession, checkpoint: str, first: int, last: int) -> DataFrame:
    """path and entry of the files in the entries ``first`` to ``last`` of the source's log (batches without new files have no entry)."""
    root = checkpoint.rstrip("/")
    if last < first or not files.exists(spark, f"{root}/sources/0"):
        return spark.createDataFrame([], SCHEMA)
    line = F.from_json("value", "path string, batchId long")
    lines = spark.read.text(f"{root}/sources/0").filter(F.col("value").startswith("{")).select(line.alias("f"))
    # a file stands in its entry and again in the compact files after it
    return lines.select(F.col("f.path").alias("path"), F.col("f.batchId").alias("entry")).filter(F.col("entry").between(first, last)).distinct()


def committed_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """path and entry of every file in the committed batches."""
    return logged_files(spark, checkpoint, 0, batch_offsets(spark, checkpoint, committed_epochs(spark, checkpoint))[1])


def batch_files(spark: SparkSession, checkpoint: str, epoch: int) -> list[str]:
    """The files that one batch takes, as the source lists them on the driver when it plans the batch."""
    first, last = batch_offsets(spark, checkpoint, epoch - 1)[1] + 1, batch_offsets(spark, checkpoint, epoch)[1]
    return [r["path"] for r in logged_files(spark, checkpoint, first, last).collect()]


def closed_before(spark: SparkSession, checkpoint: str, epoch: int) -> dt.datetime:
    """The watermark by which rows of batch ``epoch`` are late: the one that the batch before started with, as windows up to it are gone from the state."""
    return dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=batch_offsets(spark, checkpoint, epoch - 1)[0])


def plain_path(path: str) -> Column:
    """A file's path without scheme, escapes undone, so that listings and logs agree."""
    return F.url_decode(F.regexp_replace(F.regexp_replace(path, r"^[a-z0-9]+:/+(?=/)|^[a-z0-9]+:(?=/)", ""), r"\+", "%2B"))


def stream_backlog(spark: SparkSession, landing: str, checkpoint: str) -> DataFrame:
    """A18 for a stream: is any landed file not in a committed batch? One row: has_backlog, pending files, bytes, oldest.

    Listing against log: neither the landed rows nor the target are read."""
    there = listed_files(spark, landing).withColumn("path", plain_path("path"))
    done = committed_files(spark, checkpoint).select(plain_path("path").alias("path")).distinct()
    pending = there.join(done, "path", "left_anti")
    return pending.agg((F.count(F.lit(1)) > 0).alias("has_backlog"), F.count(F.lit(1)).alias("pending_files"),
                       F.coalesce(F.sum("length"), F.lit(0)).alias("pending_bytes"), F.min("modificationTime").alias("oldest_pending"))


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and change time of the data files under ``path``: a listing, no file is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return found.select("path", "length", "modificationTime")


def expire_landing(spark: SparkSession, path: str, before: dt.date, checkpoints: Sequence[str] = ()) -> list[str]:
    """Remove the folders of load dates before ``before``, oldest first, of which every stream in ``checkpoints``
    has committed all files; stops at the first folder that one has not. So neither a stream still to read them nor the
    replay of its last batch can miss a file: a batch is replayed only while it is not committed. Returns the removed names."""
    gone, root = [], path.rstrip("/")
    done = [committed_files(spark, c).select(plain_path("path").alias("path")).distinct() for c in checkpoints]
    for name in files.names(spark, root, "load_date=*"):
        day = name.split("=")[1]
        if day >= before.isoformat() or not day[:1].isdigit():  # rows without a load date stay
            continue
        there = listed_files(spark, f"{root}/{name}").withColumn("path", plain_path("path"))
        if any(not there.join(r, "path", "left_anti").isEmpty() for r in done):
            break
        files.remove(spark, f"{root}/{name}")
        gone.append(name)
    return gone
