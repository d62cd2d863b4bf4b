"""A keyed table on plain Parquet whose merge rewrites only the buckets it touches.

Rows lie in buckets by a hash of their key, one folder a bucket and version. A small
manifest, itself a Parquet folder a version, names the current folder of every
bucket and the high-water mark up to which the source has been merged. The newest
finished manifest is the table, so there is no pointer to lose: a crash before it
leaves the version before, and the same merge run again writes the same version.

A merge ranks only the rows of the touched buckets (:func:`state.upsert_latest`) and
leaves the files of the others as they are. The bucket is the hash by which Spark deals rows out, so rows
that were shuffled by key for the ranking lie by bucket too and are written without another shuffle. Inside a bucket rows are sorted by
``cluster``, so that row-group statistics prune range filters.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import state as STT
from . import files

BUCKETS = 64
MANIFEST = "bucket int, folder string, mark string, ddl string"


class Version(NamedTuple):
    """One manifest: its number, the folder of every bucket, the source's mark, and the rows' schema."""

    number: int
    folders: dict[int, str]
    mark: str | None
    ddl: str


class KeyedTable:
    """Rows unique by ``keys``; of rows that share a key the first by ``order`` stays."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[Column], buckets: int = BUCKETS,
                 cluster: Sequence[str] = (), row_group_bytes: int | None = None):
        self.spark, self.path, self.keys, self.order = spark, path.rstrip("/"), tuple(keys), tuple(order)
        self.buckets, self.cluster, self.row_group_bytes = buckets, tuple(cluster), row_group_bytes

    # --- versions --------------------------------------------------------------------------
    def versions(self) -> list[int]:
        return [int(n[2:]) for n in files.finished(self.spark, f"{self.path}/manifest", "v=")]

    def current(self, before: int | None = None) -> Version | None:
        """The newest version (before number ``before``); its manifest has one row a bucket."""
        mine = [v for v in self.versions() if before is None or v < before]
        if not mine:
            return None
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/v={mine[-1]:012d}").collect()
        return Version(mine[-1], {r["bucket"]: r["folder"] for r in rows if r["bucket"] >= 0}, rows[0]["mark"], rows[0]["ddl"])

    def mark(self) -> str | None:
        """Up to where the source has been merged (P3); None before the first merge."""
        now = self.current()
        return now.mark if now else None

    def read(self, version: Version | None = None) -> DataFrame | None:
        """The table as of ``version`` (the newest); None before the first merge."""
        now = version or self.current()
        return self._rows(now, now.folders) if now else None

    def _rows(self, now: Version, folders) -> DataFrame:
        paths = [f"{self.path}/{now.folders[b]}" for b in sorted(folders)]
        return self.spark.read.schema(now.ddl).parquet(*paths) if paths else self.spark.createDataFrame([], now.ddl)

    # --- merge -----------------------------------------------------------------------------
    def _bucket(self) -> Column:
        return F.pmod(F.hash(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _by_bucket(self) -> bool:
        """A shuffle by key leaves the rows of a bucket in few tasks: its partitions are whole parts of buckets."""
        return int(self.spark.conf.get("spark.sql.shuffle.partitions")) % self.buckets == 0

    def merge(self, changes: DataFrame, mark: object = None, number: int | None = None) -> Version:
        """Upsert ``changes`` as version ``number`` (the next one; a number given again writes that version anew).

        The changes are reduced to one row a key. Over an older version they are written by bucket first: their folders
        name the touched buckets."""
        prior = self.current(before=number)
        number = (prior.number + 1 if prior else 0) if number is None else number
        kept = prior.folders if prior else {}
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in changes.schema)
        latest = STT.latest_per_key(changes, self.keys, self.order).withColumn("bucket", self._bucket())
        data, staged = f"{self.path}/data/v={number:012d}", f"{self.path}/changes/v={number:012d}"
        if not kept:  # nothing to rank them against: the reduced changes are the table
            self._write(latest, data, self.buckets)
            touched = self._written(data)
        else:
            latest.write.mode("overwrite").partitionBy("bucket").parquet(staged)
            touched = self._written(staged)
            if touched:
                changes = self.spark.read.schema(ddl + ", bucket int").parquet(staged).drop("bucket")
                held = [b for b in touched if b in kept]
                # every row of these buckets is written anew, so all are ranked where one shuffle puts them
                rows = STT.upsert_latest(self._rows(prior, held) if held else None, changes, self.keys, self.order, whole=True).select(*changes.columns)
                self._write(rows.withColumn("bucket", self._bucket()), data, min(len(touched), self.buckets))
            files.remove(self.spark, staged)
        folders = {**kept, **{b: f"data/v={number:012d}/bucket={b}" for b in touched}}
        if mark is None and prior:
            text = prior.mark
        else:
            text = None if mark is None else str(mark)
        manifest = [(b, f, text, ddl) for b, f in sorted(folders.items())] or [(-1, None, text, ddl)]
        self.spark.createDataFrame(manifest, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/v={number:012d}")
        return Version(number, folders, text, ddl)

    def _write(self, rows: DataFrame, path: str, parts: int) -> None:
        """Rows ranked by key, with their ``bucket``, a folder a bucket, sorted inside it."""
        laid = rows if self._by_bucket() else rows.repartition(parts, "bucket")
        writer = laid.sortWithinPartitions("bucket", *self.cluster).write.mode("overwrite").partitionBy("bucket")
        if self.row_group_bytes:
            writer = writer.option("parquet.block.size", self.row_group_bytes)
        writer.parquet(path)

    def _written(self, path: str) -> list[int]:
        """Numbers of the buckets that a write has filled."""
        return [int(n.split("=")[1]) for n in files.names(self.spark, path, "bucket=*")]

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove what none of the ``keep`` newest versions names. A reader of an older version than those must be done."""
        versions = self.versions()
        live = {f for v in versions[-keep:] for f in self.current(before=v + 1).folders.values()}
        gone = [f"manifest/v={v:012d}" for v in versions[:-keep]]
        for data in files.names(self.spark, f"{self.path}/data", "v=*"):
            if int(data[2:]) > versions[-1]:
                continue  # a merge that is still running
            inside = [f"data/{data}/{b}" for b in files.names(self.spark, f"{self.path}/data/{data}", "bucket=*")]
            dead = [f for f in inside if f not in live]
            gone += [f"data/{data}"] if len(dead) == len(inside) else dead
        for folder in gone:
            files.remove(self.spark, f"{self.path}/{folder}")
        return gone
