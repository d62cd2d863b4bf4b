"""Stored gold tables, merged by watermark (C2, C3, C11, P3), and what reads them.

The decision log is appended run by run. Every table here keeps the last run (or
load time) it has merged as its high-water mark and takes over only what is newer, a
filter on the log's run folders (or on row-group statistics). The book of valid
deals is a keyed table by trade; the reject log is only ever appended to; the rate
state is keyed by date and currency. Facts are sorted by maturity date inside
their files, so the reports' date ranges skip row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S
from ..sources import ingest as I
from ..sources.keyed import KeyedTable
from . import star as ST
from . import state as STT

ROW_GROUP_BYTES = 16 << 20
ORDER_COLUMN = "batch_id"  # kept in the stored book to rank a later merge


class Gold:
    """The stored facts under ``path``, built from the decision log at ``decisions``."""

    def __init__(self, spark: SparkSession, path: str, decisions: str, bounds: ST.DateBounds, buckets: int = 64, row_group_bytes: int = ROW_GROUP_BYTES):
        self.spark, self.path, self.decisions, self.bounds = spark, path.rstrip("/"), decisions.rstrip("/"), bounds
        newest = (F.col(ORDER_COLUMN).desc(), F.col("evaluated_at").desc(), F.col("message_id").asc())
        self.book = KeyedTable(spark, f"{self.path}/valid", ("trade_id",), newest, buckets, ("maturity_date",), row_group_bytes)
        self.rejects, self.row_group_bytes = f"{self.path}/rejected", row_group_bytes

    def refresh(self) -> int:
        """Merge the runs of the log that are newer than each table's mark; returns the last run merged.

        Both tables write the run's number, so a refresh cut short is simply run again."""
        runs = I.epochs(self.spark, self.decisions)
        if not runs:
            return -1
        last, mark = runs[-1], self.book.mark()
        if mark is None or int(mark) < last:
            new = I.read_appended(self.spark, self.decisions, since=0 if mark is None else int(mark) + 1, before=last + 1)
            latest = ST.latest_accepted(new).withColumn("processed_at", F.col("evaluated_at"))
            fact = ST.attach_dim_keys(latest, self.bounds).select(*ST.VALID_FACT_COLUMNS, F.col(ORDER_COLUMN).cast("bigint").alias(ORDER_COLUMN))
            self.book.merge(fact, mark=last, number=last)
        done = I.epochs(self.spark, self.rejects)
        if not done or done[-1] < last:
            new = I.read_appended(self.spark, self.decisions, since=done[-1] + 1 if done else 0, before=last + 1)
            # sorted before the keys are added, and only within files: the rows are not shuffled
            by_day = new.filter(F.col("decision") == K.REJECTED).sortWithinPartitions("maturity_date")
            rejected = ST.build_rejected_fact(by_day, self.bounds)
            I.append(rejected, self.rejects, last, {"parquet.block.size": self.row_group_bytes})
        return last

    def valid(self) -> DataFrame:
        """The current book."""
        return self.book.read().select(*ST.VALID_FACT_COLUMNS)

    def rejected(self) -> DataFrame:
        """The reject log."""
        return I.read_appended(self.spark, self.rejects)

    def status(self, as_of) -> DataFrame:
        """C4 over the stored book."""
        return ST.build_status(self.valid(), as_of)

    def report(self, as_of) -> DataFrame:
        """C5 over the stored book: filters on it reach the scan."""
        return ST.build_report(self.status(as_of), as_of, self.bounds)


class Rates:
    """C11: the rate state by date and currency, merged from loads newer than its mark."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.table = KeyedTable(spark, path, ("as_of_date", "currency"), STT.fx_order(), buckets, ("as_of_date",))

    def refresh(self, raw: DataFrame) -> None:
        """Take over the rows of ``raw`` loaded after the mark."""
        import datetime as dt

        mark = self.table.mark()
        since = dt.datetime.fromisoformat(mark) if mark else K.EPOCH
        new = raw.filter(F.col("loaded_at") > S.lit_ts(since))
        last = new.agg(F.max("loaded_at")).first()[0]
        if last is not None:
            # up to the mark only: a load that arrives meanwhile belongs to the next run
            self.table.merge(STT.latest_rate(new.filter(F.col("loaded_at") <= S.lit_ts(last))), mark=last.isoformat())

    def read(self) -> DataFrame:
        return self.table.read()
