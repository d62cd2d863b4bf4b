"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a fixed shuffled order, repeated up
to ``max_repeats`` times. Entry finish time = words queued so far in its source
/ the source's target; the queues are merged by finish time over the whole
table and the merge stops at the total budget (all words). Sums over a source
and over the merge are two-level (per hash or time bucket, then inside one
bucket), so no task ever holds a whole source, and the driver sees one row: the
place of the cut.

Defined results: null text has size 0; a null source is a source of its own,
sorted last; size-0 documents take 0; an empty table gives an empty result; rows
that repeat a doc_id are separate documents. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BUCKETS = 4096
WORDS = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: Sequence[float], max_repeats: int) -> DataFrame:
    """source, source_size, rank, target from one row (source, source_size) per source.

    The water level: with sources by cap / weight, the first k are capped for the
    smallest k whose level (words left / weight left) stays under the next source's ratio.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    s = (sizes.withColumn("rank", F.row_number().over(order) - 1).withColumn("weight", pick)
         .withColumn("cap", F.col("source_size") * F.lit(max_repeats)).withColumn("ratio", F.col("cap") / F.col("weight")))
    by = Window.orderBy("ratio", "rank")
    all_rows = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    s = s.withColumn("level", level).withColumn("at", F.when(F.col("level") <= F.col("ratio"), F.col("level")))
    s = s.withColumn("level", F.first("at", ignorenulls=True).over(all_rows))
    return s.withColumn("target", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))).select(
        "source", "source_size", "rank", "target")


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_repeats: int = 3, buckets: int = BUCKETS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken."""
    key = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = written(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("size"), key.alias("key"),
    ).withColumn("bucket", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * buckets / 2**32)), "sized")
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_repeats)
    parts = sized.groupBy("source", "bucket").agg(F.sum("size").alias("part"))
    prior = F.coalesce(F.sum("part").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.withColumn("prior", prior)
    parts = parts.alias("p").join(targets.alias("t"), F.expr("p.source <=> t.source")).select("p.*", "source_size", "rank", "target")
    inside = F.sum("size").over(Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size")
                                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    queue = sized.withColumn("inside", inside).alias("d").join(parts.alias("p"), F.expr("d.source <=> p.source AND d.bucket = p.bucket"))
    queue = written(queue.select("d.doc_id", "d.source", "d.size", "d.key", (F.col("inside") + F.col("prior")).alias("queued"),
                                 "source_size", "rank", "target"), "queue")
    budget = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]

    def entry(e: Column) -> Column:
        """Place of repeat e in the merge: a total order but for interchangeable rows."""
        time = ((e - 1) * F.col("source_size") + F.col("queued")) / F.col("target")
        return F.struct(time.alias("time"), F.col("rank").cast("long").alias("rank"), "key",
                        F.coalesce("doc_id", F.lit(-2**63)).alias("id"), "size", e.cast("long").alias("e"))

    live = queue.filter("target > 0")
    entries = live.withColumn("e", F.explode(F.sequence(F.lit(1), F.lit(max_repeats)))).select("size", entry(F.col("e")).alias("entry"))
    entries = entries.withColumn("slot", F.floor(F.col("entry.time") * buckets))
    # two levels: the window over all time sees one row per ``buckets`` slots, the other only the slots of one of them
    run = entries.groupBy("slot").agg(F.sum("size").alias("words")).withColumn("span", F.floor(F.col("slot") / buckets))
    spans = run.groupBy("span").agg(F.sum("words").alias("words")).withColumn("until", F.sum("words").over(Window.orderBy("span")))
    wide = spans.filter(F.col("until") > budget).orderBy("span").first()
    cut = None
    if wide is not None:
        slots = run.filter(F.col("span") == wide["span"]).withColumn(
            "until", F.sum("words").over(Window.orderBy("slot")) + F.lit(wide["until"] - wide["words"]))
        cut = slots.filter(F.col("until") > budget).orderBy("slot").first()
    admitted = F.lit(max_repeats)
    if cut is not None:
        inside = F.sum("size").over(Window.partitionBy("slot").orderBy("entry").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        over = (entries.filter(F.col("slot") == cut["slot"]).withColumn("until", inside + F.lit(cut["until"] - cut["words"]))
                .filter(F.col("until") > budget).agg(F.min("entry").alias("entry")).first()["entry"])
        stop = F.struct(F.lit(over["time"]).alias("time"), F.lit(over["rank"]).cast("long").alias("rank"), F.lit(over["key"]).alias("key"),
                        F.lit(over["id"]).cast("long").alias("id"), F.lit(over["size"]).cast("long").alias("size"),
                        F.lit(over["e"]).cast("long").alias("e"))
        admitted = sum((F.when(entry(F.lit(e)) < stop, 1).otherwise(0) for e in range(1, max_repeats + 1)), F.lit(0))
    taken = F.when(F.col("target") > 0, F.col("size") * admitted).otherwise(F.lit(0)).cast("long")
    return queue.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))
