"""MinHash near-duplicates by min-max hashing.

Each permutation of the hashed shingles keeps both its smallest and its largest
value, so a signature of 2P values costs P hash evaluations; the P minima and P
maxima are banded together. Steps:

1. one pass over the texts: distinct-shingle count, a 128-bit key of the whole
   set, and the band keys (written once);
2. documents with equal sets form a class, named by its smallest doc_id; only
   classes go on, so thousands of copies cost one row;
3. in each band bucket every class meets a few hubs of the bucket (picked by
   hash, so one cluster has few hubs), not all others; each distinct meeting of
   sets of like size is confirmed on the full shingle sets;
4. components of the confirmed links by alternating large and small stars;
5. where a bucket still holds several components, the classes outside its main
   one are compared with the whole bucket, streamed past them; their links are
   merged. So every pair that shares a bucket is linked, found unlike, or
   already in one component.

Recall of the banding: a pair of similarity s shares a band with probability
1 - (1 - s**rows)**bands, 0.99998 at s = 0.8 with the defaults.

Defined results: null or empty text, or text without words, has an empty set
and links with nothing; fewer words than a shingle make one shingle; rows that
repeat a doc_id are one document; a null doc_id takes no part (component null,
kept). Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACE, U64, SpanHash, doc_blocks, mix64, string_column, to_i64, utf8_parts, word_spans, written

BANDS, ROWS, BLOCK, HUBS, OUTSIDERS = 36, 6, 1 << 20, 3, 256


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingle hashes per document: (sorted hashes of all documents, offsets)."""
    low = LOWER[data]
    starts, ends, first = word_spans(SPACE[low], offsets)
    h = SpanHash(low)(starts, ends)
    out, bounds = [], np.zeros(len(offsets), np.int64)
    n = np.diff(first)
    grams = h.copy()
    for j in range(1, k):
        grams[:-j] = grams[:-j] * U64(0xC2B2AE3D27D4EB4F) + h[j:] if len(h) > j else grams[:0]
    grams = mix64(grams + U64(k)) if len(grams) else grams
    for i in range(len(n)):
        a, b = first[i], first[i + 1]
        if n[i] >= k:
            u = np.unique(grams[a:b - k + 1])
        elif n[i]:
            x = h[a:a + 1].copy()
            for j in range(a + 1, b):
                x = x * U64(0xC2B2AE3D27D4EB4F) + h[j]
            u = mix64(x + U64(int(n[i])))
        else:
            u = grams[:0]
        out.append(u)
        bounds[i + 1] = bounds[i] + len(u)
    return (np.concatenate(out) if out else np.zeros(0, U64)), bounds


def _constants(bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    n = bands * rows // 2
    return rng.integers(0, 2**63, n, dtype=U64) * U64(2) + U64(1), rng.integers(0, 2**63, n, dtype=U64)


def band_keys(u: np.ndarray, bounds: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(sets, bands) keys of non-empty sets; each band holds the minima and maxima of rows/2 permutations."""
    mul, xor = _constants(bands, rows)
    starts, per = bounds[:-1], rows // 2
    keys = np.empty((len(starts), bands), U64)
    buf = np.empty_like(u)
    for band in range(bands):
        acc = np.full(len(starts), band + 1, U64)
        for j in range(band * per, (band + 1) * per):
            np.bitwise_xor(u, xor[j], out=buf)
            np.multiply(buf, mul[j], out=buf)
            for value in (np.minimum.reduceat(buf, starts), np.maximum.reduceat(buf, starts)):
                acc = mix64(acc * U64(0xC2B2AE3D27D4EB4F) + value)
        keys[:, band] = acc
    return keys


def signatures(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, k1, k2 (set key), keys (bands; null when the set is empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_parts(string_column(batch, "text"))
            for i, j in doc_blocks(offsets, BLOCK):
                part = offsets[i:j + 1]
                u, bounds = shingle_hashes(data[part[0]:part[-1]], part - part[0], k)
                size = np.diff(bounds)
                some = np.flatnonzero(size)
                k1, k2 = np.zeros(j - i, U64), np.zeros(j - i, U64)
                keys = np.zeros((0, bands), U64)
                if len(some):
                    cut = np.append(bounds[some], bounds[-1])
                    k1[some] = np.add.reduceat(mix64(u ^ U64(0x1234567)), cut[:-1])
                    k2[some] = np.add.reduceat(mix64(u ^ U64(0xABCDEF98765)), cut[:-1])
                    keys = band_keys(u, cut, bands, rows)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum((size > 0) * bands)]), pa.int32()),
                                                 to_i64(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i).cast(pa.int64()), to_i64(size), to_i64(k1), to_i64(k2), lists],
                    names=["doc_id", "n_shingles", "k1", "k2", "keys"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, k1 long, k2 long, keys array<long>")


def _confirm(texts: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full shingle sets have 100 * intersection >= percent * union.

    Rows of one ``a`` arrive in order, its own text first; a task keeps that one
    set and streams the others past it. ``salt`` spreads an ``a`` with many partners.
    """
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(64)).cast("int"))
    need = salted.select("a", "salt", F.col("b").alias("doc_id"), F.lit(1).alias("role")).unionByName(
        salted.select("a", "salt", F.col("a").alias("doc_id"), F.lit(0).alias("role")).distinct())
    rows = need.join(texts, "doc_id").select("a", "salt", "role", "doc_id", "text")
    ordered = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "role", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, own = None, []
        for batch in batches:
            data, offsets = utf8_parts(string_column(batch, "text"))
            a, salt, role, doc = (batch.column(x).to_numpy(zero_copy_only=False) for x in range(4))
            links = []
            for i, j in doc_blocks(offsets, BLOCK):
                part = offsets[i:j + 1]
                u, bounds = shingle_hashes(data[part[0]:part[-1]], part - part[0], k)
                for x in range(i, j):
                    s = u[bounds[x - i]:bounds[x - i + 1]]
                    if (a[x], salt[x]) != current:
                        current, own = (a[x], salt[x]), []
                    if role[x] == 0:
                        own.append(s.copy())
                        continue
                    for o in own:
                        lo, hi = sorted((len(o), len(s)))
                        if 100 * lo < percent * hi or not lo:
                            continue
                        at = np.searchsorted(o, s)
                        both = int((o[np.minimum(at, len(o) - 1)] == s).sum())
                        if 100 * both >= percent * (len(o) + len(s) - both):
                            links.append((a[x], doc[x]))
                            break
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([int(x[t]) for x in links], pa.int64()) for t in (0, 1)], names=["a", "b"])

    return ordered.mapInArrow(run, "a long, b long")


def _outsiders(texts: DataFrame, apart: DataFrame, k: int, percent: int) -> DataFrame:
    """Links between components inside one bucket (rows key, node, component, main, chunks).

    Every such pair has a class outside the bucket's main component. These outsiders are cut into chunks;
    a task holds the inverted shingle lists of one chunk and streams the bucket's classes past it, so the rows
    are the bucket's classes once per chunk, never its pairs.
    """
    own = F.pmod(F.xxhash64("node", F.lit(99)), "chunks").cast("int")
    rows = apart.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn(
        "role", F.when((F.col("component") != F.col("main")) & (own == F.col("chunk")), 0).otherwise(1))
    rows = rows.select("key", "chunk", "role", F.col("node").alias("doc_id"), "component").join(texts, "doc_id").select(
        "key", "chunk", "role", "doc_id", "component", "text")
    ordered = rows.repartition("key", "chunk").sortWithinPartitions("key", "chunk", "role", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, index, links = None, [], None, []

        def meet(doc: int, comp: int, s: np.ndarray) -> None:
            hashes, owners, ids, comps, sizes = index
            lo, hi = np.searchsorted(hashes, s), np.searchsorted(hashes, s, side="right")
            n = hi - lo
            hit = owners[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            both = np.bincount(hit, minlength=len(ids))
            for x in np.flatnonzero((100 * both >= percent * (sizes + len(s) - both)) & (comps != comp)):
                links.append((int(ids[x]), doc))

        def close() -> None:
            nonlocal index
            if held and index is None:
                everything = np.concatenate([h[2] for h in held])
                owner = np.repeat(np.arange(len(held)), [len(h[2]) for h in held])
                order = np.argsort(everything, kind="stable")
                index = (everything[order], owner[order], np.array([h[0] for h in held]), np.array([h[1] for h in held]),
                         np.array([len(h[2]) for h in held]))
                for h in held:
                    meet(*h)

        for batch in batches:
            data, offsets = utf8_parts(string_column(batch, "text"))
            key, chunk, role, doc, comp = (batch.column(x).to_numpy(zero_copy_only=False) for x in range(5))
            for i, j in doc_blocks(offsets, BLOCK):
                part = offsets[i:j + 1]
                u, bounds = shingle_hashes(data[part[0]:part[-1]], part - part[0], k)
                for x in range(i, j):
                    if (key[x], chunk[x]) != now:
                        close()
                        now, held, index = (key[x], chunk[x]), [], None
                    s = u[bounds[x - i]:bounds[x - i + 1]]
                    if role[x] == 0:
                        held.append((int(doc[x]), int(comp[x]), s.copy()))
                    elif held:
                        close()
                        meet(int(doc[x]), int(comp[x]), s)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([y[t] for y in links], pa.int64()) for t in (0, 1)], names=["a", "b"])
                links.clear()
        close()
        if links:
            yield pa.RecordBatch.from_arrays([pa.array([y[t] for y in links], pa.int64()) for t in (0, 1)], names=["a", "b"])

    return ordered.mapInArrow(run, "a long, b long").filter("a != b").distinct()


def components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """(node, component) of every node with an edge, by alternating large and small stars.

    Each half step is a grouped minimum and a join, so a node with many
    neighbours is reduced map-side and split by skewed joins; every round is
    written to the shared folder.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        if large:
            return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        near = both.filter("v < u").join(low, "u")
        return (near.select(F.col("v").alias("u"), F.col("m").alias("v"))
                .unionByName(near.select("u", F.col("m").alias("v"))).filter("u != v").distinct())

    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "edges")
    seen = None
    for _ in range(limit):
        e = written(star(star(e, True), False), "edges")
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if seen == (now["n"], now["h"]):
            return e.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
        seen = (now["n"], now["h"])
    raise RuntimeError(f"components did not settle in {limit} rounds")


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, n_links (confirmed links of its class)."""
    sig = written(signatures(docs, shingle_words, bands, rows), "signatures")
    live = sig.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = live.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    member = written(live.select("doc_id", "k1", "k2").join(classes, ["k1", "k2"]).select("doc_id", "rep", "k1", "k2").distinct(), "classes")
    # the set key of a class comes with the row of its smallest document
    reps = live.join(member.filter("doc_id = rep").select("doc_id", "k1", "k2"), ["doc_id", "k1", "k2"]).dropDuplicates(["doc_id", "k1", "k2"])
    meet = reps.select(F.explode("keys").alias("key"), F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"))
    shared = meet.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi").select("key")
    bucket = written(meet.join(shared, "key"), "buckets")
    nodes = bucket.select(F.col("node").alias("doc_id")).distinct()
    texts = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        nodes, "doc_id", "left_semi"), "texts")
    # rows that repeat an id and a text are one set to compare; without repeated ids nothing is shuffled for it
    often = written(live.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "often")
    if not often.isEmpty():
        texts = written(texts.join(often, "doc_id", "left_anti").unionByName(
            texts.join(often, "doc_id", "left_semi").withColumn("h", F.sha2("text", 256)).dropDuplicates(["doc_id", "h"]).drop("h")), "texts")
    same_id = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a != b").select("a", "b")
    repeated = member.join(same_id.select(F.col("a").alias("low"), "b"), member.rep == F.col("b")).select(F.col("low").alias("a"), F.col("rep").alias("b")).distinct()
    similar = f"100 * least(x.n, y.n) >= {int(percent)} * greatest(x.n, y.n)"  # sets of unlike size cannot be linked
    # a few hubs per bucket, picked by hash so that one cluster has few; picks may coincide, so only a bucket of two classes is sure to be met in full
    pick = [F.min_by(F.struct("node", "n"), F.xxhash64("node", F.lit(h))) for h in range(HUBS)]
    hubs = bucket.groupBy("key").agg(F.array_distinct(F.array(*pick)).alias("hubs")).select("key", F.explode("hubs").alias("x")).select("key", "x.*")
    x, y = hubs.alias("x"), bucket.alias("y")
    meetings = written(x.join(y, F.expr(f"x.key = y.key AND x.node != y.node AND {similar}")).select(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct(), "meetings")
    links = written(same_id.unionByName(repeated).unionByName(_confirm(texts, meetings, shingle_words, percent)).distinct(), "links")
    comp = written(components(links), "components")
    at = bucket.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = at.groupBy("key", "component").agg(F.count("*").alias("c")).groupBy("key").agg(
        F.count("*").alias("parts"), F.sum("c").alias("c"), F.max(F.struct("c", "component")).alias("main")).filter(
        (F.col("parts") > 1) & (F.col("c") > 2)).select(
        "key", F.col("main.component").alias("main"), F.ceil((F.col("c") - F.col("main.c")) / OUTSIDERS).cast("int").alias("chunks"))
    more = written(_outsiders(texts, at.join(split, "key"), shingle_words, percent), "links2")
    if not more.isEmpty():
        links = written(links.unionByName(more).distinct(), "links")
        comp = written(components(links), "components")
    degree = links.select(F.col("a").alias("rep")).unionByName(links.select(F.col("b").alias("rep"))).groupBy("rep").agg(F.count("*").alias("n_links"))
    of = member.join(comp.withColumnRenamed("node", "rep"), "rep", "left").join(degree, "rep", "left").groupBy("doc_id").agg(
        F.min(F.coalesce("component", "rep")).alias("component_id"), F.max(F.coalesce("n_links", F.lit(0))).alias("n_links"))
    return (sig.select("doc_id", "n_shingles").join(of, "doc_id", "left")
            .withColumn("component_id", F.coalesce("component_id", "doc_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
            .select("doc_id", "n_shingles", "component_id", "kept", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")))
