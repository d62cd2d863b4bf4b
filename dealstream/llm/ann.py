"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut in two halves, each half quantised by its own k-means; the pair
of nearest centroids is a vector's cell. A query walks the cells in order of the
summed distances of its two halves to their centroids with a heap, until the
cells it has met hold ``candidates`` vectors or ``share`` of all, whichever is
more, and all their entries are reranked by exact distance. The share is the least
that meets ``recall`` of the neighbours inside the training sample: about 0.4 on
vectors without any cluster structure (uniform on a sphere in 64 dimensions), a few
hundredths on clustered ones.

The codebooks are fitted on a bounded sample (``train_rows``); every row is
indexed. The driver holds codebooks and cell sizes only (cells = centroids
squared, whatever the corpus). Cells are packed into blocks of about ``block``
vectors, and a cell that holds a third of all vectors becomes many blocks;
queries on a block come in chunks alike. Each block gives its own nearest k per
query, which one small aggregation merges.

Defined results: vectors that are null, zero, of another length than most, or
with null or non-finite components take no part; rows that repeat a vec_id are
candidates of their own, but not of the query with that id (asked twice, the
smaller vector is the query); ties go to the
smaller vec_id; fewer than k candidates are all returned; empty tables give
no rows. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix64, rebuilt, written

CENTROIDS, TRAIN_ROWS, CANDIDATES, RECALL, BLOCK, K = 64, 8192, 640, 0.95, 2048, 10


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, v (array of double) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    d = rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("v", lambda x: x != 0))
    width = d.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return d.filter(F.size("v") == (width["n"] if width else 0))


def kmeans(x: np.ndarray, k: int, rounds: int = 15, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = ((c * c).sum(1) - 2 * x @ c.T).argmin(1)
        size = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[size > 0] = total[size > 0] / size[size > 0, None]
    return c


class MultiIndex:
    """Two codebooks and the number of vectors in every cell."""

    def __init__(self, sample: np.ndarray, centroids: int):
        self.half = (sample.shape[1] + 1) // 2
        self.books = [kmeans(sample[:, :self.half], centroids), kmeans(sample[:, self.half:], centroids)]
        self.size = np.zeros(len(self.books[0]) * len(self.books[1]), np.int64)

    def cut(self, block: int) -> None:
        """Blocks of about ``block`` vectors: neighbouring small cells share one, a large cell has several."""
        self.parts = np.maximum(1, -(-self.size // block))
        small = self.parts == 1
        self.first = np.zeros(len(self.size), np.int64)
        at = held = 0
        for c in range(len(self.size)):
            if small[c] and held + self.size[c] <= block:
                self.first[c], held = at, held + int(self.size[c])
            else:
                at += 1
                self.first[c], held = at, int(self.size[c])
                if not small[c]:
                    at += int(self.parts[c])
                    held = 0

    def blocks_of(self, cells: list[int]) -> list[tuple[int, list[int]]]:
        """(block, the given cells in it) for every block they touch."""
        out: dict[int, list[int]] = {}
        for c in cells:
            for b in range(int(self.first[c]), int(self.first[c] + self.parts[c])):
                out.setdefault(b, []).append(c)
        return sorted(out.items())

    def distances(self, v: np.ndarray) -> list[np.ndarray]:
        return [((b * b).sum(1) - 2 * x @ b.T + (x * x).sum(1)[:, None]) for b, x in zip(self.books, (v[:, :self.half], v[:, self.half:]))]

    def cell(self, v: np.ndarray) -> np.ndarray:
        a, b = self.distances(v)
        return a.argmin(1) * len(self.books[1]) + b.argmin(1)

    def probe(self, a: np.ndarray, b: np.ndarray, candidates: int) -> list[int]:
        """Non-empty cells by summed distance, best first, until they hold ``candidates`` vectors."""
        i, j = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        heap, seen, out, held = [(a[i[0]] + b[j[0]], 0, 0)], {(0, 0)}, [], 0
        while heap and held < candidates:
            _, x, y = heapq.heappop(heap)
            cell = int(i[x]) * len(b) + int(j[y])
            if self.size[cell]:
                out.append(cell)
                held += int(self.size[cell])
            for p, q in ((x + 1, y), (x, y + 1)):
                if p < len(i) and q < len(j) and (p, q) not in seen:
                    seen.add((p, q))
                    heapq.heappush(heap, (a[i[p]] + b[j[q]], p, q))
        return out


def needed_share(index: MultiIndex, sample: np.ndarray, k: int, recall: float, queries: int = 256) -> float:
    """The share of all vectors that must be visited so that ``recall`` of the k nearest are met, measured inside the sample.

    Neighbours in the whole table are nearer than those in the sample and so lie in nearer cells: the share is on the safe side."""
    q = sample[:: max(1, len(sample) // queries)][:queries]
    cell = index.cell(sample)
    size = np.bincount(cell, minlength=len(index.size))
    a, b = index.distances(q)
    d = (q * q).sum(1)[:, None] - 2 * q @ sample.T + (sample * sample).sum(1)
    near = np.argpartition(d, min(k, len(sample) - 1), axis=1)[:, :k + 1]
    need = []
    for x in range(len(q)):
        order = np.argsort((a[x][:, None] + b[x][None, :]).ravel(), kind="stable")
        met = np.empty(len(order))
        met[order] = np.cumsum(size[order])
        mine = near[x][np.argsort(d[x][near[x]], kind="stable")][1:]  # without itself
        need.append(met[cell[mine]])
    return float(min(1.0, np.quantile(np.concatenate(need), recall) / len(sample))) if need and len(sample) > 1 else 1.0


def _matrix(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def nearest(rows: DataFrame, is_query: Column, k: int = K, centroids: int = CENTROIDS, candidates: int = CANDIDATES,
            share: float | None = None, recall: float = RECALL, train_rows: int = TRAIN_ROWS, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) of each query's k nearest found.

    ``share`` of all vectors are visited for a query, by default the least that meets ``recall`` in the sample."""
    spark = rows.sparkSession
    data = usable(rows)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    total = data.count()
    if not total:
        return empty
    draw = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 30)) / (1 << 30)
    sample = data.filter(draw < 1.2 * train_rows / total).limit(2 * train_rows).toArrow().sort_by("vec_id")
    if not sample.num_rows:
        sample = data.orderBy("vec_id").limit(train_rows).toArrow()
    points = _matrix(sample.column("v").combine_chunks())
    index = MultiIndex(points, centroids)
    share = needed_share(index, points, k, recall) if share is None else share
    books = spark.sparkContext.broadcast(dict(vars(index)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = rebuilt(MultiIndex, books.value)
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(index.cell(_matrix(b.column(1))).astype(np.int32))],
                                                 names=["vec_id", "v", "cell"])

    entries = written(data.mapInArrow(assign, "vec_id long, v array<double>, cell int"), "entries")
    for r in entries.groupBy("cell").count().collect():
        index.size[r["cell"]] = r["count"]
    index.cut(block)
    sized = spark.sparkContext.broadcast(dict(vars(index)))
    wanted = max(candidates, int(share * total))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = rebuilt(MultiIndex, sized.value)
        for b in batches:
            cell = b.column(2).to_numpy()
            spread = (mix64(b.column(0).to_numpy().view(np.uint64)) >> np.uint64(33)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(index.first[cell] + spread % index.parts[cell])],
                                             names=["vec_id", "v", "cell", "part"])

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = rebuilt(MultiIndex, sized.value)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                da, db = index.distances(_matrix(part.column(1)))
                rows = []
                for x in range(part.num_rows):
                    for at, cells in index.blocks_of(index.probe(da[x], db[x], wanted)):
                        rows.append((x, at, cells))
                which = pa.array([r[0] for r in rows], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(which), part.column(1).take(which), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.list_(pa.int32()))], names=["query_id", "v", "part", "cells"])

    asked = data.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))  # an id asked twice is one query
    # by count, not by bytes: a query is few bytes but much probing
    asked = asked.repartition(max(1, -(-data.filter(is_query).count() // 64)))
    met = written(asked.mapInArrow(probes, "query_id long, v array<double>, part long, cells array<int>"), "probes")
    # queries on a block are cut into chunks of about ``block`` too; every chunk meets the whole block
    grid = written(met.groupBy("part").agg(F.ceil(F.count("*") / block).cast("int").alias("chunks")), "grid")
    left = written(entries.mapInArrow(place, "vec_id long, v array<double>, cell int, part long"), "placed").join(grid, "part").select(
        "part", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "vec_id", "v", "cell")
    right = met.join(grid, "part").select(
        "part", F.pmod(F.xxhash64("query_id"), "chunks").cast("int").alias("chunk"), "query_id", "v", "cells")
    key = ["part", "chunk"]

    def rerank(_, e: pa.Table, q: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if e.num_rows and q.num_rows:
            x, y = _matrix(e.column("v").combine_chunks()), _matrix(q.column("v").combine_chunks())
            ids, of, cell = e.column("vec_id").to_numpy(), q.column("query_id").to_numpy(), e.column("cell").to_numpy()
            for r, cells in enumerate(q.column("cells").to_pylist()):
                other = np.flatnonzero(np.isin(cell, cells) & (ids != of[r]))
                d = np.sqrt(((x[other] - y[r]) ** 2).sum(1))
                top = np.lexsort((ids[other], d))[:k]
                out["query_id"] += [of[r]] * len(top)
                out["vec_id"] += ids[other][top].tolist()
                out["score"] += d[top].tolist()
        return pa.table({"query_id": pa.array(out["query_id"], pa.int64()), "vec_id": pa.array(out["vec_id"], pa.int64()),
                         "score": pa.array(out["score"], pa.float64())})

    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(rerank, "query_id long, vec_id long, score double")
    # a query gets at most k rows from each block it met
    best = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id"))), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.vec_id").alias("vec_id"), F.col("col.score").alias("score"))
