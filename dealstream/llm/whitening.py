"""Embedding whitening from an exact scatter matrix, counted on bit slices.

Every entry c becomes the integer x = floor(1024 * c) + 100000. A task shifts x by
its dimension's least value, cuts the rest into bit planes and packs each plane
across rows into 64-bit words. The number of rows where plane p of dimension i and
plane q of dimension j are both set is the popcount of an AND; weighted by
2**(p + q) these counts add up to the exact cross-products, which Spark sums over
tasks. The driver centres them as integers, n * sum(xy) - sum(x) * sum(y), divides
once, and takes the eigenvectors of that d x d matrix (d is the vectors' length).

What is spread: the range of each dimension, the counts, the projection and the
check of its covariance are one narrow pass each; only d x d integers a task are
shuffled and only d x d reach the driver. A task holds ``CHUNK`` entries.

Defined results: vectors that are null or hold null or non-finite entries take no
part, nor do those of another length than most (of equally common lengths the
longer counts); rows that repeat a vec_id, or have none, are rows of their own;
x beyond +-2**61 is held at that; a component without variance (below 1e-12 of
the trace) is not returned, as nothing can be whitened there, so one vector alone
gives no rows; ``deviation`` is exact up to 38 digits and null beyond; an empty
table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
CHUNK = 1 << 21  # entries sliced at once
EDGE = 1 << 61
SECTION = 24  # bits of weight that are added up in one integer
FLAT = 1e-12  # share of the trace below which a component has no variance


def usable(rows: DataFrame) -> tuple[DataFrame, int]:
    """vec_id, v (array of double) of the vectors that take part, and their length."""
    v = F.col("embedding").cast("array<double>")
    d = rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    width = d.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    n = width["n"] if width else 0
    return d.filter(F.size("v") == n), n


def integers(column: pa.Array, width: int) -> np.ndarray:
    """The rows' integers x, one row each; ``column`` is a list column whose lists all have ``width`` entries."""
    c = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return np.clip(np.floor(SCALE * c) + SHIFT, -EDGE, EDGE).astype(np.int64)


def ranges(rows: DataFrame, width: int) -> tuple[int, list[int], list[int]]:
    """Number of rows, and least and greatest x of every dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, np.full(width, EDGE), np.full(width, -EDGE)
        for batch in batches:
            if batch.num_rows:
                x = integers(batch.column(0), width)
                n, low, high = n + len(x), np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(np.full(width, n), pa.int64()), pa.array(low), pa.array(high)],
                                             names=["dim", "n", "low", "high"])

    got = rows.select("v").mapInArrow(run, "dim int, n long, low long, high long").groupBy("dim").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("dim").collect()
    return (got[0]["n"], [r["low"] for r in got], [r["high"] for r in got]) if got else (0, [], [])


def slices(y: np.ndarray, bits: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of the shifted integers, packed across rows into words: (planes, dimension of each, its bit)."""
    rows = -(-len(y) // 64) * 64
    found, dims, place = [], [], []
    for p in range(max(bits, default=0)):
        here = np.flatnonzero(np.array(bits) > p)
        plane = np.zeros((len(here), rows), np.uint8)
        plane[:, :len(y)] = ((y[:, here] >> p) & 1).T
        found.append(np.packbits(plane, axis=1).view(np.uint64))
        dims.append(here)
        place.append(np.full(len(here), p))
    if not found:
        return np.zeros((0, rows // 64), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    dim, bit = np.concatenate(dims), np.concatenate(place)
    order = np.lexsort((bit, dim))
    return np.concatenate(found)[order], dim[order], bit[order]


def add_products(total: np.ndarray, planes: np.ndarray, dim: np.ndarray, bit: np.ndarray) -> None:
    """Add weighted AND-popcounts to ``total`` (section, dimension, dimension); only places with i <= j are filled."""
    first = np.flatnonzero(np.r_[True, dim[1:] != dim[:-1]]) if len(dim) else np.zeros(0, np.int64)
    for a in range(len(planes)):
        both = np.bitwise_count(planes[a:] & planes[a]).sum(1, dtype=np.int64)
        i = dim[a]
        both[1:][dim[a + 1:] == i] *= 2  # two planes of one dimension meet in both orders
        weight = bit[a:] + bit[a]
        starts = np.r_[0, first[first > a] - a]
        for section in range(int(weight.min()) // SECTION, int(weight.max()) // SECTION + 1):
            here = weight // SECTION == section
            total[section, i, dim[a + starts]] += np.add.reduceat(np.where(here, both << (weight % SECTION), 0), starts)


def scatter(rows: DataFrame, width: int, low: list[int], bits: list[int]) -> tuple[list[int], dict[tuple[int, int], int]]:
    """Exact sums and cross-products (i <= j) of the shifted integers over all rows."""
    size = max(64, CHUNK // width)
    sections = max(1, -(-2 * max(bits) // SECTION))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums, held, n = np.zeros((sections, width, width), np.int64), np.zeros((2, width), np.int64), [], 0

        def count() -> None:
            y = np.concatenate(held) - np.array(low)
            add_products(total, *slices(y, bits))
            sums[0] += (y & 0xFFFFFFFF).sum(0)
            sums[1] += (y >> 32).sum(0)

        for batch in batches:
            x = integers(batch.column(0), width)
            while len(x):
                held.append(x[:size - n])
                n, x = n + len(held[-1]), x[len(held[-1]):]
                if n == size:
                    count()
                    held, n = [], 0
        if n:
            count()
        section, i, j = np.nonzero(total)
        half, k = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[section, half], pa.int32()), pa.array(np.r_[i, np.full(len(k), -1)], pa.int32()),
                                          pa.array(np.r_[j, k], pa.int32()), pa.array(np.r_[total[section, i, j], sums[half, k]], pa.int64())],
                                         names=["section", "i", "j", "n"])

    found = rows.select("v").mapInArrow(run, "section int, i int, j int, n long").groupBy("section", "i", "j").agg(
        F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()
    sums, products = [0] * width, {}
    for r in found:
        if r["i"] < 0:
            sums[r["j"]] += int(r["n"]) << (32 * r["section"])
        else:
            products[r["i"], r["j"]] = products.get((r["i"], r["j"]), 0) + (int(r["n"]) << (SECTION * r["section"]))
    return sums, products


def components(n: int, sums: list[int], products: dict[tuple[int, int], int], keep: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues (falling), unit eigenvectors as columns, and the trace, of the covariance centred as integers."""
    d = len(sums)
    v = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            v[i, j] = v[j, i] = (n * products.get((i, j), 0) - sums[i] * sums[j]) / (n * n)
    e, w = np.linalg.eigh(v)
    e, w, trace = e[::-1], w[:, ::-1], float(np.trace(v))
    some = int(np.sum(e[:keep] > FLAT * trace)) if trace > 0 else 0
    w = w[:, :some]
    sign = np.sign(w[np.abs(w).argmax(0), np.arange(some)]) if some else np.zeros(0)
    return e[:some], w * sign, trace


def project(rows: DataFrame, width: int, n: int, low: list[int], high: list[int], sums: list[int], e: np.ndarray, w: np.ndarray) -> DataFrame:
    """vec_id, deviation, w (the whitened components in order) of every row."""
    reach = max(n * (h - l) for l, h in zip(low, high))
    narrow = reach < 1 << 62 and width * reach * reach < 1 << 63

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.int64 if narrow else object
        base, total = np.array(low, dtype=np.int64), np.array(sums, dtype=kind)
        for batch in batches:
            y = (integers(batch.column(1), width) - base).astype(kind)
            off = n * y - total
            square = (off * off).sum(1)
            if narrow:
                deviation = pa.array(square, pa.int64()).cast(pa.decimal128(38, 0), safe=False)
            else:
                deviation = pa.array([Decimal(int(s)) if s < 10 ** 38 else None for s in square], pa.decimal128(38, 0))
            white = (off / n).astype(np.float64) @ w / np.sqrt(e)
            yield pa.RecordBatch.from_arrays([batch.column(0), deviation, pa.ListArray.from_arrays(
                np.arange(0, white.size + 1, len(e), dtype=np.int32), white.ravel())], names=["vec_id", "deviation", "w"])

    return rows.select("vec_id", "v").mapInArrow(run, "vec_id long, deviation decimal(38,0), w array<double>")


def whiten(rows: DataFrame, keep: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error for every row and component."""
    used, width = usable(rows)
    n, low, high = ranges(used, width) if width else (0, [], [])
    bits = [(h - l).bit_length() for l, h in zip(low, high)]
    e = np.zeros(0)
    if n:
        sums, products = scatter(used, width, low, bits)
        e, w, trace = components(n, sums, products, keep)
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if not len(e):
        return rows.sparkSession.createDataFrame([], schema)
    white = written(project(used, width, n, low, high, sums, e, w), "whitened")
    pairs = [(i, j) for i in range(len(e)) for j in range(i, len(e))]
    cov = white.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(cov[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    explained = F.array(*[F.lit(float(x / trace)) for x in e])
    return white.select("vec_id", "deviation", F.posexplode("w").alias("_at", "whitened")).select(
        "vec_id", (F.col("_at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("_at")).alias("explained"), F.lit(float(error)).alias("identity_error"))
