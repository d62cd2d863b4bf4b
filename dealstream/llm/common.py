"""Shared helpers: written tables in the shared folder, fold rules, Arrow text as bytes, vectorised hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealstream.session import unique_dir

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write once into the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = unique_dir(spark, "llm", name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def rebuilt(kind: type, state: dict):
    """An object of ``kind`` from its ``vars``. Broadcasts carry these plain values: unlike task
    functions they are pickled by reference, and executors hold no copy of the package."""
    out = object.__new__(kind)
    vars(out).update(state)
    return out


def crc_mod(column: str, m: int) -> Column:
    """crc32(column as text) mod m; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % F.lit(m)


def string_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text column with nulls as empty strings."""
    col = batch.column(batch.schema.get_field_index(name))
    return pc.fill_null(col, "") if col.null_count else col


def utf8_parts(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without nulls; document i is bytes[offsets[i]:offsets[i+1]]."""
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - off[0]


def doc_blocks(offsets: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Cut documents into runs [i, j) of about ``limit`` bytes; one longer document is a run of its own."""
    out, i, n = [], 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        out.append((i, j))
        i = j
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising bit mixer on uint64 arrays (wraps modulo 2**64)."""
    x = x ^ (x >> U64(31))
    x *= U64(0x9E3779B97F4A7C15)
    x ^= x >> U64(29)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_INV = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, (n + 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        out = []
        for base in (_BASE, _INV):
            a = np.full(size, base & (2**64 - 1), U64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        _POWERS[size] = tuple(out)
    p, q = _POWERS[size]
    return p, q


class SpanHash:
    """Polynomial hash of any span of a byte array, from one prefix sum."""

    def __init__(self, data: np.ndarray):
        p, self.inv = _powers(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * p[:len(data)], out=self.prefix[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.prefix[ends] - self.prefix[starts]) * self.inv[starts]
        return mix64(h + (ends - starts).astype(U64) * U64(0x9FB21C651E98DF25))


#: ASCII upper case to lower case, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: \x20 and \x09-\x0D separate words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(sep: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words are maximal runs of bytes not in ``sep``, never across documents.

    Returns starts, ends, and per document the index of its first word (with a closing total).
    """
    n = len(sep)
    word = ~sep
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    start = word.copy()
    start[1:] &= sep[:-1] | first[1:n]
    end = word.copy()
    end[:-1] &= sep[1:] | first[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def to_i64(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == U64 else x.astype(np.int64))
