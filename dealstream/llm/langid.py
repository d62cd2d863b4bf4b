"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts (language, bucket) over every row of the training fold are
summed by Spark; the log-probability matrix (languages x buckets, so bounded by
``buckets`` and the number of labels, not by the corpus) is broadcast; whole
texts are scored in batches: n-gram hashes, a gather of matrix rows, and one
segmented sum per document.

Text is lower-cased, letters kept as they are, everything else one gap symbol;
n-grams of 2 and 3 symbols. A null text, or one without a letter, is ``und``
with score 0. With no training rows every prediction is ``und``. Ties go to the
label that sorts first. Extra columns are ignored, rows are never merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, doc_blocks, mix64, string_column, utf8_parts

BUCKETS, BLOCK, SMOOTH = 1 << 15, 1 << 20, 0.1
_FOLDED = 0x3000
_TABLE: list[np.ndarray] = []


def _symbols(chars: np.ndarray) -> np.ndarray:
    """Code points to lower-case letters, 0 for anything that is no letter."""
    if not _TABLE:
        fold = np.zeros(_FOLDED, np.uint32)
        for c in range(_FOLDED):
            low = chr(c).lower()
            fold[c] = ord(low[0]) if low[0].isalpha() else 0
        _TABLE.append(fold)
    out = _TABLE[0][np.minimum(chars, _FOLDED - 1)]
    high = chars >= _FOLDED
    if high.any():
        present, at = np.unique(chars[high], return_inverse=True)
        out[high] = np.array([ord(chr(c).lower()[0]) if chr(c).isalpha() else 0 for c in present.tolist()], np.uint32)[at]
    return out


def ngrams(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every n-gram in document order, offsets per document, letters per document)."""
    chars = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    off = lead[offsets]
    sym = _symbols(chars)
    letters = np.concatenate([[0], np.cumsum(sym > 0)])
    count = letters[off[1:]] - letters[off[:-1]]
    # one gap symbol before every document and for every stretch of other characters
    keep = np.ones(len(sym), bool)
    keep[1:] = (sym[1:] > 0) | (sym[:-1] > 0)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(off))[keep]
    kept = sym[keep]
    s = np.insert(kept, np.searchsorted(owner, np.arange(len(offsets))), 0).astype(U64)
    d = np.insert(owner, np.searchsorted(owner, np.arange(len(offsets))), np.arange(len(offsets)))
    if len(s) < 3:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64), count
    two = s[:-1] * U64(0x9E3779B97F4A7C15) + s[1:] * U64(0xC2B2AE3D27D4EB4F)
    three = two[:-1] * U64(0x165667B19E3779F9) + s[2:]
    grams = np.empty(2 * len(three), U64)
    grams[0::2], grams[1::2] = two[:-1], three
    same = d[2:] == d[:-2]
    grams = (mix64(grams) >> U64(64 - int(buckets - 1).bit_length())).astype(np.int64)
    use = np.repeat(same, 2)
    whose = np.repeat(d[:-2], 2)[use]
    return grams[use], np.searchsorted(whose, np.arange(len(offsets))), count


def train_counts(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(lang, bucket, n) over all rows (lang, text); bucket -1 counts documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            col = string_column(batch, "text")
            langs = np.array(batch.column(0).to_pylist(), object)
            data, offsets = utf8_parts(col)
            for i, j in doc_blocks(offsets, BLOCK):
                part = offsets[i:j + 1]
                grams, off, _ = ngrams(data[part[0]:part[-1]], part - part[0], buckets)
                names, which = np.unique(langs[i:j].astype(str), return_inverse=True)
                per = np.bincount(np.repeat(which, np.diff(off)) * buckets + grams, minlength=len(names) * buckets).reshape(len(names), buckets)
                docs = np.bincount(which, minlength=len(names))
                for x, name in enumerate(names.tolist()):
                    mine = total.setdefault(name, np.zeros(buckets + 1, np.int64))
                    mine[:-1] += per[x]
                    mine[-1] += docs[x]
        for name, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(np.where(at == buckets, -1, at), pa.int32()),
                                              pa.array(n[at], pa.int64())], names=["lang", "bucket", "n"])

    return rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


LANGUAGES = 1024  # 128 MB of log-probabilities


def identify(docs: DataFrame, train: Column, buckets: int = BUCKETS, smooth: float = SMOOTH) -> DataFrame:
    """doc_id, lang_pred, score for every row; ``train`` marks the rows that may be learned from."""
    counted = train_counts(docs.filter(train & F.col("lang").isNotNull() & F.col("text").isNotNull()), buckets).toArrow()
    langs = sorted(set(counted.column("lang").to_pylist()))
    if len(langs) > LANGUAGES:
        raise ValueError(f"{len(langs)} languages; the matrix is broadcast and made for at most {LANGUAGES}")
    matrix = np.zeros((buckets, len(langs)), np.float64)
    prior = np.zeros(len(langs))
    if langs:
        where = np.searchsorted(np.array(langs, object), np.array(counted.column("lang").to_pylist(), object))
        bucket, n = counted.column("bucket").to_numpy(), counted.column("n").to_numpy()
        grams = bucket >= 0
        matrix[bucket[grams], where[grams]] = n[grams]
        prior[where[~grams]] = n[~grams]
        matrix = np.log((matrix + smooth) / (matrix + smooth).sum(0))
        prior = np.log(prior / prior.sum())
    model = docs.sparkSession.sparkContext.broadcast((langs, matrix.astype(np.float32), prior))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, matrix, prior = model.value
        names = np.array([*langs, "und"], object)
        for batch in batches:
            data, offsets = utf8_parts(string_column(batch, "text"))
            for i, j in doc_blocks(offsets, BLOCK):
                part = offsets[i:j + 1]
                grams, off, letters = ngrams(data[part[0]:part[-1]], part - part[0], buckets)
                best, score = np.full(j - i, len(langs)), np.zeros(j - i)
                some = np.flatnonzero((letters > 0) & (np.diff(off) > 0))
                if langs and len(some):
                    logp = np.add.reduceat(matrix[grams], off[:-1][some], axis=0, dtype=np.float64) + prior
                    top = logp.argmax(1)
                    best[some] = top
                    score[some] = 1 / np.exp(logp - logp.max(1, keepdims=True)).sum(1)
                lone = np.flatnonzero((letters > 0) & (np.diff(off) == 0))
                if langs and len(lone):  # a letter but no n-gram: the prior alone
                    best[lone], score[lone] = prior.argmax(), np.exp(prior.max())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(names[best].tolist(), pa.string()), pa.array(score, pa.float64())],
                    names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double")
