"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A document is the bag of hashed character n-grams of its words and the words
themselves. Their embedding vectors are averaged and a two-class softmax reads
the average; embeddings and softmax are trained together by AdaGrad in one
task, on a bounded sample of labelled rows of the training fold (at most about
``toxic_rows`` and ``clean_rows``, picked by a hash of the id). A misspelling
never seen shares n-gram vectors with its seen form; digits and signs between
letters (``id1ot``, ``st*pid``) stay in the word, read as the letter they look like.

As the softmax is linear in the average, a trained n-gram contributes one
number; whole texts are scored in one narrow pass with that table broadcast
(``buckets`` floats, whatever the corpus). A fifth of the sample, weighted to
the labels' own shares, fits the slope and offset that put the best decision at
score 0.7.

Defined results: null, empty or wordless text scores as padding alone; an empty or one-sided training set scores 0 everywhere;
conflicting labels of one id count as toxic; rows that repeat a doc_id are
scored one by one. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, SpanHash, doc_blocks, string_column, utf8_parts

BUCKETS, DIM, EPOCHS, TOXIC_ROWS, CLEAN_ROWS, GRAMS = 1 << 18, 8, 12, 2000, 4000, (3, 4, 5)
#: Weight of one trained padding vector in every bag, so that a few odd n-grams cannot decide a very short text.
PAD = 50
THRESHOLD = 0.7
#: Digits and signs between letters that stand for a letter; others separate words.
_LIKE = {b"0": b"o", b"1": b"i", b"3": b"e", b"4": b"a", b"5": b"s", b"7": b"t", b"@": b"a", b"$": b"s", b"!": b"i", b"*": b"_"}
_INSIDE = re.compile(rb"(?<=[a-z\x80-\xff])[013457@$!*](?=[a-z\x80-\xff])")
_SPLIT = bytes(32 if x < 128 and not chr(x).isalpha() and x != ord("_") else x for x in range(256))


def words(text: str | None) -> list[bytes]:
    if not text:
        return []
    raw = text.lower().replace("_", " ").encode("utf-8", "replace")
    return _INSIDE.sub(lambda m: _LIKE[m[0]], raw).translate(_SPLIT).split()


def subwords(vocab: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket ids, offsets per word): every word as <word>, its n-grams and itself."""
    sizes = np.array([len(w) + 2 for w in vocab], np.int64)
    off = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(b"<" + w + b">" for w in vocab), np.uint8)
    h = SpanHash(data)
    owner = np.repeat(np.arange(len(vocab)), sizes)
    starts, ends = [off[:-1]], [off[1:]]
    place = np.arange(len(data))
    for n in GRAMS:
        ok = place + n <= off[owner + 1]
        starts.append(place[ok])
        ends.append(place[ok] + n)
    a, b = np.concatenate(starts), np.concatenate(ends)
    whose = owner[np.minimum(a, len(data) - 1)]
    order = np.argsort(whose, kind="stable")
    ids = (h(a, b) >> U64(64 - int(buckets - 1).bit_length())).astype(np.int64)
    return ids[order], np.concatenate([[0], np.cumsum(np.bincount(whose, minlength=len(vocab)))])


class Vocabulary:
    """Values per distinct word, computed once per task; started anew when it has grown to ``limit`` words."""

    def __init__(self, compute, limit: int = 400_000):
        self.compute, self.limit, self.at, self.values = compute, limit, {}, None

    def __call__(self, text: list[bytes]) -> np.ndarray:
        if len(self.at) > self.limit:
            self.at, self.values = {}, None
        new = [w for w in dict.fromkeys(text) if w not in self.at]
        if new:
            more = self.compute(new)
            self.values = more if self.values is None else np.concatenate([self.values, more])
            self.at.update(zip(new, range(len(self.at), len(self.at) + len(new))))
        return self.values[np.fromiter(map(self.at.__getitem__, text), np.int64, len(text))]


def bags(docs: DataFrame, buckets: int) -> DataFrame:
    """doc_id, toxic, h (hash of the text), ids, shares: distinct subword ids of each (sampled) document and, last, the padding, with their weights in the average."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in range(batch.num_rows):
                w, times = np.unique(np.array(words(batch.column(2)[x].as_py()), object), return_counts=True)
                if not len(w):
                    continue
                ids, off = subwords(w.tolist(), buckets)
                u, at = np.unique(ids, return_inverse=True)
                n = np.append(np.bincount(at, weights=np.repeat(times, np.diff(off))), PAD)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(x, 1), batch.column(1).slice(x, 1), batch.column(3).slice(x, 1), pa.array([np.append(u, buckets).astype(np.int32)], pa.list_(pa.int32())),
                     pa.array([(n / n.sum()).astype(np.float32)], pa.list_(pa.float32()))], names=["doc_id", "toxic", "h", "ids", "shares"])

    return docs.select("doc_id", "toxic", "text", F.xxhash64("text").alias("h")).mapInArrow(
        run, "doc_id long, toxic int, h long, ids array<int>, shares array<float>")


class Scorer(NamedTuple):
    """What scoring needs: the logit each subword adds before averaging (the padding's last), and the calibration."""

    table: np.ndarray
    slope: float
    offset: float


class Model:
    """Embedding table and softmax, trained jointly."""

    def __init__(self, buckets: int = BUCKETS, dim: int = DIM, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.e = np.zeros((buckets + 1, dim), np.float32)  # the last is the padding
        self.w = rng.normal(0, 1, (dim, 2)).astype(np.float32)
        self.b = np.zeros(2, np.float32)
        self.slope, self.offset = 0.0, -50.0

    def fit(self, ids: list[np.ndarray], shares: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.3) -> None:
        rng = np.random.default_rng(11)
        ge, gw, gb = np.full_like(self.e, 1e-8), np.full_like(self.w, 1e-8), np.full_like(self.b, 1e-8)
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for lo in range(0, len(y), 128):
                mine = order[lo:lo + 128]
                i = np.concatenate([ids[x] for x in mine])
                size = np.array([len(ids[x]) for x in mine])
                share = np.concatenate([shares[x] for x in mine])
                start = np.concatenate([[0], np.cumsum(size)[:-1]])
                mean = np.add.reduceat(self.e[i] * share[:, None], start, axis=0)
                z = mean @ self.w + self.b
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(mine)), y[mine]] -= 1
                p /= len(mine)
                gmean, gw_now, gb_now = p @ self.w.T, mean.T @ p, p.sum(0)
                u, at = np.unique(i, return_inverse=True)
                back = np.repeat(gmean, size, axis=0) * share[:, None]
                g = np.stack([np.bincount(at, weights=back[:, k], minlength=len(u)) for k in range(back.shape[1])], 1).astype(np.float32)
                ge[u] += g * g
                self.e[u] -= rate * g / np.sqrt(ge[u])
                gw += gw_now * gw_now
                self.w -= 0.1 * rate * gw_now / np.sqrt(gw)
                gb += gb_now * gb_now
                self.b -= 0.1 * rate * gb_now / np.sqrt(gb)

    @property
    def table(self) -> np.ndarray:
        return self.e @ (self.w[:, 1] - self.w[:, 0])

    def logits(self, ids: list[np.ndarray], shares: list[np.ndarray]) -> np.ndarray:
        t = self.table
        return np.array([t[i] @ s for i, s in zip(ids, shares)])

    def calibrate(self, z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """Put the cut with the fewest (weighted) errors, in the middle of its stretch, at the threshold; scaled by the spread of z."""
        order = np.argsort(z, kind="stable")
        z, y, weight = z[order], y[order], weight[order]
        missed = np.concatenate([[0], np.cumsum(weight * y)])
        clean = np.concatenate([[0], np.cumsum(weight * (1 - y))])
        wrong = missed + clean[-1] - clean
        best = np.flatnonzero(wrong <= wrong.min() * (1 + 1e-9))
        k = int(best[len(best) // 2])
        edge = np.concatenate([[z[0] - 1], z, [z[-1] + 1]])
        cut = (edge[k] + edge[k + 1]) / 2
        self.slope = 4.0 / max(np.abs(z - cut).mean(), 1e-6)
        self.offset = float(np.log(THRESHOLD / (1 - THRESHOLD)) - self.slope * cut)


def train(docs: DataFrame, labels: DataFrame, fold: Column, buckets: int = BUCKETS,
          toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> Scorer:
    """Fit on labelled rows of ``fold`` (a condition on doc_id), at most about ``toxic_rows`` and ``clean_rows`` of them."""
    of = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("toxic").cast("int")).alias("toxic")).filter(fold)
    size = {r["toxic"]: r["count"] for r in of.groupBy("toxic").count().collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20)) / (1 << 20)
    keep = F.lit(False)
    for label, most in ((0, clean_rows), (1, toxic_rows)):
        keep = keep | ((F.col("toxic") == label) & (draw < most / size.get(label, 1)))
    nothing = Scorer(np.zeros(buckets + 1, np.float32), 0.0, -50.0)
    if not {0, 1} <= set(size):
        return nothing
    picked = of.filter(keep).limit(2 * (toxic_rows + clean_rows))  # the draw keeps about half of that; this bounds the broadcast
    rows = bags(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(picked), "doc_id"), buckets)
    # an id may be on many rows: its copies count once, and the limit bounds the rows too
    rows = rows.dropDuplicates(["doc_id", "h"]).limit(2 * (toxic_rows + clean_rows))
    shares_of = np.array([size[0], size[1]])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = [b for b in batches if b.num_rows]
        if not some:
            return
        rows = pa.Table.from_batches(some)
        order = np.lexsort((rows.column("h").to_numpy(), rows.column("doc_id").to_numpy()))
        y = rows.column("toxic").to_numpy().astype(np.int64)[order]
        if len(np.unique(y)) < 2:
            return
        ids, shares = ([rows.column(c)[int(x)].values.to_numpy() for x in order] for c in ("ids", "shares"))
        held = np.arange(len(y)) % 5 == 0
        if len(np.unique(y[held])) < 2 or len(np.unique(y[~held])) < 2:
            held = np.zeros(len(y), bool)
        learn = np.flatnonzero(~held)
        check = np.flatnonzero(held) if held.any() else learn
        model = Model(buckets)
        model.fit([ids[x] for x in learn], [shares[x] for x in learn], y[learn])
        weight = shares_of / np.maximum(np.bincount(y[check], minlength=2), 1)
        model.calibrate(model.logits([ids[x] for x in check], [shares[x] for x in check]), y[check], weight[y[check]])
        yield pa.RecordBatch.from_pydict({"subwords": [model.table.astype(np.float32).tobytes()], "slope": [model.slope], "offset": [model.offset]},
                                         pa.schema([("subwords", pa.binary()), ("slope", pa.float64()), ("offset", pa.float64())]))

    # the sample is bounded, so one task can hold it; the driver gets the finished table
    found = rows.repartition(1).mapInArrow(fit, "subwords binary, slope double, offset double").collect()
    return Scorer(np.frombuffer(bytes(found[0]["subwords"]), np.float32), found[0]["slope"], found[0]["offset"]) if found else nothing


def _scores(state: tuple) -> Callable[[pa.Array], np.ndarray]:
    """A function that scores an array of texts; words it has met are looked up."""
    table, slope, offset = state
    buckets = len(table) - 1

    def of_words(vocab: list[bytes]) -> np.ndarray:
        out = []
        for x in range(0, len(vocab), 20_000):
            ids, off = subwords(vocab[x:x + 20_000], buckets)
            out.append(np.stack([np.add.reduceat(table[ids].astype(np.float64), off[:-1]), np.diff(off)], 1))
        return np.concatenate(out)

    lookup = Vocabulary(of_words)

    def of(col: pa.Array) -> np.ndarray:
        found = [np.zeros(0)]
        for i, j in doc_blocks(utf8_parts(col)[1], 1 << 22):
            each = [words(t) for t in col.slice(i, j - i).to_pylist()]
            size = np.array([len(w) for w in each])
            z = np.full(j - i, float(table[-1]))
            some = np.flatnonzero(size)
            if len(some):
                sums = np.add.reduceat(lookup([w for ws in each for w in ws]), np.concatenate([[0], np.cumsum(size[some])[:-1]]), axis=0)
                z[some] = (sums[:, 0] + PAD * table[-1]) / (sums[:, 1] + PAD)
            found.append(1 / (1 + np.exp(-np.clip(slope * z + offset, -60, 60))))
        return np.concatenate(found)

    return of


def score(docs: DataFrame, model: Scorer, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus score (0 to 1) of every whole text."""
    small = docs.sparkSession.sparkContext.broadcast(tuple(model))
    source = docs.select(*keep, F.col("text").cast("string").alias("_text"), F.lit(0.0).alias("score"))
    schema = source.drop("_text").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _scores(small.value)
        for batch in batches:
            cols = [batch.column(x) for x in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(of(string_column(batch, "_text")), pa.float64())], names=[*keep, "score"])

    return source.mapInArrow(run, schema)


def score_column(docs: DataFrame, text: Column, model: Scorer) -> Column:
    """The score as a column: only the text goes to Python, and only the score comes back."""
    small = docs.sparkSession.sparkContext.broadcast(tuple(model))

    @F.arrow_udf("double")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = _scores(small.value)
        for col in texts:
            yield pa.array(of(pc.fill_null(col, "") if col.null_count else col), pa.float64())

    return run(text.cast("string"))
