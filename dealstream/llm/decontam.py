"""Benchmark decontamination with an FM-index per training shard.

A task turns its documents into shards of benchmark word ids. A word that no
benchmark item has can be in no window, so it only separates; stretches too
short for the shortest window fall away, exactly. Each shard is indexed
(suffix array, Burrows-Wheeler transform, wavelet tree, sampled suffix places);
all windows are searched backwards at once, their places located through the
samples, and the covered words merged into removal spans. The pass is narrow:
no text is shuffled.

The benchmark travels in blocks of about ``block_words`` words, counted before they
are fetched: a block's broadcast arrays hold one row of ``window`` ids a word, some
30 MB by default. Further blocks are further narrow passes over the documents.

Defined results: null or empty text has no words; an item with no words has no
window; repeated benchmark rows count once; an item with a null id still marks
words but is not counted; empty tables give no rows or no hits; rows that repeat
a doc_id are judged one by one. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_blocks, rebuilt, string_column, utf8_parts
from .suffix import LIMIT, refine

WINDOW, BLOCK_WORDS, SLICE_BYTES, SAMPLE = 13, 1 << 18, 8 << 20, 16

#: \x00-\x2F, \x3A-\x60 and \x7B-\x7F separate words, after A-Z became a-z.
_FOLD = bytes(x + 32 if 65 <= x <= 90 else 32 if x < 0x30 or 0x3A <= x <= 0x60 or 0x7B <= x <= 0x7F else x for x in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


class WaveletTree:
    """Level-wise wavelet tree over small ints: rank(c, i) = how often c occurs in the first i symbols."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.ones, self.zeros = [], []
        cur = symbols.astype(np.int64)
        for level in range(self.levels - 1, -1, -1):
            bit = (cur >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(int(len(cur) - bit.sum()))
            cur = np.concatenate([cur[bit == 0], cur[bit == 1]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        lo, hi = np.zeros(len(c), np.int64), i.astype(np.int64)
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            one = ((c >> level) & 1).astype(bool)
            a, b = self.ones[k][lo], self.ones[k][hi]
            lo = np.where(one, self.zeros[k] + a, lo - a)
            hi = np.where(one, self.zeros[k] + b, hi - b)
        return hi - lo


class FMIndex:
    """Backward search and locating over one shard (ints from 0; 0 never occurs in a phrase)."""

    def __init__(self, symbols: np.ndarray, sample: int = SAMPLE):
        text = np.concatenate([symbols + 1, [0]])  # 0 closes the shard
        sa, _ = refine(text)
        self.n, self.sigma = len(text), int(text.max()) + 1
        self.bwt = text[sa - 1]
        self.tree = WaveletTree(self.bwt, self.sigma)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.sigma))])
        keep = sa % sample == 0
        self.place = np.full(self.n, -1, np.int64)
        self.place[keep] = sa[keep]

    def search(self, phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of phrases given as right-aligned rows of symbols."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        width = phrases.shape[1]
        for j in range(width - 1, -1, -1):
            live = np.flatnonzero((sizes >= width - j) & (hi > lo))
            if not len(live):
                continue
            c = phrases[live, j].astype(np.int64) + 1
            known = c < self.sigma
            hi[live[~known]] = lo[live[~known]]
            live, c = live[known], c[known]
            lo[live], hi[live] = self.less[c] + self.tree.rank(c, lo[live]), self.less[c] + self.tree.rank(c, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of rows: step back through the text until a sampled place."""
        at, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.full(len(rows), -1, np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            found = self.place[at[todo]] >= 0
            hit = todo[found]
            out[hit] = self.place[at[hit]] + steps[hit]
            todo = todo[~found]
            c = self.bwt[at[todo]].astype(np.int64)
            at[todo] = self.less[c] + self.tree.rank(c, at[todo])
            steps[todo] += 1
        return out


class Phrases:
    """The windows of a block of benchmark items, as word ids from 1."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int):
        self.ids: dict[bytes, int] = {}
        rows: dict[tuple[int, ...], set] = {}
        for item, text in items:
            w = [self.ids.setdefault(x, len(self.ids) + 1) for x in words(text)]
            size = min(window, len(w))
            for i in range(len(w) - size + 1 if size else 0):
                rows.setdefault(tuple(w[i:i + size]), set()).add(item)
        self.sizes = np.array([len(x) for x in rows], np.int64)
        self.rows = np.zeros((len(rows), window), np.int64)
        for i, x in enumerate(rows):
            self.rows[i, window - len(x):] = x
        self.items = [sorted(y for y in x if y is not None) for x in rows.values()]
        self.shortest = int(self.sizes.min()) if len(rows) else 0


def _merged(covered: np.ndarray) -> list[list[int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return edge.reshape(-1, 2).tolist()


def find_hits(docs: list[list[bytes]], ph: Phrases) -> list[tuple[list[list[int]], list[int]]]:
    """Per document: merged spans of hit words [start, end) and the ids of the items found."""
    out: list[tuple[list[list[int]], list[int]]] = [([], []) for _ in docs]
    if not len(ph.rows):
        return out
    get = ph.ids.get
    syms, whose, place, held = [], [], [], 0

    def flush() -> None:
        if not syms:
            return
        s, d, p = np.concatenate(syms), np.concatenate(whose), np.concatenate(place)
        present = np.unique(s)  # the shard's own alphabet, 0 first
        index = FMIndex(np.searchsorted(present, s))
        at = np.minimum(np.searchsorted(present, ph.rows), len(present) - 1)
        real = np.arange(ph.rows.shape[1])[None, :] >= ph.rows.shape[1] - ph.sizes[:, None]
        use = np.flatnonzero(((present[at] == ph.rows) | ~real).all(1))
        lo, hi = index.search(at[use], ph.sizes[use])
        count = hi - lo
        which = np.repeat(use, count)
        rows = np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        spot = index.locate(rows)
        cover = np.zeros(len(s) + 1, np.int64)
        np.add.at(cover, spot, 1)
        np.add.at(cover, spot + ph.sizes[which], -1)
        covered = np.cumsum(cover[:-1]) > 0
        for x in np.unique(d[spot]) if len(spot) else ():
            mine = d == x if len(s) < 4096 else slice(int(np.searchsorted(d, x)), int(np.searchsorted(d, x, side="right")))
            hit = p[mine][covered[mine]]
            spans = out[x][0]
            for i, j in _merged_places(hit):
                spans.append([i, j])
        if len(spot):
            pairs = np.unique(d[spot] * len(ph.rows) + which)
            for key in pairs.tolist():
                out[key // len(ph.rows)][1].extend(ph.items[key % len(ph.rows)])
        syms.clear(), whose.clear(), place.clear()

    for x, w in enumerate(docs):
        ids = np.fromiter((get(y, 0) for y in w), np.int64, len(w))
        edge = np.flatnonzero(np.diff(np.concatenate([[0], (ids > 0).astype(np.int8), [0]]))).reshape(-1, 2)
        for a, b in edge[edge[:, 1] - edge[:, 0] >= ph.shortest].tolist():
            while a < b:
                # a stretch longer than a shard is cut with an overlap of a window less one word
                e = min(b, a + LIMIT // 2)
                if held + e - a + 1 > LIMIT - 2:
                    flush()
                    held = 0
                syms.append(np.append(ids[a:e], 0))
                whose.append(np.full(e - a + 1, x))
                place.append(np.append(np.arange(a, e), -1))
                held += e - a + 1
                a = e if e == b else e - ph.rows.shape[1] + 1
    flush()
    return [(_join(s), sorted(set(i))) for s, i in out]


def _merged_places(hit: np.ndarray) -> list[tuple[int, int]]:
    if not len(hit):
        return []
    cut = np.flatnonzero(np.diff(hit) != 1)
    return list(zip(hit[np.concatenate([[0], cut + 1])].tolist(), (hit[np.append(cut, len(hit) - 1)] + 1).tolist()))


def _join(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for i, j in sorted(spans):
        if out and i <= out[-1][1]:
            out[-1][1] = max(out[-1][1], j)
        else:
            out.append([i, j])
    return out


def _item_type(benchmark: DataFrame) -> str:
    """Whole-numbered ids stay numbers, others are text."""
    return "bigint" if benchmark.schema["item_id"].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint") else "string"


def phrase_blocks(benchmark: DataFrame, window: int, block_words: int) -> Iterator[Phrases]:
    """The benchmark dealt by a hash of its items into blocks of about ``block_words`` words (or one item): their number
    of windows, and so the size of their arrays, is at most that."""
    b = benchmark.select(F.col("item_id").cast(_item_type(benchmark)).alias("item_id"), F.col("text").cast("string").alias("text"))
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    total = b.distinct().agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_words))
    for x in range(blocks if total else 0):
        yield Phrases([(r["item_id"], r["text"]) for r in b.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == x).distinct().collect()], window)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS,
                  keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus n_words, n_hit, items (distinct item ids), spans (merged removal spans in words)."""
    out = docs.select(*keep, F.col("text").cast("string").alias("_text"), F.lit(0).cast("long").alias("n_words"),
                      F.expr(f"CAST(array() AS array<{_item_type(benchmark)}>)").alias("items"),
                      F.expr("CAST(array() AS array<array<bigint>>)").alias("spans"))
    schema = out.schema
    for phrases in _broadcast_blocks(docs, benchmark, window, block_words):
        def run(batches: Iterator[pa.RecordBatch], phrases=phrases) -> Iterator[pa.RecordBatch]:
            of = _hits(phrases.value)
            for batch in batches:
                for i, j in doc_blocks(utf8_parts(string_column(batch, "_text"))[1], SLICE_BYTES):
                    part = batch.slice(i, j - i)
                    cols = {name: part.column(i) for i, name in enumerate(part.schema.names)}
                    cols["n_words"], cols["items"], cols["spans"] = of(string_column(part, "_text"), cols["items"], cols["spans"])
                    yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

        out = out.mapInArrow(run, schema)
    return out.withColumn("n_hit", _n_hit("spans")).select(*keep, "n_words", "n_hit", "items", "spans")


def _n_hit(spans: str) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])


def _broadcast_blocks(docs: DataFrame, benchmark: DataFrame, window: int, block_words: int) -> list:
    share = docs.sparkSession.sparkContext.broadcast
    return [share(vars(x)) for x in phrase_blocks(benchmark, window, block_words)] or [share(vars(Phrases([], window)))]


def _hits(state: dict) -> Callable[[pa.Array, pa.Array, pa.Array], tuple[pa.Array, pa.Array, pa.Array]]:
    """A function from texts, and the items and spans found before, to n_words, items and spans."""
    phrases = rebuilt(Phrases, state)

    def of(texts: pa.Array, items: pa.Array, spans: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
        w = [words(t) for t in texts.to_pylist()]
        found = find_hits(w, phrases)
        return (pa.array([len(t) for t in w], pa.int64()),
                pa.array([sorted({*a, *b[1]}) for a, b in zip(items.to_pylist(), found)], items.type),
                pa.array([_join([*map(list, a), *b[0]]) for a, b in zip(spans.to_pylist(), found)], pa.list_(pa.list_(pa.int64()))))

    return of


def hit_columns(docs: DataFrame, text: str, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, into: str = "_found") -> DataFrame:
    """``docs`` plus struct ``into`` (n_words, n_hit, items, spans): only the text goes to Python, and only the hits come back."""
    names = ["n_words", "items", "spans"]
    out = docs.withColumn(into, F.struct(F.lit(0).cast("long").alias("n_words"), F.expr(f"CAST(array() AS array<{_item_type(benchmark)}>)").alias("items"),
                                         F.expr("CAST(array() AS array<array<bigint>>)").alias("spans")))
    for phrases in _broadcast_blocks(docs, benchmark, window, block_words):
        @F.arrow_udf(f"struct<n_words:bigint,items:array<{_item_type(benchmark)}>,spans:array<array<bigint>>>")
        def run(cols: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            of = _hits(phrases.value)
            for texts, items, spans in cols:
                texts = pc.fill_null(texts, "")
                parts = [of(texts.slice(i, j - i), items.slice(i, j - i), spans.slice(i, j - i))
                         for i, j in doc_blocks(utf8_parts(texts)[1], SLICE_BYTES) or [(0, 0)]]
                yield pa.StructArray.from_arrays([pa.concat_arrays([p[x] for p in parts]) for x in range(3)], names)

        out = out.withColumn(into, run(F.col(text).cast("string"), F.col(f"{into}.items"), F.col(f"{into}.spans")))
    return out.withColumn(into, F.col(into).withField("n_hit", _n_hit(f"{into}.spans")))


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words") -> Column:
    """The contract's rule: some word is hit, and at least a twentieth of the words."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))
