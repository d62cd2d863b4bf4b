"""Packing of tokenised examples into sequences, as vector bin packing by the dot-product heuristic.

A piece of an example is a vector: its tokens, one segment, and its loss-bearing
tokens (those after the prompt that have a token before them in the piece). A
sequence holds pieces while all three limits hold at once. A sequence is filled by
taking, again and again, the piece that fits and whose vector, scaled by the limits
and weighted by the pool's mean demand, has the greatest dot product with what the
sequence has left (of equal ones the one that came first into the pool). Where no
whole piece fits, pieces may be cut (``cut``): the prefix with the greatest product
goes in and the rest stays in the pool. A sequence that then is neither full nor at
its limit of loss-bearing tokens is cut back to a power of two, which needs no
padding, and the rest goes back to the pool.

The work is narrow: every task tokenises its rows and packs them from a pool of at
most ``POOL`` pieces, so that no text is shuffled and a task holds one Arrow batch,
one example and the pool. The number of a sequence is its task's number and a
count within it; a task that runs again on the same rows packs alike.

Tokens are those of the given tokenizer file, then ``end``. Texts whose code points
are all below U+0240 and hold no special token's text go through a faster encoder
over the same vocabulary and merges where the file's ids rank its merges
(``Encoder``); tests hold the two against each other.

Defined results: a null or empty text is one piece of the end id; a very long text
is cut into full pieces; repeated rows and ids are examples of their own; with
``cut`` off only an example over a limit by itself is cut (at the limit), and
sequences may stay short; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMITS = (1024, 256, 1023)  # tokens, segments and loss-bearing tokens of one sequence
POOL, RESERVE = 1024, 256
BATCH_BYTES = 1 << 20  # text encoded at once


# --- tokens ----------------------------------------------------------------------------------

class Encoder:
    """Token ids of texts by a tokenizer file; the same ids by a faster encoder where that is safe."""

    PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed: byte-level BPE's split

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens") or ()]
        self.beyond = re.compile("[^\x00-\u023f]")
        self.quick = self._quick(spec)

    def _quick(self, spec: dict):
        """An encoder over ranks, or None where the file's parts are not the plain byte-level ones."""
        model, split, added = spec.get("model") or {}, spec.get("pre_tokenizer") or {}, set(self.special)
        plain = (model.get("type") == "BPE" and not spec.get("normalizer") and split.get("type") == "ByteLevel" and not split.get("add_prefix_space")
                 and split.get("use_regex", True) and not model.get("dropout") and not model.get("ignore_merges"))
        if not plain:
            return None
        import tiktoken

        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown}
        byte.update({chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))})
        ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [model["vocab"][a + b] for a, b in pairs]
        if order != sorted(order) or len(set(order)) < len(order):
            return None
        return tiktoken.Encoding("quick", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def safe(self, text: str) -> bool:
        return not self.beyond.search(text) and not any(s in text for s in self.special)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        rest = []
        for i, text in enumerate(texts):
            if self.quick is not None and self.safe(text):
                out[i] = np.array(self.quick.encode_ordinary(text), np.uint32)
            else:
                rest.append(i)
        for i, e in zip(rest, self.full.encode_batch([texts[i] for i in rest], add_special_tokens=False)):
            out[i] = np.array(e.ids, np.uint32)
        return out


# --- packing ---------------------------------------------------------------------------------

def loss_tokens(start: int, end: int, prompt: int) -> int:
    """Tokens of [start, end) after the prompt that have one before them in the piece."""
    return max(0, end - max(start + 1, prompt))


class Packer:
    """A pool of pieces and the sequences made of it. A piece is (example, start, end, prompt)."""

    def __init__(self, limits: tuple[int, int, int], cut: bool, emit: Callable[[int, int, object, int, int], None]):
        self.limits, self.cut, self.emit = np.array(limits, np.float64), cut, emit
        self.vectors = np.zeros((POOL + 64, 3))  # tokens, segments, loss-bearing tokens of every piece in the pool
        self.spans = np.zeros((POOL + 64, 3))  # start, end, prompt
        self.examples: list = []
        self.sequences = 0

    def __len__(self) -> int:
        return len(self.examples)

    def add(self, example: object, start: int, end: int, prompt: int) -> None:
        """Into the pool, cut where it is over a limit by itself."""
        while start < end:
            stop = int(min(end, start + self.limits[0], max(start + 1, prompt) + self.limits[2]))
            if stop - start == self.limits[0]:
                self._close([(example, start, stop, prompt)])
            else:
                self._pool((example, start, stop, prompt))
            start = stop

    def drain(self, keep: int) -> None:
        """Fill sequences until at most ``keep`` pieces are left."""
        while len(self) > keep:
            self._close(self._fill())

    def _pool(self, piece: tuple) -> None:
        n = len(self)
        if n == len(self.vectors):
            self.vectors, self.spans = (np.concatenate([x, np.zeros_like(x)]) for x in (self.vectors, self.spans))
        example, start, end, prompt = piece
        self.vectors[n] = end - start, 1, loss_tokens(start, end, prompt)
        self.spans[n] = start, end, prompt
        self.examples.append(example)

    def _take(self, k: int) -> tuple:
        n = len(self)
        start, end, prompt = self.spans[k].astype(int).tolist()
        for x in (self.vectors, self.spans):
            x[k:n - 1] = x[k + 1:n]
        return self.examples.pop(k), start, end, prompt

    def _fill(self) -> list:
        """Pieces of one sequence, taken from the pool by the dot-product rule."""
        left, chosen = self.limits.copy(), []
        weight = self.vectors[:len(self)].mean(0) / self.limits ** 2
        while self.examples and left[0] > 0 and left[1] > 0:
            v = self.vectors[:len(self)]
            fits = (v[:, 0] <= left[0]) & (v[:, 2] <= left[2])
            score = np.where(fits, v @ (weight * left), -1)
            k = int(score.argmax())
            if fits[k]:
                left -= v[k]
                chosen.append(self._take(k))
                continue
            if not self.cut:
                break
            start, end, prompt = self.spans[:len(self)].T
            late = np.maximum(start + 1, prompt)
            stop = np.minimum(end, np.minimum(start + left[0], late + left[2]))
            part = np.stack([stop - start, np.ones(len(self)), np.maximum(0, stop - late)], 1)
            k = int((part @ (weight * left)).argmax())
            left -= part[k]
            at = int(stop[k])
            example, a, b, p = self._take(k)
            chosen.append((example, a, at, p))
            self._pool((example, at, b, p))
        return chosen

    def _close(self, chosen: list) -> None:
        size = sum(p[2] - p[1] for p in chosen)
        if self.cut and size < self.limits[0] and sum(loss_tokens(*p[1:]) for p in chosen) < self.limits[2]:
            over = size - (1 << (size.bit_length() - 1))
            while over:  # cut back to a power of two
                example, a, b, prompt = chosen.pop()
                back = min(over, b - a)
                if back < b - a:
                    chosen.append((example, a, b - back, prompt))
                self._pool((example, b - back, b, prompt))
                over -= back
        at = 0
        for example, a, b, _ in chosen:
            self.emit(self.sequences, at, example, a, b)
            at += b - a
        self.sequences += 1


def pack(rows: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", prompt: str | None = None, end: int = 0,
         limits: tuple[int, int, int] = LIMITS, cut: bool = True, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, loss_tokens, sequence_id, offset (and ids, little-endian).

    ``prompt`` names a column whose text comes before ``text`` and bears no loss.
    ``tokenizer`` is the file's path on every executor.
    """
    kind = rows.schema[id].dataType.simpleString()
    fields = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
              ("loss_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())] + ([("ids", pa.binary())] if with_ids else [])
    spark_type = {pa.int64(): "long", pa.binary(): "binary"}
    schema = ", ".join([f"`{id}` {kind}"] + [f"{n} {spark_type[t]}" for n, t in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, base = Encoder(tokenizer), TaskContext.get().partitionId() << 32
        done: list = []
        key_type = None

        def emit(sequence: int, offset: int, example: tuple, a: int, b: int) -> None:
            key, ids, first = example
            part = ids[a:b].astype("<u4").tobytes()
            row = (key, a, b - a, zlib.crc32(part), len(ids), loss_tokens(a, b, first), base + sequence, offset)
            done.append(row + ((part,) if with_ids else ()))

        def ready() -> pa.RecordBatch:
            columns = list(zip(*done))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], key_type)] + [pa.array(c, t) for c, (_, t) in zip(columns[1:], fields)],
                                              names=[id] + [n for n, _ in fields])

        packer = Packer(limits, cut, emit)
        for batch in batches:
            key_type = batch.column(0).type
            for keys, heads, texts in _portions(batch):
                tokens, before = encode(texts), [0] * len(texts)
                if prompt:
                    first = encode(heads)
                    tokens, before = [np.concatenate(x) for x in zip(first, tokens)], [len(t) for t in first]
                for key, ids, first in zip(keys, tokens, before):
                    ids = np.append(ids, np.uint32(end))
                    packer.add((key, ids, first), 0, len(ids), first)
                    if len(packer) >= POOL:
                        packer.drain(RESERVE)
                    if len(done) >= 8192:
                        yield ready()
        packer.drain(0)
        if done:
            yield ready()

    head = F.coalesce(F.col(f"`{prompt}`").cast("string"), F.lit("")) if prompt else F.lit("")
    return rows.select(F.col(f"`{id}`"), head.alias("head"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("body")).mapInArrow(run, schema)


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str], list[str]]]:
    """Keys, prompts and texts in portions of about ``BATCH_BYTES``."""
    i, held, n = 0, 0, batch.num_rows
    for j in range(n):
        held += len(batch.column(2)[j].as_buffer() or b"") + 64
        if held >= BATCH_BYTES or j == n - 1:
            part = batch.slice(i, j + 1 - i)
            yield part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist()
            i, held = j + 1, 0
