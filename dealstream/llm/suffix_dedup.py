"""Exact removal of repeated byte strings with suffix arrays per shard.

A string of ``width`` bytes is repeated where it also starts earlier: in a
document with a smaller doc_id, or earlier in the same one. Every byte of a
repeated string goes.

1. Shards. Each task cuts its documents into shards of at most 2**21 bytes
   (longer documents into pieces that overlap by width - 1), builds the suffix
   array by Larsson-Sadakane refinement and the common prefixes by Kasai. Runs of
   suffixes that share ``width`` bytes are the repeats inside the shard; the
   first of each run is a head.
2. Between shards only heads matter. Consecutive heads whose windows have the
   same anchor (the 16 bytes of smallest hash inside the window, so equal
   windows have equal anchors wherever they stand) travel as one record: hash
   of the anchor, hash of the bytes they cover, place. As a shard keeps one head
   per string, no string has more records than there are shards.
3. Records meet by anchor. Equal covered bytes settle a whole run at once. Runs
   that share an anchor but not all bytes are compared window by window: the
   bytes of just these runs are fetched, and each sorted batch of window hashes
   is merged into those seen by binary search. An anchor with more than
   ``hot`` different runs is dealt out by window instead of by anchor.
4. Removed runs are joined back to their documents.

Defined results: null text is empty; documents shorter than ``width`` keep
everything; rows that repeat a doc_id are the same document for "earlier": a
string at the same place of both is not earlier in either; a null doc_id sorts
after all others; an empty table gives no rows. Extra columns are ignored.
Windows are compared by 64-bit hashes between shards, by their bytes inside one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, SpanHash, doc_blocks, mix64, string_column, to_i64, utf8_parts, written
from .suffix import LIMIT, common_prefixes, packed, refine

WIDTH, GRAM, HOT = 100, 16, 20_000
_LOW = U64(LIMIT - 1)
_RECORD = "anchor long, ctx long, did long, th int, start long, n int, settled boolean"
_NAMES = ["anchor", "ctx", "did", "th", "start", "n", "settled"]


def _runs(at: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) index of maximal runs of consecutive places with equal ``same`` values."""
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = at[1:] != at[:-1] + 1
    for s in same:
        cut |= s[1:] != s[:-1]
    cut = np.flatnonzero(cut)
    return np.concatenate([[0], cut + 1]), np.append(cut, len(at) - 1)


def shard_records(pieces: list[tuple[int, int, int, np.ndarray]], width: int, gram: int) -> list[np.ndarray]:
    """Columns of _RECORD for one shard; a piece is (did, th, first place, bytes)."""
    pieces = sorted(pieces, key=lambda p: (p[0], p[2]))
    size = np.array([len(p[3]) for p in pieces], np.int64)
    off = np.concatenate([[0], np.cumsum(size)])
    data = np.concatenate([p[3] for p in pieces])
    did = np.array([p[0] for p in pieces], np.int64)
    th = np.array([p[1] for p in pieces], np.int64)
    first = np.array([p[2] for p in pieces], np.int64)
    owner = np.repeat(np.arange(len(pieces)), size)
    place = np.arange(len(data)) - off[owner] + first[owner]
    eligible = np.arange(len(data)) + width <= off[owner + 1]
    sa, rank = refine(data, width)
    good = eligible[sa]
    sa = sa[good]
    tied = np.flatnonzero(rank[sa[1:]] == rank[sa[:-1]]) + 1
    tied = tied[common_prefixes(data, sa, tied, width) >= width]
    repeat = np.zeros(len(data), bool)
    if len(tied):
        # runs of tied slots, each with the slot before it: all but the earliest (document, place) are repeats
        a, b = _runs(tied)
        lead = np.zeros(len(sa), bool)
        lead[tied[a] - 1] = True
        member = lead.copy()
        member[tied] = True
        slots = np.flatnonzero(member)
        order = np.unique(did, return_inverse=True)[1]
        key = (order[owner[sa[slots]]].astype(np.int64) << 40) + place[sa[slots]]
        starts = np.flatnonzero(lead[slots])
        least = np.repeat(np.minimum.reduceat(key, starts), np.diff(np.append(starts, len(slots))))
        repeat[sa[slots[key > least]]] = True
    out = []
    gone = np.flatnonzero(repeat)
    a, b = _runs(gone, owner[gone])
    if len(a):
        s = gone[a]
        out.append([mix64(s.astype(U64) + mix64(did[owner[s]].view(U64))), np.zeros(len(s), U64), did[owner[s]], th[owner[s]], place[s], b - a + 1, np.ones(len(s), bool)])
    heads = np.flatnonzero(eligible & ~repeat)
    if len(heads):
        word = packed(data)
        tail = np.zeros(len(data), U64)
        tail[:-8] = word[8:]
        h = mix64(word * U64(0x9E3779B97F4A7C15) ^ mix64(tail + U64(gram)))
        low = (h & ~_LOW) | np.arange(len(h), dtype=U64)
        reach, span = low, 1
        want = width - gram + 1
        while 2 * span <= want:
            reach = np.minimum(reach[:-span], reach[span:])
            span *= 2
        if want > span:
            reach = np.minimum(reach[:len(low) - want + 1], reach[want - span:want - span + len(low) - want + 1])
        anchor = (reach[heads] & _LOW).astype(np.int64)
        a, b = _runs(heads, anchor, owner[heads])
        s, e = heads[a], heads[b] + width
        ctx = SpanHash(data)(s, e)
        out.append([h[anchor[a]], ctx, did[owner[s]], th[owner[s]], place[s], b - a + 1, np.zeros(len(s), bool)])
    return [np.concatenate(c) for c in zip(*out)] if out else []


def records(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """Step 1 over all documents (did, th, text)."""

    def emit(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if cols:
            yield pa.RecordBatch.from_arrays(
                [to_i64(cols[0]), to_i64(cols[1]), to_i64(cols[2]), pa.array(cols[3].astype(np.int32)), to_i64(cols[4]),
                 pa.array(cols[5].astype(np.int32)), pa.array(cols[6])], names=_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, most = [], 0, LIMIT - 64
        for batch in batches:
            data, off = utf8_parts(string_column(batch, "text"))
            did, th = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for x in range(batch.num_rows):
                at, end = int(off[x]), int(off[x + 1])
                while end - at >= width:
                    room = min(most - size, end - at)
                    if room < min(end - at, most):  # does not fit: close the shard, unless the piece is long anyway
                        yield from emit(shard_records(held, width, gram))
                        held, size = [], 0
                        room = min(most, end - at)
                    held.append((did[x], th[x], at - int(off[x]), data[at:at + room].copy()))
                    size += room
                    if at + room == end:
                        break
                    at += room - width + 1
        if held:
            yield from emit(shard_records(held, width, gram))

    return docs.mapInArrow(run, _RECORD)


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (anchor, ctx, did, start): all but the first of equal runs are settled; the first is kept
    as an open run if its anchor has another one."""
    last = pending = None
    for batch in batches:
        settled = batch.column(6).to_numpy(zero_copy_only=False)
        todo = np.flatnonzero(~settled)
        if not len(todo):
            yield batch
            continue
        anchor, ctx, did, start = (batch.column(c).to_numpy()[todo] for c in (0, 1, 2, 4))
        new_a, new_c = np.ones(len(todo), bool), np.ones(len(todo), bool)
        new_a[1:] = anchor[1:] != anchor[:-1]
        if last is not None:
            new_a[0] = anchor[0] != last[0]
        new_c[1:] = new_a[1:] | (ctx[1:] != ctx[:-1])
        new_c[0] = new_a[0] or ctx[0] != last[1]
        head = np.flatnonzero(new_c)
        # the first of the equal runs each row belongs to; it may lie in an earlier batch
        of = np.searchsorted(head, np.arange(len(todo)), side="right") - 1
        lead_did, lead_at = (np.where(of >= 0, v[head[of]] if len(head) else 0, last[k] if last else 0) for v, k in ((did, 2), (start, 3)))
        # the same place of a repeated doc_id is no earlier place: it stays open
        twin = ~new_c & (did == lead_did) & (start == lead_at)
        open_ = twin.copy()
        open_[head] = ~new_a[head] | np.append(~new_a[head][1:], False)
        if pending is not None and len(head):
            if not new_a[head[0]]:
                yield pending
            pending = None
        flag, mark = np.zeros(batch.num_rows, bool), settled.copy()
        flag[todo[open_]] = True
        mark[todo[~new_c & ~twin]] = True
        keep = np.flatnonzero(mark | flag)
        yield batch.take(pa.array(keep)).set_column(6, "settled", pa.array(mark[keep]))
        last = (anchor[-1], ctx[-1], lead_did[-1], lead_at[-1])
        if len(head) and not open_[head[-1]]:
            pending = batch.take(pa.array([todo[head[-1]]]))


def _compare(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, did, start) with the bytes of their run (or none: the key is the window itself).

    Windows seen under the current key are kept as a sorted array; every batch is
    merged into it by binary search, so a long key never needs its rows at once.
    """
    key_now, seen, seen_key = None, np.zeros(0, U64), np.zeros(0, np.int64)
    for batch in batches:
        key, did, start, n = (batch.column(c).to_numpy() for c in (0, 1, 3, 4))
        whole = batch.column(5)
        bare = whole.is_null().to_numpy(zero_copy_only=False)
        data, off = utf8_parts(whole.fill_null(b""))
        count = np.where(bare, 1, n).astype(np.int64)
        row = np.repeat(np.arange(len(key)), count)
        step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        h = key[row].view(U64).copy()
        full = ~bare[row]
        if full.any():
            p = off[row[full]] + step[full]
            h[full] = SpanHash(data)(p, p + width)
        group = np.cumsum(np.append(True, key[1:] != key[:-1]))[row]
        if key_now is not None and len(key) and key[0] != key_now:
            seen = seen[:0]
        elif key_now is None:
            seen = seen[:0]
        pos = start[row] + step
        order = np.lexsort((pos, did[row], h, group))
        g, hh = group[order], h[order]
        lead = np.ones(len(order), bool)
        lead[1:] = (g[1:] != g[:-1]) | (hh[1:] != hh[:-1])
        first = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))]
        drop = np.zeros(len(row), bool)
        drop[order] = (did[row][order] != did[row][first]) | (pos[order] != pos[first])
        if len(seen):
            mine = np.flatnonzero(group == 1)
            k = np.minimum(np.searchsorted(seen, h[mine]), len(seen) - 1)
            drop[mine[seen[k] == h[mine]]] = True
        if len(key):
            tail = np.unique(h[group == group[-1]])
            seen = np.union1d(seen, tail) if group[-1] == 1 else tail
            key_now = key[-1]
        gone = np.flatnonzero(drop)
        a, b = _runs(gone, row[gone])
        yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(row[gone[a]])), batch.column(2).take(pa.array(row[gone[a]])),
                                          to_i64(pos[gone[a]]), pa.array((b - a + 1).astype(np.int32))], names=["did", "th", "start", "n"])


def _fetch(docs: DataFrame, open_runs: DataFrame, width: int) -> DataFrame:
    """key, did, th, start, n, bytes of every open run; hot ones window by window with the window's hash as key."""
    per = open_runs.groupBy("did", "th").agg(F.collect_list(F.struct("anchor", "start", "n", "hot")).alias("runs"))
    schema = "key long, did long, th int, start long, n int, bytes binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8_parts(string_column(batch, "text"))
            did, th, runs = (batch.column(c).to_pylist() for c in (0, 1, 3))
            for i, j in doc_blocks(off, 4 << 20):
                part = data[off[i]:off[j]]
                h = SpanHash(part)
                rows = []
                for x in range(i, j):
                    base = int(off[x] - off[i])
                    for r in runs[x]:
                        a = base + r["start"]
                        if r["hot"]:
                            p = np.arange(a, a + r["n"])
                            for k, v in enumerate(h(p, p + width).view(np.int64).tolist()):
                                rows.append((v, did[x], th[x], r["start"] + k, 1, None))
                        else:
                            rows.append((r["anchor"], did[x], th[x], r["start"], r["n"], part[a:a + r["n"] + width - 1].tobytes()))
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)],
                                                 names=["key", "did", "th", "start", "n", "bytes"])

    return docs.join(per, ["did", "th"]).select("did", "th", "text", "runs").mapInArrow(run, schema)


def removed_runs(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """did, th, start, n: n consecutive places whose ``width`` bytes also start earlier."""
    met = written(records(docs, width, gram).repartition("anchor").sortWithinPartitions("anchor", "ctx", "did", "start")
                  .mapInArrow(_settle, _RECORD), "settled")
    open_runs = met.filter("NOT settled").select("anchor", "did", "th", "start", "n").distinct()
    many = open_runs.groupBy("anchor").count().filter(F.col("count") > hot).select("anchor", F.lit(True).alias("hot"))
    open_runs = open_runs.join(many, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    compared = _fetch(docs, open_runs, width).repartition("key").sortWithinPartitions("key", "did", "start").mapInArrow(
        lambda batches: _compare(batches, width), "did long, th int, start long, n int")
    return met.filter("settled").select("did", "th", "start", "n").unionByName(written(compared, "compared"))


def identified(docs: DataFrame) -> DataFrame:
    """did (null ids last), th (tells rows with one doc_id apart), doc_id, text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("did"), F.hash(text).alias("th"),
                       F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans (removed byte runs), kept (remaining bytes) of every document."""
    d = identified(docs)
    runs = removed_runs(d.select("did", "th", "text"), width)
    per = runs.groupBy("did", "th").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    joined = d.join(per, ["did", "th"], "left").select("doc_id", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8_parts(string_column(batch, "text"))
            lists = batch.column(2)
            for i, j in doc_blocks(off, 4 << 20):
                rows = []
                for x in range(i, j):
                    body = data[off[x]:off[x + 1]]
                    spans: list[list[int]] = []
                    for r in sorted((r["start"], r["n"]) for r in lists[x].as_py() or ()):
                        a, b = r[0], r[0] + r[1] + width - 1
                        if spans and a <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], b)
                        else:
                            spans.append([a, b])
                    keep = np.ones(len(body), bool)
                    for a, b in spans:
                        keep[a:b] = False
                    rows.append((len(body), sum(b - a for a, b in spans), len(spans), spans, body[keep].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), *(pa.array([r[c] for r in rows], pa.int64()) for c in range(3)),
                     pa.array([r[3] for r in rows], pa.list_(pa.list_(pa.int64()))), pa.array([r[4] for r in rows], pa.binary())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<array<long>>, kept binary")
