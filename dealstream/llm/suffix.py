"""Suffix arrays of one shard by Larsson-Sadakane refinement in numpy.

Suffixes are ranked by their first h symbols; every round ranks those still
tied by the rank h places further on, doubling h. Groups of one suffix are
settled and never looked at again, so a round costs only what is still tied.
Group, next rank and place are packed in one 64-bit word each, which makes a
round one plain sort; that bounds a shard to 2**21 symbols.
"""

from __future__ import annotations

import numpy as np

LIMIT = 1 << 21
_BITS = np.uint64(21)
_LOW = np.uint64(LIMIT - 1)


def refine(symbols: np.ndarray, depth: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank) of ``symbols`` (non-negative ints below 2**21).

    With ``depth`` suffixes equal in their first ``depth`` symbols share the rank of the
    first of them and stay in order of place; without it the order is total.
    The end of the shard counts as smaller than every symbol.
    """
    n = len(symbols)
    if n > LIMIT:
        raise ValueError(f"a shard holds at most {LIMIT} symbols")
    if n == 0:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    used = np.bincount(symbols) > 0
    code = np.cumsum(used).astype(np.uint64)[symbols]
    width = int(used.sum()).bit_length()
    h = max(1, 42 // width)
    if depth is not None:
        h = min(h, depth)
    padded = np.concatenate([code, np.zeros(h, np.uint64)])
    key = padded[:n].copy()
    for j in range(1, h):
        key <<= np.uint64(width)
        key |= padded[j:j + n]
    key = (key << _BITS) | np.arange(n, dtype=np.uint64)
    key.sort()
    sa = (key & _LOW).astype(np.int32)
    key >>= _BITS
    new = np.ones(n, bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    rank = np.empty(n, np.int32)
    head = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), 0))
    rank[sa] = head
    # slots of the array whose group has more than one suffix
    tied = np.flatnonzero(~(new & np.append(new[1:], True)))
    while len(tied) and (depth is None or h < depth):
        step = h if depth is None else min(h, depth - h)
        at = sa[tied]
        nxt = at.astype(np.int64) + step
        after = np.zeros(len(at), np.uint64)
        ok = nxt < n
        after[ok] = rank[nxt[ok]].astype(np.uint64) + np.uint64(1)
        key = (head[tied].astype(np.uint64) << np.uint64(43)) | (after << _BITS) | at.astype(np.uint64)
        key.sort()
        at = (key & _LOW).astype(np.int32)
        sa[tied] = at
        key >>= _BITS
        new = np.ones(len(tied), bool)
        np.not_equal(key[1:], key[:-1], out=new[1:])
        group = np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))
        head[tied] = tied[group]
        rank[at] = tied[group]
        tied = tied[~(new & np.append(new[1:], True))]
        h += step
    return sa, rank


def packed(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one word (zeros past the end), without copying."""
    pad = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), "<u8", buffer=pad, strides=(1,))


def common_prefixes(data: np.ndarray, sa: np.ndarray, slots: np.ndarray, cap: int) -> np.ndarray:
    """Kasai: bytes shared (counted up to ``cap`` at the end of a run) by the suffixes in slots s and s-1.

    For ``slots`` whose pairs share at least one byte. Going through the text, a suffix shares one byte
    less with its neighbour than the suffix before it while both neighbours move together; so only the
    last suffix of each such run is compared byte by byte (eight at a time), and the others follow from it.
    """
    i, j = sa[slots].astype(np.int64), sa[slots - 1].astype(np.int64)
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    last = np.flatnonzero(np.append((i[1:] != i[:-1] + 1) | (j[1:] != j[:-1] + 1), True)) if len(i) else np.zeros(0, np.int64)
    n, word = len(data), packed(data)
    size, a, b = np.zeros(len(last), np.int64), i[last], j[last]
    alive = np.arange(len(last))
    while len(alive):  # whole words, then the bytes of the first unequal one
        p, q = a[alive] + size[alive], b[alive] + size[alive]
        ok = np.maximum(p, q) + 8 <= n
        ok[ok] = word[p[ok]] == word[q[ok]]
        alive = alive[ok]
        size[alive] += 8
        alive = alive[size[alive] < cap]
    alive = np.flatnonzero(size < cap)
    for _ in range(7):
        p, q = a[alive] + size[alive], b[alive] + size[alive]
        ok = np.maximum(p, q) < n
        ok[ok] = data[p[ok]] == data[q[ok]]
        alive = alive[ok]
        size[alive] += 1
    of = np.searchsorted(last, np.arange(len(i)))
    out = np.empty(len(i), np.int64)
    out[order] = size[of] + (i[last[of]] - i) if len(i) else 0
    return out
