"""Personal data: candidate generators, boosted trees over format and context, calibrated thresholds.

Exact base patterns (e-mail, IPv4, payment card, phone) always count. Beyond
them, generators with high recall propose overlapping spans: spelled-out
addresses, digit groups with unusual separators, dotted quads with noise, from
every digit group and at sign to every end within the kind's limits. Each
proposal is described by its format (digits, separators, Luhn, octets, ...) and
its context (neighbouring characters, nearby key words), scored by boosted
trees, and kept if it reaches its kind's threshold; of overlapping ones the best
stays, and none may touch a base span.

There are no hand labels: the trees learn from the excerpts around every span of
every row. Base spans, rewritten in unusual formats and with made-up names, in
their own sentences or among other words, are positive, and both rejected
look-alikes and digits with the same shapes but no personal meaning (dates,
prices, versions, codes) are negative. Trees are grown level by level: tasks count
histograms of their share of the examples, the driver adds them up and splits. A
fifth of the excerpts, with all that was made of them, sets each kind's threshold
at ``precision``; a kind that cannot reach it adds nothing.

Offsets are code points. Defined results: null text is empty and has no spans;
with no base span in any row nothing is added; repeated rows are judged one by
one; extra columns are ignored.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_blocks, rebuilt, string_column, utf8_parts, written

KINDS = ("email", "ip", "card", "phone")
PRECISION, CHUNK = 0.98, 4096
FEATURES, RATIO = 30, 21  # the feature RATIO is a share, the others are counts and flags
A_TASK, A_BLOCK, A_REDUCE = 1024, 1 << 16, 32  # excerpts a task rewrites, examples a task counts, partial sums the driver adds up itself
STEPS, UNIT = 4096, float(1 << 20)  # of a score, for the thresholds; of a gradient: whole numbers, whose sums are the same in any order

# The base patterns. A dotted quad cannot start inside a digit run (the rest of the run would
# fail or match from its start), so the look-behind changes no match and keeps long runs linear.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each base pattern that pass its check, by kind and start."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(int(p[-4:]) <= 255 and (len(p) < 4 or not p[:-3].strip("0")) for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


# Generators: wide on purpose. An address has at most 64 characters before its sign and a name of at most 253 after it.
_AT = r"(?:\s?@\s?|\s?[(\[{<]\s?(?:[Aa][Tt]|@)\s?[)\]}>]\s?|\s(?:at|AT)\s)"
_DOT = r"(?:\.|\s\.\s|\s?[(\[{<]\s?(?:[Dd][Oo][Tt]|\.)\s?[)\]}>]\s?|\s(?:dot|DOT)\s)"
LOCAL, NAME = 64, 253
_LABEL = r"[A-Za-z0-9-]{1,63}"
_SPELLED = re.compile(rf"(?<=[A-Za-z0-9._%+-])(?={_AT}({_LABEL}){_DOT}{_LABEL})")  # at every at sign, also inside another address
_MORE = re.compile(_DOT + _LABEL)
_GROUP = re.compile(r"[0-9]+")
_QUAD = re.compile(r"[0-9]{1,3}(?:\s?[(\[{]?(?:\.|[Dd][Oo][Tt])[)\]}]?\s?[0-9]{1,3}){3}(?![0-9])")
_CARD_GAP, _PHONE_GAP = frozenset(" ._/-"), frozenset(" ().-/")
_KEYS = {k: re.compile(p, re.I) for k, p in {
    "email": r"mail|contact|write|@", "ip": r"\bip\b|host|addr|server|login", "card": r"card|visa|pay|iban|account", "phone": r"phone|tel|call|mobile|fax|cell"}.items()}


def _chains(text: str, groups: list[tuple[int, int]], i: int, gap: frozenset, low: int, high: int) -> Iterator[int]:
    """Ends of the runs of digit groups from group ``i`` on with ``low`` to ``high`` digits, up to three characters of ``gap`` between groups."""
    n = 0
    for j in range(i, len(groups)):
        s, e = groups[j]
        if j > i:
            between = s - groups[j - 1][1]
            if between > 3 or not gap.issuperset(text[s - between:s]):
                return
        n += e - s
        if n > high:
            return
        if n >= low:
            yield e


def proposals(text: str) -> list[tuple[str, int, int]]:
    """Every candidate, overlapping ones included: from each at sign to each further label, from each digit group to each end within its kind's digits."""
    found = []
    for m in _SPELLED.finditer(text):
        start, end = m.start(), m.end(1)
        while start and m.start() - start < LOCAL and text[start - 1] in _LOCAL:
            start -= 1
        more = _MORE.match(text, end)
        while more and more.end() - m.start() <= NAME:
            end = more.end()
            found.append(("email", start, end))
            more = _MORE.match(text, end)
    groups = [m.span() for m in _GROUP.finditer(text)]
    for i, (s, e) in enumerate(groups):
        if e - s <= 3:
            quad = _QUAD.match(text, s)
            if quad:
                found.append(("ip", s, quad.end()))
        found += [("card", s, z) for z in _chains(text, groups, i, _CARD_GAP, 13, 19)]
        if e - s > 15:  # the last digits of a long run, as far as a number can reach
            found.append(("phone", e - 15, e))
        long = 17 if e - s > 2 and text.startswith("00", s) else 15  # 00 before the number itself
        for z in _chains(text, groups, i, _PHONE_GAP, 7, long):
            found.append(("phone", s, z))
            if text[s - 1:s] in ("+", "("):
                found.append(("phone", s - 1, z))
    return found


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    s = text[start:end]
    d = _digits(s)
    groups = [g for g in re.split(r"[^0-9]+", s) if g]
    octets = [int(g) for g in groups if len(g) < 4]
    sep = [c for c in s if not c.isalnum()]
    before, after = text[max(0, start - 1):start], text[end:end + 1]
    near = text[max(0, start - 32):start]
    return [KINDS.index(kind), len(s), len(d), len(s) - len(d) - len(sep), len(sep), len(set(sep)), len(groups),
            max(map(len, groups), default=0), min(map(len, groups), default=0), float(len(d) >= 12 and luhn(d)),
            float(len(octets) == 4 and max(octets) <= 255), max(octets, default=0), float(s[:1] == "+"), float("(" in s), float("@" in s),
            float(bool(re.search(r"\bat\b", s, re.I))), float(bool(re.search(r"\bdot\b", s, re.I))), float(before.isalnum()), float(after.isalnum()),
            float(before in "#$€£=\"'/:_-." and before != ""), float(after in "%€$°/:_\"'" and after != ""), len(set(d)) / max(1, len(d)),
            float(bool(_KEYS[kind].search(near))), float(d[:1] == "0"), float(len(re.split(_DOT, s)[-1])),
            float(s.count("(") != s.count(")")), float(bool(_GROUP.search(text, max(0, start - 2), start))), float(bool(_GROUP.search(text, end, end + 2))),
            float(before in "+(" and before != ""), float(bool(_MORE.match(text, end)))]


class _OneBlock:
    """A single block inside a task, with the steps of an RDD that training takes."""

    def __init__(self, block):
        self.block = block

    def map(self, f: Callable) -> "_OneBlock":
        return _OneBlock(f(self.block))

    def persist(self, _level) -> "_OneBlock":
        return self

    def unpersist(self) -> None:
        pass


class BoostedTrees:
    """Gradient boosting of shallow regression trees on binned features, logistic loss."""

    def __init__(self, rounds: int = 50, depth: int = 4, rate: float = 0.2, bins: int = 32, smallest: int = 8):
        self.rounds, self.depth, self.rate, self.bins, self.smallest = rounds, depth, rate, bins, smallest
        self.trees: list[list] = []

    def fit(self, examples: RDD) -> "BoostedTrees":
        """From blocks of (codes, labels, counts), a job for each level of each tree; of a single block, a task fits the same trees."""
        if examples.getNumPartitions() > 1:
            return self._fit(examples)
        settings = dict(vars(self))
        self.trees = examples.map(lambda block: rebuilt(BoostedTrees, settings)._fit(_OneBlock(block)).trees).first()
        return self

    def _fit(self, examples: RDD | _OneBlock) -> "BoostedTrees":
        cuts = _cuts(_added_up(examples.map(_value_counts)), self.bins)
        bins = _bin_table(cuts)
        binned = examples.map(lambda block: (bins[np.arange(FEATURES), block[0]], *block[1:])).persist(StorageLevel.MEMORY_AND_DISK)
        grown: list[list] = []  # the same trees on bins
        for _ in range(self.rounds):
            state = binned.map(_gradients(grown, self.depth)).persist(StorageLevel.MEMORY_AND_DISK)
            grown.append(self._grow(state, cuts))
            state.unpersist()
        binned.unpersist()
        scale = [256 if j == RATIO else 1 for j in range(FEATURES)]
        self.trees = [[(j, float(cuts[j][v]) / scale[j], a, z) if j >= 0 else (j, v, a, z) for j, v, a, z in tree] for tree in grown]
        return self

    def _grow(self, state: RDD | _OneBlock, cuts: list) -> list:
        """One tree, a level a job; inner nodes hold the bin they split after."""
        tree: list = [None]
        level = [0]
        for depth in range(self.depth):
            sums = _added_up(state.map(_histograms(list(tree), level, self.bins)))
            below: list[int] = []
            for at, (g, h, k) in zip(level, (sums[:, i] for i in range(len(level)))):
                g, h = g / UNIT, h / UNIT
                gs, hs, n = g[0].sum(), h[0].sum(), k[0].sum()
                gl, hl, kl = (np.cumsum(v, 1)[:, :-1] for v in (g, h, k))
                gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                gain[(kl < self.smallest) | (n - kl < self.smallest)] = 0
                for j, c in enumerate(cuts):
                    gain[j, len(c):] = 0
                j, t = divmod(int(gain.argmax()), gain.shape[1])
                if n < 2 * self.smallest or gain[j, t] <= 1e-6:
                    tree[at] = (-1, self.rate * gs / (hs + 1), 0, 0)
                    continue
                left, right = (gl[j, t], hl[j, t]), (gs - gl[j, t], hs - hl[j, t])
                tree[at] = (j, t, len(tree), len(tree) + 1)
                for gc, hc in (left, right):
                    below.append(len(tree))
                    tree.append((-1, self.rate * gc / (hc + 1), 0, 0) if depth == self.depth - 1 else None)
            level = below
            if not level:
                break
        return tree

    def score(self, x: np.ndarray) -> np.ndarray:
        f = np.zeros(len(x))
        for tree in self.trees:
            at = np.zeros(len(x), np.int64)
            nodes = np.array(tree, float)
            for _ in range(self.depth + 1):
                j = nodes[at, 0].astype(np.int64)
                inner = j >= 0
                right = x[np.arange(len(x)), np.maximum(j, 0)] > nodes[at, 1]
                at = np.where(inner, np.where(right, nodes[at, 3], nodes[at, 2]).astype(np.int64), at)
            f += nodes[at, 1]
        return 1 / (1 + np.exp(-f))


def _codes(x: np.ndarray) -> np.ndarray:
    """Features as bytes: a cut of codes is one of features (counts above 255 are one value, the share is in 256ths)."""
    x = x.copy()
    x[:, RATIO] *= 256
    return np.ceil(np.clip(x, 0, 255)).astype(np.uint8)


def _decoded(codes: np.ndarray) -> np.ndarray:
    x = codes.astype(float)
    x[:, RATIO] /= 256
    return x


def _added_up(parts: RDD | _OneBlock) -> np.ndarray:
    """Sum of arrays of whole numbers."""
    if isinstance(parts, _OneBlock):
        return parts.block
    return parts.reduce(np.add) if parts.getNumPartitions() <= A_REDUCE else parts.treeReduce(np.add)


def _value_counts(block: tuple) -> np.ndarray:
    """How often each code of each feature occurs."""
    codes, _, n = block
    return np.stack([np.bincount(codes[:, j], weights=n, minlength=256) for j in range(FEATURES)])


def _cuts(counts: np.ndarray, bins: int) -> list[np.ndarray]:
    """By feature the smallest value and the quantiles, the largest value excepted: a cut leaves something on both sides."""
    out = []
    for c in counts:
        total = np.cumsum(c)
        values = np.flatnonzero(c)
        ranks = np.linspace(0, 1, bins)[1:-1] * (total[-1] - 1)
        cuts = np.unique(np.concatenate([values[:1], np.searchsorted(total, ranks, side="right")]))
        out.append(cuts[cuts < values[-1]])
    return out


def _bin_table(cuts: list[np.ndarray]) -> np.ndarray:
    """The bin of each code of each feature."""
    return np.stack([np.searchsorted(c, np.arange(256), side="left") for c in cuts]).astype(np.uint8)


def _leaf_of(tree: list, bins: np.ndarray, depth: int) -> np.ndarray:
    """Where each row stands in a tree on bins; a node not split yet is None."""
    j, t, left, right = (np.array([0 if node is None or node[0] < 0 else node[i] for node in tree], np.int64) for i in range(4))
    inner = np.array([node is not None and node[0] >= 0 for node in tree])
    at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(depth):
        at = np.where(inner[at], np.where(bins[rows, j[at]] > t[at], right[at], left[at]), at)
    return at


def _gradients(trees: list[list], depth: int) -> Callable[[tuple], tuple]:
    def of(block: tuple) -> tuple:
        """Bins, counts, and the two derivatives of the loss after ``trees``, in whole units times the counts."""
        bins, y, n = block
        f = np.zeros(len(bins))
        for tree in trees:
            f += np.array([node[1] for node in tree], float)[_leaf_of(tree, bins, depth)]
        p = 1 / (1 + np.exp(-f))
        return bins, n, np.rint((y - p) * UNIT) * n, np.rint(p * (1 - p) * UNIT) * n

    return of


def _histograms(tree: list, level: list[int], bins: int) -> Callable[[tuple], np.ndarray]:
    def of(block: tuple) -> np.ndarray:
        """(derivatives and counts) by node of ``level``, feature and bin."""
        x, n, g, h = block
        place = np.full(len(tree), -1)
        place[level] = np.arange(len(level))
        node = place[_leaf_of(tree, x, len(tree).bit_length())]
        here = node >= 0
        x, node, weights = x[here], node[here], [w[here] for w in (g, h, n)]
        out = np.zeros((3, len(level), FEATURES, bins))
        for j in range(FEATURES):
            key = node * bins + x[:, j]
            for i, w in enumerate(weights):
                out[i, :, j] = np.bincount(key, weights=w, minlength=len(level) * bins).reshape(len(level), bins)
        return out

    return of


def _word(rng: random.Random, low: int, high: int) -> str:
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(low, high)))


def _rewrite(kind: str, s: str, rng: random.Random) -> str:
    """A base span in a format the base patterns miss; half of the addresses get made-up names, so that no name is learned."""
    if kind == "email":
        local, _, domain = s.partition("@")
        if rng.random() < 0.5:
            local = rng.choice(["", _word(rng, 1, 7) + rng.choice([".", "_", "-"])]) + _word(rng, 2, 9) + rng.choice(["", str(rng.randint(1, 99))])
            domain = ".".join([_word(rng, 2, 10) for _ in range(rng.randint(1, 3))] + [_word(rng, 2, 4)])
        at = rng.choice(["[at]", " [at] ", "(at)", " (at) ", "{at}", " at ", " AT ", " @ ", "@ ", " [AT] ", "<at>", " (@) "])
        dot = rng.choice([".", ".", " dot ", " [dot] ", "[dot]", "(dot)", " (dot) ", "{dot}", " DOT ", " . ", "[.]"])
        return local + at + domain.replace(".", dot)
    d = _digits(s)
    if kind == "ip":
        return s.replace(".", rng.choice(["[.]", " . ", "(.)", "[dot]", "(dot)", " dot ", "{.}"]))
    if kind == "card":
        if rng.random() < 0.5:  # other digits that pass the check
            d = "".join(rng.choice("0123456789") for _ in d[:-1])
            d = next(d + c for c in "0123456789" if luhn(d + c))
        sep = rng.choice([".", "_", "/", " - ", "  ", ". ", " / ", "--"])
        cut = rng.choice([4, 4, 4, 6, 8])
        return sep.join(d[i:i + cut] for i in range(0, len(d), cut))
    if rng.random() < 0.5:
        d = "".join(rng.choice("0123456789") for _ in range(10))
    d = d[-10:]
    a, b, c = d[:3], d[3:6], d[6:]
    return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"001 {a} {b} {c}", f"({a}){b}-{c}", f"{a}/{b}-{c}", f"{a} {b} {c}", f"1-{a}-{b}-{c}",
                       f"({a}) {b} {c}", f"0{a} {b}{c}", f"0{a}/{b}{c}", f"{a} - {b} - {c}", f"0{a}-{b}-{c}"])


def _harmless(rng: random.Random) -> str:
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    return rng.choice([
        f"{_word(rng, 2, 6)} at {_word(rng, 2, 6)}. {_word(rng, 2, 6)}", f"{_word(rng, 2, 6)} at {_word(rng, 2, 6)}.{_word(rng, 2, 6)}ing",
        f"{rng.randint(1900, 2035)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.{rng.randint(1900, 2035)}",
        f"{n(1)}.{n(2)}.{n(3)}.{rng.randint(300, 999)}", f"v{n(1)}.{n(1)}.{n(2)}", f"${n(3)},{n(3)}.{n(2)}", n(7), n(9), n(12), n(13), n(16), n(20), n(24),
        f"{n(4)} {n(4)} {n(4)} {n(4)}", f"{n(4)}-{n(4)}", f"{n(3)} {n(3)} {n(3)} {n(3)}", f"{n(5)}.{n(4)}", f"{n(2)}:{n(2)}:{n(2)}.{n(6)}", f"ISBN 978-{n(1)}-{n(4)}-{n(4)}-{n(1)}",
        f"look at this. And", f"meet at noon. Then", f"id={n(10)}", f"#{n(8)}", f"{n(8)}-{n(8)}"])


def _examples(rows: list[dict], times: int, seed: int) -> Iterator[tuple[str, list[tuple[list[float], bool, int, int]]]]:
    """Texts made of excerpts: the excerpt and its candidates' features, labels, starts and ends.

    A rewritten span stands in its own sentence, in its sentence cut short at either side, or among words of another excerpt."""
    plain = [" ".join(w for w in r["near"].split() if w.isalpha()) for r in rows]

    def learn(text: str, good: tuple[str, int, int] | None, lo: int, hi: int) -> list[tuple[list[float], bool, int, int]]:
        return [(features(text, kind, a, z), good == (kind, a, z), a, z) for kind, a, z in proposals(text) if z > lo and a < hi]

    def sides(t: str, a: int, z: int, rng: random.Random) -> tuple[str, str]:
        how = rng.randrange(3)
        if how == 0:
            return t[:a], t[z:]
        if how == 1:
            return t[max(0, a - rng.randint(0, 12)):a], t[z:z + rng.randint(0, 12)]
        other = rng.choice(plain).split()
        k = rng.randint(0, len(other))
        return "".join(w + " " for w in other[max(0, k - 4):k]), "".join(" " + w for w in other[k:k + 4])

    for r in rows:
        t, a, z = r["near"], r["a"], r["z"]
        rng = random.Random(f"{seed} {r['kind']} {a} {z} {t}")
        if r["kind"]:
            yield t, learn(t, (r["kind"], a, z), a, z)
            for _ in range(times):
                left, right = sides(t, a, z, rng)
                beside = rng.choice(["", "", _harmless(rng) + " "]), rng.choice(["", "", " " + _harmless(rng)])  # numbers right beside it
                new = _rewrite(r["kind"], t[a:z], rng)
                at = len(left) + len(beside[0])
                yield t, learn(left + beside[0] + new + beside[1] + right, (r["kind"], at, at + len(new)), at, at + len(new))
                left, right = sides(t, a, z, rng)
                other = _harmless(rng)
                if not base_spans(left[-1:] + other + right[:1]):  # digits that pass the check by chance are no look-alike
                    yield t, learn(left + other + right, None, len(left), len(left) + len(other))
        elif not any(p < z and q > a for _, p, q in base_spans(t)):
            yield t, learn(t, None, a, z)


def excerpts(docs: DataFrame) -> DataFrame:
    """near, kind, a, z: every different excerpt of 60 characters around a base span (its kind) or a run of digits (kind empty)."""
    some = docs.select(F.col("text").cast("string").alias("text")).filter(F.col("text").rlike("[0-9@]"))

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in range(b.num_rows):
                t = b.column(0)[x].as_py()
                spans = [(a, z, k) for k, a, z in base_spans(t)] + [(m.start(), m.end(), "") for m in re.finditer(r"[0-9][0-9 .-]{5,40}", t)]
                spans = [s for s in spans if s[1] - s[0] <= LOCAL + NAME]
                for i in range(0, len(spans), CHUNK):
                    out = [(t[max(0, a - 60):z + 60], k, min(a, 60), z - a + min(a, 60)) for a, z, k in spans[i:i + CHUNK]]
                    yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], ty) for c, ty in enumerate(
                        (pa.string(), pa.string(), pa.int32(), pa.int32()))], names=["near", "kind", "a", "z"])

    return some.mapInArrow(around, "near string, kind string, a int, z int").distinct()


def _made(found: DataFrame, times: int, tasks: int, hold: bool, seed: int) -> DataFrame:
    """Examples of all excerpts. To learn from: code, label and count of each (``codes`` of one). To check with: all
    candidates of a text in a row. With ``hold`` a fifth of the excerpts is for the check and the others to learn from, else all are for both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        learn: Counter = Counter()
        out: list[tuple] = []
        for near, made in _examples(rows, times, seed):
            if not made:
                continue
            codes = _codes(np.array([m[0] for m in made]))
            held = zlib.crc32(near.encode()) % 5 == 0
            if held or not hold:
                out.append((True, codes.tobytes(), bytes(m[1] for m in made), np.array([m[2:] for m in made], np.int32).tobytes(), 1))
            if not held or not hold:
                learn.update((c.tobytes(), m[1]) for c, m in zip(codes, made))
        out += [(False, c, bytes([y]), b"", n) for (c, y), n in learn.items()]
        for i in range(0, len(out), CHUNK):
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out[i:i + CHUNK]], ty) for c, ty in enumerate(
                (pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.int64()))], names=["check", "codes", "labels", "places", "n"])

    dealt = found.repartition(tasks, "near", "kind", "a", "z").sortWithinPartitions("near", "kind", "a", "z")
    return dealt.mapInArrow(run, "check boolean, codes binary, labels binary, places binary, n long")


def _blocks(learn: DataFrame) -> RDD:
    """(codes, labels, counts) of different examples, a block a partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[], [], []]
        for b in batches:
            parts[0] += b.column(0).to_pylist()
            parts[1] += b.column(1).to_pylist()
            parts[2].append(b.column(2).to_numpy())
        if parts[0]:
            yield pa.RecordBatch.from_pydict({"c": [b"".join(parts[0])], "y": [b"".join(parts[1])], "n": [np.concatenate(parts[2]).tobytes()]})

    def arrays(r) -> tuple:
        return np.frombuffer(r["c"], np.uint8).reshape(-1, FEATURES), np.frombuffer(r["y"], np.uint8), np.frombuffer(r["n"], np.int64)

    return learn.repartition(1 + learn.count() // A_BLOCK).mapInArrow(run, "c binary, y binary, n binary").rdd.map(arrays)


def _limits(check: DataFrame, trees: BoostedTrees, precision: float) -> dict[str, float]:
    """By kind the lowest threshold with ``precision``, to a step of the score: of overlapping candidates only the best is ever added."""
    shared = check.sparkSession.sparkContext.broadcast(dict(vars(trees)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = rebuilt(BoostedTrees, shared.value)
        for b in batches:
            best = []
            texts = [np.frombuffer(c, np.uint8).reshape(-1, FEATURES) for c in b.column(0).to_pylist()]
            scores = np.split(model.score(_decoded(np.concatenate(texts))), np.cumsum([len(t) for t in texts])[:-1]) if texts else []
            for x, p, y, place in zip(texts, scores, b.column(1).to_pylist(), b.column(2).to_pylist()):
                place = np.frombuffer(place, np.int32).reshape(-1, 2)
                taken: list[tuple[int, int]] = []
                for i in np.lexsort((-place[:, 1], place[:, 0], -p)).tolist():
                    a, z = place[i].tolist()
                    if not any(s < z and e > a for s, e in taken):
                        taken.append((a, z))
                        best.append((int(x[i, 0]), int(p[i] * STEPS), y[i]))
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in best], pa.int64()) for c in range(3)], names=["kind", "step", "y"])

    steps = check.select("codes", "labels", "places").mapInArrow(run, "kind long, step long, y long")
    right: dict[int, int] = {}
    seen, hit = Counter(), Counter()
    for r in steps.groupBy("kind", "step").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y")).orderBy(F.col("step").desc()).collect():
        seen[r["kind"]] += r["n"]
        hit[r["kind"]] += r["y"]
        if 2 * r["step"] >= STEPS and hit[r["kind"]] >= precision * seen[r["kind"]]:
            right[r["kind"]] = r["step"]
    return {KINDS[k]: step / STEPS for k, step in right.items()}


def train(docs: DataFrame, precision: float = PRECISION, seed: int = 9) -> tuple[BoostedTrees | None, dict[str, float]]:
    """Trees and thresholds by kind, from all rows: trees on four fifths of the excerpts, thresholds on the others. The driver
    gets histograms and score counts, whose size does not grow with the rows."""
    found = written(excerpts(docs), "pii_excerpts")
    n, spans = found.agg(F.count(F.lit(1)), F.count_if(F.col("kind") != "")).first()
    if not spans:
        return None, {}
    times, tasks = min(40, max(3, 4000 // spans)), 1 + n // A_TASK  # few spans are rewritten more often
    for hold in (True, False):  # all excerpts for both, if there is nothing to learn from or to check with
        made = written(_made(found, times, tasks, hold, seed), "pii_examples")
        learn = made.filter("NOT check").groupBy("codes", "labels").agg(F.sum("n").alias("n"))
        if not made.filter("NOT check AND labels = X'01'").isEmpty() and not made.filter("check").isEmpty():
            trees = BoostedTrees().fit(_blocks(learn))
            return trees, _limits(made.filter("check"), trees, precision)
    return None, {}


def added_spans(text: str, base: list, trees: BoostedTrees | None, limits: dict[str, float]) -> list[tuple[str, int, int]]:
    if trees is None or not limits:
        return []
    taken: list[tuple[int, int]] = []  # disjoint, in order
    for a, z in sorted((a, z) for _, a, z in base):
        if taken and a < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(z, taken[-1][1]))
        else:
            taken.append((a, z))

    def clear(a: int, z: int) -> int | None:
        """Where (a, z) goes among the taken spans, or None if it meets one."""
        at = bisect_left(taken, (z,))
        return None if at and taken[at - 1][1] > a else at

    free = [c for c in proposals(text) if c[0] in limits and clear(c[1], c[2]) is not None]
    if not free:
        return []
    p = np.concatenate([trees.score(np.array([features(text, *c) for c in free[x:x + CHUNK]])) for x in range(0, len(free), CHUNK)])
    out: list[tuple[str, int, int]] = []
    for i in sorted((i for i in range(len(free)) if p[i] >= limits[free[i][0]]), key=lambda i: (-p[i], free[i][1], -free[i][2])):
        kind, a, z = free[i]
        at = clear(a, z)
        if at is not None:
            taken.insert(at, (a, z))
            out.append(free[i])
    return out


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _found(state: tuple) -> Callable[[pa.Array], tuple[pa.Array, pa.Array]]:
    """A function that gives base and added spans of an array of texts."""
    trees, limits = state
    trees = rebuilt(BoostedTrees, trees) if trees is not None else None

    def of(col: pa.Array) -> tuple[pa.Array, pa.Array]:
        base, added = [], []
        for x in range(len(col)):
            text = col[x].as_py() or ""
            b = base_spans(text)
            for found, to in ((b, base), (added_spans(text, b, trees, limits), added)):
                to.append([{"kind": k, "start": s, "end": e} for k, s, e in sorted(found, key=lambda f: (KINDS.index(f[0]), f[1]))])
        return pa.array(base, _ARROW_SPANS), pa.array(added, _ARROW_SPANS)

    return of


def _state(model: tuple[BoostedTrees | None, dict[str, float]]) -> tuple:
    return (dict(vars(model[0])) if model[0] is not None else None, model[1])


def find(docs: DataFrame, model: tuple[BoostedTrees | None, dict[str, float]], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus base and added: arrays of (kind, start, end), by kind and start."""
    shared = docs.sparkSession.sparkContext.broadcast(_state(model))
    source = docs.select(*keep, F.col("text").cast("string").alias("_text"), F.expr(f"CAST(array() AS {SPANS})").alias("base"),
                         F.expr(f"CAST(array() AS {SPANS})").alias("added"))
    schema = source.drop("_text").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _found(shared.value)
        for batch in batches:
            col = string_column(batch, "_text")
            for i, j in doc_blocks(utf8_parts(col)[1], 8 << 20):
                cols = [batch.column(c).slice(i, j - i) for c in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*cols, *of(col.slice(i, j - i))], names=[*keep, "base", "added"])

    return source.mapInArrow(run, schema)


def span_column(docs: DataFrame, text: Column, model: tuple[BoostedTrees | None, dict[str, float]]) -> Column:
    """struct(base, added) as a column: only the text goes to Python, and only the spans come back."""
    shared = docs.sparkSession.sparkContext.broadcast(_state(model))

    @F.arrow_udf(f"struct<base:{SPANS},added:{SPANS}>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = _found(shared.value)
        for col in texts:
            yield pa.StructArray.from_arrays(of(col), ["base", "added"])

    return run(text.cast("string"))


def redacted(text: Column, base: Column | str = "base", added: Column | str = "added") -> Column:
    """``text`` with every span of ``base`` and ``added`` replaced by its kind in brackets; overlapping spans become one."""
    spans = F.array_sort(F.transform(F.concat(base, added), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(done: Column, s: Column) -> Column:
        between = F.substring(text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        more = F.concat(done["out"], between, F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.when(s["start"] >= done["at"], more).otherwise(done["out"]).alias("out"), F.greatest(done["at"], s["end"]).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    return F.aggregate(spans, start, step, lambda done: F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text))))
