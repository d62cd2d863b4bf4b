"""Repair of conversation structure by the cheapest edits, ties to the ASCII-least audit.

A conversation's rows, by turn, are kept (K), given role user or assistant (R),
deleted (D, required for blank rows and repeats), and empty rows of role user or
assistant are inserted (I), until the initials of the roles read ``(s?(ua)+)?``.
Keeping costs 0, R and I 2, D 3, and a truncated row that stays 1 more. The audit is
the edits' initials in order.

The method, over blocks of ``BLOCK`` rows in the order (conversation, turn, role,
text's hash): the four states of the pattern (nothing yet, after s, after u, after a)
make a row a 4 x 4 cost matrix, and the cheapest cost from every row to its
conversation's end is a product of such matrices under (min, +), taken by doubling.
The arcs on cheapest paths are then ranked by their least audit of 1, 2, 4, ...
edits: the rank of length 2L is that of the pair (rank at L, rank at L of the arc
that the pointer reaches after L edits), and pointers double alike. A label leaves a
node by one arc at most, so a pointer is decided by the labels before it. At its
first node a path takes the arc of least rank, and the doubled pointers mark all
arcs behind it.

A conversation may span any number of blocks, so none is ever held whole: blocks
give the cost matrix of their first and last conversation, one small task a
conversation multiplies these from its end, and a block that starts inside a
conversation ranks the paths from all four states, of which the state that the
blocks before it leave is picked. An audit is one cell of at most 2**31 characters,
so such a task holds at most 2**31 / BLOCK matrices.

Rows alike in conversation, turn, role and text are counted before the shuffle: all
but the first are deleted at cost 3, right after it, as D comes first among equally
cheap edits. Texts are shuffled once, for the repaired conversation, and pass their
task as a stream. Order among rows of one turn: role, then SHA-256 of the text.

Defined results: a null role or text counts as one space; rows with null conv_id are
one conversation; null turns come first; a repeat is a row whose role and text came
earlier in the conversation; conversations whose rows are all deleted, or that have
none, are empty; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

BLOCK_BITS = 12
BLOCK = 1 << BLOCK_BITS
FAR = 1 << 60

# Edits by rising ASCII code, and what they cost.
EDITS = "DIKR"
DELETE, INSERT, KEEP, REROLE = range(4)
COST = (3, 2, 0, 2)
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"

OTHER, SYSTEM, USER, ASSISTANT, FORCED = range(5)  # a row by its role's initial; FORCED rows must be deleted
START, AFTER_S, AFTER_U, AFTER_A = range(4)
ADVANCE = np.array([AFTER_U, AFTER_U, AFTER_A, AFTER_U])  # the state after one more user or assistant row
TAIL = np.array([0, 4, 2, 0])  # cost of the inserts that end a conversation in each state
KEPT = np.full((5, 4), -1)  # the state that keeping a row leads to, by kind and state
KEPT[SYSTEM, START] = AFTER_S
KEPT[USER, [START, AFTER_S, AFTER_A]] = AFTER_U
KEPT[ASSISTANT, AFTER_U] = AFTER_A


# --- costs -----------------------------------------------------------------------------------

def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of 4 x 4 matrices under (min, +)."""
    return np.minimum((a[:, :, :, None] + b[:, None, :, :]).min(2), FAR)


def row_costs(kind: np.ndarray, truncated: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """Cheapest cost of every row from each state before it to each state after it, inserts before it included."""
    n = len(kind)
    act = np.full((n, 4, 4), FAR)
    for s in range(4):
        act[:, s, s] = COST[DELETE]
    rows = np.arange(n)
    stays = kind != FORCED
    for s in range(4):
        r = rows[stays]
        act[r, s, ADVANCE[s]] = np.minimum(act[r, s, ADVANCE[s]], COST[REROLE] + truncated[r])
        to = KEPT[kind, s]
        r = rows[to >= 0]
        act[r, s, to[r]] = np.minimum(act[r, s, to[r]], COST[KEEP] + truncated[r])
    act += (COST[DELETE] * (copies - 1))[:, None, None]
    best = act
    for _ in range(2):  # up to two inserts on the way
        best = np.minimum(best, COST[INSERT] + best[:, ADVANCE, :])
    return np.minimum(best, FAR)


def to_end(cost: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Product of the matrices from every row to the last of its piece, by doubling."""
    out, step = cost.copy(), 1
    longest = np.bincount(piece).max(initial=0)
    while step < longest:
        i = np.flatnonzero(piece[:-step] == piece[step:])
        out[i] = times(out[i], out[i + step])
        step *= 2
    return out


# --- paths -----------------------------------------------------------------------------------

class Paths:
    """The arcs on cheapest paths of one block, ranked by least audit, and pointers of power-of-two length."""

    def __init__(self, kind: np.ndarray, truncated: np.ndarray, copies: np.ndarray, piece: np.ndarray, ends: np.ndarray):
        n, last = len(kind), np.r_[piece[1:] != piece[:-1], True]
        total = to_end(row_costs(kind, truncated, copies), piece)
        left = np.minimum((total + ends[piece][:, None, :]).min(2), FAR)  # from (row, state) to the conversation's end
        value = np.concatenate([left.ravel(), ends.ravel()])  # nodes: 4 a row, then 4 where each piece ends
        after = np.where(last, 4 * n + 4 * piece, 4 * np.arange(1, n + 1))[:, None]
        state = np.arange(4)[None, :]
        extra = (COST[DELETE] * (copies - 1))[:, None]
        head, cost = np.full((4, n, 4), -1), np.zeros((4, n, 4), np.int64)
        head[DELETE], cost[DELETE] = after + state, COST[DELETE] + extra
        head[INSERT], cost[INSERT] = 4 * np.arange(n)[:, None] + ADVANCE[state], COST[INSERT]
        to = KEPT[kind]
        head[KEEP], cost[KEEP] = np.where(to >= 0, after + to, -1), COST[KEEP] + truncated[:, None] + extra
        head[REROLE], cost[REROLE] = np.where(kind[:, None] != FORCED, after + ADVANCE[state], -1), COST[REROLE] + truncated[:, None] + extra
        tight = (head >= 0) & (cost + value[head] == left)
        row, at, label = np.nonzero(np.moveaxis(tight, 0, 2))
        self.row, self.state, self.label, self.head = row, at, label, head[label, row, at]
        node, stop = 4 * row + at, len(row)
        self.first = np.searchsorted(node, np.arange(4 * n + 1))
        leave = np.full(len(value), stop)
        leave[:4 * n] = self.first[:-1]
        self.n = n
        rank, ptr = np.r_[label + 1, 0], np.r_[leave[self.head], stop]
        self.pointers = [ptr]
        while (ptr != stop).any():
            rank = np.unique(rank * (rank.max() + 1) + rank[ptr], return_inverse=True)[1]
            ptr = ptr[ptr]
            self.pointers.append(ptr)
        self.rank = rank

    def follow(self, rows: np.ndarray, state: int) -> np.ndarray:
        """Mask of the arcs on the least paths from ``state`` before each of ``rows`` (the first rows of pieces)."""
        on = np.zeros(len(self.rank), bool)
        for r in rows:
            a, b = self.first[4 * r + state], self.first[4 * r + state + 1]
            on[a + int(self.rank[a:b].argmin())] = True
        for ptr in self.pointers:
            on[ptr[np.flatnonzero(on)]] = True
        return on[:-1]

    def codes(self, on: np.ndarray) -> np.ndarray:
        """Per row: state before the edit + 4 * edit + 16 * inserts before it (-1 where no path passes)."""
        out = np.full(self.n, -1)
        act = on & (self.label != INSERT)
        out[self.row[act]] = self.state[act] + 4 * self.label[act]
        put = np.bincount(self.row[on & (self.label == INSERT)], minlength=self.n)
        return np.where(out >= 0, out + 16 * put, -1)

    def leaves(self, on: np.ndarray, row: int) -> int:
        """The state after ``row``, the last of a piece."""
        act = np.flatnonzero(on & (self.label != INSERT) & (self.row == row))
        return int(self.head[act[0]] % 4)


def inserted(code: int) -> list[str]:
    """Roles of the rows inserted before a row's edit."""
    state, put = code % 4, code // 16
    names = ["user", "assistant"]
    return [names[(state - AFTER_U - back) % 2] for back in range(put - 1, -1, -1)]


# --- blocks ----------------------------------------------------------------------------------

def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one block at a time (the stream is sorted by block)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        block = batch.column(0).to_numpy()
        cuts = np.r_[0, np.flatnonzero(block[1:] != block[:-1]) + 1, len(block)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            if held and held[0].column(0)[0].as_py() != int(block[a]):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _features(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """kind, truncated, copies and number of the piece of a block's rows."""
    conv = pc.dictionary_encode(t.column("conv_id").combine_chunks(), null_encoding="encode").indices.to_numpy()
    piece = np.r_[0, np.cumsum(conv[1:] != conv[:-1])] if len(conv) else np.zeros(0, np.int64)
    return (t.column("kind").to_numpy().astype(np.int64), t.column("truncated").to_numpy().astype(np.int64),
            t.column("copies").to_numpy().astype(np.int64), piece)


def _borders(ordered: DataFrame, key: str) -> DataFrame:
    """conv_id, block, m: the cost matrix of the first and the last conversation's rows of every block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _blocks(batches):
            kind, truncated, copies, piece = _features(t)
            first = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
            spans = [(int(first[k]), int(first[k + 1]) if k + 1 < len(first) else len(piece)) for k in sorted({0, len(first) - 1})]
            m = [to_end(row_costs(kind[a:b], truncated[a:b], copies[a:b]), np.zeros(b - a, np.int64))[0].ravel().tolist() for a, b in spans]
            yield pa.RecordBatch.from_arrays([pc.take(t.column("conv_id"), pa.array([a for a, _ in spans])).combine_chunks(),
                                              pa.array([t.column(0)[0].as_py()] * len(spans), pa.int64()), pa.array(m, pa.list_(pa.int64()))],
                                             names=["conv_id", "block", "m"])

    return _by_block(ordered.select("block", "id", "conv_id", "kind", "truncated", "copies")).mapInArrow(
        run, f"conv_id {key}, block long, m array<long>")


def _by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition("block").sortWithinPartitions("block", "id")


def _ends(pieces: DataFrame) -> DataFrame:
    """block, goes_on (costs of the states after a block's last conversation, null if it ends there), continued."""
    def run(t: pa.Table) -> pa.Table:
        order = np.argsort(t.column("block").to_numpy(), kind="stable")
        block = t.column("block").to_numpy()[order]
        m = np.array(t.column("m").to_pylist(), np.int64).reshape(-1, 4, 4)[order]
        ends, v = [], TAIL
        for k in range(len(block) - 1, -1, -1):
            ends.append(v.tolist() if k < len(block) - 1 else None)
            v = np.minimum((m[k] + v[None, :]).min(1), FAR)
        some = slice(0, len(block) if len(block) > 1 else 0)
        return pa.table([pa.array(block[some], pa.int64()), pa.array(ends[::-1][some], pa.list_(pa.int64())),
                         pa.array((np.arange(len(block)) > 0)[some])], names=["block", "goes_on", "continued"])

    found = pieces.groupBy("conv_id").applyInArrow(run, "block long, goes_on array<long>, continued boolean")
    # a block's first and last conversation differ, or are one that continues on both sides
    return found.groupBy("block").agg(F.max("goes_on").alias("goes_on"), F.max("continued").alias("continued"))


def _ranked(ordered: DataFrame, ends: DataFrame, key: str) -> DataFrame:
    """The ordered rows with codes c0 .. c3 (by the state before the block's first conversation, where it is continued: ``open``),
    and a row (id null) for every conversation that crosses a border of the block, with the states it leaves there."""
    columns = ["block", "id", "conv_id", "turn", "role", "digest", "copies", "kind", "blank", "truncated"]
    kinds = ["long", "long", key, "long", "string", "binary", "long", "int", "boolean", "boolean"]
    codes = ["c0", "c1", "c2", "c3"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _blocks(batches):
            mark = pc.is_null(t.column("id"))
            marks, rows = t.filter(mark), t.filter(pc.invert(mark)).combine_chunks()
            if not rows.num_rows:
                continue
            goes_on = marks.column("goes_on")[0].as_py() if marks.num_rows else None
            continued = bool(marks.num_rows and marks.column("continued")[0].as_py())
            kind, truncated, copies, piece = _features(rows)
            ends = np.tile(TAIL, (piece[-1] + 1, 1))
            if goes_on:
                ends[-1] = goes_on
            paths = Paths(kind, truncated, copies, piece, ends)
            first = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
            plain = first[1:] if continued else first
            on = paths.follow(plain, START)
            base = paths.codes(on)
            out, borders = [base] * 4, []  # (row, states left, open): the continued conversation and the one that goes on
            if continued:
                runs = [paths.follow(first[:1], s) for s in range(4)]
                out = [np.where(piece == 0, paths.codes(r), base) for r in runs]
                borders.append((0, [paths.leaves(r, paths.n - 1) for r in runs] if len(first) == 1 else [-1] * 4, True))
            if goes_on and not (continued and len(first) == 1):
                borders.append((paths.n - 1, [paths.leaves(on, paths.n - 1)] * 4, False))
            fields = [rows.column(c).combine_chunks() for c in columns]
            yield pa.RecordBatch.from_arrays(fields + [pa.array(o, pa.int32()) for o in out] + [pa.array(continued & (piece == 0))],
                                             names=[*columns, *codes, "open"])
            for row, leave, open_ in borders:
                one = [rows.column(c).slice(row, 1).combine_chunks() if c in ("block", "conv_id") else pa.nulls(1, rows.column(c).type) for c in columns]
                yield pa.RecordBatch.from_arrays(one + [pa.array([x], pa.int32()) for x in leave] + [pa.array([open_])], names=[*columns, *codes, "open"])

    schema = ", ".join(f"{c} {k}" for c, k in zip(columns, kinds)) + ", " + ", ".join(f"{c} int" for c in codes) + ", open boolean"
    given = ordered.select(*columns, F.lit(None).cast("array<long>").alias("goes_on"), F.lit(None).cast("boolean").alias("continued"))
    marks = ends.select("block", *[F.lit(None).cast(k).alias(c) for c, k in zip(columns[1:], kinds[1:])], "goes_on", "continued")
    return _by_block(given.unionByName(marks)).mapInArrow(run, schema)


def _entries(borders: DataFrame) -> DataFrame:
    """block, entry: the state in which a block's first conversation comes in."""
    def run(t: pa.Table) -> pa.Table:
        order = np.argsort(t.column("block").to_numpy(), kind="stable")
        block, open_ = t.column("block").to_numpy()[order], t.column("open").to_numpy(zero_copy_only=False)[order]
        leave = np.stack([t.column(f"c{s}").to_numpy()[order] for s in range(4)], 1)
        out, state = [], START
        for k in range(len(block)):
            if open_[k]:
                out.append((int(block[k]), state))
            state = int(leave[k][state])
        return pa.table([pa.array([b for b, _ in out], pa.int64()), pa.array([s for _, s in out], pa.int32())], names=["block", "entry"])

    return borders.groupBy("conv_id").applyInArrow(run, "block long, entry int")


# --- the operator ----------------------------------------------------------------------------

def features(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (nulls: one space), digest, blank, truncated."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")).select(
        "*", F.unhex(F.substring(F.sha2("text", 256), 1, 32)).alias("digest"), (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("truncated"))


def plan_edits(rows: DataFrame) -> DataFrame:
    """One row per distinct (conv_id, turn, role, digest) with its copies, faults and ``code`` (see :meth:`Paths.codes`)."""
    key = rows.schema["conv_id"].dataType.simpleString()
    runs = features(rows).groupBy("conv_id", "turn", "role", "digest").agg(
        F.count(F.lit(1)).alias("copies"), F.max("blank").alias("blank"), F.max("truncated").alias("truncated"))
    at = F.struct(F.col("turn").isNotNull().alias("k"), F.coalesce("turn", F.lit(0)).alias("turn"))
    seen = runs.groupBy("conv_id", "role", "digest").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    r, s = runs.alias("r"), seen.select("conv_id", "role", "digest", "first").alias("s")
    faults = r.join(s, F.col("r.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("r.role") == F.col("s.role")) & (F.col("r.digest") == F.col("s.digest")),
                    "left").select("r.*", F.coalesce(F.struct(F.col("r.turn").isNotNull().alias("k"), F.coalesce("r.turn", F.lit(0)).alias("turn")) != F.col("s.first"),
                                                     F.lit(False)).alias("repeat"))
    initial = F.substring("role", 1, 1)
    kind = F.when(F.col("blank") | F.col("repeat"), FORCED).when(initial == "s", SYSTEM).when(initial == "u", USER).when(
        initial == "a", ASSISTANT).otherwise(OTHER)
    order = ("conv_id", "turn", "role", "digest")
    placed = faults.select(*order, "copies", kind.alias("kind"), "blank", (F.col("truncated") & ~F.col("blank") & ~F.col("repeat")).alias("truncated"))
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id())
    ordered = written(placed.withColumn("block", F.shiftright("id", BLOCK_BITS)), "turns")
    ranked = written(_ranked(ordered, _ends(_borders(ordered, key)), key), "edits")
    entry = _entries(ranked.filter("id IS NULL"))
    edits = ranked.filter("id IS NOT NULL").join(entry, "block", "left")
    code = F.when(F.col("open"), F.get(F.array("c0", "c1", "c2", "c3"), F.col("entry"))).otherwise(F.col("c0"))
    return edits.select(*order, "copies", "kind", "blank", "truncated", code.alias("code"))


class _Conversation:
    """What is known of one conversation while its rows pass."""

    def __init__(self, conv: object):
        self.conv, self.state, self.cost, self.audit = conv, START, 0, []
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.low = self.high = self.initial = None
        self.pending: tuple | None = None
        self.lines = 0
        self.hash = hashlib.sha256()

    def line(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
        self.lines += 1

    def edit(self, turn: int | None, role: str, copies: int, kind: int, blank: bool, truncated: bool, code: int) -> Iterator[tuple[str, str, str]]:
        """Take in a row and its edit; gives the rows inserted before it as (edit, role, text)."""
        if turn is not None:
            self.distinct += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        initial = role[:1]
        for a, n in ((self.initial, 1), (initial, copies - 1)):
            if a is not None and a + initial not in ("su", "ua", "au"):
                self.illegal += n
        self.initial = initial
        self.blank += copies if blank else 0
        self.duplicate += 0 if blank else copies - (kind != FORCED)
        self.truncated += truncated
        before = inserted(code)
        self.audit.append("I" * len(before) + EDITS[code // 4 % 4] + "D" * (copies - 1))
        label, state = code // 4 % 4, code % 4
        self.cost += COST[INSERT] * len(before) + COST[label] + COST[DELETE] * (copies - 1) + (truncated and label != DELETE)
        for name in before:
            self.line(name, "")
            yield "I", name, ""
        if label == KEEP:
            self.state, self.pending = int(KEPT[kind, state]), ("K", role)
        elif label == REROLE:
            self.state = int(ADVANCE[state])
            self.pending = ("R", "user" if self.state == AFTER_U else "assistant")
        else:
            self.state, self.pending = state, None

    def text(self, text: str) -> Iterator[tuple[str, str, str]]:
        """The text of the row just taken in; further copies of it are ignored."""
        if self.pending:
            edit, role = self.pending
            self.pending = None
            self.line(role, text)
            yield edit, role, text

    def close(self) -> Iterator[tuple[str, str, str]]:
        """The inserts that end the conversation."""
        while self.state in (AFTER_S, AFTER_U):
            self.state = int(ADVANCE[self.state])
            name = "user" if self.state == AFTER_U else "assistant"
            self.audit.append("I")
            self.cost += COST[INSERT]
            self.line(name, "")
            yield "I", name, ""

    def summary(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


def _passed(rows: DataFrame, conversations: DataFrame | None) -> DataFrame:
    """Per conversation in order: a marker (kind -1), every edit, and behind each the texts of its rows."""
    columns = {"conv_id": rows.schema["conv_id"].dataType.simpleString(), "turn": "long", "role": "string", "digest": "binary", "part": "int",
               "copies": "long", "kind": "int", "blank": "boolean", "truncated": "boolean", "code": "int", "text": "string"}

    def shaped(d: DataFrame, part: int) -> DataFrame:
        return d.select(*[F.lit(part).alias(c) if c == "part" else F.col(c) if c in d.columns else F.lit(None).cast(t).alias(c) for c, t in columns.items()])

    texts = features(rows).filter("NOT blank").select("conv_id", "turn", "role", "digest", "text")
    every = (conversations if conversations is not None else rows).select("conv_id").distinct()
    both = shaped(every, -1).unionByName(shaped(plan_edits(rows), 0)).unionByName(shaped(texts, 1))
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest", "part")


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Conversation, tuple | None]]:
    """(conversation, repaired row) for every repaired row, and (conversation, None) where one is complete."""
    now: _Conversation | None = None
    for batch in batches:
        for conv, turn, role, _, part, copies, kind, blank, truncated, code, text in zip(*[c.to_pylist() for c in batch.columns]):
            if part < 0:
                if now:
                    yield from ((now, r) for r in now.close())
                    yield now, None
                now = _Conversation(conv)
            elif part:
                yield from ((now, r) for r in now.text(text))
            else:
                yield from ((now, r) for r in now.edit(turn, role, copies, kind, blank, truncated, code))
    if now:
        yield from ((now, r) for r in now.close())
        yield now, None


def repair(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 1), edit (K, R or I), role, text."""
    key = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_type, out = None, []

        def ready() -> pa.RecordBatch:
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (conv_type, pa.int64(), pa.string(), pa.string(), pa.string()))],
                                              names=["conv_id", "place", "edit", "role", "text"])

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal conv_type
            for b in batches:
                conv_type = b.column(0).type
                yield b

        held = 0
        for now, row in _stream(typed()):
            if row is not None:
                out.append((now.conv, now.lines, *row))
                held += len(row[2]) + 64
            if held > 1 << 20:
                yield ready()
                out, held = [], 0
        if out:
            yield ready()

    return _passed(rows, None).mapInArrow(run, f"conv_id {key}, place long, edit string, role string, text string")


def audit(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Faults, cost, audit and the hash of the repaired text of every conversation (of ``conversations``, which may have no rows left)."""
    key = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_type, out, held = None, [], 0

        def ready() -> pa.RecordBatch:
            kinds = [conv_type] + [pa.int64()] * 6 + [pa.string()] * 2
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal conv_type
            for b in batches:
                conv_type = b.column(0).type
                yield b

        for now, row in _stream(typed()):
            if row is None:
                out.append(now.summary())
                held += len(out[-1][7]) + 128
            if held > 1 << 20:
                yield ready()
                out, held = [], 0
        if out:
            yield ready()

    return _passed(rows, conversations).mapInArrow(
        run, f"conv_id {key}, " + ", ".join(f"{c} long" for c in names[1:7]) + ", audit string, repaired_sha256 string")
