"""Conversation repair, whitening and packing against brute force."""
import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dealstream.llm import packing, queries, turns, whitening

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


# --- conversation repair ---------------------------------------------------------------------

def brute_repair(rows):
    """Cheapest edits of one conversation's (turn, role, text) rows, ties to the least audit, by plain recursion over suffixes."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    seen, out = set(), {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    kinds = []
    for _, role, text in rows:
        bare = text.rstrip(SPACE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        kinds.append(fault)
        if fault:
            out[fault] += 1
    out["illegal"] = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    known = sorted({t for t, _, _ in rows if t is not None})
    out["gaps"] = known[-1] - known[0] + 1 - len(known) if known else 0
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {s: min(x for x in [(0, "", ()) if s in ("", "a") else None, (4, "II", ("user:", "assistant:")) if s == "s" else None,
                               (2, "I", ("assistant:",)) if s == "u" else None] if x) for s in follow}
    full = {"u": "user", "a": "assistant"}
    for (_, role, text), fault in zip(reversed(rows), reversed(kinds)):
        now = {}
        for s, nxt in follow.items():
            options = [(best[s][0] + 3, "D" + best[s][1], best[s][2])]
            if fault not in ("blank", "duplicate"):
                cut = fault == "truncated"
                options.append((best[nxt][0] + 2 + cut, "R" + best[nxt][1], (f"{full[nxt]}:{text}", *best[nxt][2])))
                c = role[:1]
                if c == nxt or (c == "s" and s == ""):
                    options.append((best[c][0] + cut, "K" + best[c][1], (f"{role}:{text}", *best[c][2])))
            now[s] = min(options)
        for _ in range(3):
            now = {s: min(now[s], (now[n][0] + 2, "I" + now[n][1], (full[n] + ":", *now[n][2]))) for s, n in follow.items()}
        best = now
    cost, audit, lines = best[""]
    return {**out, "cost": cost, "audit": audit, "lines": lines, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def conversations(seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "unknown", "", None, "é"]
    texts = ["Yes.", "No!", "cut off", "", " \n", None, "Why?\n ", "end. x"]
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, rng.choice([turn, turn, turn, None, turn // 2]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"t{rng.random()}."))
    hot = [(1000, t, rng.choice(roles), f"{rng.choice(['a', 'b.', 'c!'])}{rng.randint(0, 150)}{rng.choice(['', '.'])}") for t in range(300)]
    return rows + hot + [(1000, 7, "user", "same.")] * 70 + [(None, 1, "user", "x."), (None, 2, "user", "y.")]


@pytest.mark.parametrize("bits", [2, 5, 12])
def test_repairs_equal_brute_force(spark, monkeypatch, bits):
    rows = conversations(bits)
    monkeypatch.setattr(turns, "BLOCK_BITS", bits)
    given_rows = spark.createDataFrame(rows, SCHEMA)
    for name in ("digest", "kind", "block", "code", "id", "part"):
        given_rows = given_rows.withColumn(name, given_rows.turn)
    got = {r["conv_id"]: r.asDict() for r in turns.audit(given_rows).collect()}
    lines = {}
    for r in turns.repair(given_rows).collect():
        lines.setdefault(r["conv_id"], []).append((r["place"], f"{r['role']}:{r['text']}"))
    for conv in {r[0] for r in rows}:
        want = brute_repair([r[1:] for r in rows if r[0] == conv])
        assert {k: got[conv][k] for k in want if k != "lines"} == {k: v for k, v in want.items() if k != "lines"}
        assert [x for _, x in sorted(lines.get(conv, []))] == list(want["lines"])


def test_conversations_without_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert turns.audit(none).count() == 0 and turns.repair(none).count() == 0
    every = spark.createDataFrame([(3,), (3,), (None,)], "conv_id long")
    got = sorted(map(tuple, turns.audit(none, every).collect()), key=str)
    assert got == sorted([(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in (3, None)], key=str)


def test_op11_sql_on_odd_rows(spark, tmp_path):
    spark.createDataFrame(conversations(1)[:200] + [(None, None, None, None)] * 2 + [(c, None, "user", "x.") for c in range(60, 90)], SCHEMA).coalesce(1).write.parquet(
        str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.sql(queries.ORACLE["op11_conversation_repair"])
    got = queries.op11(spark, str(tmp_path)).select(*want.columns).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want.fetchall(), key=str)


def test_pointer_ranks_order_whole_audits():
    """The rank of every arc at the first node orders the audits that start with it."""
    rng = np.random.default_rng(4)
    kind, cut = rng.integers(0, 5, 40), np.zeros(40, np.int64)
    p = turns.Paths(kind, cut, np.ones(40, np.int64), np.zeros(40, np.int64), np.tile(turns.TAIL, (1, 1)))

    def least(arc):
        out = ""
        while arc < len(p.row):
            out += turns.EDITS[p.label[arc]]
            arc = p.pointers[0][arc]
        return out

    audits = [least(a) for a in range(len(p.row))]
    order = sorted(range(len(audits)), key=lambda a: audits[a])
    assert all((audits[a] == audits[b]) == (p.rank[a] == p.rank[b]) and p.rank[a] <= p.rank[b] for a, b in zip(order, order[1:]))


# --- whitening -------------------------------------------------------------------------------

def vectors(rng, n, d, scale=0.2):
    return (rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) * scale).astype(np.float32)


@pytest.mark.parametrize("n,d,scale,chunk", [(700, 6, 0.2, 1 << 21), (700, 6, 0.2, 600), (90, 12, 1e9, 1 << 21), (300, 3, 1e-5, 64)])
def test_bit_sliced_products_are_exact(spark, monkeypatch, n, d, scale, chunk):
    monkeypatch.setattr(whitening, "CHUNK", chunk)
    v = vectors(np.random.default_rng(n), n, d, scale)
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>").repartition(3)
    used, width = whitening.usable(rows)
    count, low, high = whitening.ranges(used, width)
    sums, products = whitening.scatter(used, width, low, [(b - a).bit_length() for a, b in zip(low, high)])
    x = [[int(np.floor(1024 * float(c))) + 100000 for c in row] for row in v]
    assert (count, low, high) == (n, [min(c) for c in zip(*x)], [max(c) for c in zip(*x)])
    y = [[a - b for a, b in zip(row, low)] for row in x]
    assert sums == [sum(c) for c in zip(*y)]
    assert all(products.get((i, j), 0) == sum(r[i] * r[j] for r in y) for i in range(d) for j in range(i, d))


def test_whitened_rows_against_numpy(spark):
    v = vectors(np.random.default_rng(3), 400, 10)
    odd = [(900, None), (901, [0.1] * 9 + [None]), (902, [0.1] * 9 + [float("nan")]), (903, [0.1] * 9 + [float("inf")]), (904, [0.5] * 4), (905, [])]
    rows = [(i % 390, x.tolist()) for i, x in enumerate(v)] + odd + [(None, v[5].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for name in ("n", "w", "dim", "component", "deviation"):
        df = df.withColumn(name, df.vec_id)
    got = whitening.whiten(df).toPandas()
    x = np.floor(1024 * np.array([*map(list, v), list(v[5])], float)) + 100000
    e, w = np.linalg.eigh(np.cov(x.T, bias=True))
    want = (x - x.mean(0)) @ w[:, ::-1][:, :8] / np.sqrt(e[::-1][:8])
    assert len(got) == 8 * 401 and set(got.n) == {401}
    xi = x.astype(int)
    exact = sorted(((401 * xi - xi.sum(0)) ** 2).sum(1).tolist())
    assert sorted(map(int, got[got.component == 1].deviation)) == exact
    for c in range(8):
        mine = got[got.component == c + 1]
        a, b = np.sort(mine.whitened), np.sort(want[:, c])
        assert np.allclose(a, b, atol=1e-9) or np.allclose(a, np.sort(-b), atol=1e-9)
        assert np.allclose(mine.explained, e[::-1][c] / e.sum(), rtol=1e-9)
    assert got.identity_error.max() < 1e-9
    byid = got[got.vec_id == 395 % 390]
    assert len(byid) == 16  # rows that repeat an id are rows of their own


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.25])], [(1, [0.5]), (2, [0.5])]])
def test_nothing_to_whiten(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).count() == 0


def test_wide_values_keep_their_digits(spark):
    got = whitening.whiten(spark.createDataFrame([(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [1e300, 2.0])], "vec_id long, embedding array<double>")).toPandas()
    x = [[1024 * 10 ** 12 + 100000, 100000], [-1024 * 10 ** 12 + 100000, 101024], [1 << 61, 102048]]
    s = [sum(c) for c in zip(*x)]
    want = [sum((3 * a - b) ** 2 for a, b in zip(r, s)) for r in x]
    mine = {int(r.vec_id): r.deviation for r in got[got.component == 1].itertuples()}
    assert [mine[i + 1] for i in range(3)] == [w if w < 10 ** 38 else None for w in want]


# --- packing ---------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(queries.tokenizer())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(max_codepoint=0x23F), st.sampled_from(" \n'ste.1é"), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=4))
def test_quick_tokens_equal_the_tokenizer(texts):
    enc = test_quick_tokens_equal_the_tokenizer.enc = getattr(test_quick_tokens_equal_the_tokenizer, "enc", None) or packing.Encoder(queries.tokenizer())
    assert enc.quick is not None
    want = [e.ids for e in enc.full.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in enc(texts)] == want


def test_special_tokens_take_the_full_tokenizer(encoder):
    for t in ("a<|endoftext|>b", "<|endoftext|>", "日本 <|endo", "x" * 3000):
        assert encoder([t])[0].tolist() == encoder.full.encode(t, add_special_tokens=False).ids


def packed(docs, **kw):
    return packing.pack(docs, queries.tokenizer(), with_ids=True, **kw).toPandas()


def check_cover(got, docs, encoder):
    """Every id in one piece, offsets gapless, checksums right."""
    for key, text in docs:
        want = [*encoder.full.encode(text or "", add_special_tokens=False).ids, 0]
        mine = got[got.doc_id == key].sort_values("start")
        assert np.concatenate([np.frombuffer(b, "<u4") for b in mine.ids]).tolist() == want and set(mine.doc_tokens) == {len(want)}
        assert mine.start.tolist() == [0, *np.cumsum(mine.length)[:-1]]
    assert all(zlib.crc32(b) == c and len(b) == 4 * n for b, c, n in zip(got.ids, got.ids_crc32, got.length))
    for _, seq in got.sort_values("offset").groupby("sequence_id"):
        assert seq.offset.tolist() == [0, *np.cumsum(seq.length)[:-1]]


def test_documents_are_packed_without_padding(spark, encoder):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(["alpha", "beta", "日本", "x1"]) for _ in range(rng.choice([0, 1, 5, 90, 400, 5000])))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, "<|endoftext|>")]
    got = packed(spark.createDataFrame(docs, "doc_id long, text string").repartition(2))
    check_cover(got, docs, encoder)
    per = got.groupby("sequence_id").agg({"length": "sum", "loss_tokens": "sum", "doc_id": "size"})
    assert (per.length <= 1024).all() and (per.loss_tokens <= 1023).all() and (per.doc_id <= 256).all()
    assert all((n & (n - 1)) == 0 for n in per.length) and (per.length == 1024).mean() > 0.9


@pytest.mark.parametrize("cut", [True, False])
def test_three_limits_hold_at_once(spark, encoder, cut):
    rng = random.Random(5)
    rows = [(i, "ask " * rng.randint(0, 60), "say " * rng.choice([3, 10, 30, 200])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, prompt string, text string").coalesce(1)
    limits = (256, 6, 100)
    got = packed(df, prompt="prompt", limits=limits, cut=cut)
    per = got.groupby("sequence_id").agg({"length": "sum", "doc_id": "size", "loss_tokens": "sum"}).to_numpy()
    assert (per <= limits).all()
    total = sum(len(encoder.full.encode(p, add_special_tokens=False).ids) + len(encoder.full.encode(t, add_special_tokens=False).ids) + 1 for _, p, t in rows)
    assert per[:, 0].sum() == total
    tight = (per / limits).max(1)
    assert np.mean(tight > 0.9) > 0.9  # nearly every sequence is near one of its limits
    if not cut:
        small = got[got.doc_tokens <= 90]
        assert (small.length == small.doc_tokens).all()
    fewest = max(np.array([total, len(rows), got.loss_tokens.sum()]) / limits)
    if not cut:
        assert got.sequence_id.nunique() < 1.25 * fewest + 2


def test_the_dot_product_decides():
    """With few segments left, the sequence takes the long piece; with few tokens left, the one that fits."""
    out = []
    p = packing.Packer((100, 2, 100), False, lambda s, at, e, a, b: out.append((s, e, b - a)))
    for name, n in (("a", 60), ("b", 10), ("c", 40), ("d", 90)):
        p.add(name, 0, n, 0)
    p.drain(0)
    assert {(s, e) for s, e, _ in out if s == 0} == {(0, "d"), (0, "b")} and {e for s, e, _ in out if s == 1} == {"a", "c"}


def test_nothing_to_pack(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string, start long"), queries.tokenizer()).count() == 0


def test_odd_documents(spark, odd_docs, encoder):
    got = packed(odd_docs)
    assert got.length.sum() == sum(len(encoder.full.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in odd_docs.collect())
