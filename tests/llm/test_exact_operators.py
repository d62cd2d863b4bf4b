"""Operators with an exact answer: brute force, SQL or round trips on small tables."""
import hashlib

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from dealstream.llm import decontam, minhash, mixing, suffix, suffix_dedup, warc


# --- suffix arrays and repeats ---------------------------------------------------------------

@pytest.mark.parametrize("depth", [None, 1, 7, 20])
def test_suffix_array_is_sorted(depth):
    rng = np.random.default_rng(1)
    for data in (rng.integers(0, 3, 700), np.zeros(300, np.int64), np.tile(rng.integers(0, 200, 40), 9), np.array([5]), np.array([], int)):
        sa, rank = suffix.refine(data.astype(np.uint8), depth)
        cut = len(data) if depth is None else depth
        b = bytes(data.astype(np.uint8))
        assert sa.tolist() == sorted(range(len(b)), key=lambda i: (b[i:i + cut], i) if depth else b[i:])
        ties = [int(rank[sa[s]] == rank[sa[s - 1]]) for s in range(1, len(sa))]
        full = [s for s in range(1, len(sa)) if depth and sa[s] + depth <= len(b) and sa[s - 1] + depth <= len(b)]
        assert all(ties[s - 1] == (b[sa[s]:sa[s] + depth] == b[sa[s - 1]:sa[s - 1] + depth]) for s in full)


def test_common_prefixes_match_bytes():
    data = np.frombuffer(b"abracadabra-abracadabra-abracadabra!" * 3, np.uint8)
    sa, _ = suffix.refine(data)
    b = data.tobytes()
    real = [0] + [next((n for n, (x, y) in enumerate(zip(b[sa[s]:], b[sa[s - 1]:])) if x != y), min(len(b) - sa[s], len(b) - sa[s - 1])) for s in range(1, len(sa))]
    slots = np.array([s for s in range(1, len(sa)) if real[s] > 0])
    assert suffix.common_prefixes(data, sa, slots, len(data)).tolist() == [real[s] for s in slots]


def brute_repeats(docs, width):
    seen, out = {}, {}
    for d, t in sorted(docs, key=lambda x: (x[0] is None, x[0] or 0)):
        for i in range(len(t) - width + 1):
            seen.setdefault(t[i:i + width], (d, i))
    for d, t in docs:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - width + 1):
            if seen[t[i:i + width]] != (d, i):
                gone[i:i + width] = True
        out[d, t] = bytes(np.frombuffer(t, np.uint8)[~gone]) if len(t) else b""
    return out


@pytest.mark.parametrize("limit,hot", [(1 << 21, 20_000), (700, 20_000), (700, 1)])
def test_removed_repeats_equal_brute_force(spark, monkeypatch, limit, hot):
    rng = random.Random(limit + hot)
    lines = ["".join(rng.choice("ab c") for _ in range(rng.randint(5, 80))) for _ in range(12)]
    texts = ["".join(rng.choice(lines) for _ in range(rng.randint(0, 12))) for _ in range(40)] + ["a" * 400, "ab" * 300, "", "z" * 30]
    texts += [texts[3], texts[5]]
    docs = [(i * 3 % 101, t) for i, t in enumerate(texts)]
    monkeypatch.setattr(suffix_dedup, "LIMIT", limit)
    monkeypatch.setattr(suffix_dedup.removed_runs, "__defaults__", (suffix_dedup.WIDTH, suffix_dedup.GRAM, hot))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = brute_repeats([(d, t.encode()) for d, t in docs], 100)
    got = suffix_dedup.remove_repeats(df).collect()
    assert len(got) == len(docs)
    for r in got:
        t = dict(docs)[r["doc_id"]].encode()
        assert bytes(r["kept"]) == want[r["doc_id"], t]
        assert r["n_bytes"] == len(t) and r["n_removed"] == len(t) - len(r["kept"]) and r["n_spans"] == len(r["spans"])


def test_repeats_on_odd_rows(spark, odd_docs):
    got = sorted(((r["doc_id"] is None, r["doc_id"]), r["n_bytes"], r["n_removed"]) for r in suffix_dedup.remove_repeats(odd_docs).collect() if r["doc_id"] is not None)
    assert [x[0][1] for x in got] == [1, 1, 2, 3, 4, 5, 6, 7]
    by = {x[0][1]: x[1:] for x in got}
    assert by[2] == (0, 0) and by[3] == (0, 0) and by[5][1] == by[5][0] and by[4][1] > 0  # 4 repeats itself every 977 words
    assert suffix_dedup.remove_repeats(odd_docs.limit(0)).count() == 0


# --- benchmark windows -----------------------------------------------------------------------

def brute_hits(text, items, window=13):
    w = decontam.words(text)
    hit, found = set(), set()
    for item, t in items:
        p = decontam.words(t)
        n = min(window, len(p))
        grams = {tuple(p[i:i + n]) for i in range(len(p) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i:i + n]) in grams:
                hit |= set(range(i, i + n))
                found.add(item)
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block", [1 << 18, 40])
def test_contamination_equals_brute_force(spark, block):
    rng = random.Random(4)
    vocab = [f"v{i}" for i in range(9)] + ["Été", "x7"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 3, 13, 14, 30])))) for i in range(14)] + [(3, None), (20, "...")]
    texts = [" ".join(rng.choice(vocab + ["zzz"]) for _ in range(rng.randint(0, 120))) for _ in range(40)]
    texts += ["pre " + (items[k][1] or "") + " post " + (items[k][1] or "").upper() for k in range(14)] + [None, ""]
    docs = list(enumerate(texts))
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], list(r["items"])) for r in decontam.contamination(df, bench, block_words=block).collect()}
    assert got == {d: brute_hits(t, items) for d, t in docs}


def test_fm_index_finds_all_places():
    rng = np.random.default_rng(3)
    text = rng.integers(1, 5, 500)
    text[100:140] = 0
    index = decontam.FMIndex(text, sample=7)
    phrases = np.array([text[20:24], [0, 0, 1, 2], [9, 9, 9, 9]])
    phrases[1, :2] = 0
    sizes = np.array([4, 2, 4])
    lo, hi = index.search(phrases, sizes)
    for p, n, a, b in zip(phrases, sizes, lo, hi):
        want = [i for i in range(len(text) - n + 1) if (text[i:i + n] == p[len(p) - n:]).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_contamination_on_odd_rows(spark, odd_docs):
    bench = spark.createDataFrame([(1, "gamma delta"), (None, "word")], "item_id long, text string")
    rows = decontam.contamination(odd_docs, bench).collect()
    assert len(rows) == 9
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_hit"] == 2 and list(by[1]["items"]) == [1] and by[7]["n_hit"] == 1 and list(by[7]["items"]) == [] and by[2]["n_words"] == 0
    assert all(r["n_hit"] == 0 for r in decontam.contamination(odd_docs, bench.limit(0)).collect())
    assert decontam.contamination(odd_docs.limit(0), bench).count() == 0


# --- near duplicates -------------------------------------------------------------------------

def brute_components(docs, k, percent=80):
    sets = {}
    for d, t in docs:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
        sets[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {d: (len(sets[d]), root(d)) for d in sets}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_brute_force(spark, k):
    rng = random.Random(k)
    docs, bases = [], [[f"t{rng.randint(0, 400)}" for _ in range(rng.randint(1, 120))] for _ in range(6)]
    for i in range(160):  # chains of edits, copies, and one large group with a few outsiders
        w = list(rng.choice(bases if i % 3 else bases[:1]))
        for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
            w[rng.randrange(len(w))] = f"e{rng.randint(0, 50)}"
        docs.append((i * 7 % 1000, " ".join(w) if i % 5 else "  ".join(w).upper()))
    docs += [(2000, None), (2001, ""), (2002, " \n"), (2003, "one"), (2004, "One")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), k).collect()}
    assert got == brute_components(docs, k)


def test_linked_pair_in_a_small_bucket_without_its_hubs(spark):
    from pyspark.sql import functions as F

    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(words), " ".join(words[:-1] + ["other"])]

    def key(text):
        raw = np.frombuffer(text.encode(), np.uint8)
        u, bounds = minhash.shingle_hashes(raw, np.array([0, len(raw)]), 1)
        return int(minhash.band_keys(u, bounds, 1, 2)[0, 0])

    assert key(texts[0]) == key(texts[1])  # the smallest and the largest shingle are common to the pair
    ends = next((x, y) for i, x in enumerate(words) for y in words[:i] if key(f"{x} {y}") == key(texts[0]))
    third = next(w for w in words if w not in ends)
    texts += [" ".join(ends), " ".join([*ends, third])]  # two short texts of the same bucket, linked to nothing
    assert len(set(map(key, texts))) == 1
    rows = [tuple(r) for r in spark.range(1, 500).select("id", *[F.xxhash64("id", F.lit(h)) for h in range(minhash.HUBS)]).collect()]
    hub = min(rows, key=lambda r: max(r[1:]))
    a, b, d = [r[0] for r in rows if all(x > y for x, y in zip(r[1:], hub[1:]))][:3]  # every pick falls on the hub
    docs = list(zip((a, b, hub[0], d), texts))
    for some in (docs, docs[:3]):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(
            spark.createDataFrame(some, "doc_id long, text string"), 1, bands=1, rows=2).collect()}
        assert got == brute_components(some, 1) and got[a][1] == got[b][1]


def test_near_duplicates_on_odd_rows(spark, odd_docs):
    rows = {(r["doc_id"], r["component_id"], r["kept"], r["n_shingles"]) for r in minhash.near_duplicates(odd_docs, 2).collect()}
    assert (None, None, True, 5) in rows and (1, 1, True, 5) in rows and (2, 2, True, 0) in rows
    assert {r[:3] for r in rows if r[0] in (4, 5)} == {(4, 4, True), (5, 4, False)}
    assert minhash.near_duplicates(odd_docs.limit(0), 2).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 99)], "a long, b long")
    got = {r["node"]: r["component"] for r in minhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 100: 99}


# --- mixing ----------------------------------------------------------------------------------

def test_targets_are_the_water_level(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 5), (None, 300)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes, (5, 2, 1), 3).collect()}
    weight, cap, left, target = {"a": 5, "b": 2, "c": 1, None: 5}, {"a": 30, "b": 3000, "c": 15, None: 900}, 1315.0, {}
    while True:  # share out, stop at the cap, share the excess again
        open_ = [s for s in cap if s not in target]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap[s]]
        if not over:
            target.update(share)
            break
        target.update({s: cap[s] for s in over})
        left = 1315.0 - sum(target.values())
    assert got == pytest.approx(target)


def test_mix_comes_near_targets_and_reruns_agree(spark, odd_docs):
    docs = spark.createDataFrame([(i, "w " * (i % 50), f"s{i % 7}" if i % 11 else None) for i in range(3000)], "doc_id long, text string, source string")
    rows = mixing.mix_sources(docs).collect()
    assert sorted(rows) == sorted(mixing.mix_sources(docs.repartition(5)).collect())
    by = {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["size"] == r["doc_id"] % 50
        x = by.setdefault(r["source"], [0, r["target"], r["source_size"], 0])
        x[0] += r["taken"]
        x[3] += r["size"]
    assert all(abs(t - want) <= 200 and size == s for t, want, size, s in by.values())
    odd = mixing.mix_sources(odd_docs).collect()
    assert len(odd) == 9 and {r["size"] for r in odd if r["doc_id"] in (2, 3)} == {0}
    assert mixing.mix_sources(docs.limit(0)).count() == 0


# --- WARC ------------------------------------------------------------------------------------

def test_warc_round_trip(spark):
    big = "<p>" + "äöü🙂 text " * 40_000
    rows = [(5, "http://a/ä b", "<html>" + "x" * 200), (2, None, "<html>" + "x" * 200), (9, "u", "<html>" + "x" * 200), (3, "u", "short"), (4, "u", "short"),
            (6, "u", None), (7, "u", ""), (8, "\r\nInjected: 1", big), (1, "u", big), (None, "u", "n" * 150), (2, "u", "<html>" + "x" * 200), (11, "u", "\x1f\x8b\x08" * 60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    manifest = warc.write_warc(pages, file_bytes=2000)
    for split in (1 << 20, 37, 512):
        got = warc.read_warc(spark, manifest, split_bytes=split).collect()
        assert len(got) == len(rows)
        have = sorted((r["page_id"] if r["page_id"] is not None else -1, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"] or 0) for r in got)
        first = {}
        for i, _, h in rows:
            if h and len(h.encode()) >= 100 and i is not None:
                first[h] = min(i, first.get(h, i))
        want = sorted((i if i is not None else -1, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest(),
                       "revisit" if h in first and i != first[h] else "response", first[h] if h in first and i != first[h] else 0) for i, _, h in rows)
        assert have == want
        for r in got:
            assert r["record_type"] == "revisit" or len(r["payload"]) == r["payload_bytes"]


def test_reader_owns_records_by_first_byte():
    records = [warc._record(i, "u", bytes([i]) * (i * 50) + b"\x1f\x8b\x08\x00junk", "d", None) for i in range(30)]
    data = b"".join(records)
    file = pa.BufferReader(data)
    starts = np.cumsum([0] + [len(r) for r in records[:-1]])
    for split in (1, 100, 333, len(data)):
        for a in range(0, len(data), split):
            n = len(list(warc.records_in(file, len(data), a, min(a + split, len(data))))) if split > 1 or a < 400 else None
            assert n is None or n == ((starts >= a) & (starts < a + split)).sum()


def test_warc_of_an_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_warc(spark, warc.write_warc(pages)).count() == 0
