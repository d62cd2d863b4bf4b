"""One query per operator, over its whole table, with the SQL that states the same rows where SQL can.

QUERIES and ORACLE are read by ``__spark_entry__.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, decontam, html_text, langid, minhash, mixing, packing, pii, suffix_dedup, toxicity, turns, warc, whitening
from .common import crc_mod, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return add


@query("op1_ann")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), crc_mod("doc_id", 3) == 1
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held)
    return toxicity.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"))


@query("op3_warc", """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT p.*, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_warc(table(spark, sf_dir, "pages"))
    return warc.read_warc(spark, manifest, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_langid")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = crc_mod("doc_id", 5) == 0
    return langid.identify(table(spark, sf_dir, "documents"), ~held).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def _span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query("op5_pii")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_email, n_ip, n_card and n_phone count base spans; n_added counts those that the method adds."""
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.train(docs))
    order = F.create_map(*[F.lit(x) for pair in ((k, i) for i, k in enumerate(pii.KINDS)) for x in pair])
    both = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(
        order[s["kind"]].alias("order"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(_span_list(F.col("base")), 256).alias("base_sha256"), _span_list(both).alias("spans"),
                        F.size("added").cast("long").alias("n_added"))


@query("op6_suffix_dedup", """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
g AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM b WHERE n >= 100)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM g) WHERE k > 1),
e AS (SELECT doc_id, i, i + 100 AS j, max(i + 100) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM r),
p AS (SELECT *, sum(CASE WHEN reach IS NULL OR i > reach THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM e),
q AS (SELECT doc_id, span, min(i) AS a, max(j) AS z FROM p GROUP BY 1, 2),
k AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans, list(a ORDER BY a) AS a, list(z ORDER BY a) AS z FROM q GROUP BY 1),
o AS (SELECT b.doc_id, n, h, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, coalesce([0] || z, [0]) AS f, coalesce(a || [n], [n]) AS t FROM b LEFT JOIN k USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans,
       sha256(unhex(array_to_string(list_transform(range(1, len(f) + 1), lambda x: substr(h, CAST(2 * f[x] + 1 AS BIGINT), CAST(2 * (t[x] - f[x]) AS BIGINT))), ''))) AS kept_sha256
FROM o
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_decontaminate", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS gram
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
gram AS (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS gram
         FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hit AS (SELECT g.doc_id, g.i, g.size, win.item_id FROM gram g JOIN win ON g.size = win.size AND g.gram = win.gram),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(ids, 256).alias("items_sha256"), decontam.contaminated().alias("contaminated"))


@query("op8_mix_sources", r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
             md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][(rank % 3) + 1]::DOUBLE AS weight, 3 * source_size AS cap FROM s),
r AS (SELECT *, cap / weight AS ratio FROM w),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM r),
t AS (SELECT *, least(cap::DOUBLE, weight * (SELECT min_by(level, (ratio, rank)) FROM l WHERE level <= ratio)) AS target FROM l),
q AS (SELECT d.*, source_size, rank, target, sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS queued
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT q.*, e, ((e - 1) * source_size + queued)::DOUBLE / target AS time FROM q, (SELECT unnest([1, 2, 3]) AS e) WHERE target > 0),
m AS (SELECT *, sum(size) OVER (ORDER BY time, rank, key, doc_id, size, e ROWS UNBOUNDED PRECEDING) AS until FROM e),
k AS (SELECT doc_id, count(*) AS n FROM m WHERE until <= (SELECT sum(size) FROM d) GROUP BY doc_id)
SELECT q.doc_id, q.source, q.size, source_size::BIGINT AS source_size, target, (q.size * coalesce(n, 0))::BIGINT AS taken FROM q LEFT JOIN k USING (doc_id)
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


@query("op9_minhash", r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
             ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w),
c AS (SELECT min(doc_id) AS rep, list_sort(s) AS s FROM s WHERE len(s) > 0 GROUP BY 2),
x AS (SELECT rep, len(s) AS n, unnest(s) AS g FROM c),
p AS (SELECT a.rep AS a, b.rep AS b, a.n AS na, b.n AS nb, count(*) AS common FROM x a JOIN x b ON a.g = b.g AND a.rep < b.rep
             AND a.n * 100 >= 80 * b.n AND b.n * 100 >= 80 * a.n GROUP BY ALL),
e AS (SELECT a, b FROM p WHERE 100 * common >= 80 * (na + nb - common)),
y AS (SELECT a AS u, b AS v FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT rep AS node, rep AS seen FROM c UNION SELECT y.v, r.seen FROM r JOIN y ON r.node = y.u),
k AS (SELECT node AS rep, min(seen) AS component_id FROM r GROUP BY 1)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(component_id, s.doc_id) AS component_id, coalesce(component_id, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN c ON list_sort(s.s) = c.s LEFT JOIN k ON c.rep = k.rep
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2).select(
        "doc_id", "n_shingles", "component_id", "kept")


@query("op10_main_text")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, cut, repeated or given to the user, by a checksum of conv_id and turn."""
    def known(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    text = F.when(F.col("_fate") == 1, "").when(F.col("_fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), fate.alias("_fate")).filter("_fate <> 0").select(
        "conv_id", "turn", F.when(F.col("_fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("_fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy")).drop("_copy")


def _repair_sql() -> str:
    """Costs and audits of every row from each of the four states, from the last row of a conversation to its first."""
    step = {0: 2, 1: 2, 2: 3, 3: 2}  # the state after a user or assistant row
    keep = {0: {"u": 2, "s": 1}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def edit(mark: str, cost: str, to: int, line: str | None) -> str:
        lines = f"list_prepend({line}, p{to}.t)" if line else f"p{to}.t"
        return f"{{'c': p{to}.c + {cost}, 'a': '{mark}' || p{to}.a, 't': {lines}}}"

    def acts(s: int) -> str:
        role = "user" if step[s] == 2 else "assistant"
        found = [edit("D", "3", s, None), f"CASE WHEN stays THEN {edit('R', '2 + cut', step[s], repr(role + ':') + ' || text')} END"]
        found += [f"CASE WHEN stays AND role[1] = '{c}' THEN {edit('K', 'cut', to, chr(39) + chr(39) + ' || role || ' + repr(':') + ' || text')} END" for c, to in keep[s].items()]
        return f"list_min([{', '.join(found)}])"

    def put(s: int) -> str:
        role = "user" if step[s] == 2 else "assistant"
        first = f"{{'c': b{step[s]}.c + 2, 'a': 'I' || b{step[s]}.a, 't': list_prepend('{role}:', b{step[s]}.t)}}"
        s2 = step[step[s]]
        role2 = "user" if step[step[s]] == 2 else "assistant"
        second = f"{{'c': b{s2}.c + 4, 'a': 'II' || b{s2}.a, 't': list_prepend('{role}:', list_prepend('{role2}:', b{s2}.t))}}"
        return f"list_min([b{s}, {first}, {second}])"

    ends = {0: (0, "", []), 1: (4, "II", ["user:", "assistant:"]), 2: (2, "I", ["assistant:"]), 3: (0, "", [])}
    base = ", ".join(f"{{'c': {c}::BIGINT, 'a': '{a}', 't': {t}::VARCHAR[]}} AS p{s}" for s, (c, a, t) in ends.items())
    return rf"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
h AS (SELECT k.*, xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen(key)), lambda j: ord(key[j + 1])::BIGINT)),
                                  lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295) % 20 AS f FROM k, tab),
d AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM h, range(2) AS x(copy) WHERE f <> 0 AND (copy = 0 OR f = 3)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i, NOT regexp_matches(text, '[^ 	-
]') AS blank FROM d),
q AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM o),
e AS (SELECT *, NOT blank AND NOT seen AS stays, CASE WHEN NOT blank AND NOT seen AND NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 1 ELSE 0 END AS cut FROM q),
s AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (seen AND NOT blank) AS duplicate,
             sum(cut) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM e GROUP BY conv_id),
r AS (SELECT conv_id, n + 1 AS i, {base} FROM s
      UNION ALL
      SELECT conv_id, i, {", ".join(f"{put(s)} AS p{s}" for s in range(4))}
      FROM (SELECT r.conv_id, e.i, {", ".join(f"{acts(s)} AS b{s}" for s in range(4))} FROM r JOIN e ON r.conv_id IS NOT DISTINCT FROM e.conv_id AND e.i = r.i - 1)),
v AS (SELECT conv_id, p0 FROM r WHERE i = 1),
c AS (SELECT DISTINCT conv_id FROM conversations)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(p0.c, 0) AS BIGINT) AS cost,
       coalesce(p0.a, '') AS audit, sha256(coalesce(array_to_string(p0.t, chr(10)), '')) AS repaired_sha256
FROM c LEFT JOIN s ON c.conv_id IS NOT DISTINCT FROM s.conv_id LEFT JOIN v ON c.conv_id IS NOT DISTINCT FROM v.conv_id
"""


@query("op11_conversation_repair", _repair_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return turns.audit(damaged(rows), rows)


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` is null where it exceeds a long."""
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))


def tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op13_packing")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer())
