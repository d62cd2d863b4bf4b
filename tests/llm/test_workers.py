"""Workers without this package, pages of hostile markup, and the pipeline as a whole."""
import os
import subprocess
import sys
import time

import pytest

from dealstream.llm import html_text

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", {shared!r}).getOrCreate()
spark.sparkContext.setLogLevel("OFF")

def importable(_):
    try:
        import dealstream
    except ModuleNotFoundError:
        return [0]
    return [1]

assert spark.sparkContext.parallelize(range(2), 2).mapPartitions(importable).sum() == 0
import __spark_entry__ as E
for name in sorted(n for n in E.queries() if n == "pipeline" or n[:2] == "op" and "_" in n and n[2].isdigit()):
    print(name, E.queries()[name](spark, {sf!r}).count(), flush=True)
"""


def test_executors_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = tmp_path / "driver.py"
    script.write_text(SCRIPT.format(root=ROOT, shared=f"file:{tmp_path}/shared", sf=SF))
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-3000:]
    assert len(out.stdout.split("\n")) == 15  # thirteen operators, the pipeline, and the end


@pytest.mark.parametrize("page", [
    "<main><p>x</p>" + "<nav>a</nav>" * 50_000, "<div>" * 30_000 + "</b>" * 50_000, '<a href="' * 50_000, "<a \">\"" * 50_000 + "'>", "<!" * 50_000,
    "<a " + "x" * 200_000 + " =>", "<li><ul>" + "<b><li></li>" * 30_000, "<p>" + "<b>" * 50_000 + "</i>" * 50_000, "<!--" * 50_000])
def test_hostile_pages_take_linear_time(page):
    start = time.perf_counter()
    html_text.main_text(page)
    assert time.perf_counter() - start < 10


def test_tags_that_never_end():
    assert html_text.main_text("<p>One two three four five.</p><a href=\"x") == 'One two three four five. <a href="x'
    assert html_text.main_text("a <b 'c>d</b> e") == "a d e"
    assert html_text.main_text("x <!-- y") == "x"


def test_pipeline_equals_its_stages_and_takes_empty_tables(spark, tmp_path):
    import corpus_pipeline as C
    from dealstream.llm.common import table, written

    docs = table(spark, SF, "documents")
    for name, stage in C.STAGES:
        docs = written(stage(spark, docs, SF), name)
    want = sorted(map(str, docs.collect()))
    assert sorted(map(str, C.run(spark, SF).collect())) == want
    for t in ("documents", "labels", "benchmark"):
        table(spark, SF, t).limit(0).coalesce(1).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0


def test_columns_and_frames_agree(spark, odd_docs):
    """The pipeline's column forms give what the operators give."""
    from pyspark.sql import functions as F

    from dealstream.llm import decontam, pii, toxicity
    from dealstream.llm.common import table

    docs = odd_docs.select("doc_id", "text").unionByName(table(spark, SF, "documents").select("doc_id", "text"))
    bench = table(spark, SF, "benchmark")
    model = toxicity.train(docs, table(spark, SF, "labels"), F.lit(True))
    key = lambda d: sorted(map(str, d.collect()))
    assert key(docs.select("doc_id", toxicity.score_column(docs, F.col("text"), model).alias("score"))) == key(toxicity.score(docs, model))
    for block in (1 << 18, 200):
        got = decontam.hit_columns(docs, "text", bench, block_words=block).select("doc_id", "_found.*")
        assert key(got.select("doc_id", "n_words", "n_hit", "items", "spans")) == key(decontam.contamination(docs, bench, block_words=block))
    spans = pii.train(docs)
    got = docs.select("doc_id", pii.span_column(docs, F.col("text"), spans).alias("f")).select("doc_id", "f.base", "f.added")
    assert key(got) == key(pii.find(docs, spans))
