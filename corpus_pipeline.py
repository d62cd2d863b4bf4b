"""The corpus pipeline: documents through five stages, each written as Parquet and read again.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all
but the last return the columns of documents.

1. toxicity: documents scored toxic go (model trained on the labelled training fold of the stage's input);
2. near-duplicates: one document of each group stays (five-word shingles, similarity 0.8 or more);
3. decontamination: documents that the benchmark contaminates go, others stay as they are;
4. personal data: spans are replaced by their kind in brackets, documents stay;
5. mixing: how many words the mix takes from each document.

There is no SQL for the trained stages, so ORACLE_SQL is None; tests run the whole
pipeline and hold each stage's decisions against its operator's brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealstream.llm import decontam, minhash, mixing, pii, toxicity
from dealstream.llm.common import crc_mod, table, written

ORACLE_SQL = None


def _packed(docs: DataFrame) -> DataFrame:
    """The whole row as one struct, so that no column of the documents can clash with one of an operator."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", 3) != 1)
    rows = _packed(docs)
    return rows.filter(toxicity.score_column(rows, F.col("_row.text"), model) < toxicity.THRESHOLD).select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of every component stays; rows that repeat that id all stay."""
    gone = minhash.near_duplicates(docs, shingle_words=5).filter("NOT kept").select("doc_id").distinct()
    return _packed(docs).join(gone, F.col("_row.doc_id") == F.col("doc_id"), "left_anti").select("_row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontam.hit_columns(_packed(docs), "_row.text", table(spark, sf_dir, "benchmark"))
    return found.filter(~decontam.contaminated("_found.n_hit", "_found.n_words")).select("_row.*")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _packed(docs)
    found = rows.withColumn("_found", pii.span_column(rows, F.col("_row.text"), pii.train(docs)))
    clean = found.withColumn("_clean", pii.redacted(F.col("_row.text"), "_found.base", "_found.added"))
    size = F.length("_clean").cast(docs.schema["n_chars"].dataType)
    new = F.when(F.size("_found.base") + F.size("_found.added") > 0, F.col("_row").withField("text", F.col("_clean")).withField("n_chars", size))
    return clean.withColumn("_row", new.otherwise(F.col("_row"))).select("_row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
