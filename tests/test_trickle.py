"""A landing that reaches the stream a file a micro-batch."""

from pyspark.sql import functions as F

from paths import SF_SMALL

from dealstream.plans import queries_core as QC
from dealstream.session import unique_dir
from dealstream.streaming import jobs as J


def test_a_trickled_landing_has_few_files(spark):
    path = unique_dir(spark, "landing", "few")
    dl = QC.deliveries(spark, SF_SMALL).repartition(9)
    J.land_messages(dl, path, parts=2)
    got = spark.read.schema(J.LANDING_SCHEMA).parquet(path)
    assert got.count() == dl.count()
    per = got.select("batch_id", F.input_file_name().alias("f")).distinct().groupBy("batch_id").count().collect()
    assert per and max(r["count"] for r in per) <= 2
