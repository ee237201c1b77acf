"""op3: quality of every document, learned from the labels outside the held-out fifth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quality
from .common import table
from .registry import query

#: A document passes from this probability on.
THRESHOLD = 0.3


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 5 == 0


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    outputs = quality.train(docs, table(spark, sf_dir, "labels"), usable=~held_out(F.col("k")))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), quality.quality_score(F.col("text"), outputs).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
