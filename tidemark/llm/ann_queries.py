"""op6: the five nearest vectors of every fiftieth one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann
from .common import table
from .registry import query


@query("op6_nearest_vectors")
def op6_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)
