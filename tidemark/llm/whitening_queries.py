"""op13: the embeddings along their first whitened components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import whitening
from .common import table
from .registry import query


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=8, scale=1024, offset=100_000)
