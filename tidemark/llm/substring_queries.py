"""op8: documents without passages that an earlier document has."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import substrings
from .common import table
from .registry import query


@query("op8_substring_dedup")
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), size=50, digest=True).withColumnRenamed("kept", "kept_sha256")
