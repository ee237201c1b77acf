"""op2: pages through ARC files, their WARC equivalent, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import archive
from .common import table
from .registry import query

SQL = r"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
r AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d, n) END AS f FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN f < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f < page_id THEN f END AS refers_to FROM r
"""


@query("op2_warc", SQL)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    arcs, warcs = archive.scratch(spark, "arc"), archive.scratch(spark, "warc")
    fetched = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(mins=(F.col("page_id") * 37 % (120 * 1440)).cast("int"))
    archive.write_arc(archive.http_captures(table(spark, sf_dir, "pages"), fetched), arcs)
    archive.write_warc(archive.to_warc(spark, arcs, least=100), warcs)
    found = cut_lineage(archive.warc_records(spark, warcs, payloads=False).where(F.col("record_type").isin("response", "revisit")).drop("payload"))
    target = found.where(F.col("record_type") == "response").select(F.col("record_id").alias("refers_to_id"), F.col("id").alias("refers_to"))
    return found.join(target, "refers_to_id", "left").select(
        F.col("id").alias("page_id"), "payload_bytes", F.col("payload_sha256").alias("payload_digest"), "record_type", "refers_to")
