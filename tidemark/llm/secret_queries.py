"""op7: secret spans of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import secrets
from .common import table
from .registry import query


@query("op7_secret_scan")
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    spans = F.col("secret_spans")
    kinds = F.transform(spans, lambda s: s["kind"])
    return scanned.select(
        "doc_id", *[F.size(F.filter(kinds, F.lit(kind).eqNullSafe)).cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secrets.span_text(F.filter(spans, lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
        secrets.span_text(spans).alias("spans"))
