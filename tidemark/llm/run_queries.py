"""op11: periodic runs of words in the documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import runs
from .common import table
from .registry import query


def planted(doc_id: Column, text: Column) -> Column:
    """Every tenth text, by a hash of its id, with a part of its words repeated to its end; a text without an id stays as it is."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(doc_id.cast("string").cast("binary"))
    n, g = F.size(words), F.floor(h / 10)
    first = (g % n).cast("int")
    period = (F.floor((n - first) / (3 + g % 8)) + 1).cast("int")
    root = F.slice(words, first + 1, period)
    filled = F.flatten(F.array_repeat(root, F.ceil((n - first) / period).cast("int")))
    repeated = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), first), filled), F.lit(1), n), " ")
    return F.when((h % 10 == 0) & (n > 0), repeated).otherwise(text)


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = runs.periodic_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    # The longest run; of equal ones the first, then that of the smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
