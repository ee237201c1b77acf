"""The corpus pipeline: ``documents`` through five stages, each written as Parquet and read again by the next.

1. quality: documents that the subword classifier scores below 0.3 go; it is trained on the labels beside the documents.
2. near_duplicates: SimHash trees and a prefix filter find documents whose five-word shingle sets have a Jaccard similarity of at least 0.8;
   of those linked the one with the smallest id stays.
3. decontamination: documents with a twentieth or more of their words inside benchmark passages go.
4. secrets: spans of secrets are replaced by a mask; ``n_chars`` follows the text.
5. tokens: the ids of every remaining text, whose decoded form must be the text.

Nulls: a null text is an empty one to every stage and stays null where it is passed on; rows without an id are never
near duplicates and are otherwise treated alike. Extra columns of the documents are passed on by the first four stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import archive, bpe, decontaminate, quality, secrets, shingles
from tidemark.llm.common import prepare, table, without_rows
from tidemark.llm.quality_queries import THRESHOLD, held_out

#: No column of a table is called this.
OWN = "__corpus_pipeline"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    outputs = quality.train(docs, table(spark, sf_dir, "labels"), usable=~held_out(F.col("k")))
    return docs.withColumn(OWN, quality.quality_score(F.col("text"), outputs)).where(F.col(OWN) >= THRESHOLD).drop(OWN)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return shingles.keep_one(docs, size=5)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    index = decontaminate.build_index(docs, table(spark, sf_dir, "benchmark"), size=13)
    judged = decontaminate.contamination(index, decontaminate.exact_hits(index), share=20)
    # A row is told by its id and text, so that rows without an id are judged one by one.
    return without_rows(docs, judged.where("contaminated").select("doc_id", "digest"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = docs.columns
    masked = secrets.mask_secrets(docs, OWN)
    changed = {"text": F.col(OWN)}
    if "n_chars" in names:
        changed["n_chars"] = F.when(F.col(OWN).eqNullSafe(F.col("text")), F.col("n_chars")).otherwise(F.length(OWN)).cast(docs.schema["n_chars"].dataType)
    return masked.select(*[changed[n].alias(n) if n in changed else F.col(n) for n in names])


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): the decoded text is what the ids stand for."""
    prepare(spark)
    encoded = bpe.encode_texts(docs, public_tokenizers.path("byte_bpe_50k.json"), decoded=True)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("tokens", token_stage),
]
#: The classifier and the components can't be put into SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = archive.scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
