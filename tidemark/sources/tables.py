"""Table readers and sinks: CSV and Parquet archives, keyed stores, merges and inventories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import encode
from ..operators.timeline import keep_latest


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob matches anything, on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = system.globStatus(target)
    return found is not None and len(found) > 0


def read_csv(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",") -> DataFrame:
    """Header CSV with every column as text; a missing file is an empty table."""
    schema = text_schema(columns)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).option("sep", sep).option("enforceSchema", False).csv(path)


def read_csv_glob(spark: SparkSession, pattern: str, columns: Sequence[str], name_pattern: str) -> DataFrame:
    """All CSV files of a pattern, with the part of the file name that ``name_pattern`` captures."""
    df = read_csv(spark, pattern, columns)
    if not path_exists(spark, pattern):
        return df.withColumn("file_part", F.lit(None).cast("string"))
    return df.select(*columns, F.regexp_extract(F.col("_metadata.file_path"), name_pattern, 1).alias("file_part"))


def write_csv(df: DataFrame, path: str, columns: Sequence[str], mode: str = "error") -> None:
    """CSV whose column list is part of the contract."""
    df.select(*columns).write.mode(mode).option("header", True).csv(path)


def write_twin(df: DataFrame, reason: str, accepted: str, rejected: str) -> None:
    """Accepted and rejected rows from one stored evaluation of the plan."""
    from ..session import cut_lineage

    stored = cut_lineage(df)
    stored.where(F.col(reason).isNull()).drop(reason).write.parquet(accepted)
    stored.where(F.col(reason).isNotNull()).write.parquet(rejected)


def read_parquet_fields(spark: SparkSession, path: str, column: str = "variable") -> DataFrame:
    """Row count and the distinct values of one column; only that column is read."""
    df = spark.read.parquet(path).select(column)
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def append_deduplicated(existing: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows first, new rows after; the first row of a key stays. Schemas may differ."""
    both = existing.withColumn("__source", F.lit(0)).unionByName(
        fresh.withColumn("__source", F.lit(1)), allowMissingColumns=True)
    return keep_latest(both, keys, [F.col("__source")], earliest=True).drop("__source")


def keyed_table(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Store form of a table: blank text becomes NULL and the last row of a key wins."""
    cleaned = rows.select(*[
        F.nullif(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in rows.schema.fields])
    return keep_latest(cleaned, keys, list(order))


def save_keyed(rows: DataFrame, path: str, keys: Sequence[str], order: Sequence[Column], partition_by: Sequence[str] = ()) -> None:
    """Replace the stored table; loading the same rows again gives the same table."""
    writer = keyed_table(rows, keys, order).write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def merge_rows(existing: DataFrame, fresh: DataFrame, keys: Sequence[str], first_wins: bool) -> DataFrame:
    from ..operators.joins import union_newest

    return union_newest(existing, fresh, keys, first_wins)


def model_runs(manifests: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Run table from several manifests of (provider, model, init, raw_path, sha256, retrieved_at).

    The id is the start of the hash of provider, model, init and raw path; a later manifest wins.
    """
    parts = [
        df.select(F.lit(kind).alias("provider"), "model", "initialization_time_utc", "raw_path", "sha256", "retrieved_at").withColumn(
            "__order", F.lit(i)) for i, (kind, df) in enumerate(manifests)]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    keyed = both.withColumn("run_id", encode.run_id("provider", "model", "initialization_time_utc", "raw_path"))
    return keep_latest(keyed, ["run_id"], [F.col("__order"), F.col("retrieved_at")]).drop("__order")


def table_counts(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows and distinct keys of each table, each counted in two combining steps."""
    parts = []
    for name, (df, keys) in tables.items():
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
        parts.append(per_key.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("rows"), F.count(F.lit(1)).alias("keys")).select(
            F.lit(name).alias("table_name"), "rows", "keys"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 and size of every file under a path; one file is one row."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
