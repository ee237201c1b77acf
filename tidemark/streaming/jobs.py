"""Structured Streaming jobs over a directory of JSON lines.

Late data never changes an earlier decision: streams only append, and decisions read the appended
rows through the two-clock filters. No watermark is used, so no frame is too late to be kept.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import clocks, encode
from ..operators import book, filters
from ..operators.state import sequence_health
from ..operators.timeline import keep_latest
from ..session import cut_lineage, release
from ..sources.json_products import unwrap_messages
from ..sources.tables import path_exists


def read_frames(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    """Raw lines with their file; malformed lines stay."""
    return spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger).load(path)


def raw_frames(lines: DataFrame) -> DataFrame:
    """Every line with its parsed envelope, frame hash, receipt and exchange time."""
    out = unwrap_messages(lines).withColumn("frame_sha", encode.text_sha256(F.coalesce("message_json", "value")))
    body = F.coalesce(F.get_json_object("message_json", "$.msg"), F.col("message_json"))
    ts = F.get_json_object(body, "$.ts")
    exchange = clocks.exchange_instant(F.get_json_object(body, "$.ts_ms").try_cast("double"), ts.try_cast("double"), ts)
    return out.withColumn("exchange_ts", exchange).withColumn("message_type", F.coalesce(F.get_json_object("message_json", "$.type"), F.lit("unknown")))


def append_distinct(frames: DataFrame, path: str, checkpoint: str) -> None:
    """Append every frame whose hash the table does not hold yet, however late it comes.

    The table is laid out by the first two digits of the hash, so a batch reads only the parts its own hashes fall into. A
    replayed batch finds its rows there already.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.dropDuplicates(["frame_sha"]).withColumn("part", F.substring("frame_sha", 1, 2))
        if path_exists(batch.sparkSession, path):
            parts = [row["part"] for row in fresh.select("part").distinct().collect()]  # 256 at most
            held = batch.sparkSession.read.schema(fresh.schema).parquet(path).where(F.col("part").isin(parts))
            fresh = cut_lineage(fresh.join(held.select("part", "frame_sha"), ["part", "frame_sha"], "left_anti").select(*fresh.columns))
        fresh.write.mode("append").partitionBy("part").parquet(path)

    run_available(frames, each, checkpoint)


def append_table(frames: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append-only Parquet sink; with ``partition_by`` it routes frames by type."""
    writer = frames.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    return writer.trigger(availableNow=True).start()


def follow_books(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Keep ``path/frames``, ``path/health`` and ``path/books`` up to date with a stream of book frames.

    Each batch stores its frames and then judges anew the connection sessions it touches, from the stored frames and by
    the order of receipt, with the segmented scans of ``book``. So neither the order of files nor of batches matters,
    and a subscription that carries most frames is spread over its hours. A reconnect ends a session, which bounds what
    a batch has to read. ``health`` has every frame with its event (applied, gap or stale), ``books`` the
    accepted frames with their quarantine flag.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/frames/__batch={batch_id}")
        sessions = batch.select("connection_epoch").distinct()
        store = spark.read.schema(batch.schema).option("basePath", f"{path}/frames").parquet(f"{path}/frames")
        touched = cut_lineage(store.select(*batch.columns).dropDuplicates(["connection_epoch", "sid", "event_id"]).join(sessions, "connection_epoch", "left_semi"))
        event = F.when(F.col("stale"), "stale").when(F.col("accepted_gap"), "gap").otherwise("applied")
        replace_parts(sequence_health(touched).select(*touched.columns, event.alias("event")), f"{path}/health", "connection_epoch")
        oldest = store.groupBy("market_ticker").agg(F.min("connection_epoch").alias("first_epoch"))
        replace_parts(book.sequence_books(touched, oldest), f"{path}/books", "connection_epoch")

    run_available(stream, each, checkpoint)


def replace_parts(rows: DataFrame, path: str, part: str) -> None:
    """Overwrite the partitions of a table that ``rows`` has, and no others."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process what is there and stop."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


#: Parts of a keyed table; a batch reads and writes the parts its keys fall into.
PARTS = 64


def key_part(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(PARTS)).cast("int")


def _parts_of(batch: DataFrame) -> list[int]:
    return [row["part"] for row in batch.select("part").distinct().collect()]  # PARTS at most


def ingest_new(stream: DataFrame, path: str, checkpoint: str, key: str = "record_id") -> None:
    """Append only rows whose id is not in the table yet; a replayed batch adds nothing."""
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = keep_latest(batch, [key], [F.lit(0)], earliest=True).withColumn("part", key_part([key]))
        if path_exists(spark, path):
            held = spark.read.schema(fresh.schema).parquet(path).where(F.col("part").isin(_parts_of(fresh)))
            fresh = cut_lineage(fresh.join(held.select("part", key), ["part", key], "left_anti").select(*fresh.columns))
        fresh.write.mode("append").partitionBy("part").parquet(path)

    run_available(stream, each, checkpoint)


def upsert(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], receipt: Column, newest: bool) -> None:
    """Keep one row per key: the earliest receipt, or the newest one.

    A batch merges the parts its keys fall into with their current rows and overwrites those parts. A replayed batch, or a
    lost checkpoint, gives the same rows. A lost executor is harmless, since parts are swapped when all tasks have ended;
    a driver that dies during that swap can leave a part out, which then takes a replay of the source to fill.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("part", key_part(keys))
        if path_exists(spark, path):
            held = spark.read.schema(rows.schema).parquet(path).where(F.col("part").isin(_parts_of(rows)))
            rows = rows.unionByName(held)
        # The rows held are read to their end before their files are replaced.
        merged = cut_lineage(keep_latest(rows, [*keys, "part"], [receipt], earliest=not newest))
        replace_parts(merged, path, "part")
        release(merged)

    run_available(stream, each, checkpoint)


def latest_version(spark: SparkSession, path: str) -> DataFrame:
    """Current rows of an upserted table, with their ``part``."""
    return spark.read.parquet(path)


def asof_view(bronze: DataFrame, decision: Column, issue: str, receipt: str) -> DataFrame:
    """What an appended table showed at a decision: late arrivals stay invisible to earlier decisions."""
    return filters.split(filters.mark_available(bronze, decision, (issue,), (receipt,)))[0]
