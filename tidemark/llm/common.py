"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Rows and bytes of one Arrow batch, rows of one batch of a Parquet scan. Texts are long, so Spark's defaults of 10,000 and 4,096 rows
#: would hold far too much: a scan's text column grows by doubling into arrays of tens of megabytes, in every task.
BATCH_SETTINGS = {
    "spark.sql.parquet.columnarReaderBatchSize": "512",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
}

#: Bits of a bitmap at most (16 MB). It starts with ``FILL`` bits for each value that it holds.
MOST_BITS, FILL = 1 << 27, 32


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches of ``spark`` for tables that hold whole texts."""
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, body): the whole text as UTF-8 bytes, empty where it is null."""
    return docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("body"))


def bitmap(hashed: DataFrame, column: str, values: int | None = None) -> bytes:
    """A bitmap of the low bits of a column of longs; its size is a power of two, by the rows or by about how many ``values`` they have."""
    bits = min(MOST_BITS, max(1 << 15, 1 << (FILL * max(hashed.count() if values is None else values, 1) - 1).bit_length()))
    bit = F.col(column).bitwiseAND(bits - 1) + 1
    rows = (hashed.select(F.bitmap_bucket_number(bit).alias("bucket"), F.bitmap_bit_position(bit).alias("at"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits")).collect())
    held = bytearray(bits // 8)
    for row in rows:
        at = (row["bucket"] - 1) * len(row["bits"])
        held[at:at + len(row["bits"])] = row["bits"]
    return bytes(held)


def among(bits: bytes, values: np.ndarray) -> np.ndarray:
    """Which values have their bit in a bitmap."""
    held, at = np.frombuffer(bits, np.uint8), values.view(np.uint64) & np.uint64(8 * len(bits) - 1)
    return (held[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def without_rows(docs: DataFrame, gone: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose key, null included, and XXH64 of the text are a row of ``gone``.

    Only rows whose text may have to go are shuffled.
    """
    # Names that no column of ``docs`` has.
    names = [f"{'_'.join(docs.columns)}_{n}" for n in ("key", "digest")]
    gone = cut_lineage(gone.toDF(*names).distinct())
    held = bitmap(gone.select(names[1]), names[1])

    @F.pandas_udf("boolean")
    def suspect(digests: pd.Series) -> pd.Series:
        return pd.Series(among(held, digests.to_numpy(np.int64)))

    digest = F.xxhash64(F.coalesce(docs[text].cast("binary"), F.lit(b"")))
    doubtful = docs.where(suspect(digest)).join(gone, docs[key].eqNullSafe(F.col(names[0])) & (digest == F.col(names[1])), "left_anti")
    return docs.where(~suspect(digest)).unionAll(doubtful)


class Memo(dict):
    """A bounded cache of ``compute(key)`` in two generations: recent keys stay when the older half goes.

    Hits are plain dictionary lookups, so ``map(memo.__getitem__, words)`` runs without Python calls.
    """

    def __init__(self, compute: Callable[[Any], Any], limit: int = 300_000, longest: int = 64) -> None:
        super().__init__()
        self.compute, self.limit, self.longest, self.older = compute, limit, longest, {}

    def __missing__(self, key: Any) -> Any:
        if len(key) > self.longest:  # rare and large
            return self.compute(key)
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        self.put(key, value)
        return value

    def put(self, key: Any, value: Any) -> None:
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value


def pieces(text: str, size: int = 200_000) -> Iterator[str]:
    """``text`` in order, cut only before a single space between a letter and a letter, about every ``size`` characters.

    No tokenizer here joins anything across such a place, so a very long text needs no more memory than a piece.
    """
    start, at = 0, size
    while len(text) - start > size:
        at = text.find(" ", at)
        if at < 0 or at + 1 >= len(text):
            break
        if text[at - 1].isalpha() and text[at + 1].isalpha():
            yield text[start:at]
            start, at = at, at + size
        else:
            at += 1
    yield text[start:]


_HELD: dict[Any, Any] = {}


def worker_cache(name: Any, build: Callable[[], Any] = lambda: None) -> Any:
    """What ``build`` made for ``name`` in this Python worker; tasks of one operator share it.

    Workers outlive a stage. Asking for another name drops what the worker held, so one cache at a time takes memory.
    """
    if name not in _HELD:
        _HELD.clear()
        give_back()
        _HELD[name] = build()
    return _HELD[name]


def give_back() -> None:
    """Hands memory that this worker no longer uses to the system. Allocators keep it otherwise, beside what the JVM takes meanwhile."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)
