"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import contextlib
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def build_session(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings every operator relies on onto an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Without one, a session on this machine alone gets a temporary folder that goes with the process; on a cluster each
    executor would write such a folder to its own disk, so there its absence is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None or not current.startswith(configured.rstrip("/")):
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
        atexit.register(shutil.rmtree, current, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(current)
    return current


_WRITTEN: list[str] = []


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Operators that read an intermediate result from several branches use it, so that a chain of them
    neither recomputes nor regrows its plan, and a lost executor only re-reads files. The write happens
    when the plan is built; ``intermediates`` removes the files.
    """
    folder = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/tidemark-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    _WRITTEN.append(folder)
    written = df.sparkSession.read.schema(df.schema).parquet(folder)
    written.tidemark_folder = folder
    return written


def _remove(spark: SparkSession, folders: list[str]) -> None:
    jvm = spark.sparkContext._jvm
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        _WRITTEN.remove(folder)


def release(*frames: DataFrame) -> None:
    """Removes the files of results of ``cut_lineage`` that nothing reads any more, before the whole work is done."""
    for frame in frames:
        _remove(frame.sparkSession, [frame.tidemark_folder])


@contextlib.contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Removes what ``cut_lineage`` wrote inside the block once its results have been used or stored."""
    start = len(_WRITTEN)
    try:
        yield
    finally:
        _remove(spark, _WRITTEN[start:])
