"""Incremental loading as a stream: a file source, a checkpoint and a change log with snapshots."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tabprep.operators.cleaning import remove_duplicates
from tabprep.sources.incremental import WATERMARK_COLUMN

BATCH = "batch_id"
#: Folder of a log's snapshots, hidden from plain readers of the log, and how their names begin.
SNAPSHOTS, THROUGH = "_snapshots", "through="


def start_incremental(
    spark: SparkSession,
    source: str,
    schema: str | T.StructType,
    log: str,
    checkpoint: str,
    keys: Sequence[str],
    watermark_col: str = WATERMARK_COLUMN,
    fmt: str = "json",
    max_files: int = 1000,
) -> StreamingQuery:
    """Load files that appeared since the last run, then stop.

    The checkpoint plays the part of the stored watermark. Each micro-batch is cut down to the
    newest row per key and lands in its own ``batch_id`` folder, which a repeated batch replaces,
    so every file counts exactly once and no batch rewrites what is already there.
    """

    def load(batch: DataFrame, number: int) -> None:
        newest = remove_duplicates(batch, keys, "last", [watermark_col, *_tiebreak(batch, keys, watermark_col)])
        newest.write.mode("overwrite").parquet(f"{log.rstrip('/')}/{BATCH}={number}")

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).format(fmt).load(source)
    return (
        rows.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _tiebreak(df: DataFrame, keys: Sequence[str], watermark_col: str) -> list[str]:
    """The remaining sortable columns, so that equal watermarks have one winner."""
    return [
        f.name
        for f in df.schema.fields
        if f.name not in (*keys, watermark_col) and isinstance(f.dataType, T.AtomicType)
    ]


def current_rows(
    spark: SparkSession, log: str, keys: Sequence[str], watermark_col: str = WATERMARK_COLUMN
) -> DataFrame:
    """The newest row per key over the whole change log; later batches win on equal watermarks.

    Read are the last snapshot, if there is one, and the finished batches after it.
    """
    return _newest(_changes(spark, log)[0], keys, watermark_col).drop(BATCH)


def compact(spark: SparkSession, log: str, keys: Sequence[str], target: str, watermark_col: str = WATERMARK_COLUMN) -> None:
    """Write the current rows to a new table, after which the old log can be retired."""
    current_rows(spark, log, keys, watermark_col).write.mode("error").parquet(target)


def snapshot(spark: SparkSession, log: str, keys: Sequence[str], watermark_col: str = WATERMARK_COLUMN) -> int | None:
    """Write the current rows into the log as a snapshot and return the last batch that it holds.

    The log may be live. A snapshot holds all batches up to the one in its name, that is those which are
    finished when it is begun; batches that arrive meanwhile are read together with it. It appears by one rename, so that
    a reader sees the one before or this one. It costs a reading of the snapshot before and the batches since; without new
    batches nothing is written. None for a log without batches.
    """
    root = log.rstrip("/")
    if not _numbers(spark, root, f"{BATCH}=") and not _numbers(spark, f"{root}/{SNAPSHOTS}", THROUGH):
        return None
    changes, through, new = _changes(spark, log)
    if not new:
        return through
    written, final = f"{root}/{SNAPSHOTS}/.{uuid.uuid4().hex}", f"{root}/{SNAPSHOTS}/{THROUGH}{max(new)}"
    _newest(changes, keys, watermark_col).write.parquet(written)
    files, path_of = _files(spark, root)
    if files.exists(path_of(final)):  # another one was faster
        files.delete(path_of(written), True)
    elif not files.rename(path_of(written), path_of(final)):
        raise OSError(f"could not rename {written} to {final}")
    return max(new)


def retire(spark: SparkSession, log: str) -> None:
    """Delete the batches that the last snapshot holds, and older snapshots.

    Frames over the log that were made before the last snapshot may still read them: call it when those are done.
    """
    root = log.rstrip("/")
    snapshots = _numbers(spark, f"{root}/{SNAPSHOTS}", THROUGH)
    if not snapshots:
        return
    through = max(snapshots)
    old = [f"{root}/{BATCH}={n}" for n in _numbers(spark, root, f"{BATCH}=") if n <= through]
    old += [f"{root}/{SNAPSHOTS}/{THROUGH}{n}" for n in snapshots if n < through]
    files, path_of = _files(spark, root)
    for path in old:
        files.delete(path_of(path), True)


def _newest(changes: DataFrame, keys: Sequence[str], watermark_col: str) -> DataFrame:
    return remove_duplicates(changes, keys, "last", [watermark_col, BATCH])


def _changes(spark: SparkSession, log: str) -> tuple[DataFrame, int | None, list[int]]:
    """Rows of the last snapshot and the batches after it, with their batch; the snapshot's last batch, the batches."""
    root = log.rstrip("/")
    through = max(_numbers(spark, f"{root}/{SNAPSHOTS}", THROUGH), default=None)
    new = [n for n in _numbers(spark, root, f"{BATCH}=") if through is None or n > through]
    parts = []
    if through is not None:
        parts.append(spark.read.parquet(f"{root}/{SNAPSHOTS}/{THROUGH}{through}"))
    if new or not parts:
        paths = [f"{root}/{BATCH}={n}" for n in new] or [root]
        parts.append(spark.read.option("basePath", root).parquet(*paths).withColumn(BATCH, F.col(BATCH).cast("bigint")))
    return reduce(DataFrame.unionByName, parts), through, new


def _files(spark: SparkSession, path: str):
    """File system of a path, and what makes a path for it."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    return path_of(path).getFileSystem(spark._jsc.hadoopConfiguration()), path_of


def _numbers(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """Numbers after the prefix in the names of the finished folders below one: those with Spark's success mark."""
    files, path_of = _files(spark, folder)
    if not files.exists(path_of(folder)):
        return []
    found = [s.getPath() for s in files.listStatus(path_of(folder)) if s.getPath().getName().startswith(prefix)]
    return sorted(int(p.getName().removeprefix(prefix)) for p in found if files.exists(path_of(p, "_SUCCESS")))
