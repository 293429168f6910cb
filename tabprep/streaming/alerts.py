"""Alert cooldown on a stream of candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabprep.operators.metrics import alerts_with_cooldown

BATCH = "batch_id"


def start_alerts(candidates: DataFrame, log: str, checkpoint: str, time_column: str = "timestamp") -> StreamingQuery:
    """Write the firing times of a stream of alert candidates to a log, then stop.

    ``candidates`` is a streaming frame with alert, the time column and cooldown_seconds. What is
    carried from batch to batch is a small table beside the log with the last firing per alert; a
    batch reads the version of the batch before it and nothing of the log. A candidate before the
    end of that cooldown never fires, however late it arrives. Within a batch the chain of firings
    is found by the batch operator, so a hot alert is spread over tasks. A repeated batch replaces
    its own ``batch_id`` folder and its own version; older versions than the one before are deleted.
    """
    root = log.rstrip("/")
    state = f"{root}-state"

    def fire(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        versions = _versions(spark, state)
        before = max((v for v in versions if v < number), default=None)
        kept = None if before is None else spark.read.parquet(f"{state}/{before}")
        if kept is not None:
            last = kept.withColumnRenamed(time_column, "_last")
            free_at = F.col("_last") + F.make_dt_interval(secs=F.col("cooldown_seconds"))
            batch = batch.join(last, "alert", "left").where(F.col("_last").isNull() | (F.col(time_column) >= free_at))
        fired = alerts_with_cooldown(batch.select("alert", time_column, "cooldown_seconds"), time_column)
        fired.write.mode("overwrite").parquet(f"{root}/{BATCH}={number}")
        fired = spark.read.schema(fired.schema).parquet(f"{root}/{BATCH}={number}")
        times = fired if kept is None else fired.unionByName(kept)
        latest = times.groupBy("alert").agg(F.max(time_column).alias(time_column))
        latest.write.mode("overwrite").parquet(f"{state}/{number}")
        _drop(spark, [f"{state}/{v}" for v in versions if before is not None and v < before])

    return (
        candidates.writeStream.foreachBatch(fire)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _versions(spark: SparkSession, state: str) -> list[int]:
    """Batches whose last firings are at hand and complete."""
    path = spark._jvm.org.apache.hadoop.fs.Path(state)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = [s.getPath() for s in files.listStatus(path)]
    done = [n for n in names if files.exists(spark._jvm.org.apache.hadoop.fs.Path(n, "_SUCCESS"))]
    return sorted(int(n.getName()) for n in done)


def _drop(spark: SparkSession, paths: list[str]) -> None:
    for path in map(spark._jvm.org.apache.hadoop.fs.Path, paths):
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fired_alerts(log: DataFrame) -> DataFrame:
    """The firings of a log, without the batch they came from."""
    return log.drop(BATCH)
