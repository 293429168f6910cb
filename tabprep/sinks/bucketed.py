"""Tables in hash buckets, so that an upsert rewrites only the buckets that its source hits."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.operators.merge import upsert
from tabprep.scratch import materialize

#: The partition column names the number of buckets, so that a table cannot be merged with another number.
PARTITION = "_bucket_of_"


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write a table as Parquet, in folders by hash of its key; an earlier table there is replaced.

    Rows with a null in the key are spread by a hash of the whole row. Choose ``buckets`` for the size that the
    table is to reach: a bucket is what an upsert rewrites at least. Large ones are written by several tasks.
    """
    column = f"{PARTITION}{buckets}"
    if any(c.startswith(PARTITION) for c in df.columns):
        raise ValueError(f"columns may not be named {PARTITION}...")
    _laid(df.withColumn(column, _bucket(df, keys, buckets)), column).mode("overwrite").parquet(path)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table in buckets."""
    table = spark.read.parquet(path)
    return table.drop(_column(table, path))


def upsert_bucketed(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], update_columns: Sequence[str] | None = None
) -> list[int]:
    """``upsert`` of a source into a table in buckets, in place; returns the numbers of the rewritten buckets.

    Buckets that the source does not hit are neither read nor written. The rules are those of ``upsert``: a repeated
    key or an unknown column is an error, and then nothing has changed. The rewritten buckets are staged as a whole and
    replace the old ones one after the other when the job commits (Spark's dynamic partition overwrite): lost executors
    do no harm, but a driver lost within that commit may leave a bucket missing. One writer at a time. A source without
    rows changes nothing.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("a table in buckets is merged by key")
    table = spark.read.parquet(path)
    column = _column(table, path)
    unknown = [c for c in source.columns if c not in table.columns or c == column] + [c for c in keys if c not in source.columns]
    if unknown:
        raise ValueError(f"unknown columns: {', '.join(unknown)}")
    buckets = int(column.removeprefix(PARTITION))
    # Keys of the table's types, as the hash of a number depends on its type.
    typed = source.select(*(F.col(f"`{c}`").cast(table.schema[c].dataType).alias(c) if c in keys else F.col(f"`{c}`") for c in source.columns))
    incoming = materialize(typed.withColumn(column, _bucket(typed, keys, buckets)))
    # No more than there are buckets.
    hit = sorted(r[0] for r in incoming.select(column).distinct().collect())
    if not hit:
        return hit
    old = table.where(F.col(column).isin(hit))
    # Equal keys lie in one bucket, so that it may count as part of the key; rows with a null key keep theirs.
    nulls = F.lit(False)
    for c in keys:
        nulls = nulls | F.col(f"`{c}`").isNull()
    updated = None if update_columns is None else list(update_columns)
    merged = upsert(old.where(~nulls), incoming.where(~nulls), [*keys, column], updated)
    apart = old.where(nulls).unionByName(incoming.where(nulls), allowMissingColumns=True)
    _laid(merged.unionByName(apart), column).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return hit


def _laid(df: DataFrame, column: str):
    """A writer that gives a bucket to one task, or to several if it is large."""
    return df.hint("rebalance", F.col(column)).write.partitionBy(column)


def _bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> Column:
    columns = [F.col(f"`{c}`") for c in keys]
    nulls = F.lit(False)
    for c in columns:
        nulls = nulls | c.isNull()
    rest = [F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return F.pmod(F.when(nulls, F.xxhash64(*rest)).otherwise(F.xxhash64(*columns)), F.lit(buckets)).cast("int")


def _column(table: DataFrame, path: str) -> str:
    found = [c for c in table.columns if re.fullmatch(PARTITION + "[1-9][0-9]*", c)]
    if len(found) != 1:
        raise ValueError(f"no table in buckets: {path}")
    return found[0]
