"""Upserts, de-duplicating appends, key checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.scratch import unused


def assert_key(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that break a primary key: repeated, or with a null part. Empty means the key holds."""
    has_null = F.lit(False)
    for c in columns:
        has_null = has_null | F.col(c).isNull()
    return (
        df.groupBy(*columns)
        .agg(F.count("*").alias("row_count"))
        .withColumn("violation", F.when(has_null, "null").when(F.col("row_count") > 1, "duplicate"))
        .where(F.col("violation").isNotNull())
    )


def _unique(df: DataFrame, keys: list[str], side: str, mark: str) -> DataFrame:
    """Add a true ``mark``; reading it fails if the row's key is a repeated one.

    The window needs the rows exchanged and sorted by key, which the join that follows needs too.
    """
    copy = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    repeated = F.raise_error(F.concat(F.lit(f"repeated key in {side}: "), F.to_json(F.struct(*keys))))
    return df.withColumn(mark, F.when(copy > 1, repeated.cast("boolean")).otherwise(F.lit(True)))


def upsert(
    target: DataFrame,
    source: DataFrame,
    conflict_columns: Sequence[str],
    update_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Target after inserting new keys and updating existing ones from ``source``.

    Only ``update_columns`` (default: all non-key columns of the source) change on a conflict.
    Without conflict columns the source is appended. A source column the target lacks is an
    error. As with a unique index, so is a key repeated on either side, and null keys never
    conflict: such rows bypass the join, so a large block of them never meets in one task.
    """
    keys = list(conflict_columns)
    given = [c for c in source.columns if c not in keys]
    updated = list(update_columns) if update_columns else given
    unknown = [c for c in (*source.columns, *keys) if c not in target.columns]
    unknown += [c for c in (*keys, *updated) if c not in source.columns]
    if unknown:
        raise ValueError(f"unknown columns: {', '.join(dict.fromkeys(unknown))}")
    if not keys:
        return target.unionByName(source, allowMissingColumns=True)

    keyed = F.lit(True)
    for c in keys:
        keyed = keyed & F.col(c).isNotNull()
    # A caller's own columns may have any name.
    new = {c: unused(f"_new_{c}", target.columns) for c in given}
    in_target, in_source = (unused(c, target.columns, new.values()) for c in ("_target", "_source"))
    old = _unique(target.where(keyed), keys, "target", in_target)
    incoming = source.where(keyed).select(*keys, *[F.col(c).alias(new[c]) for c in given])
    # Reading both marks keeps the checks in the plan.
    both = old.join(_unique(incoming, keys, "source", in_source), keys, "full_outer").where(
        F.col(in_target).isNotNull() | F.col(in_source).isNotNull()
    )

    def value(c: str) -> Column:
        if c not in given:
            return F.col(c)
        side = F.col(in_source).isNotNull() if c in updated else F.col(in_target).isNull()
        return F.when(side, F.col(new[c])).otherwise(F.col(c)).alias(c)

    merged = both.select(*[value(c) for c in target.columns])
    return merged.unionByName(target.where(~keyed)).unionByName(
        source.where(~keyed).select(*keys, *given), allowMissingColumns=True
    )


def append_dedup(
    existing: DataFrame, new: DataFrame, key_columns: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Both tables together with the last row per key: new rows win over existing ones.

    ``order_by`` says which row is last among several of one input. The rank filter turns into a
    group limit on each input split, so a key with many copies is thinned before the exchange.
    """
    batch, rank = (unused(c, existing.columns, new.columns) for c in ("_batch", "_rank"))
    both = existing.withColumn(batch, F.lit(0)).unionByName(new.withColumn(batch, F.lit(1)), allowMissingColumns=True)
    last = Window.partitionBy(*key_columns).orderBy(F.desc(batch), *[F.desc(c) for c in order_by])
    ranked = both.withColumn(rank, F.row_number().over(last))
    return ranked.where(F.col(rank) == 1).drop(rank, batch)
