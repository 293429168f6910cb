"""Fill strategies for missing values."""

from __future__ import annotations

import math
import sys
from collections.abc import Mapping, Sequence
from itertools import takewhile
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.scratch import BUCKET, cut_ranges, null_safe_join, place_of


def handle_missing(
    df: DataFrame,
    strategy: Mapping[str, Any],
    order_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Apply one action per column, in the order given; each sees the effect of those before.

    Actions: ``drop``, ``zero``, ``mean``, ``median``, ``forward``, ``backward``, a constant, a
    ``Column``, or ``None`` to leave the column alone. Unknown columns are skipped. The two
    directional fills need ``order_by``; rows that tie in it come in any order.
    """
    wanted = [(c, a) for c, a in strategy.items() if c in df.columns and a is not None]
    for i, (column, action) in enumerate(wanted):
        if isinstance(action, Column):
            df = df.withColumn(column, F.coalesce(F.col(column), action))
        elif action == "drop":
            df = df.na.drop(subset=[column])
        elif action == "mean":
            mean = df.agg(F.avg(column)).scalar()
            df = df.withColumn(column, F.coalesce(F.col(column), mean))
        elif action == "median":
            middle = exact_median(df, column).scalar()
            df = df.withColumn(column, F.coalesce(F.col(column), middle))
        elif action in ("forward", "backward"):
            # Neighbours that fill the same way do not affect each other and share one pass.
            if i and _same(wanted[i - 1][1], action):
                continue
            columns = [c for c, _ in takewhile(lambda entry: _same(entry[1], action), wanted[i:])]
            df = fill_directional(df, columns, order_by, partition_by, forward=action == "forward")
        else:
            value = 0 if action == "zero" else action
            df = df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))
    return df


def _same(action: Any, other: str) -> bool:
    return isinstance(action, str) and action == other


def fill_directional(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    forward: bool = True,
    unique: bool = False,
) -> DataFrame:
    """Fill nulls with the last non-null value above (or the next one below).

    One window over all rows, or over one hot partition, would run in one task. Rows are cut into
    key ranges instead: each range fills itself, and what a range has to take over from its
    neighbours is worked out on one row per range and partition. ``unique`` says that
    ``partition_by`` and ``order_by`` identify a row.
    """
    if not order_by:
        raise ValueError("a directional fill needs order_by")
    keys = list(partition_by)
    ranged = cut_ranges(df, [*keys, *order_by], unique)
    order = [*order_by, *place_of(ranged)]

    pick = F.max_by if forward else F.min_by
    edges = ranged.groupBy(BUCKET, *keys).agg(
        *[pick(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c) for c in columns]
    )
    # At most one row per partition in each range; unpartitioned, the whole table is one row per range.
    ranges = F.col(BUCKET).asc() if forward else F.col(BUCKET).desc()
    before = Window.partitionBy(*keys).orderBy(ranges).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        BUCKET, *keys, *[F.last(c, ignorenulls=True).over(before).alias(f"_carry_{c}") for c in columns]
    )
    some_carry = F.lit(False)
    for c in columns:
        some_carry = some_carry | F.col(f"_carry_{c}").isNotNull()
    carried = carried.where(some_carry)

    # Only partitions that cross a range border have a carry: fewer rows than there are ranges.
    joined = null_safe_join(ranged, F.broadcast(carried), [BUCKET, *keys])

    # Backward is forward over the reversed order: a frame that shrinks row by row would be
    # evaluated anew for each row.
    sequence = [F.col(c).asc() if forward else F.col(c).desc() for c in order]
    inside = Window.partitionBy(BUCKET, *keys).orderBy(*sequence).rowsBetween(Window.unboundedPreceding, 0)
    local = {c: F.last(c, ignorenulls=True).over(inside) for c in columns}
    return joined.select(
        *[
            F.coalesce(local[c], F.col(f"_carry_{c}")).alias(c) if c in local else F.col(c)
            for c in df.columns
        ]
    )


#: Classes that a pass of the median counts values in.
CLASSES = 4096


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """Exact median of a numeric column as a one-row frame; null without values, NaN being the largest.

    The range of the values is cut into classes, counted on the map side, and the class that holds the middle is cut
    again, until its values are equal. Only class counts are exchanged; a pass divides the range by ``CLASSES``, so
    that few are needed. ``df`` must give the same rows in each.
    """
    held = df.schema[column].dataType
    real = isinstance(held, T.FloatType | T.DoubleType)
    # One zero for both; differences of whole numbers and decimals are exact.
    v = F.col(column) + F.lit(0.0).cast(held) if real else F.col(column)
    values = df.select(v.cast(held).alias("v")).where("v is not null")
    total, low, high = values.agg(F.count("*"), F.min("v"), F.max("v")).first()
    ends = [_value_at(values, held, rank, total, low, high) for rank in sorted({(total + 1) // 2, total // 2 + 1})] if total else [None]
    first, second = (F.lit(e).cast(held) for e in (ends[0], ends[-1]))
    both = first + second
    if isinstance(held, T.IntegralType):
        # The sum of two large numbers needs a digit more.
        both = (first.cast("decimal(20,0)") + second.cast("decimal(20,0)")).cast("double")
    return df.sparkSession.range(1).select((both / 2).alias(column))


def _value_at(values: DataFrame, held: T.DataType, rank: int, total: int, low: Any, high: Any) -> Any:
    """The value of a rank, from 1, of ``total`` values that range from low to high."""
    real = isinstance(held, T.FloatType | T.DoubleType)
    wide = "double" if real else held.simpleString() if isinstance(held, T.DecimalType) else "decimal(20,0)"
    before, place = 0, None
    # The range is one value if its ends are equal, or both NaN.
    while rank not in (before + 1, before + total) and low != high and low == low:
        v, a, b = (x.cast(wide) for x in (F.col("v"), F.lit(low).cast(held), F.lit(high).cast(held)))
        if place is None and real:
            # Infinite ends and NaN are classes of their own; halves keep a difference finite.
            largest = sys.float_info.max
            bottom, top = max(low, -largest), min(high, largest) if high == high else largest
            v, a, b = (F.greatest(F.lit(-largest), F.least(F.lit(largest), x)) / (2 if math.isinf(top - bottom) else 1) for x in (v, a, b))
        if place is None:
            share = F.try_divide((v - a).cast("double"), (b - a).cast("double"))
            place = F.floor(F.least(F.lit(1.0), share) * CLASSES).cast("int")
        if real:
            place = F.when(F.isnan("v"), CLASSES + 2).when(F.col("v") == math.inf, CLASSES + 1).when(F.col("v") == -math.inf, -1).otherwise(place)
        within = values.where(F.col("v").between(F.lit(low).cast(held), F.lit(high).cast(held)))
        classes = within.groupBy(place.alias("place")).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        ends = low, high
        for _, total, low, high in sorted(classes.collect(), key=lambda r: r.place):
            if rank <= before + total:
                break
            before += total
        # Decimals of 38 digits may lie so close that their difference is lost: then each value is a class.
        place = F.col("v") if (low, high) == ends else None
    return low if rank == before + 1 else high
