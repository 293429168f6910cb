"""Reading only what is newer than a watermark."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WATERMARK_COLUMN = "modifiedon"


class Increment(NamedTuple):
    rows: DataFrame
    watermark: DataFrame


def read_incremental(
    df: DataFrame, last: Column | object | None = None, watermark_col: str = WATERMARK_COLUMN
) -> Increment:
    """Rows newer than ``last`` and, as a one-row frame, the next watermark.

    The comparison is pushed down to the scan. With nothing new the watermark stays as it was.
    """
    bound = last if isinstance(last, Column) else F.lit(last)
    rows = df if last is None else df.where(F.col(watermark_col) > bound)
    kind = df.schema[watermark_col].dataType
    watermark = rows.agg(F.coalesce(F.max(watermark_col), bound.cast(kind)).alias("watermark"))
    return Increment(rows, watermark)
