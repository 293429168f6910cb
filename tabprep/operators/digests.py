"""Trees of digests: which ranges of a key differ between two versions of a table.

The rows of a table are hashed and the hashes summed by range of the key; sums of neighbouring ranges add up to
those of wider ones, level by level. Two tables are compared from the widest ranges down, and only ranges that
differ are looked into. Their rows alone are then exchanged to name what differs. A tree is a small table that
can be kept beside the data, so that a later comparison need not read the older version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.scratch import materialize, null_safe_join, unused

#: Levels of a tree, and bits by which a range of one level is narrower than that of the next.
LEVELS, STEP = 4, 5
#: Bits of the number of a hashed range: as many ranges at most, however large the table.
HASHED_BITS = 20
SUMMAND = "decimal(28,0)"


def key_range(column: str, bits: int = 10) -> Column:
    """Range of an integer key: ``2 ** bits`` neighbouring values each; null keys are a range of their own."""
    return F.shiftright(F.col(column).cast("bigint"), bits)


def hashed_range(keys: Sequence[str], bits: int = HASHED_BITS) -> Column:
    """Range of the hash of any key."""
    return F.shiftright(F.xxhash64(*_with_nulls(keys)), 64 - bits)


def _with_nulls(columns: Sequence[str]) -> list[Column]:
    """Columns to be hashed; the hash passes over nulls, so that where they are is hashed too."""
    return [*(F.col(f"`{c}`") for c in columns), *(F.col(f"`{c}`").isNull() for c in columns)]


def digest_tree(df: DataFrame, leaf: Column, columns: Sequence[str] | None = None, levels: int = LEVELS, step: int = STEP) -> DataFrame:
    """``level``, ``range``, ``rows`` and ``digest`` of every range that has rows; level 0 is the narrowest.

    ``leaf`` is the range of a row, an integer. Range ``r`` of a level is part of range ``r >> step`` of the next.
    The digest does not depend on the order of rows, and rows count as often as they occur. Sums combine on the
    map side: what is exchanged is one row per task and range. Columns of maps cannot be hashed.
    """
    names = list(columns or df.columns)
    summed = df.select(leaf.cast("bigint").alias("range"), F.xxhash64(*_with_nulls(names)).cast(SUMMAND).alias("h"))
    leaves = summed.groupBy("range").agg(F.count("*").alias("rows"), F.sum("h").alias("digest"))
    nodes = F.array(
        *(F.struct(F.lit(level).alias("level"), F.shiftright("range", step * level).alias("range"), "rows", "digest") for level in range(levels))
    )
    tree = leaves.select(F.inline(nodes)).groupBy("level", "range")
    return tree.agg(F.sum("rows").alias("rows"), F.sum("digest").cast("decimal(38,0)").alias("digest"))


def differing_ranges(one: DataFrame, two: DataFrame, levels: int = LEVELS, step: int = STEP) -> DataFrame:
    """Ranges in which two trees differ: ``level``, ``range``, ``rows_1`` and ``rows_2`` (0 where a side has none).

    Levels are compared from the widest ranges down, each only below the differing ranges of the one above. The
    trees must have been made with the same ranges, columns, ``levels`` and ``step``.
    """
    one, two = materialize(one), materialize(two)
    found = above = None
    for level in reversed(range(levels)):
        sides = []
        for number, tree in ((1, one), (2, two)):
            nodes = tree.where(F.col("level") == level).select(
                "range", F.shiftright("range", step).alias("above"), F.col("rows").alias(f"rows_{number}"), F.col("digest").alias(f"digest_{number}")
            )
            if above is not None:
                nodes = null_safe_join(nodes, above, ["above"], "left_semi")
            sides.append(nodes.drop("above"))
        both = null_safe_join(*sides, ["range"], "full_outer")
        differs = ~(F.col("digest_1").eqNullSafe(F.col("digest_2")) & F.col("rows_1").eqNullSafe(F.col("rows_2")))
        rows = [F.coalesce(f"rows_{n}", F.lit(0)).alias(f"rows_{n}") for n in (1, 2)]
        here = materialize(both.where(differs).select(F.lit(level).alias("level"), "range", *rows))
        found = here if found is None else found.unionByName(here)
        above = here.select(F.col("range").alias("above"))
    return found


def rows_in_ranges(df: DataFrame, leaf: Column, ranges: DataFrame) -> DataFrame:
    """The rows whose range is one of the ``range`` of level 0."""
    name = unused("range", df.columns)
    wanted = ranges.where("level = 0").select(F.col("range").alias(name))
    return null_safe_join(df.withColumn(name, leaf.cast("bigint")), wanted, [name], "left_semi").drop(name)


def changed_rows(one: DataFrame, two: DataFrame, leaf: Column, ranges: DataFrame | None = None, side: str = "only_in", copies: str = "copies") -> DataFrame:
    """Rows that one table holds more often than the other: all columns, which table (1 or 2), and how much more often.

    ``ranges`` are those that differ, found from fresh trees by default; only their rows are exchanged. Both tables
    have the same columns and types, none of them named like ``side`` or ``copies``.
    """
    if sorted(one.dtypes) != sorted(two.dtypes):
        raise ValueError("tables of different columns")
    names = one.columns
    if {side.lower(), copies.lower()} & {c.lower() for c in names}:
        raise ValueError(f"columns {side} or {copies} are there already")
    if ranges is None:
        ranges = differing_ranges(digest_tree(one, leaf), digest_tree(two.select(one.columns), leaf))
    held = [rows_in_ranges(t, leaf, ranges).withColumn(copies, F.lit(sign)) for t, sign in ((one, 1), (two, -1))]
    more = held[0].unionByName(held[1]).groupBy(*(f"`{c}`" for c in names)).agg(F.sum(copies).alias(copies)).where(F.col(copies) != 0)
    return more.select(*(f"`{c}`" for c in names), F.when(F.col(copies) > 0, 1).otherwise(2).alias(side), F.abs(copies).alias(copies))
