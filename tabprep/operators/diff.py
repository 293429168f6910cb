"""Table comparison, change hashes and column profiles."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.scratch import BUCKET, cut_ranges, materialize, null_safe_join, passing

TOLERANCE = 1e-10
SAMPLES = 5
#: Rows of a key on either side up to which its pairs are formed where values are counted.
FORMED = 32
#: Rows of both tables that are exchanged at a time where values are counted, about.
PASS_ROWS = 32 << 20
PAIRS = "decimal(38,0)"
UNITS = "decimal(38,0)"
UNIT_DIGITS = 38


def table_hash(df: DataFrame, columns: Sequence[str] | None = None, position: Sequence[str] = ()) -> DataFrame:
    """16 hex digits that change when the rows do, as a one-row frame.

    Each row is hashed and the hashes are summed, so the result does not depend on row order or
    partitioning and needs no sort. Columns named in ``position`` are hashed along with the rows,
    which makes the order they express count.
    """
    names = list(columns or df.columns)
    row = F.struct(*names, *[F.col(c).alias(f"_position_{c}") for c in position])
    digest = F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)
    # Fifteen hex digits fit a bigint; two such parts hold twice the bits of the result.
    parts = [F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)") for i in range(2)]
    sums = [F.coalesce(F.sum(p), F.lit(0)).cast("decimal(38,0)").cast("string") for p in parts]
    text = F.concat_ws("|", F.lit(",".join(names)), F.count("*").cast("string"), *sums)
    return df.agg(F.substring(F.sha2(text, 256), 1, 16).alias("hash"))


def compare_shape(df1: DataFrame, df2: DataFrame) -> DataFrame:
    """Row and column counts of both tables, and whether shapes and column orders agree."""
    rows1 = df1.agg(F.count("*").alias("n")).scalar()
    counted = df2.agg(F.count("*").alias("rows_2")).select(rows1.alias("rows_1"), "rows_2")
    same_width = F.lit(len(df1.columns) == len(df2.columns))
    return counted.withColumns(
        {
            "columns_1": F.lit(len(df1.columns)),
            "columns_2": F.lit(len(df2.columns)),
            "shape_match": (F.col("rows_1") == F.col("rows_2")) & same_width,
            "columns_match": F.lit(df1.columns == df2.columns),
        }
    )


def _per_key(df: DataFrame, keys: list[str], side: int) -> DataFrame:
    """Row count per key; a key with many copies is folded before the exchange."""
    return df.groupBy(*keys).agg(F.count("*").cast(PAIRS).alias(f"n{side}"))


def compare_keys(df1: DataFrame, df2: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows only in the first, only in the second, and pairs of rows in both, as one row.

    Null keys match each other. Repeated keys count as all their pairs, which are multiplied
    from the row counts and never formed.
    """
    keys = list(keys)
    one, two = _per_key(df1, keys, 1), _per_key(df2, keys, 2)
    joined = null_safe_join(one, two, keys, "full_outer")
    zero = F.lit(0).cast(PAIRS)

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), zero).cast(PAIRS)

    return joined.agg(
        total(F.when(F.col("n2").isNull(), F.col("n1"))).alias("rows_only_in_1"),
        total(F.when(F.col("n1").isNull(), F.col("n2"))).alias("rows_only_in_2"),
        total((F.col("n1") * F.col("n2")).cast(PAIRS)).alias("rows_in_both"),
    )


def _known(c: Column, held: T.DataType) -> Column:
    """NaN counts as missing."""
    return F.when(~F.isnan(c), c) if isinstance(held, T.FloatType | T.DoubleType) else c


def _exact(held: T.DataType, tolerance: float) -> bool:
    """Whether two values within the tolerance are bound to be equal."""
    if isinstance(held, T.FloatType | T.DoubleType):
        return tolerance == 0
    if isinstance(held, T.DecimalType):
        return Decimal(repr(tolerance)) < Decimal(1).scaleb(-held.scale)
    return tolerance < 1 or not isinstance(held, T.IntegralType)


def _number(c: Column, held: T.DataType, tolerance: float) -> tuple[Column, Column]:
    """A value and the tolerance in numbers whose sum and difference lose no digit.

    Those are doubles for doubles, and for decimals whole numbers of their last digit.
    """
    if isinstance(held, T.FloatType | T.DoubleType):
        return _known(c, held).cast("double"), F.lit(float(tolerance))
    scale = held.scale if isinstance(held, T.DecimalType) else 0
    units = int(Decimal(repr(tolerance)).scaleb(scale))
    if scale:
        c = F.regexp_replace(F.format_number(c, scale), "[,.]", "")
    return c.cast(UNITS), F.lit(units).cast(UNITS)


def _differs(a: Column, b: Column, held: T.DataType, tolerance: float, alike: bool = False) -> Column:
    """Whether two values differ; ``alike`` if both have the type ``held``."""
    if _exact(held, tolerance):
        return ~_known(a, held).eqNullSafe(_known(b, held))
    (x, apart), (y, _) = _number(a, held, tolerance), _number(b, held, tolerance)
    differs = (x.isNull() != y.isNull()) | F.coalesce(~y.between(x - apart, x + apart), F.lit(False))
    if not alike or not isinstance(held, T.DecimalType) or not 0 < held.scale < UNIT_DIGITS:
        return differs
    units = int(Decimal(repr(tolerance)).scaleb(held.scale))
    if units >= 10**UNIT_DIGITS:
        return differs
    # Whole numbers of last digits are made as texts, which takes long; with a digit less a difference fits the type.
    narrow = T.DecimalType(min(held.precision, UNIT_DIGITS - 1), held.scale)
    x, y = a.try_cast(narrow), b.try_cast(narrow)
    far = F.abs(x - y) > F.lit(Decimal(f"{units}E-{held.scale}"))
    return F.when(a.eqNullSafe(b), F.lit(False)).when(x.isNotNull() & y.isNotNull(), far).otherwise(differs)


def _common(df1: DataFrame, df2: DataFrame, keys: list[str]) -> list[str]:
    return [c for c in df1.columns if c in df2.columns and c not in keys]


def _sides(df1: DataFrame, df2: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows of both tables: the keys, a struct ``r1`` or ``r2``, and ``n1`` and ``n2``, 1 for the row's side."""
    one, zero = F.lit(1).cast(PAIRS), F.lit(0).cast(PAIRS)
    rows1 = df1.select(*keys, F.struct(*columns).alias("r1"), one.alias("n1"), zero.alias("n2"))
    rows2 = df2.select(*keys, F.struct(*columns).alias("r2"), zero.alias("n1"), one.alias("n2"))
    return rows1.unionByName(rows2, allowMissingColumns=True)


def _met(df1: DataFrame, df2: DataFrame, keys: list[str], columns: list[str], most: int = 1) -> tuple[DataFrame, DataFrame]:
    """Pairs of rows whose key is held ``most`` times at most on either side, as ``r1`` and ``r2``, and the other keys of both tables.

    The second frame has ``n1`` and ``n2``, the key's rows on either side, and is written down: it decides which rows
    the join leaves out, so that no key, however often it repeats, forms more pairs or meets in one task.
    """
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    sides = df1.select(*keys, one.alias("n1"), zero.alias("n2")).unionByName(df2.select(*keys, zero.alias("n1"), one.alias("n2")))
    counts = sides.groupBy(*keys).agg(F.sum("n1").alias("n1"), F.sum("n2").alias("n2")).where(f"n1 > {most} or n2 > {most}")
    repeated = materialize(counts.withColumns({n: F.col(n).cast(PAIRS) for n in ("n1", "n2")}))
    rows1, rows2 = (
        null_safe_join(df.select(*keys, F.struct(*columns).alias(r)), repeated.select(*keys), keys, "left_anti")
        for df, r in ((df1, "r1"), (df2, "r2"))
    )
    return null_safe_join(rows1, rows2, keys, "inner"), repeated.where("n1 > 0 and n2 > 0")


def compare_values(
    df1: DataFrame, df2: DataFrame, keys: Sequence[str], tolerance: float = TOLERANCE
) -> DataFrame:
    """Columns that differ between rows of equal key, with the number of differing pairs of rows.

    Rows whose key is held ``FORMED`` times at most on either side are joined. Where a key repeats more often, its
    pairs are counted without being formed. The keys are dealt to passes by a hash, and each pass drops what it has
    exchanged and written before the next, so the disk that it takes does not grow with the tables. They are
    read anew in each pass.
    """
    keys = list(keys)
    kinds = {c: df1.schema[c].dataType for c in _common(df1, df2, keys)}
    spark, totals = df1.sparkSession, dict.fromkeys(kinds, 0)
    passes = _passes(df1, df2, keys)
    for number in range(passes):
        sides = (df1, df2) if passes == 1 else (df.where(_pass_of(df, keys, passes) == number) for df in (df1, df2))
        with passing(spark):
            for column, n in _differences(*sides, keys, kinds, tolerance).items():
                totals[column] += n
    found = [F.struct(F.lit(c).alias("column"), F.lit(str(n)).cast(PAIRS).alias("differences")) for c, n in totals.items()]
    return spark.range(1).select(F.inline(F.array(*found))).where(F.col("differences") > 0)


def _passes(df1: DataFrame, df2: DataFrame, keys: list[str]) -> int:
    """How many passes the keys are dealt to; one, if equal keys of other types would have other hashes."""
    for c in keys:
        a, b = df1.schema[c].dataType, df2.schema[c].dataType
        if a != b and not (isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType)):
            return 1
    return max(1, -(-(df1.count() + df2.count()) // PASS_ROWS))


def _pass_of(df: DataFrame, keys: list[str], passes: int) -> Column:
    parts = (F.col(c).cast("bigint") if isinstance(df.schema[c].dataType, T.IntegralType) else F.col(c) for c in keys)
    # Not the remainder: tasks and ranges are told by other hashes of the same keys.
    return F.pmod(F.xxhash64(F.lit("pass"), *parts), F.lit(passes))


def _differences(df1: DataFrame, df2: DataFrame, keys: list[str], kinds: dict[str, T.DataType], tolerance: float) -> dict[str, int]:
    """Number of differing pairs of rows per column."""
    met, repeated = _met(df1, df2, keys, list(kinds), FORMED)
    differing = []
    for c, held in kinds.items():
        alike = df2.schema[c].dataType == held
        differing.append(F.count_if(_differs(F.col("r1")[c], F.col("r2")[c], held, tolerance, alike)))
    totals = dict(zip(kinds, met.agg(*differing).first(), strict=True))
    pairs, rows = repeated.agg(F.sum((F.col("n1") * F.col("n2")).cast(PAIRS)), F.sum(F.col("n1") + F.col("n2"))).first()
    if pairs:
        again = materialize(null_safe_join(_sides(df1, df2, keys, list(kinds)), repeated.select(*keys), keys, "left_semi"))
        # A row makes an entry of each column: as many columns at a time as make no more entries than a pass has rows.
        some = max(1, PASS_ROWS // int(rows))
        for at in range(0, len(kinds), some):
            part = dict([*kinds.items()][at : at + some])
            with passing(df1.sparkSession):
                equal = {r.column: int(r.equal) for r in _equal_pairs(again, keys, part, tolerance).collect()}
            for c in part:
                totals[c] += int(pairs) - equal.get(c, 0)
    return totals


def _equal_pairs(sides: DataFrame, keys: list[str], kinds: dict[str, T.DataType], tolerance: float) -> DataFrame:
    """Per column, pairs of equal values among rows of equal key.

    Values are counted per key first. Pairs of equal values are the product of their counts on
    either side; with a tolerance, a value meets the other side's counts in a range around it.
    """
    entries = []
    for c, held in kinds.items():
        value = F.when(F.col("r1").isNotNull(), F.col("r1")[c]).otherwise(F.col("r2")[c])
        text = real = units = None
        if not _exact(held, tolerance):
            number, _ = _number(value, held, tolerance)
            real, units = (number, None) if isinstance(held, T.FloatType | T.DoubleType) else (None, number)
        elif isinstance(held, T.FloatType | T.DoubleType):
            # The two zeros are equal.
            text = (_known(value, held) + F.lit(0.0)).cast("string")
        else:
            text = value.cast("string") if isinstance(held, T.AtomicType) else F.to_json(F.struct(value))
        parts = (("text", text, "string"), ("real", real, "double"), ("units", units, UNITS))
        typed = [(F.lit(None) if v is None else v).cast(t).alias(n) for n, v, t in parts]
        entries.append(F.struct(F.lit(c).alias("column"), *typed))
    long = sides.select(*keys, "n1", "n2", F.inline(F.array(*entries)))
    counted = long.groupBy(*keys, "column", "text", "real", "units").agg(
        *[F.sum(n).cast(PAIRS).alias(n) for n in ("n1", "n2")]
    )
    if not all(_exact(held, tolerance) for held in kinds.values()):
        counted = materialize(counted)
    both = (F.col("n1") * F.col("n2")).cast(PAIRS).alias("equal")
    equal = counted.where("real is null and units is null").select("column", both)
    inexact = [held for held in kinds.values() if not _exact(held, tolerance)]
    for name, held in (("real", T.FloatType | T.DoubleType), ("units", T.DecimalType | T.IntegralType)):
        if not any(isinstance(k, held) for k in inexact):
            continue
        # Tolerances differ by column: in last digits of its type.
        for apart in {_tolerance(k, tolerance) for k in inexact if isinstance(k, held)}:
            columns = [c for c, k in kinds.items() if not _exact(k, tolerance) and isinstance(k, held) and _tolerance(k, tolerance) == apart]
            values = counted.where(F.col(name).isNotNull() & F.col("column").isin(columns))
            equal = equal.union(_near_pairs(values, [*keys, "column"], name, F.expr(apart)))
    return equal.groupBy("column").agg(F.sum("equal").cast(PAIRS).alias("equal"))


def _near_pairs(values: DataFrame, groups: list[str], name: str, apart: Column) -> DataFrame:
    """Per row of side 1, the rows of side 2 in its group whose value is no further apart: ``(column, equal)``.

    A value meets as many rows as lie up to its upper end, less those that lie below its lower end. So values and
    both ends are put in one order, in which side 2 is summed up. The order is cut into ranges, and what lies
    before a range within a group is settled on one row per range: one key, however hot, spreads over ranges.
    """
    value, none = F.col(name), F.lit(0).cast(PAIRS)
    events = F.array(
        *(
            F.struct(at.alias("at"), F.lit(kind).alias("kind"), adds.alias("adds"), weight.cast(PAIRS).alias("weight"))
            for at, kind, adds, weight in ((value - apart, 0, none, -F.col("n1")), (value, 1, F.col("n2"), none), (value + apart, 2, none, F.col("n1")))
        )
    )
    events = values.select(*groups, F.inline(F.filter(events, lambda e: (e["adds"] != 0) | (e["weight"] != 0))))
    ranged = cut_ranges(events, [*groups, "at", "kind"], unique=True)
    sums = ranged.groupBy(BUCKET, *groups).agg(F.sum("adds").alias("adds"))
    earlier = Window.partitionBy(*groups).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    # Only a group that goes on from an earlier range has a sum: fewer rows than ranges.
    carried = sums.select(BUCKET, *groups, F.sum("adds").over(earlier).alias("_carried")).where("_carried is not null")
    inside = Window.partitionBy(BUCKET, *groups).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    located = ranged.withColumn("_before", F.sum("adds").over(inside))
    located = null_safe_join(located, F.broadcast(carried), [BUCKET, *groups]).where("weight <> 0")
    before = (F.col("_before") + F.coalesce("_carried", F.lit(0))).cast(PAIRS)
    return located.select("column", (F.col("weight") * before).cast(PAIRS).alias("equal"))


def _tolerance(held: T.DataType, tolerance: float) -> str:
    """The tolerance as a literal of the type that values are compared in."""
    if isinstance(held, T.FloatType | T.DoubleType):
        return f"CAST({tolerance!r} AS DOUBLE)"
    scale = held.scale if isinstance(held, T.DecimalType) else 0
    return f"CAST({int(Decimal(repr(tolerance)).scaleb(scale))} AS {UNITS})"


def compare_samples(
    df1: DataFrame, df2: DataFrame, keys: Sequence[str], tolerance: float = TOLERANCE, n: int = SAMPLES
) -> DataFrame:
    """The first ``n`` differing pairs of values per column, in the order of the keys and then of the values.

    Equal pairs under one key are one sample. Of a repeated key the ``n + 1`` smallest and largest
    values of either side are paired, whatever it holds: they differ if any do.
    """
    keys = list(keys)
    common = _common(df1, df2, keys)
    single, repeated = _met(df1, df2, keys, common)
    entries = [
        F.when(
            _differs(F.col("r1")[c], F.col("r2")[c], df1.schema[c].dataType, tolerance),
            F.struct(
                F.lit(c).alias("column"),
                F.col("r1")[c].cast("string").alias("value_1"),
                F.col("r2")[c].cast("string").alias("value_2"),
                F.lit(1).alias("_o1"),
                F.lit(1).alias("_o2"),
            ),
        )
        for c in common
    ]
    differing = single.select(*keys, F.inline(F.array_compact(F.array(*entries))))
    # Every column looks at these rows four times.
    again = materialize(null_safe_join(_sides(df1, df2, keys, common), repeated.select(*keys), keys, "left_semi"))
    for c in common:
        one, two = (_ends(again, keys, c, side, n + 1) for side in (1, 2))
        pairs = null_safe_join(one, two, keys, "inner")
        pairs = pairs.where(_differs(F.col("v1"), F.col("v2"), df1.schema[c].dataType, tolerance))
        differing = differing.unionByName(
            pairs.select(
                *keys, F.lit(c).alias("column"), F.col("v1").cast("string").alias("value_1"), F.col("v2").cast("string").alias("value_2"), "_o1", "_o2"
            )
        )
    rank = F.row_number().over(Window.partitionBy("column").orderBy(*keys, "_o1", "_o2"))
    return differing.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank", "_o1", "_o2")


def _ends(sides: DataFrame, keys: list[str], column: str, side: int, n: int) -> DataFrame:
    """The ``n`` smallest and largest distinct values of a column per key, as ``v<side>``, with their place ``_o<side>``."""
    value, place = f"v{side}", f"_o{side}"
    values = sides.where(f"n{side} = 1").select(*keys, F.col(f"r{side}")[column].alias(value)).distinct()
    ends = []
    for sign, order in ((1, F.col(value).asc_nulls_first()), (-1, F.col(value).desc_nulls_last())):
        number = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
        ranked = values.withColumn(place, number).where(F.col(place) <= n)
        # Places from the large end are put behind those from the small end.
        ends.append(ranked if sign == 1 else ranked.withColumn(place, 3 * n - F.col(place)))
    return ends[0].unionByName(ends[1]).groupBy(*keys, value).agg(F.min(place).alias(place))


def compare_rows(df1: DataFrame, df2: DataFrame) -> DataFrame:
    """Whether both tables hold the same rows equally often, in columns of equal names and types, as one row.

    One exchange.
    """
    names = df1.columns
    if sorted(df1.dtypes) != sorted(df2.dtypes):
        return df1.sparkSession.range(1).select(F.lit(False).alias("data_equal"))
    both = df1.withColumn("_n", F.lit(1)).unionByName(df2.withColumn("_n", F.lit(-1)))
    unequal = both.groupBy(*names).agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0)
    return unequal.agg((F.count("*") == 0).alias("data_equal"))


def profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, null count, row count."""
    described = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            (F.col("_rows") - F.col(f"_known_{i}")).alias("null_count"),
            F.col("_rows").alias("row_count"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    counts = [F.count(F.col(f"`{c}`")).alias(f"_known_{i}") for i, c in enumerate(df.columns)]
    return df.agg(F.count("*").alias("_rows"), *counts).select(F.inline(F.array(*described)))
