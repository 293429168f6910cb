"""Table cleaning: duplicates, column types, the tender register clean-up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.dates import clean_date
from tabprep.functions.numeric import MONEY, clean_numeric, parse_probability
from tabprep.functions.text import UNKNOWN, clean_string, standardize_status, strip

# Columns of the tender register by the cleaning they get.
TEXT_COLUMNS = ("TenderID", "ProjectName", "ClientName", "BusinessDivision", "TenderStatus", "ActionOwner")
AMOUNT_COLUMNS = (
    "TenderValue",
    "ReportingValue",
    "ProbabilityPercentage",
    "WeightedValue",
    "MonthlyForecast",
    "QuarterlyForecast",
)
DATE_COLUMNS = ("TenderReceivedDate", "TenderSubmissionDate", "ProjectStartDate", "ProjectEndDate")
ZERO_FILLED = ("TenderValue", "ReportingValue", "ProbabilityPercentage", "WeightedValue")
TRIMMED_COLUMNS = ("ClientName", "ProjectName", "BusinessDivision", "TenderStatus", "ActionOwner")


def remove_duplicates(
    df: DataFrame,
    subset: Sequence[str],
    keep: str | bool = "first",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Keep the ``first`` or ``last`` row per key in ``order_by`` order, or (``False``) only single rows.

    Nulls in the key compare equal. Without ``order_by`` any copy is kept. A key with very many
    copies is cut down to one row per input split before the exchange: the rank filter becomes a
    partial group limit, and the count is a partial aggregate.
    """
    keys = list(subset)
    if keep is False:
        rest = [c for c in df.columns if c not in keys]
        single = (
            df.groupBy(*keys)
            .agg(F.count("*").alias("_n"), F.first(F.struct(*rest)).alias("_row") if rest else F.lit(None).alias("_row"))
            .where(F.col("_n") == 1)
        )
        return single.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first', 'last' or False, not {keep!r}")
    if not order_by:
        return df.dropDuplicates(keys)
    order = [F.col(c).asc() if keep == "first" else F.col(c).desc() for c in order_by]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def duplicates_removed(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """One row with the number of rows, of distinct keys, and of rows beyond the first per key."""
    return (
        df.groupBy(*subset)
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
            F.count("*").alias("kept"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("removed"),
        )
    )


def enforce_schema(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Cast columns to declared types; what cannot be cast becomes null, unknown columns are skipped."""
    casts: dict[str, Column] = {}
    for name, kind in schema.items():
        if name in df.columns:
            casts[name] = _cast(F.col(name), df.schema[name].dataType, kind)
    return df.withColumns(casts)


def _cast(c: Column, held: T.DataType, kind: str) -> Column:
    text = isinstance(held, T.StringType)
    if kind in ("string", "str"):
        return c.cast("string")
    if kind in ("int", "int64", "Int64"):
        return c.try_cast("bigint")
    if kind in ("float", "float64"):
        return c.try_cast("double")
    if kind == "decimal":
        return clean_numeric(c) if text else c.try_cast(MONEY)
    if kind in ("date", "datetime"):
        return clean_date(c) if text else c.cast("timestamp_ntz")
    if kind == "bool":
        return c.try_cast("boolean")
    raise ValueError(f"unknown type name {kind!r}")


def clean_tenders(df: DataFrame, probability: str = "amount") -> DataFrame:
    """Standard clean-up of the tender register as one projection; absent columns are skipped.

    ``probability="amount"`` reads the probability like any amount, so a text such as ``80%`` ends
    as 0; ``"parse"`` reads it as a share.
    """
    cleaned: dict[str, Column] = {}
    for name in df.columns:
        c, text = F.col(name), isinstance(df.schema[name].dataType, T.StringType)
        if name == "TenderStatus":
            cleaned[name] = standardize_status(clean_string(c))
        elif name in TEXT_COLUMNS:
            cleaned[name] = clean_string(c)
        elif name == "ProbabilityPercentage" and probability == "parse":
            cleaned[name] = parse_probability(c)
        elif name in AMOUNT_COLUMNS:
            amount = clean_numeric(c) if text else c.try_cast(MONEY)
            cleaned[name] = F.coalesce(amount, F.lit(0).cast(MONEY)) if name in ZERO_FILLED else amount
        elif name in DATE_COLUMNS:
            cleaned[name] = clean_date(c) if text else c.cast("timestamp_ntz")
    return df.withColumns(cleaned)


def trim_columns(df: DataFrame, columns: Sequence[str] = TRIMMED_COLUMNS) -> DataFrame:
    """Trim text columns and leave nulls null."""
    return df.withColumns({c: strip(c) for c in columns if c in df.columns})


__all__ = [
    "UNKNOWN",
    "clean_tenders",
    "duplicates_removed",
    "enforce_schema",
    "remove_duplicates",
    "trim_columns",
]
