"""Contract checks: every row gets its list of errors, then a status."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.contracts import TENDER_RAW, TRANSACTION_RAW, Contract, Field
from tabprep.functions.numeric import MONEY, parse_currency, parse_probability

ERRORS = "_errors"
STATUS = "_status"
VALID, INVALID, QUARANTINED = "valid", "invalid", "quarantined"

# A date, maybe with a time of day; and one that has it.
ISO_DATE = r"^\d{4}-\d{2}-\d{2}($|[Tt ]\d{2}:\d{2})"
ISO_TIME = r"^\d{4}-\d{2}-\d{2}[Tt ]"
SHOWN_ERRORS = 10


class Rule(NamedTuple):
    field: str
    error: str
    broken: Column


def source_column(df: DataFrame, f: Field) -> str | None:
    """Column a field is read from: its source name, else its clean name."""
    return next((c for c in (f.source, f.name) if c in df.columns), None)


def rules_for(df: DataFrame, contract: Contract) -> list[Rule]:
    """The contract's checks as columns over ``df``."""
    rules: list[Rule] = []
    for f in contract.fields:
        name = source_column(df, f)
        if name is None:
            if f.required:
                rules.append(Rule(f.source, "missing", F.lit(True)))
            continue
        if f.parse is None:
            rules.extend(_checks(F.col(name), df.schema[name].dataType, f))
    return rules


def _checks(c: Column, held: T.DataType, f: Field) -> list[Rule]:
    rules = [] if f.nullable else [Rule(f.source, f"{f.kind}_type", c.isNull())]
    text = isinstance(held, T.StringType)
    if f.kind == "string" and not text:
        rules.append(Rule(f.source, "string_type", c.isNotNull()))
    elif f.kind == "date" and isinstance(held, T.TimestampType | T.TimestampNTZType):
        rules.append(Rule(f.source, "date_from_datetime_inexact", c != F.date_trunc("day", c)))
    elif f.kind == "date" and text:
        read = c.try_cast("timestamp_ntz")
        unread = F.when(c.rlike(ISO_DATE), read.isNull()).otherwise(c.isNotNull())
        timed = c.rlike(ISO_TIME) & (read != F.date_trunc("day", read))
        rules.append(Rule(f.source, "date_from_datetime_parsing", unread))
        rules.append(Rule(f.source, "date_from_datetime_inexact", timed))
    elif f.kind == "date" and not isinstance(held, T.DateType):
        rules.append(Rule(f.source, "date_type", c.isNotNull()))
    elif f.kind == "decimal":
        rules.append(Rule(f.source, "decimal_parsing", c.isNotNull() & c.try_cast(MONEY).isNull()))
    return rules


def with_errors(df: DataFrame, contract: Contract) -> DataFrame:
    """Add ``_errors``, the array of ``(field, type)`` a row breaks. A narrow projection.

    Short arrays are concatenated, which compiles; filtering one long array would be interpreted.
    """
    nothing = F.array().cast("array<struct<field:string,type:string>>")
    broken = [
        F.when(r.broken, F.array(F.struct(F.lit(r.field).alias("field"), F.lit(r.error).alias("type")))).otherwise(nothing)
        for r in rules_for(df, contract)
    ]
    return df.withColumn(ERRORS, F.concat(nothing, *broken))


def validate(df: DataFrame, contract: Contract, quarantine_threshold: float | None = 0.5) -> DataFrame:
    """Add ``_errors`` and ``_status``.

    If the share of bad rows exceeds the threshold, all of them are quarantined rather than
    invalid. The share is a scalar subquery over the same rows, so the frame stays lazy; it costs
    a second pass, which ``quarantine_threshold=None`` saves.
    """
    checked = with_errors(df, contract)
    bad = F.size(ERRORS) > 0
    if quarantine_threshold is None:
        held_as = F.lit(INVALID)
    else:
        share = checked.agg(F.try_divide(F.count_if(bad), F.count("*")).alias("share")).scalar()
        held_as = F.when(share > quarantine_threshold, QUARANTINED).otherwise(INVALID)
    return checked.withColumn(STATUS, F.when(bad, held_as).otherwise(VALID))


def validate_tenders(df: DataFrame, quarantine_threshold: float | None = 0.5) -> DataFrame:
    return validate(df, TENDER_RAW, quarantine_threshold)


def validate_transactions(df: DataFrame, quarantine_threshold: float | None = 0.5) -> DataFrame:
    return validate(df, TRANSACTION_RAW, quarantine_threshold)


def with_status(validated: DataFrame, status: str) -> DataFrame:
    """The rows of one status, without the check columns.

    Valid rows are those without errors, whatever the share of bad ones, which then need not be counted.
    """
    held = F.size(ERRORS) == 0 if status == VALID else F.col(STATUS) == status
    return validated.where(held).drop(ERRORS, STATUS)


def validation_errors(validated: DataFrame, id_column: str) -> DataFrame:
    """One row per error: record id, field, error type.

    The outer form keeps Spark from testing the array, and so evaluating it, in a filter first.
    """
    each = validated.select(F.col(id_column).alias("record_id"), F.explode_outer(ERRORS).alias("e"))
    return each.where(F.col("e").isNotNull()).select("record_id", "e.field", "e.type")


def validation_summary(checked: DataFrame, quarantine_threshold: float | None = 0.5) -> DataFrame:
    """Counts and rates as one row, from the ``_errors`` column alone in one pass.

    The total leaves quarantined rows out, so the quarantine rate can exceed 100.
    """
    bad = F.size(ERRORS) > 0
    counts = checked.agg(F.count_if(~bad).alias("valid_records"), F.count_if(bad).alias("bad"), F.count("*").alias("all"))
    limit = F.lit(quarantine_threshold).cast("double")
    held = F.coalesce(F.try_divide("bad", "all") > limit, F.lit(False))

    def rate(part: str, of_nothing: float) -> Column:
        share = F.coalesce(F.try_divide(F.col(part), F.col("total_records")), F.lit(of_nothing))
        return F.round(share * 100, 2)

    return (
        counts.withColumn("invalid_records", F.when(held, 0).otherwise(F.col("bad")))
        .withColumn("quarantined_records", F.when(held, F.col("bad")).otherwise(0))
        .withColumn("total_records", F.col("valid_records") + F.col("invalid_records"))
        .withColumns(
            {"success_rate": rate("valid_records", 1.0), "quarantine_rate": rate("quarantined_records", 0.0)}
        )
        .drop("bad", "all")
    )


def first_errors(validated: DataFrame, id_column: str, n: int = SHOWN_ERRORS) -> DataFrame:
    """The first bad rows by record id, for a report."""
    bad = validated.where(F.size(ERRORS) > 0)
    return bad.select(F.col(id_column).alias("record_id"), F.col(ERRORS).alias("errors")).orderBy("record_id").limit(n)


def coerce(df: DataFrame, contract: Contract) -> DataFrame:
    """Contract fields under their clean names with coerced values; extra columns are left out."""
    out: list[Column] = []
    for f in contract.fields:
        name = source_column(df, f)
        if name is None:
            value = F.lit(None if f.required else f.default).cast(f.sql_type)
        elif f.parse == "currency":
            value = parse_currency(name)
        elif f.parse == "probability":
            value = parse_probability(name)
        elif f.kind == "date":
            value = F.col(name).try_cast("timestamp_ntz").cast("date")
        else:
            value = F.col(name).try_cast(f.sql_type)
        out.append(value.alias(f.name))
    return df.select(*out)
