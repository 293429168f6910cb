"""Value spreads, calendar and fiscal periods, currency conversion, flags."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tabprep.functions.dates import as_date, duration_months, duration_months_avg
from tabprep.functions.numeric import value_tier
from tabprep.functions.text import lookup, strip

# Statuses behind the flags.
ACTIVE_STATUSES = ("Won", "Submitted", "In Progress", "On Hold")
LOST_STATUSES = ("Lost", "Declined", "Cancelled")
SCENARIOS = ("Actual", "Budget", "Forecast")
SPREAD_DATES = ("ProjectStartDate", "ProjectEndDate")


def _optional(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).try_cast(kind) if name in df.columns else F.lit(None).cast(kind)


def spreads(df: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Spread project values evenly over the months between start and end date.

    With an ``observation`` the row count, rows with a spread and rows lacking a date are
    reported when the frame is written.
    """
    df = df.withColumns({c: as_date(c) for c in SPREAD_DATES if c in df.columns})
    start, end = (_optional(df, c, "date") for c in SPREAD_DATES)
    months = F.col("ProjectDurationMonths")
    reporting = F.nullif(_optional(df, "ReportingValue", "double"), F.lit(0.0))
    value = F.coalesce(reporting, _optional(df, "TenderValue", "double"))
    df = df.withColumn("ProjectDurationMonths", duration_months(start, end)).withColumns(
        {
            "MonthlySpread": value / months,
            "WeightedMonthlySpread": _optional(df, "WeightedValue", "double") / months,
            "HasMissingDates": start.isNull() | end.isNull(),
            "MissingDateFields": F.concat_ws(
                ", ", *[F.when(d.isNull(), c) for d, c in zip((start, end), SPREAD_DATES, strict=True)]
            ),
        }
    )
    df = df.withColumn("QuarterlySpread", F.col("MonthlySpread") * 3)
    if observation is None:
        return df
    return df.observe(observation, *spread_counts())


def spread_counts() -> list[Column]:
    """Row count, rows with a spread, rows lacking a date."""
    return [
        F.count("*").alias("total"),
        F.count("MonthlySpread").alias("with_spread"),
        F.count_if("HasMissingDates").alias("missing_dates"),
    ]


def average_month_spread(df: DataFrame) -> DataFrame:
    """``MonthlySpread`` over average-length months; null unless the project has some."""
    months = duration_months_avg(*[as_date(c) for c in SPREAD_DATES])
    return df.withColumn(
        "MonthlySpread", F.when(months > 0, F.col("ReportingValue").try_cast("double") / months)
    )


def financial_periods(df: DataFrame, date_column: str = "Date", fiscal_year_start_month: int = 1) -> DataFrame:
    """Add calendar and fiscal period columns; a frame without the date column is returned as is.

    The fiscal year carries the year it ends in. Dates that cannot be read give null periods.
    """
    if date_column not in df.columns:
        return df
    if not 1 <= fiscal_year_start_month <= 12:
        raise ValueError("fiscal_year_start_month must be between 1 and 12")
    day = as_date(date_column)
    year, month, quarter = F.year(day), F.month(day), F.quarter(day)
    start = fiscal_year_start_month
    fiscal_year = year if start == 1 else year + F.when(month >= start, 1).otherwise(0)
    fiscal_month = F.pmod(month - start, F.lit(12)) + 1
    fiscal_quarter = F.ceil(fiscal_month / 3).cast("int")

    def two(c: Column) -> Column:
        return F.lpad(c.cast("string"), 2, "0")

    return df.withColumns(
        {
            "CalendarYear": year,
            "CalendarQuarter": quarter,
            "CalendarMonth": month,
            "CalendarMonthName": F.date_format(day, "MMM"),
            "CalendarWeek": F.weekofyear(day),
            "YearMonth": F.concat(year.cast("string"), F.lit("-"), two(month)),
            "YearQuarter": F.concat(year.cast("string"), F.lit("-Q"), quarter.cast("string")),
            "FiscalYear": fiscal_year,
            "FiscalQuarter": fiscal_quarter,
            "FiscalMonth": fiscal_month,
            "FiscalPeriod": F.concat(fiscal_year.cast("string"), F.lit("-P"), two(fiscal_month)),
            "FiscalQuarterLabel": F.concat(fiscal_year.cast("string"), F.lit("-Q"), fiscal_quarter.cast("string")),
            "YearMonthSort": year * 100 + month,
            "FiscalYearMonthSort": fiscal_year * 100 + fiscal_month,
        }
    )


def fx_convert(
    df: DataFrame,
    rates: Mapping[str, float] | DataFrame,
    amount_column: str = "AmountLocal",
    currency_column: str = "Currency",
    target_currency: str = "EUR",
) -> DataFrame:
    """Add ``Amount<target>`` and ``FXRateUsed``; a frame without the amount column is returned as is.

    ``rates`` is a mapping, put into the plan as a literal, or a frame ``(currency, rate)``, joined;
    Spark's size statistics choose how, and split a currency that makes up most rows. Amounts in the target currency stay as they are and unknown currencies give null.
    """
    if amount_column not in df.columns:
        return df
    code = F.upper(strip(currency_column))
    if isinstance(rates, DataFrame):
        # One row per currency, so that the join can never multiply rows.
        table = rates.groupBy(F.col("currency").alias("_fx_currency")).agg(
            F.when(F.count("*") > 1, F.raise_error(F.lit("several rates for one currency")).cast("double"))
            .otherwise(F.max(F.col("rate").cast("double")))
            .alias("_fx_rate")
        )
        joined = df.join(table, code == table["_fx_currency"], "left")
        rate = F.col("_fx_rate")
    else:
        joined = df
        rate = lookup(code, {k: float(v) for k, v in rates.items()}) if rates else F.lit(None).cast("double")
    amount = F.col(amount_column).cast("double")
    # The currency is matched before the rate is, so the target itself needs no rate.
    converted = F.when(code == target_currency, amount).otherwise(amount * rate)
    return joined.withColumns({f"Amount{target_currency}": converted, "FXRateUsed": rate}).drop(
        "_fx_currency", "_fx_rate"
    )


def _in(name: str, values: tuple[str, ...]) -> Column:
    return F.coalesce(F.col(name).isin(*values), F.lit(False))


def calculated_fields(df: DataFrame, source_type: str = "tender") -> DataFrame:
    """Derived columns by kind of table; an unknown kind is returned as is."""
    if source_type == "tender":
        df = spreads(df)
        if "TenderStatus" in df.columns:
            df = df.withColumns(
                {
                    "IsActive": _in("TenderStatus", ACTIVE_STATUSES),
                    "IsWon": _in("TenderStatus", ("Won",)),
                    "IsLost": _in("TenderStatus", LOST_STATUSES),
                }
            )
        if "ReportingValue" in df.columns:
            df = df.withColumn("ValueTier", value_tier("ReportingValue"))
    elif source_type == "financial":
        df = financial_periods(df, "Date")
        if "Scenario" in df.columns:
            df = df.withColumns({f"Is{s}": _in("Scenario", (s,)) for s in SCENARIOS})
    elif source_type == "dynamics365":
        df = financial_periods(df, "modifiedon")
    return df
