"""Reporting measures: one aggregation for any set of measures and any grouping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.operators.enrichment import LOST_STATUSES, financial_periods
from tabprep.scratch import materialize, null_safe_join

# Money is summed as decimals, in the type of the contracts, so a result never depends on the order
# of the rows and no row is rounded to cents before it is added.
SUM_TYPE = "decimal(38,10)"


def _total(column: str, when: Column | None = None) -> Column:
    value = F.col(column).cast(SUM_TYPE)
    return F.sum(value if when is None else F.when(when, value)).cast("double")


def _ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def _won() -> Column:
    return F.col("TenderStatus") == "Won"


def _decided() -> Column:
    return F.col("TenderStatus").isin("Won", *LOST_STATUSES)


# Measure name -> aggregate expression; blank (null) where a denominator is zero.
MEASURES = {
    "total_tender_value": lambda: _total("ReportingValue"),
    "total_weighted_value": lambda: _total("WeightedValue"),
    "tender_count": lambda: F.count("*"),
    "avg_deal_size": lambda: _ratio(_total("ReportingValue"), F.count("*")),
    "win_rate": lambda: _ratio(F.count_if(_won()), F.count_if(_decided())),
    "monthly_spread_value": lambda: _total("MonthlySpread"),
    "quarterly_spread_value": lambda: _total("QuarterlySpread"),
    "weighted_monthly_spread": lambda: _total("WeightedMonthlySpread"),
    "active_pipeline_value": lambda: _total("WeightedValue", F.col("IsActive")),
    "won_pipeline_value": lambda: _total("ReportingValue", F.col("IsWon")),
    "lost_pipeline_value": lambda: _total("ReportingValue", F.col("IsLost")),
    "division_win_rate": lambda: _ratio(F.count_if("IsWon"), F.count_if(F.col("IsWon") | F.col("IsLost"))),
    "missing_dates_count": lambda: F.count_if("HasMissingDates"),
    "data_quality": lambda: _ratio(F.count("*") - F.count_if("HasMissingDates"), F.count("*")),
}


def measures(
    df: DataFrame, by: Sequence[str] = (), names: Sequence[str] | None = None, subtotals: str | None = None
) -> DataFrame:
    """Any measures of an enriched tender table by any columns, in one aggregation.

    ``subtotals`` is ``rollup`` or ``cube``; subtotal rows then carry ``grouping_level``, whose
    bits mark the columns summed over. All measures aggregate partially before the exchange.
    """
    columns = [MEASURES[n]().alias(n) for n in (names or MEASURES)]
    if subtotals is None:
        return df.groupBy(*by).agg(*columns)
    if subtotals not in ("rollup", "cube"):
        raise ValueError(f"subtotals must be 'rollup' or 'cube', not {subtotals!r}")
    grouped = df.rollup(*by) if subtotals == "rollup" else df.cube(*by)
    return grouped.agg(*columns, F.grouping_id().alias("grouping_level"))


def date_table(df: DataFrame, date_column: str, fiscal_year_start_month: int = 1) -> DataFrame:
    """One row per day from the first to the last date of a column, with all period columns."""
    day = F.col(date_column).cast("date")
    days = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("Date")
    )
    return financial_periods(days, "Date", fiscal_year_start_month)


def time_measures(df: DataFrame, date_column: str = "TenderReceivedDate", by: Sequence[str] = ()) -> DataFrame:
    """Total, year-to-date, previous-year value and year-over-year change per month.

    Rows are summed per month first, and the sums written down once since they are read for the
    calendar's bounds, its groups and its values. The windows then run over one row per group and
    month of a calendar without gaps, so a month without tenders still has a year-to-date value.
    """
    keys = list(by)
    month = F.trunc(F.col(date_column).cast("date"), "month")
    monthly = materialize(
        df.where(F.col(date_column).isNotNull())
        .groupBy(*keys, month.alias("month"))
        .agg(F.sum(F.col("ReportingValue").cast(SUM_TYPE)).alias("value"))
    )
    # The first and last month are scalars, so the calendar is laid out per group without a join.
    lo = monthly.agg(F.min("month")).scalar()
    hi = monthly.agg(F.max("month")).scalar()
    groups = monthly.select(*keys).distinct() if keys else monthly.agg(F.count("*").alias("_n")).where("_n > 0")
    calendar = groups.select(*keys, F.explode(F.sequence(lo, hi, F.expr("interval 1 month"))).alias("month"))
    dense = null_safe_join(calendar, monthly, [*keys, "month"])

    to_date = (
        Window.partitionBy(*keys, F.year("month")).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    )
    year_before = F.lag("value", 12).over(Window.partitionBy(*keys).orderBy("month"))
    total, previous = F.col("total_tender_value"), F.col("py_tender_value")
    return (
        dense.select(
            *keys,
            "month",
            F.col("value").cast("double").alias("total_tender_value"),
            F.sum("value").over(to_date).cast("double").alias("ytd_tender_value"),
            year_before.cast("double").alias("py_tender_value"),
            # A blank counts as zero on either side, two blanks stay blank.
            F.when(
                F.col("value").isNotNull() | year_before.isNotNull(),
                F.coalesce(F.col("value"), F.lit(0)) - F.coalesce(year_before, F.lit(0)),
            )
            .cast("double")
            .alias("yoy_variance"),
        )
        .withColumn("yoy_pct", F.try_divide(F.col("yoy_variance"), previous))
        .select(*keys, "month", total, "ytd_tender_value", previous, "yoy_variance", "yoy_pct")
    )
