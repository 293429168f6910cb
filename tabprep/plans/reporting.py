"""Queries for enrichment (E) and measures (M)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tabprep.operators.cleaning import clean_tenders
from tabprep.operators.enrichment import (
    calculated_fields,
    financial_periods,
    fx_convert,
    spread_counts,
    spreads,
)
from tabprep.operators.facts import DIMENSIONS, dimension, register_members, to_tender_fact, to_transaction_fact
from tabprep.operators.measures import MEASURES, date_table, measures, time_measures
from tabprep.plans.adapters import OPPORTUNITIES, TENDERS, TENDERS_RAW, TRANSACTIONS, adapted
from tabprep.plans.functions import OPPS, TYPED, sql_months, sql_tier
from tabprep.plans.registry import query
from tabprep.plans.tables import CLEAN_SQL, LEDGER
from tabprep.scratch import scratch_dir

RATES = {"USD": 0.91, "GBP": 1.17, "BRL": 0.17}


def sql_enriched(tenders: str) -> str:
    months = sql_months("ProjectStartDate", "ProjectEndDate")
    return f"""SELECT *, coalesce(nullif(ReportingValue, 0), TenderValue)::double / months AS MonthlySpread,
        coalesce(nullif(ReportingValue, 0), TenderValue)::double / months * 3 AS QuarterlySpread,
        WeightedValue::double / months AS WeightedMonthlySpread,
        ProjectStartDate IS NULL OR ProjectEndDate IS NULL AS HasMissingDates,
        concat_ws(', ', CASE WHEN ProjectStartDate IS NULL THEN 'ProjectStartDate' END,
                  CASE WHEN ProjectEndDate IS NULL THEN 'ProjectEndDate' END) AS MissingDateFields,
        coalesce(TenderStatus IN ('Won', 'Submitted', 'In Progress', 'On Hold'), false) AS IsActive,
        coalesce(TenderStatus = 'Won', false) AS IsWon,
        coalesce(TenderStatus IN ('Lost', 'Declined', 'Cancelled'), false) AS IsLost,
        {sql_tier("ReportingValue")} AS ValueTier
        FROM (SELECT *, {months} AS months FROM ({tenders}))"""


ENRICHED = sql_enriched(TYPED)
CLEAN_ENRICHED = sql_enriched(
    f"SELECT * REPLACE (ProjectStartDate::date AS ProjectStartDate, ProjectEndDate::date AS ProjectEndDate) FROM ({CLEAN_SQL})"
)


def _enriched(spark, d):
    return calculated_fields(adapted(spark, d, TENDERS))


# One E query per output of the spread step.
SPREAD_COLUMNS = {
    "E1_duration_months": ("ProjectDurationMonths", "months"),
    "E2_monthly_spread": ("MonthlySpread", "MonthlySpread"),
    "E3_quarterly_spread": ("QuarterlySpread", "QuarterlySpread"),
    "E4_weighted_monthly_spread": ("WeightedMonthlySpread", "WeightedMonthlySpread"),
    "E5_has_missing_dates": ("HasMissingDates", "HasMissingDates"),
    "E6_missing_date_fields": ("MissingDateFields", "MissingDateFields"),
}


def _register_spread(name: str, column: str, sql: str) -> None:
    @query(name, f"SELECT k, {sql} AS {column} FROM ({ENRICHED})")
    def run(spark, d):
        return spreads(adapted(spark, d, TENDERS)).select("k", column)


for _name, (_column, _sql) in SPREAD_COLUMNS.items():
    _register_spread(_name, _column, _sql)


@query(
    "E7_spread_counts",
    f"""SELECT count(*) AS total, count(MonthlySpread) AS with_spread,
        count(*) FILTER (WHERE HasMissingDates) AS missing_dates FROM ({ENRICHED})""",
)
def e7(spark, d):
    return spreads(adapted(spark, d, TENDERS)).agg(*spread_counts())


def sql_periods(c: str, start: int) -> str:
    year = f"year({c})" if start == 1 else f"year({c}) + CASE WHEN month({c}) >= {start} THEN 1 ELSE 0 END"
    month = f"((month({c}) - {start} + 12) % 12 + 1)"
    return f"""year({c}) AS CalendarYear, quarter({c}) AS CalendarQuarter, month({c}) AS CalendarMonth,
        strftime({c}, '%b') AS CalendarMonthName, weekofyear({c}) AS CalendarWeek, strftime({c}, '%Y-%m') AS YearMonth,
        year({c}) || '-Q' || quarter({c}) AS YearQuarter, {year} AS FiscalYear,
        ({month} + 2) // 3 AS FiscalQuarter, {month} AS FiscalMonth,
        ({year}) || '-P' || lpad({month}::varchar, 2, '0') AS FiscalPeriod,
        ({year}) || '-Q' || (({month} + 2) // 3) AS FiscalQuarterLabel,
        year({c}) * 100 + month({c}) AS YearMonthSort, ({year}) * 100 + {month} AS FiscalYearMonthSort"""


CALENDAR = ("CalendarYear", "CalendarQuarter", "CalendarMonth", "CalendarMonthName", "CalendarWeek", "YearMonth", "YearQuarter")
FISCAL = ("FiscalYear", "FiscalQuarter", "FiscalMonth")
LABELS = ("FiscalPeriod", "FiscalQuarterLabel", "YearMonthSort", "FiscalYearMonthSort")


def _register_periods(name: str, columns: tuple[str, ...], start: int) -> None:
    sql = f"SELECT k, {', '.join(columns)} FROM (SELECT k, {sql_periods('ProjectStartDate', start)} FROM ({TYPED}))"

    @query(name, sql)
    def run(spark, d):
        return financial_periods(adapted(spark, d, TENDERS), "ProjectStartDate", start).select("k", *columns)


_register_periods("E8_calendar_periods", CALENDAR, 1)
_register_periods("E9_fiscal_periods", FISCAL, 4)
_register_periods("E10_period_labels", LABELS, 7)

SQL_CODE = "upper(trim(Currency))"
SQL_RATE = f"CASE {SQL_CODE} WHEN 'USD' THEN 0.91::double WHEN 'GBP' THEN 1.17::double WHEN 'BRL' THEN 0.17::double END"
CONVERTED = f"""SELECT *, CASE WHEN {SQL_CODE} = 'EUR' THEN AmountLocal::double ELSE AmountLocal::double * ({SQL_RATE}) END
    AS AmountEUR, {SQL_RATE} AS FXRateUsed FROM ({LEDGER})"""


@query("E11_fx_convert", f"SELECT TransactionID, Currency, AmountLocal::double AS AmountLocal, AmountEUR FROM ({CONVERTED})")
def e11(spark, d):
    rates = spark.createDataFrame(list(RATES.items()), "currency string, rate double")
    converted = fx_convert(adapted(spark, d, TRANSACTIONS), rates)
    return converted.select("TransactionID", "Currency", "AmountLocal", "AmountEUR")


@query("E12_fx_rate_used", f"SELECT TransactionID, Currency, FXRateUsed FROM ({CONVERTED})")
def e12(spark, d):
    return fx_convert(adapted(spark, d, TRANSACTIONS), RATES).select("TransactionID", "Currency", "FXRateUsed")


@query(
    "E13_tender_fields",
    f"SELECT k, MonthlySpread, HasMissingDates, MissingDateFields, IsActive, IsWon, IsLost, ValueTier FROM ({ENRICHED})",
)
def e13(spark, d):
    return _enriched(spark, d).select(
        "k", "MonthlySpread", "HasMissingDates", "MissingDateFields", "IsActive", "IsWon", "IsLost", "ValueTier"
    )


@query(
    "E14_financial_fields",
    f"""SELECT TransactionID, {sql_periods("Date", 1)}, Scenario = 'Actual' AS IsActual, Scenario = 'Budget' AS IsBudget,
        Scenario = 'Forecast' AS IsForecast FROM ({LEDGER})""",
)
def e14(spark, d):
    fields = calculated_fields(adapted(spark, d, TRANSACTIONS), "financial")
    return fields.select("TransactionID", *CALENDAR, *FISCAL, *LABELS, "IsActual", "IsBudget", "IsForecast")


@query(
    "E15_opportunity_fields",
    f"SELECT opportunityid, {sql_periods('m', 1)} FROM (SELECT opportunityid, modifiedon::date AS m FROM ({OPPS}))",
)
def e15(spark, d):
    fields = calculated_fields(adapted(spark, d, OPPORTUNITIES), "dynamics365")
    return fields.select("opportunityid", *CALENDAR, *FISCAL, *LABELS)


@query(
    "E16_tender_fact",
    f"""SELECT row_number() OVER (ORDER BY TenderID) AS tender_key, TenderID AS tender_id, ProjectName AS project_name,
        ClientName AS client_name, BusinessDivision AS business_division, TenderStatus AS tender_status,
        TenderReceivedDate AS tender_received_date, TenderSubmissionDate AS tender_submission_date,
        ProjectStartDate AS project_start_date, ProjectEndDate AS project_end_date, TenderValue::double AS tender_value,
        ReportingValue::double AS reporting_value, ProbabilityPercentage::double AS probability,
        WeightedValue::double AS weighted_value, ActionOwner AS action_owner, MonthlyForecast::double AS monthly_forecast,
        QuarterlyForecast::double AS quarterly_forecast,
        date_diff('day', ProjectStartDate, ProjectEndDate) AS project_duration_days, months AS project_duration_months,
        MonthlySpread AS monthly_spread, QuarterlySpread AS quarterly_spread, IsActive AS is_active,
        HasMissingDates AS has_missing_dates, 'orders.parquet' AS source_file FROM ({ENRICHED})""",
)
def e16(spark, d):
    return to_tender_fact(_enriched(spark, d), "orders.parquet").drop("load_timestamp")


def _sql_dimension(name: str) -> str:
    columns, key = DIMENSIONS[name]
    order = ", ".join(f"{c} NULLS FIRST" for c in columns)
    return f"SELECT row_number() OVER (ORDER BY {order}) AS {key}, * FROM (SELECT DISTINCT {', '.join(columns)} FROM ({LEDGER}))"


def _register_dimension(name: str) -> None:
    @query(f"E17_dimension_{name}", _sql_dimension(name))
    def run(spark, d):
        return dimension(adapted(spark, d, TRANSACTIONS), name)


for _name in DIMENSIONS:
    _register_dimension(_name)

_joins = " ".join(
    f"LEFT JOIN ({_sql_dimension(n)}) {n} ON "
    + " AND ".join(f"t.{c} IS NOT DISTINCT FROM {n}.{c}" for c in columns)
    for n, (columns, _) in DIMENSIONS.items()
)
_keys = [key for _, key in DIMENSIONS.values()]
_order = ", ".join(f"{c} NULLS FIRST" for c in ["TransactionID", "date_key", *_keys, "amount_local", "amount_eur", "fx_rate"])


@query(
    "E17_transaction_fact",
    f"""SELECT row_number() OVER (ORDER BY {_order}) AS transaction_key, * EXCLUDE (TransactionID) FROM (
        SELECT TransactionID, strftime(Date, '%Y%m%d')::bigint AS date_key, {", ".join(_keys)},
        AmountLocal::double AS amount_local, AmountEUR AS amount_eur, FXRateUsed AS fx_rate
        FROM ({CONVERTED}) t {_joins})""",
)
def e17(spark, d):
    return to_transaction_fact(fx_convert(adapted(spark, d, TRANSACTIONS), RATES))


@query(
    "E17_keys_two_loads",
    """WITH first AS (SELECT *, row_number() OVER (ORDER BY p_brand, p_type) AS part_key
        FROM (SELECT DISTINCT p_brand, p_type FROM part WHERE p_retailprice >= 980)),
      new AS (SELECT DISTINCT p_brand, p_type FROM part ANTI JOIN first USING (p_brand, p_type))
      SELECT * FROM first UNION ALL SELECT p_brand, p_type,
        row_number() OVER (ORDER BY p_brand, p_type) + (SELECT count(*) FROM first) FROM new""",
)
def e17_two_loads(spark, d):
    """Keys of a dimension after a second load that brings members with smaller codes."""
    path = f"{scratch_dir(spark)}/registry-{uuid.uuid4().hex}"
    parts = spark.read.parquet(f"{d}/part.parquet").select("p_brand", "p_type", "p_retailprice")
    columns = ["p_brand", "p_type"]
    register_members(parts.filter("p_retailprice >= 980"), columns, "part_key", path, 1)
    return register_members(parts, columns, "part_key", path, 2)


# --- measures


def _sql_total(c: str, where: str = "") -> str:
    return f"cast(sum({c}){f' FILTER (WHERE {where})' if where else ''} AS double)"


def _sql_spread(c: str) -> str:
    """Summed in decimals of the contract's type: no more digits than that of a double are its own."""
    return f"sum({c}::varchar::decimal(38,10))"


def _sql_ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} <> 0 THEN {part}::double / {whole}::double END"


WON = "count(*) FILTER (WHERE TenderStatus = 'Won')"
DECIDED = "count(*) FILTER (WHERE TenderStatus IN ('Won', 'Lost', 'Declined', 'Cancelled'))"
MISSING = "count(*) FILTER (WHERE HasMissingDates)"
SQL_MEASURES = {
    "total_tender_value": _sql_total("ReportingValue"),
    "total_weighted_value": _sql_total("WeightedValue"),
    "tender_count": "count(*)",
    "avg_deal_size": _sql_ratio(_sql_total("ReportingValue"), "count(*)"),
    "win_rate": _sql_ratio(WON, DECIDED),
    "monthly_spread_value": _sql_spread("MonthlySpread"),
    "quarterly_spread_value": _sql_spread("QuarterlySpread"),
    "weighted_monthly_spread": _sql_spread("WeightedMonthlySpread"),
    "active_pipeline_value": _sql_total("WeightedValue", "IsActive"),
    "won_pipeline_value": _sql_total("ReportingValue", "IsWon"),
    "lost_pipeline_value": _sql_total("ReportingValue", "IsLost"),
    "division_win_rate": _sql_ratio("count(*) FILTER (WHERE IsWon)", "count(*) FILTER (WHERE IsWon OR IsLost)"),
    "missing_dates_count": MISSING,
    "data_quality": _sql_ratio(f"(count(*) - {MISSING})", "count(*)"),
}
MEASURE_IDS = dict(
    zip(MEASURES, ("M1", "M2", "M3", "M4", "M5", "M6", "M7", "M8", "M13", "M14", "M15", "M16", "M17", "M18"), strict=True)
)
# Spreads have more digits than money; their sums are shown to the cent.
ROUNDED = ("monthly_spread_value", "quarterly_spread_value", "weighted_monthly_spread")


def _sql_measure(name: str) -> str:
    sql = SQL_MEASURES[name]
    return f"{sql}::decimal(38,6)::decimal(38,2)::double AS {name}" if name in ROUNDED else f"{sql} AS {name}"


def _rounded(df):
    # Six digits first, so that the last digits of a sum do not decide about half a cent.
    return df.withColumns(
        {c: F.round(F.col(c).cast("decimal(38,6)"), 2).cast("double") for c in ROUNDED if c in df.columns}
    )


def _register_measure(name: str) -> None:
    by = "BusinessDivision" if name == "division_win_rate" else "ClientName"

    @query(f"{MEASURE_IDS[name]}_{name}", f"SELECT {by}, {_sql_measure(name)} FROM ({ENRICHED}) GROUP BY {by}")
    def run(spark, d):
        return _rounded(measures(_enriched(spark, d), [by], [name]))


for _name in MEASURES:
    _register_measure(_name)

ALL_MEASURES = ", ".join(map(_sql_measure, SQL_MEASURES))


@query(
    "M_all_by_division",
    f"SELECT BusinessDivision, {ALL_MEASURES} FROM ({CLEAN_ENRICHED}) GROUP BY BusinessDivision",
)
def m_all(spark, d):
    """The whole way: read the messy register, clean, enrich, aggregate."""
    enriched = calculated_fields(clean_tenders(adapted(spark, d, TENDERS_RAW)))
    return _rounded(measures(enriched, ["BusinessDivision"]))


@query("M_all_total", f"SELECT {ALL_MEASURES} FROM ({ENRICHED})")
def m_total(spark, d):
    return _rounded(measures(_enriched(spark, d)))


def _register_subtotals(kind: str) -> None:
    by = "BusinessDivision, TenderStatus"

    @query(
        f"M_all_{kind}",
        f"SELECT {by}, {ALL_MEASURES}, GROUPING({by})::bigint AS grouping_level FROM ({ENRICHED}) GROUP BY {kind.upper()} ({by})",
    )
    def run(spark, d):
        return _rounded(measures(_enriched(spark, d), ["BusinessDivision", "TenderStatus"], subtotals=kind))


_register_subtotals("rollup")
_register_subtotals("cube")

TIME_SQL = f"""WITH monthly AS (SELECT BusinessDivision, date_trunc('month', TenderReceivedDate)::date AS month,
        sum(ReportingValue) AS v FROM ({TYPED}) GROUP BY 1, 2),
    bounds AS (SELECT min(month) AS lo, max(month) AS hi FROM monthly),
    months AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH))::date AS month FROM bounds),
    dense AS (SELECT g.BusinessDivision, m.month, monthly.v FROM (SELECT DISTINCT BusinessDivision FROM monthly) g
        CROSS JOIN months m LEFT JOIN monthly ON monthly.BusinessDivision = g.BusinessDivision AND monthly.month = m.month),
    timed AS (SELECT a.BusinessDivision, a.month, a.v,
        (SELECT sum(b.v) FROM dense b WHERE b.BusinessDivision = a.BusinessDivision
            AND year(b.month) = year(a.month) AND b.month <= a.month) AS ytd, p.v AS py
        FROM dense a LEFT JOIN dense p ON p.BusinessDivision = a.BusinessDivision
            AND p.month = (a.month - INTERVAL 1 YEAR)::date)"""
SQL_VARIANCE = "CASE WHEN v IS NOT NULL OR py IS NOT NULL THEN coalesce(v, 0) - coalesce(py, 0) END"
TIME_MEASURES = {
    "M9_ytd_tender_value": ("ytd_tender_value", "ytd::double"),
    "M10_py_tender_value": ("py_tender_value", "py::double"),
    "M11_yoy_variance": ("yoy_variance", f"({SQL_VARIANCE})::double"),
    "M12_yoy_pct": ("yoy_pct", f"CASE WHEN py <> 0 THEN ({SQL_VARIANCE})::double / py::double END"),
}


def _register_time(name: str, column: str, sql: str) -> None:
    @query(name, f"{TIME_SQL} SELECT BusinessDivision, month, v::double AS total_tender_value, {sql} AS {column} FROM timed")
    def run(spark, d):
        timed = time_measures(adapted(spark, d, TENDERS), by=["BusinessDivision"])
        return timed.select("BusinessDivision", "month", "total_tender_value", column)


for _name, (_column, _sql) in TIME_MEASURES.items():
    _register_time(_name, _column, _sql)


@query(
    "M19_date_table",
    f"""SELECT Date, {sql_periods("Date", 4)} FROM (SELECT unnest(generate_series(min(o_orderdate)::date::timestamp,
        max(o_orderdate)::date::timestamp, INTERVAL 1 DAY))::date AS Date FROM orders)""",
)
def m19(spark, d):
    return date_table(spark.read.parquet(f"{d}/orders.parquet"), "o_orderdate", 4)
