from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import plan_of
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tabprep.operators.enrichment import calculated_fields, financial_periods, fx_convert, spreads
from tabprep.operators.facts import dense_key, dimensions, hash_key, to_tender_fact, to_transaction_fact
from tabprep.operators.measures import date_table, measures, time_measures
from tabprep.sources.synthetic import gen_opportunities, gen_tenders, gen_transactions

TENDER = "ProjectStartDate date, ProjectEndDate date, ReportingValue double, TenderValue double, WeightedValue double"


def tender(spark, *rows):
    parse = lambda d: dt.date.fromisoformat(d) if d else None
    return spark.createDataFrame([(parse(r[0]), parse(r[1]), *r[2:]) for r in rows], TENDER)


def test_spreads(spark):
    r = spreads(tender(spark, ("2025-03-01", "2026-03-01", 1200000.0, None, 960000.0))).first()
    assert (r.ProjectDurationMonths, r.MonthlySpread, r.QuarterlySpread, r.WeightedMonthlySpread) == (12, 100000.0, 300000.0, 80000.0)
    assert (r.HasMissingDates, r.MissingDateFields) == (False, "")


def test_spread_value_falls_back(spark):
    day = ("2025-01-01", "2025-03-01")
    rows = [(*day, 0.0, 200.0, None), (*day, None, 200.0, None), (*day, 0.0, 0.0, None), (*day, 0.0, None, None)]
    got = [r.MonthlySpread for r in spreads(tender(spark, *rows)).collect()]
    assert got == [100.0, 100.0, 0.0, None]


def test_missing_dates(spark):
    rows = [(None, "2025-01-01", 1.0, 1.0, 1.0), (None, None, 1.0, 1.0, 1.0)]
    got = spreads(tender(spark, *rows)).collect()
    assert [r.MissingDateFields for r in got] == ["ProjectStartDate", "ProjectStartDate, ProjectEndDate"]
    assert all(r.HasMissingDates and r.MonthlySpread is None for r in got)


def test_spreads_without_value_columns(spark):
    r = spreads(tender(spark, ("2025-01-01", "2025-03-01", 1.0, 1.0, 1.0)).select("ProjectStartDate")).first()
    assert (r.HasMissingDates, r.MissingDateFields, r.MonthlySpread) == (True, "ProjectEndDate", None)


def test_spreads_of_text(spark):
    rows = [("2025-01-01", "2025-03-01", "1200.50", "x"), ("2025-01-01", "soon", "5", "1")]
    df = spark.createDataFrame(rows, "ProjectStartDate string, ProjectEndDate string, ReportingValue string, WeightedValue string")
    first, second = spreads(df).collect()
    assert (first.MonthlySpread, first.WeightedMonthlySpread, second.MissingDateFields) == (600.25, None, "ProjectEndDate")


def test_spread_observation(spark):
    seen = Observation()
    spreads(tender(spark, ("2025-01-01", "2025-03-01", 1.0, 1.0, 1.0), (None, None, 1.0, 1.0, 1.0)), seen).collect()
    assert seen.get == {"total": 2, "with_spread": 1, "missing_dates": 1}


def periods(spark, day, start):
    return financial_periods(spark.createDataFrame([(day,)], "Date string"), "Date", start).first()


def test_calendar_periods(spark):
    r = periods(spark, "2025-01-15", 1)
    assert (r.CalendarYear, r.CalendarQuarter, r.CalendarMonthName, r.YearMonth, r.YearQuarter) == (2025, 1, "Jan", "2025-01", "2025-Q1")
    assert (r.FiscalYear, r.FiscalPeriod, r.YearMonthSort) == (2025, "2025-P01", 202501)
    assert periods(spark, "2024-12-30", 1).CalendarWeek == 1


@pytest.mark.parametrize(
    "day, start, year, month, quarter",
    [
        ("2025-01-15", 4, 2025, 10, 4),
        ("2025-04-15", 4, 2026, 1, 1),
        ("2025-12-31", 10, 2026, 3, 1),
        ("2025-09-30", 10, 2025, 12, 4),
        ("2025-07-01", 7, 2026, 1, 1),
    ],
)
def test_fiscal_periods(spark, day, start, year, month, quarter):
    r = periods(spark, day, start)
    assert (r.FiscalYear, r.FiscalMonth, r.FiscalQuarter) == (year, month, quarter)
    assert r.FiscalPeriod == f"{year}-P{month:02d}" and r.FiscalYearMonthSort == year * 100 + month


def test_unreadable_dates_have_no_period(spark):
    r = periods(spark, "soon", 4)
    assert r.CalendarYear is None and r.YearQuarter is None and r.FiscalPeriod is None
    df = spark.range(1)
    assert financial_periods(df, "Date") is df
    with pytest.raises(ValueError):
        periods(spark, "2025-01-01", 13)


def amounts(spark):
    rows = [(1000.0, "USD"), (2000.0, "EUR"), (3000.0, "GBP"), (1.0, " usd "), (1.0, "XXX"), (None, "USD"), (1.0, None)]
    return spark.createDataFrame(rows, "AmountLocal double, Currency string")


RATES = {"USD": 0.91, "GBP": 1.17}


@pytest.mark.parametrize("as_frame", [True, False])
def test_fx(spark, as_frame):
    rates = spark.createDataFrame(list(RATES.items()), "currency string, rate double") if as_frame else RATES
    got = fx_convert(amounts(spark), rates).collect()
    key = {(r.AmountLocal, r.Currency): (r.AmountEUR, r.FXRateUsed) for r in got}
    assert key[(1000.0, "USD")] == (910.0, 0.91) and key[(3000.0, "GBP")][0] == pytest.approx(3510.0)
    # The target currency needs no rate.
    assert key[(2000.0, "EUR")] == (2000.0, None) and key[(1.0, " usd ")] == (0.91, 0.91)
    assert key[(1.0, "XXX")] == (None, None) and key[(None, "USD")] == (None, 0.91) and key[(1.0, None)] == (None, None)


def test_fx_edges(spark):
    rates = spark.createDataFrame(list(RATES.items()), "currency string, rate double")
    df = spark.range(1)
    assert fx_convert(df, RATES) is df
    with pytest.raises(Exception, match="Currency"):
        fx_convert(amounts(spark).drop("Currency"), RATES).collect()
    with pytest.raises(Exception, match="several rates"):
        fx_convert(amounts(spark), rates.union(rates)).collect()


def test_tender_flags(spark):
    statuses = ["Won", "Submitted", "Lost", "Declined", None, "Lead"]
    df = spark.createDataFrame([(i, s, 5000000.0) for i, s in enumerate(statuses)], "i int, TenderStatus string, ReportingValue double")
    got = calculated_fields(df.withColumns({"ProjectStartDate": F.lit(None).cast("date"), "ProjectEndDate": F.lit(None).cast("date")}))
    rows = got.orderBy("i").collect()
    assert [(r.IsActive, r.IsWon, r.IsLost) for r in rows] == [
        (True, True, False),
        (True, False, False),
        (False, False, True),
        (False, False, True),
        (False, False, False),
        (False, False, False),
    ]
    assert {r.ValueTier for r in rows} == {"5M+"}


def test_other_source_types(spark):
    r = calculated_fields(gen_transactions(spark, 1), "financial").first()
    assert [r.IsActual, r.IsBudget, r.IsForecast].count(True) == 1 and r.FiscalYear == 2025
    assert "YearMonth" in calculated_fields(gen_opportunities(spark, 1), "dynamics365").columns
    df = spark.range(1)
    assert calculated_fields(df, "other") is df


@pytest.mark.parametrize("n", [1, 3, 8])
def test_dense_key(spark, n):
    df = spark.range(500).select((F.col("id") * 37 % 501).alias("k")).repartition(n)
    keyed = dense_key(df, "key", ["k"]).orderBy("k").collect()
    assert [r.key for r in keyed] == list(range(1, 501))
    assert hash_key(df, "key", ["k"]).select("key").distinct().count() == 500


def test_tender_fact(spark):
    fact = to_tender_fact(calculated_fields(gen_tenders(spark, 30)), "register.xlsx")
    assert len(fact.columns) == 25
    assert sorted(r.tender_key for r in fact.collect()) == list(range(1, 31))


def test_transaction_fact(spark):
    ledger = fx_convert(gen_transactions(spark, 200), RATES)
    dims = dimensions(ledger)
    fact = to_transaction_fact(ledger, dims)
    assert fact.columns == [
        "transaction_key", "date_key", "account_key", "department_key", "cost_center_key", "entity_key",
        "scenario_key", "amount_local", "amount_eur", "fx_rate",
    ]
    assert fact.count() == 200 and fact.where("account_key is null or scenario_key is null").isEmpty()
    assert sorted(r.account_key for r in dims["account"].collect()) == list(range(1, dims["account"].count() + 1))


def test_a_missing_member_has_its_own_key(spark):
    ledger = fx_convert(gen_transactions(spark, 50), RATES).withColumn("Department", F.lit(None).cast("string"))
    dims = dimensions(ledger, ["department", "entity"])
    assert [r.Department for r in dims["department"].collect()] == [None]
    assert to_transaction_fact(ledger).where("department_key = 1").count() == 50


MEASURED = "Division string, TenderStatus string, ReportingValue double, WeightedValue double, MonthlySpread double, " \
    "QuarterlySpread double, WeightedMonthlySpread double, IsActive boolean, IsWon boolean, IsLost boolean, HasMissingDates boolean"


def measured(spark):
    return spark.createDataFrame(
        [
            ("a", "Won", 100.0, 50.0, 1.0, 3.0, 0.5, True, True, False, False),
            ("a", "Lost", 300.0, 10.0, None, None, None, False, False, True, True),
            ("b", "Lead", 7.0, 7.0, 2.0, 6.0, 1.0, False, False, False, False),
        ],
        MEASURED,
    )


def test_measures(spark):
    a, b = measures(measured(spark), ["Division"]).orderBy("Division").collect()
    assert (a.total_tender_value, a.tender_count, a.avg_deal_size, a.win_rate) == (400.0, 2, 200.0, 0.5)
    assert (a.won_pipeline_value, a.lost_pipeline_value, a.active_pipeline_value) == (100.0, 300.0, 50.0)
    assert (a.missing_dates_count, a.data_quality) == (1, 0.5)
    # No decided tender: the rate is blank.
    assert (b.win_rate, b.division_win_rate, b.quarterly_spread_value) == (None, None, 6.0)
    total = measures(measured(spark)).first()
    assert total.tender_count == 3 and total.total_weighted_value == 67.0


def test_subtotals(spark):
    rolled = measures(measured(spark), ["Division", "TenderStatus"], ["tender_count"], "rollup")
    assert {(r.grouping_level, r.Division): r.tender_count for r in rolled.where("TenderStatus is null").collect()} == {
        (1, "a"): 2,
        (1, "b"): 1,
        (3, None): 3,
    }
    assert measures(measured(spark), ["Division", "TenderStatus"], ["tender_count"], "cube").count() == 9
    with pytest.raises(ValueError):
        measures(measured(spark), ["Division"], subtotals="all")


def test_time_measures(spark):
    days = [("2023-12-05", 5.0), ("2024-01-10", 10.0), ("2024-03-10", 30.0), ("2025-01-20", 40.0), (None, 99.0)]
    df = spark.createDataFrame(days, "TenderReceivedDate string, ReportingValue double")
    got = {str(r.month): r for r in time_measures(df).collect()}
    assert len(got) == 14
    assert got["2024-02-01"].ytd_tender_value == 10.0 and got["2024-02-01"].total_tender_value is None
    assert got["2024-12-01"].ytd_tender_value == 40.0 and got["2024-12-01"].yoy_variance == -5.0
    january = got["2025-01-01"]
    assert (january.py_tender_value, january.yoy_variance, january.yoy_pct) == (10.0, 30.0, 3.0)
    # Nothing to compare with: the whole value is the change, and the share is blank.
    assert (got["2024-03-01"].yoy_variance, got["2024-03-01"].yoy_pct) == (30.0, None)
    assert got["2024-02-01"].yoy_variance is None


def test_date_table(spark):
    df = spark.createDataFrame([("2024-02-27",), ("2024-03-02",)], "d string")
    days = date_table(df, "d", 4).orderBy("Date").collect()
    assert [r.Date.day for r in days] == [27, 28, 29, 1, 2] and days[-1].FiscalYear == 2024


def test_small_amounts_add_up(spark):
    rows = [("Won", True, True, False, False, Decimal("0.0040"), 0.0000004)] * 1000
    schema = "TenderStatus string, IsActive boolean, IsWon boolean, IsLost boolean, HasMissingDates boolean, WeightedValue decimal(38,10), MonthlySpread double"
    found = measures(spark.createDataFrame(rows, schema), names=["total_weighted_value", "active_pipeline_value", "monthly_spread_value"]).first()
    assert tuple(found) == (4.0, 4.0, 0.0004)


def test_large_amounts_add_up(spark):
    df = spark.createDataFrame([(Decimal(10) ** 20,), (Decimal("0.01"),)], "ReportingValue decimal(38,10)")
    assert measures(df, names=["total_tender_value"]).first()[0] == 1e20
