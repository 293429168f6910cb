from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pandas as pd
import pytest
from conftest import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabprep.operators.cleaning import (
    clean_tenders,
    duplicates_removed,
    enforce_schema,
    remove_duplicates,
    trim_columns,
)
from tabprep.operators.enrichment import average_month_spread
from tabprep.operators.missing import exact_median, fill_directional, handle_missing
from tabprep.scratch import BUCKET, range_buckets

# Half of all rows share one group, as one hot key might.
GROUPS = ["a", "a", "a", "b", None]


def series(n=400, seed=3, gaps=0.7):
    rng = random.Random(seed)
    return [(i, rng.choice(GROUPS), None if rng.random() < gaps else float(i)) for i in range(n)]


@pytest.mark.parametrize("forward", [True, False])
@pytest.mark.parametrize("partitioned", [True, False])
@pytest.mark.parametrize("gaps", [0.7, 0.99])
def test_directional_fill_against_pandas(spark, forward, partitioned, gaps):
    data = series(gaps=gaps)
    df = spark.createDataFrame(data, "t long, g string, v double").repartition(5)
    filled = fill_directional(df, ["v"], ["t"], ["g"] if partitioned else [], forward)
    got = [r.v for r in filled.orderBy("t").collect()]
    pdf = pd.DataFrame(data, columns=["t", "g", "v"])
    source = pdf.groupby("g", dropna=False)["v"] if partitioned else pdf["v"]
    expected = source.ffill() if forward else source.bfill()
    assert got == [None if pd.isna(v) else v for v in expected]


def test_neighbouring_fills_share_a_pass(spark):
    rows = [(1, 1.0, None, None), (2, None, "x", None), (3, None, None, 3.0)]
    df = spark.createDataFrame(rows, "t int, a double, b string, c double")
    filled = handle_missing(df, {"a": "forward", "b": "forward", "c": "backward", "t": F.lit(0)}, ["t"])
    assert sorted(tuple(r) for r in filled.collect()) == [(1, 1.0, None, 3.0), (2, 1.0, "x", 3.0), (3, 1.0, "x", 3.0)]


@pytest.mark.parametrize("forward", [True, False])
def test_directional_fill_of_ties(spark, forward):
    """All rows tie: each null takes some value, and only the nulls ahead of all values stay."""
    df = spark.createDataFrame([(1, float(i) if i % 5 == 0 else None) for i in range(200)], "t int, v double").repartition(4)
    filled = fill_directional(df, ["v"], ["t"], forward=forward)
    assert filled.count() == 200 and {r.v for r in filled.where("v is not null").collect()} <= {float(i) for i in range(0, 200, 5)}
    assert filled.where("v is null").count() < 160


def test_equal_keys_spread_over_ranges(spark):
    df = spark.range(4000).select((F.col("id") * 0).alias("k"), F.lit("x").alias("copy"))
    sizes = [r["count"] for r in range_buckets(df, ["k"]).groupBy(BUCKET).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 4000 / 3


def test_directional_fill_needs_an_order(spark):
    with pytest.raises(ValueError, match="order_by"):
        handle_missing(spark.range(3), {"id": "forward"})


@pytest.mark.parametrize("values", [[3.0, 1.0, 2.0], [4.0, 1.0, 2.0, 100.0], [5.0] * 9 + [1.0], [7.0], [None, 2.0, 4.0]])
def test_exact_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_median(df, "v").first().v == pd.Series(values).median()


def test_exact_median_of_a_hot_value(spark):
    values = [10] * 500 + list(range(500))
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(6)
    assert exact_median(df, "v").first().v == pd.Series(values).median()


def test_missing_strategies(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, "x"), (3, 3.0, "y")], "i int, a double, b string")
    filled = handle_missing(df, {"a": 0, "b": "missing", "c": "zero"}).orderBy("i").collect()
    assert [(r.a, r.b) for r in filled] == [(1.0, "missing"), (0.0, "x"), (3.0, "y")]
    assert handle_missing(df, {"a": "drop"}).count() == 2
    assert handle_missing(df, {"a": None}).orderBy("i").collect()[1].a is None
    # The drop comes first, so the mean is that of the rows left.
    ordered = handle_missing(df, {"b": "drop", "a": "mean"}).orderBy("i").collect()
    assert [r.a for r in ordered] == [3.0, 3.0]
    assert handle_missing(df, {"a": F.col("i") * 10.0}).orderBy("i").collect()[1].a == 20.0


def test_remove_duplicates(spark):
    data = [(1, "a", 1), (2, "b", 2), (2, "b", 3), (3, "c", 4), (4, None, 5), (4, None, 6)]
    df = spark.createDataFrame(data, "id int, v string, t int")

    def kept(keep):
        return sorted(r.t for r in remove_duplicates(df, ["id", "v"], keep, ["t"]).collect())

    assert kept("first") == [1, 2, 4, 5]
    assert kept("last") == [1, 3, 4, 6]
    assert kept(False) == [1, 4]
    assert remove_duplicates(df, ["id", "v"]).count() == 4
    assert duplicates_removed(df, ["id", "v"]).first().asDict() == {"total": 6, "kept": 4, "removed": 2}
    with pytest.raises(ValueError):
        remove_duplicates(df, ["id"], "middle", ["t"])


def test_a_hot_key_is_cut_before_the_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = plan_of(remove_duplicates(df, ["k"], "last", ["id"]))
    assert "Partial" in plan.split("Exchange", 1)[1] and "WindowGroupLimit" in plan.split("Exchange", 1)[1]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["x", "y", None])), min_size=1, max_size=30), st.integers(1, 6))
def test_remove_duplicates_does_not_depend_on_partitions(spark, data, n):
    numbered = [(k, v, i) for i, (k, v) in enumerate(data)]
    df = spark.createDataFrame(numbered, "k int, v string, t int").repartition(n)
    got = sorted(r.t for r in remove_duplicates(df, ["k", "v"], "last", ["t"]).collect())
    assert got == sorted({(k, v): i for k, v, i in numbered}.values())


def test_enforce_schema(spark):
    df = spark.createDataFrame(
        [("1", "1.5", 7, "$1,000", "15/01/2025", "true", None)], "a string, b string, c int, d string, e string, f string, g string"
    )
    kinds = {"a": "int", "b": "float", "c": "string", "d": "decimal", "e": "date", "f": "bool", "g": "string", "zz": "int"}
    typed = enforce_schema(df, kinds)
    assert [t for _, t in typed.dtypes] == ["bigint", "double", "string", "decimal(38,10)", "timestamp_ntz", "boolean", "string"]
    assert tuple(typed.first()) == (1, 1.5, "7", Decimal(1000), dt.datetime(2025, 1, 15), True, None)
    assert enforce_schema(df, {"b": "int"}).first().b is None
    with pytest.raises(ValueError):
        enforce_schema(df, {"a": "colour"})


MESSY = [
    ("  TND-001 ", "  Bridge ", "Client A", " Energy", "won", "2025-01-15", "1,000,000", "€ 950,000.50", "80%", "760000", None),
    ("TND-002", "Road", None, "Energy", "submitted", "15/02/2025", "TBC", None, "0.5", None, "12"),
]
MESSY_SCHEMA = (
    "TenderID string, ProjectName string, ClientName string, BusinessDivision string, TenderStatus string, "
    "TenderReceivedDate string, TenderValue string, ReportingValue string, ProbabilityPercentage string, "
    "WeightedValue string, MonthlyForecast string"
)


def test_clean_tenders(spark):
    df = spark.createDataFrame(MESSY, MESSY_SCHEMA)
    first, second = clean_tenders(df).orderBy("TenderID").collect()
    assert (first.TenderID, first.TenderStatus, first.TenderValue) == ("TND-001", "Won", 1000000)
    assert (second.TenderStatus, second.ClientName, second.TenderValue, second.ReportingValue) == ("Submitted", "", 0, 0)
    assert first.ReportingValue == Decimal("950000.50") and first.MonthlyForecast is None
    assert first.TenderReceivedDate == dt.datetime(2025, 1, 15)
    # Read like any amount, a percentage is lost; it can be parsed instead.
    assert first.ProbabilityPercentage == 0
    assert clean_tenders(df, "parse").orderBy("TenderID").first().ProbabilityPercentage == Decimal("0.8")


def test_cleaning_twice_changes_nothing(spark):
    once = clean_tenders(spark.createDataFrame(MESSY, MESSY_SCHEMA))
    assert sorted(once.collect()) == sorted(clean_tenders(once).collect())


def test_cleaning_stays_in_the_engine(spark):
    plan = plan_of(clean_tenders(spark.createDataFrame(MESSY, MESSY_SCHEMA)))
    assert "Python" not in plan and "Exchange" not in plan


def test_trim_columns_keeps_nulls(spark):
    df = spark.createDataFrame(MESSY, MESSY_SCHEMA)
    assert [r.ClientName for r in trim_columns(df).orderBy("TenderID").collect()] == ["Client A", None]


def test_average_month_spread(spark):
    df = spark.createDataFrame(
        [("2025-01-01", "2026-01-01", 1200.0), ("2025-01-01", "2025-01-05", 5.0), (None, "2025-01-01", 1.0)],
        "ProjectStartDate string, ProjectEndDate string, ReportingValue double",
    )
    assert [r.MonthlySpread for r in average_month_spread(df).collect()] == [100.0, None, None]
