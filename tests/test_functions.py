from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tabprep.functions import (
    clean_date,
    clean_numeric,
    clean_string,
    duration_months,
    duration_months_avg,
    parse_currency,
    parse_probability,
    standardize_status,
    statecode,
    strip,
    title_case,
    value_tier,
)


def rows(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r.v for r in df.select("i", expression("c").alias("v")).orderBy("i").collect()]


def test_clean_string(spark):
    given = ["  hello  ", None, "\t a b\n 　", "", "\x1cx\x85"]
    assert rows(spark, given, clean_string) == ["hello", "", "a b", "", "x"]
    assert rows(spark, [123], clean_string, "int") == ["123"]
    assert rows(spark, given, clean_string) == [(v or "").strip() for v in given]
    assert rows(spark, [None, " x "], strip) == [None, "x"]


def test_clean_numeric(spark):
    given = ["1,000,000", "$1,000.50", "€ 500", "£7", None, "1.234,56", "80%", "(500)", "1e3", "TBC", "\t5\n"]
    expected = ["1000000", "1000.5", "500", "7", None, "1.23456", None, None, "1000", None, "5"]
    assert rows(spark, given, clean_numeric) == [None if e is None else Decimal(e) for e in expected]
    assert rows(spark, [1.5, None], clean_numeric, "double") == [Decimal("1.5"), None]


def test_parse_currency(spark):
    given = ["1,000,000", "$1,000,000", "€ 950,000.50", None, "TBC"]
    expected = [1000000, 1000000, Decimal("950000.50"), 0, 0]
    assert rows(spark, given, parse_currency) == expected
    assert rows(spark, [1000000], parse_currency, "bigint") == [1000000]


def test_parse_probability(spark):
    given = ["80%", "0.8", "50", "0.25", "1%", "0,5", "abc", None, " 30 % "]
    expected = ["0.8", "0.8", "0.5", "0.25", "1", "0.5", "0", "0", "0.3"]
    assert rows(spark, given, parse_probability) == [Decimal(e) for e in expected]
    # A number is not taken for a percentage.
    assert rows(spark, [80.0, None, 0.25], parse_probability, "double") == [80, 0, Decimal("0.25")]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-01-15", "2025-01-15"),
        ("2025-1-5", "2025-01-05"),
        ("15/01/2025", "2025-01-15"),
        ("01/15/2025", "2025-01-15"),
        ("5/1/2025", "2025-01-05"),
        ("2025/01/15", "2025-01-15"),
        ("15-01-2025", "2025-01-15"),
        ("Jan 5, 2025", "2025-01-05"),
        ("jan 5, 2025", "2025-01-05"),
        ("5 Jan 2025", "2025-01-05"),
        ("20250115", "2025-01-15"),
        ("January 5, 2025", "2025-01-05"),
        (" 2025-01-15\t", "2025-01-15"),
        ("2025-01-15 10:30:00", "2025-01-15 10:30:00"),
        ("2025-01-15T10:30:00", "2025-01-15 10:30:00"),
        ("January 5 2025", "2025-01-05"),
        ("5 January 2025", "2025-01-05"),
        ("5-Jan-2025", "2025-01-05"),
        ("Sept 5, 2025", "2025-09-05"),
        ("May 5th 2025", "2025-05-05"),
        ("Jan 5, 2025 3:04:05", "2025-01-05 03:04:05"),
        ("1/5/2025 10:30", "2025-01-05 10:30:00"),
        ("13/01/2025 10:30", "2025-01-13 10:30:00"),
        ("05.01.2025", "2025-05-01"),
        ("13.01.2025", "2025-01-13"),
        ("01-15-2025", "2025-01-15"),
        ("2025.01.05", "2025-01-05"),
        ("2025/1/5 10:30", "2025-01-05 10:30:00"),
        ("Marchy 5, 2025", None),
        ("Jan 32, 2025", None),
        ("1/2.2025", None),
        ("31/02/2025", None),
        ("2025-02-30", None),
        ("13/13/2025", None),
        ("199707", None),
        ("TBC", None),
        ("", None),
        (None, None),
    ],
)
def test_clean_date(one, text, expected):
    when = None if expected is None else dt.datetime.fromisoformat(expected)
    assert one(clean_date("c"), c=text) == when


def test_clean_date_formats(one):
    assert one(clean_date("c", ["dd.MM.yyyy"]), c="15.01.2025") == dt.datetime(2025, 1, 15)
    assert one(clean_date("c", ["dd.MM.yyyy"]), c="15/01/2025") is None


def test_status(spark):
    given = ["won", "CLOSED WON", "proposal", "negotiating", "unknown", " active ", "", None, "in review", "Awarded"]
    expected = ["Won", "Won", "Proposal", "Negotiation", "Unknown", "In Progress", "Unknown", "Unknown", "In Review", "Won"]
    assert rows(spark, given, standardize_status) == expected
    assert rows(spark, ["x"], lambda c: standardize_status(c, {"x": "Ex"})) == ["Ex"]


def test_title_case(spark):
    given = ["o'neil-smith", "HELLO wORLD", "3rd place", "élan vital", "", None, "a1b2"]
    assert rows(spark, given, title_case) == [None if v is None else v.title() for v in given]


def test_value_tier(spark):
    given = [None, 0.0, 99999.99, 100000.0, 500000.0, 1000000.0, 4999999.0, 5000000.0]
    expected = ["Unknown", "<100K", "<100K", "100K-500K", "500K-1M", "1M-5M", "1M-5M", "5M+"]
    assert rows(spark, given, value_tier, "double") == expected


@pytest.mark.parametrize(
    "start, end, months",
    [
        ("2025-03-01", "2026-03-01", 12),
        ("2025-03-31", "2026-02-28", 10),
        ("2025-03-01", "2025-03-20", 1),
        ("2025-03-01", "2024-03-01", 1),
        (None, "2025-03-01", None),
        ("2025-03-01", None, None),
    ],
)
def test_duration_months(one, start, end, months):
    a, b = F.col("a").cast("date"), F.col("b").cast("date")
    assert one(duration_months(a, b), a=start, b=end) == months


def test_duration_months_avg(one):
    a, b = F.col("a").cast("date"), F.col("b").cast("date")
    assert one(duration_months_avg(a, b), a="2025-01-01", b="2026-01-01") == round(365 / 30.44)
    assert one(duration_months_avg(a, b), a="2025-01-01", b="2025-01-10") == 0


def test_statecode(spark):
    assert rows(spark, ["Open", "In Progress", "Qualified", "Won", "Lost", None], statecode) == [0, 0, 0, 1, 1, 1]
