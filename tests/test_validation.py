from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tabprep.contracts import TENDER_RAW, TRANSACTION_RAW
from tabprep.operators.validation import (
    coerce,
    first_errors,
    validate,
    validate_tenders,
    validate_transactions,
    validation_errors,
    validation_summary,
    with_errors,
    with_status,
)
from tabprep.sinks.files import write_quarantine

TENDER = {
    "TenderID": "T1", "ProjectName": "P", "ClientName": "C", "BusinessDivision": "D", "TenderStatus": "Won",
    "ProjectStartDate": "2025-01-15", "TenderValue": "$1,000,000", "ProbabilityPercentage": "80%", "ActionOwner": "me",
}


def frame(spark, *changes):
    rows = [{**TENDER, **c} for c in changes]
    schema = ", ".join(f"{c} string" for c in TENDER)
    return spark.createDataFrame([tuple(r[c] for c in TENDER) for r in rows], schema)


def errors_of(df, contract=TENDER_RAW):
    return [(e.field, e.type) for e in with_errors(df, contract).first()._errors]


@pytest.mark.parametrize(
    "change, expected",
    [
        ({}, []),
        ({"TenderID": None}, [("TenderID", "string_type")]),
        ({"ActionOwner": None}, [("ActionOwner", "string_type")]),
        ({"ClientName": ""}, []),
        ({"TenderValue": None}, []),
        ({"TenderValue": "TBC"}, []),
        ({"ProjectStartDate": None}, []),
        ({"ProjectStartDate": "15/01/2025"}, [("ProjectStartDate", "date_from_datetime_parsing")]),
        ({"ProjectStartDate": "2025-02-30"}, [("ProjectStartDate", "date_from_datetime_parsing")]),
        ({"ProjectStartDate": "2025-01-15T00:00:00"}, []),
        ({"ProjectStartDate": "2025-01-15 10:00:00"}, [("ProjectStartDate", "date_from_datetime_inexact")]),
        ({"ProjectStartDate": "20250115"}, [("ProjectStartDate", "date_from_datetime_parsing")]),
    ],
)
def test_tender_rules(spark, change, expected):
    assert errors_of(frame(spark, change)) == expected


def test_absent_columns(spark):
    # A default stands in for an absent column; a required one is missing in every row.
    assert errors_of(frame(spark, {}).drop("ActionOwner", "TenderValue")) == []
    assert errors_of(frame(spark, {}).drop("TenderStatus", "ClientName")) == [
        ("ClientName", "missing"),
        ("TenderStatus", "missing"),
    ]
    # The clean name is accepted as well.
    assert errors_of(frame(spark, {}).withColumnRenamed("ClientName", "client_name")) == []


def test_transaction_rules(spark):
    schema = "TransactionID string, Date string, AccountCode {}, AccountName string, AmountLocal string"
    good = spark.createDataFrame([("1", "2025-01-01", "4000", "x", "12.5")], schema.format("string"))
    assert errors_of(good, TRANSACTION_RAW) == []
    codes = spark.createDataFrame([("1", "2025-01-01", 4000, "x", "12.5")], schema.format("int"))
    assert errors_of(codes, TRANSACTION_RAW) == [("AccountCode", "string_type")]
    bad = spark.createDataFrame([("1", None, "4000", "x", "1,000")], schema.format("string"))
    assert errors_of(bad, TRANSACTION_RAW) == [("Date", "date_type"), ("AmountLocal", "decimal_parsing")]


def summary(df, threshold=0.5):
    return validation_summary(validate(df, TENDER_RAW, threshold), threshold).first()


def test_one_good_row(spark):
    s = summary(frame(spark, {}))
    assert (s.valid_records, s.invalid_records, s.quarantined_records, s.success_rate) == (1, 0, 0, 100.0)


def test_one_bad_row_is_quarantined(spark):
    s = summary(frame(spark, {"TenderID": None}))
    assert (s.total_records, s.invalid_records, s.quarantined_records) == (0, 0, 1)
    # Quarantined rows do not count, and of nothing everything succeeded.
    assert (s.success_rate, s.quarantine_rate) == (100.0, 0.0)


def test_the_threshold_is_exclusive(spark):
    half = frame(spark, {}, {"TenderID": None})
    assert summary(half).invalid_records == 1
    assert [r._status for r in validate_tenders(half).orderBy("_status").collect()] == ["invalid", "valid"]
    more = frame(spark, {}, {"TenderID": None}, {"ClientName": None})
    s = summary(more)
    assert (s.quarantined_records, s.invalid_records, s.quarantine_rate) == (2, 0, 200.0)
    assert summary(more, None).invalid_records == 2
    assert summary(spark.createDataFrame([], frame(spark, {}).schema)).success_rate == 100.0


def test_errors_by_record(spark):
    df = frame(spark, {"TenderID": "a", "ActionOwner": None, "TenderStatus": None}, {"TenderID": "b"})
    found = validation_errors(validate_tenders(df), "TenderID").collect()
    assert sorted((r.record_id, r.field) for r in found) == [("a", "ActionOwner"), ("a", "TenderStatus")]
    shown = first_errors(validate_tenders(df), "TenderID").collect()
    assert [(r.record_id, len(r.errors)) for r in shown] == [("a", 2)]


def test_coerce(spark):
    r = coerce(frame(spark, {}).drop("ActionOwner"), TENDER_RAW).first()
    assert (r.tender_id, r.project_start_date) == ("T1", dt.date(2025, 1, 15))
    assert (r.tender_value, r.probability_percentage) == (1000000, Decimal("0.8"))
    assert (r.action_owner, r.reporting_value, r.monthly_forecast) == ("", 0, None)


def test_quarantine(spark, tmp_path):
    df = frame(spark, {"TenderID": "a"}, {"TenderID": "b"}, {"TenderID": "c", "TenderStatus": None})
    path = str(tmp_path / "quarantine")
    clean = write_quarantine(validate_tenders(df), path, "bad status")
    assert sorted(r.TenderID for r in clean.collect()) == ["a", "b"]
    bad = spark.read.parquet(path).collect()
    assert [(r.TenderID, r._quarantine_reason) for r in bad] == [("c", "bad status")]
    assert bad[0]._quarantined_at is not None


def test_status_split_is_whole(spark):
    df = spark.range(100).select(
        F.col("id").cast("string").alias("TransactionID"),
        F.lit("2025-01-01").alias("Date"),
        F.when(F.col("id") % 3 == 0, F.lit("4000")).alias("AccountCode"),
        F.lit("x").alias("AccountName"),
    )
    checked = validate_transactions(df)
    assert sum(with_status(checked, s).count() for s in ("valid", "invalid", "quarantined")) == 100


def test_valid_rows_need_no_share_of_bad_ones(spark):
    df = spark.createDataFrame([("T1", None), ("T2", "x")], "TenderID string, ProjectName string")
    checked = validate_tenders(df)
    assert "ubquery" not in plan_of(with_status(checked, "valid")) and "ubquery" in plan_of(with_status(checked, "invalid"))
