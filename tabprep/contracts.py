"""Declared row contracts of the business tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from tabprep.functions.numeric import MONEY

REQUIRED = object()


@dataclass(frozen=True)
class Field:
    """One contract field.

    ``name`` is the clean name and ``source`` the column it is read from. ``kind`` is ``string``,
    ``date`` or ``decimal``; ``default`` stands in for an absent column only, ``nullable`` says
    whether an explicit null is allowed. ``parse`` names a lenient reader that never fails.
    """

    name: str
    source: str
    kind: str
    default: object = REQUIRED
    nullable: bool = False
    parse: str | None = None

    @property
    def required(self) -> bool:
        return self.default is REQUIRED

    @property
    def sql_type(self) -> str:
        return MONEY if self.kind == "decimal" else self.kind


@dataclass(frozen=True)
class Contract:
    name: str
    id_column: str
    fields: tuple[Field, ...] = field(default_factory=tuple)

    def landing_schema(self) -> T.StructType:
        """All-text schema under which messy files are read, in contract order."""
        return T.StructType([T.StructField(f.source, T.StringType()) for f in self.fields])


# Fields, source columns and defaults of the tender register.
TENDER_RAW = Contract(
    "TenderRaw",
    "TenderID",
    (
        Field("tender_id", "TenderID", "string"),
        Field("project_name", "ProjectName", "string"),
        Field("client_name", "ClientName", "string"),
        Field("business_division", "BusinessDivision", "string"),
        Field("tender_status", "TenderStatus", "string"),
        Field("tender_received_date", "TenderReceivedDate", "date", None, nullable=True),
        Field("tender_submission_date", "TenderSubmissionDate", "date", None, nullable=True),
        Field("project_start_date", "ProjectStartDate", "date", None, nullable=True),
        Field("project_end_date", "ProjectEndDate", "date", None, nullable=True),
        Field("tender_value", "TenderValue", "decimal", 0, parse="currency"),
        Field("reporting_value", "ReportingValue", "decimal", 0, parse="currency"),
        Field("probability_percentage", "ProbabilityPercentage", "decimal", 0, parse="probability"),
        Field("weighted_value", "WeightedValue", "decimal", 0, parse="currency"),
        Field("action_owner", "ActionOwner", "string", ""),
        Field("monthly_forecast", "MonthlyForecast", "decimal", None, nullable=True, parse="currency"),
        Field("quarterly_forecast", "QuarterlyForecast", "decimal", None, nullable=True, parse="currency"),
    ),
)

# Fields, source columns and defaults of the transaction ledger.
TRANSACTION_RAW = Contract(
    "FinancialTransactionRaw",
    "TransactionID",
    (
        Field("transaction_id", "TransactionID", "string"),
        Field("transaction_date", "Date", "date"),
        Field("account_code", "AccountCode", "string"),
        Field("account_name", "AccountName", "string"),
        Field("department", "Department", "string", ""),
        Field("cost_center", "CostCenter", "string", ""),
        Field("entity", "Entity", "string", ""),
        Field("scenario", "Scenario", "string", "Actual"),
        Field("amount_local", "AmountLocal", "decimal", 0),
        Field("currency", "Currency", "string", "USD"),
        Field("description", "Description", "string", ""),
    ),
)

# Fields of an opportunity as served in JSON pages.
OPPORTUNITY = T.StructType(
    [
        T.StructField("opportunityid", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("statecode", T.IntegerType()),
        T.StructField("statuscode", T.StringType()),
        T.StructField("stepname", T.StringType()),
        T.StructField("estimatedvalue", T.DecimalType(18, 2)),
        T.StructField("estimatedclosedate", T.StringType()),
        T.StructField("actualclosedate", T.StringType()),
        T.StructField("customerid", T.StringType()),
        T.StructField("ownerid", T.StringType()),
        T.StructField("probability", T.IntegerType()),
        T.StructField("createdon", T.StringType()),
        T.StructField("modifiedon", T.StringType()),
    ]
)

# A metric event and an alert event as logged.
METRIC = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("unit", T.StringType()),
    ]
)
ALERT = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("context", T.MapType(T.StringType(), T.DoubleType())),
    ]
)
