"""Queries for table cleaning (T), recipe steps (Q) and validation (V)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabprep.contracts import TENDER_RAW, TRANSACTION_RAW
from tabprep.operators.cleaning import (
    clean_tenders,
    duplicates_removed,
    enforce_schema,
    remove_duplicates,
    trim_columns,
)
from tabprep.operators.enrichment import average_month_spread
from tabprep.operators.missing import handle_missing
from tabprep.operators.validation import (
    coerce,
    first_errors,
    validate_tenders,
    validate_transactions,
    validation_errors,
    validation_summary,
    with_errors,
    with_status,
)
from tabprep.plans.adapters import TENDERS, TENDERS_RAW, TRANSACTIONS, adapted, plain
from tabprep.plans.functions import (
    RAW,
    TYPED,
    sql_amount,
    sql_date,
    sql_probability,
    sql_status,
    sql_strip,
)
from tabprep.plans.registry import query

LEDGER = plain(TRANSACTIONS)

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["Date", "AccountCode", "AccountName", "Department", "CostCenter", "Entity", "Scenario", "AmountLocal", "Currency", "Description"]
LINE_COLUMNS = f"TransactionID, l_orderkey, l_linenumber::bigint AS l_linenumber, {', '.join(LINE_ORDER)}".replace(
    "AmountLocal", "AmountLocal::double AS AmountLocal"
)


def _ranked_ledger(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in LINE_ORDER)
    return f"""SELECT {LINE_COLUMNS} FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn FROM ({LEDGER})) WHERE rn = 1"""


@query("T1_remove_duplicates_first", _ranked_ledger("ASC NULLS FIRST"))
def t1_first(spark, d):
    return remove_duplicates(adapted(spark, d, TRANSACTIONS), LINE_KEY, "first", LINE_ORDER)


@query("T1_remove_duplicates_last", _ranked_ledger("DESC NULLS LAST"))
def t1_last(spark, d):
    return remove_duplicates(adapted(spark, d, TRANSACTIONS), LINE_KEY, "last", LINE_ORDER)


@query(
    "T1_remove_duplicates_all",
    f"""SELECT {LINE_COLUMNS} FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n
        FROM ({LEDGER})) WHERE n = 1""",
)
def t1_all(spark, d):
    return remove_duplicates(adapted(spark, d, TRANSACTIONS), LINE_KEY, False)


@query(
    "T1_duplicates_removed",
    """SELECT count(*) AS total, count(DISTINCT (l_orderkey, l_linenumber)) AS kept,
        count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS removed FROM lineitem""",
)
def t1_removed(spark, d):
    return duplicates_removed(spark.read.parquet(f"{d}/lineitem.parquet"), LINE_KEY)


@query(
    "T2a_missing_drop",
    f"SELECT k, ReportingValue::double AS ReportingValue FROM ({TYPED}) WHERE ReportingValue IS NOT NULL",
)
def t2a(spark, d):
    return handle_missing(adapted(spark, d, TENDERS), {"ReportingValue": "drop"}).select("k", "ReportingValue")


@query("T2b_missing_zero", f"SELECT k, coalesce(ReportingValue, 0)::double AS ReportingValue FROM ({TYPED})")
def t2b(spark, d):
    return handle_missing(adapted(spark, d, TENDERS), {"ReportingValue": "zero"}).select("k", "ReportingValue")


@query(
    "T2c_missing_mean",
    f"""WITH t AS ({TYPED}) SELECT k, round(coalesce(ReportingValue::double,
        (SELECT sum(ReportingValue)::double / count(ReportingValue) FROM t)), 2) AS ReportingValue FROM t""",
)
def t2c(spark, d):
    filled = handle_missing(adapted(spark, d, TENDERS), {"ReportingValue": "mean"})
    return filled.select("k", F.round(F.col("ReportingValue").cast("double"), 2).alias("ReportingValue"))


@query(
    "T2d_missing_median",
    f"""WITH t AS ({TYPED}) SELECT k, round(coalesce(ReportingValue::double,
        (SELECT median(ReportingValue::double) FROM t)), 3) AS ReportingValue FROM t""",
)
def t2d(spark, d):
    filled = handle_missing(adapted(spark, d, TENDERS), {"ReportingValue": "median"})
    return filled.select("k", F.round(F.col("ReportingValue").cast("double"), 3).alias("ReportingValue"))


@query(
    "T2e_missing_forward",
    f"""SELECT k, last_value(ReportingValue IGNORE NULLS) OVER (ORDER BY k
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::double AS ReportingValue FROM ({TYPED})""",
)
def t2e(spark, d):
    values = adapted(spark, d, TENDERS).select("k", "ReportingValue")
    return handle_missing(values, {"ReportingValue": "forward"}, order_by=["k"])


@query(
    "T2e_missing_forward_partitioned",
    f"""SELECT k, BusinessDivision, last_value(ReportingValue IGNORE NULLS) OVER (PARTITION BY BusinessDivision
        ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::double AS ReportingValue FROM ({TYPED})""",
)
def t2e_partitioned(spark, d):
    values = adapted(spark, d, TENDERS).select("k", "BusinessDivision", "ReportingValue")
    return handle_missing(values, {"ReportingValue": "forward"}, ["k"], ["BusinessDivision"])


@query(
    "T2f_missing_backward",
    f"""SELECT k, first_value(ReportingValue IGNORE NULLS) OVER (ORDER BY k
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::double AS ReportingValue FROM ({TYPED})""",
)
def t2f(spark, d):
    values = adapted(spark, d, TENDERS).select("k", "ReportingValue")
    return handle_missing(values, {"ReportingValue": "backward"}, order_by=["k"])


@query("T2g_missing_constant", f"SELECT k, coalesce(ActionOwner, 'nobody') AS ActionOwner FROM ({RAW})")
def t2g(spark, d):
    return handle_missing(adapted(spark, d, TENDERS_RAW), {"ActionOwner": "nobody"}).select("k", "ActionOwner")


@query(
    "T2h_missing_expression",
    f"SELECT k, coalesce(ReportingValue, TenderValue)::double AS ReportingValue FROM ({TYPED})",
)
def t2h(spark, d):
    filled = handle_missing(adapted(spark, d, TENDERS), {"ReportingValue": F.col("TenderValue")})
    return filled.select("k", "ReportingValue")


@query(
    "T2_missing_in_order",
    f"""WITH t AS (SELECT * FROM ({TYPED}) WHERE TenderStatus IS NOT NULL)
        SELECT k, TenderStatus, round(coalesce(ReportingValue::double,
        (SELECT sum(ReportingValue)::double / count(ReportingValue) FROM t)), 2) AS ReportingValue FROM t""",
)
def t2(spark, d):
    strategy = {"TenderStatus": "drop", "ReportingValue": "mean", "MonthlyForecast": None, "NoSuchColumn": "zero"}
    filled = handle_missing(adapted(spark, d, TENDERS), strategy)
    return filled.select("k", "TenderStatus", F.round(F.col("ReportingValue").cast("double"), 2).alias("ReportingValue"))


@query(
    "T3_enforce_schema",
    f"""SELECT k::varchar AS k, try_cast(ActionOwner AS bigint) AS ActionOwner,
        try_cast(ReportingValue AS double) AS ReportingValue, {sql_amount("TenderValue")} AS TenderValue,
        {sql_date("TenderReceivedDate")} AS TenderReceivedDate FROM ({RAW})""",
)
def t3(spark, d):
    kinds = {
        "k": "string",
        "ActionOwner": "int",
        "ReportingValue": "float",
        "TenderValue": "decimal",
        "TenderReceivedDate": "date",
        "NoSuchColumn": "int",
    }
    typed = enforce_schema(adapted(spark, d, TENDERS_RAW), kinds)
    return typed.select(*[c for c in kinds if c in typed.columns])


@query(
    "Q2_transform_types",
    f"""SELECT k, {sql_date("ProjectStartDate")} AS ProjectStartDate, {sql_date("ProjectEndDate")} AS ProjectEndDate,
        {sql_amount("WeightedValue")} AS WeightedValue FROM ({RAW})""",
)
def q2(spark, d):
    kinds = {"ProjectStartDate": "date", "ProjectEndDate": "date", "WeightedValue": "decimal"}
    return enforce_schema(adapted(spark, d, TENDERS_RAW), kinds).select("k", *kinds)


@query(
    "Q3_trim_columns",
    f"""SELECT k, {sql_strip("ClientName")} AS ClientName, {sql_strip("ProjectName")} AS ProjectName,
        {sql_strip("BusinessDivision")} AS BusinessDivision, {sql_strip("TenderStatus")} AS TenderStatus,
        {sql_strip("ActionOwner")} AS ActionOwner FROM ({RAW})""",
)
def q3(spark, d):
    trimmed = trim_columns(adapted(spark, d, TENDERS_RAW))
    return trimmed.select("k", "ClientName", "ProjectName", "BusinessDivision", "TenderStatus", "ActionOwner")


@query(
    "Q4_average_month_spread",
    f"""SELECT k, CASE WHEN m > 0 THEN ReportingValue::double / m END AS MonthlySpread FROM (
        SELECT k, ReportingValue, round(date_diff('day', ProjectStartDate, ProjectEndDate) / 30.44) AS m FROM ({TYPED}))""",
)
def q4(spark, d):
    return average_month_spread(adapted(spark, d, TENDERS)).select("k", "MonthlySpread")


CLEAN_SQL = f"""SELECT k, coalesce({sql_strip("TenderID")}, '') AS TenderID,
    coalesce({sql_strip("ProjectName")}, '') AS ProjectName, coalesce({sql_strip("ClientName")}, '') AS ClientName,
    coalesce({sql_strip("BusinessDivision")}, '') AS BusinessDivision,
    {sql_status(f"coalesce({sql_strip('TenderStatus')}, '')")} AS TenderStatus,
    {sql_date("TenderReceivedDate")} AS TenderReceivedDate, {sql_date("TenderSubmissionDate")} AS TenderSubmissionDate,
    {sql_date("ProjectStartDate")} AS ProjectStartDate, {sql_date("ProjectEndDate")} AS ProjectEndDate,
    coalesce({sql_amount("TenderValue")}, 0) AS TenderValue, coalesce({sql_amount("ReportingValue")}, 0) AS ReportingValue,
    coalesce({sql_amount("ProbabilityPercentage")}, 0) AS ProbabilityPercentage,
    coalesce({sql_amount("WeightedValue")}, 0) AS WeightedValue, coalesce({sql_strip("ActionOwner")}, '') AS ActionOwner,
    {sql_amount("MonthlyForecast")} AS MonthlyForecast, {sql_amount("QuarterlyForecast")} AS QuarterlyForecast
    FROM ({RAW})"""


@query("T4_clean_tenders", CLEAN_SQL)
def t4(spark, d):
    return clean_tenders(adapted(spark, d, TENDERS_RAW))


@query(
    "T4_clean_tenders_share",
    f"SELECT k, {sql_probability('ProbabilityPercentage')} AS ProbabilityPercentage FROM ({RAW})",
)
def t4_share(spark, d):
    cleaned = clean_tenders(adapted(spark, d, TENDERS_RAW), probability="parse")
    return cleaned.select("k", "ProbabilityPercentage")


# --- validation: the error list of a row, spelled out in SQL


def _date_errors(c: str) -> str:
    read = f"try_cast({c} AS timestamp)"
    shaped = rf"(regexp_matches({c}, '^\d{{4}}-\d{{2}}-\d{{2}}$') OR regexp_matches({c}, '^\d{{4}}-\d{{2}}-\d{{2}}[Tt ]\d{{2}}:\d{{2}}'))"
    return (
        f"SELECT k, TenderID, '{c}' AS field, 'date_from_datetime_parsing' AS type FROM raw "
        f"WHERE {c} IS NOT NULL AND ({read} IS NULL OR NOT {shaped}) UNION ALL "
        f"SELECT k, TenderID, '{c}', 'date_from_datetime_inexact' FROM raw "
        f"WHERE {shaped} AND {read} <> date_trunc('day', {read})"
    )


def _null_errors(c: str, table: str = "raw", key: str = "k, TenderID") -> str:
    return f"SELECT {key}, '{c}' AS field, 'string_type' AS type FROM {table} WHERE {c} IS NULL"


TENDER_ERRORS = " UNION ALL ".join(
    [
        *map(_null_errors, ("TenderID", "ProjectName", "ClientName", "BusinessDivision", "TenderStatus", "ActionOwner")),
        *map(_date_errors, ("TenderReceivedDate", "TenderSubmissionDate", "ProjectStartDate", "ProjectEndDate")),
    ]
)
TENDER_CHECK = f"WITH raw AS ({RAW}), errors AS ({TENDER_ERRORS})"
# More than half of the rows are bad, so all bad ones are quarantined.
TENDER_STATUS = f"""{TENDER_CHECK}, bad AS (SELECT DISTINCT k FROM errors),
    share AS (SELECT (SELECT count(*) FROM bad) / (SELECT count(*) FROM raw) AS s),
    checked AS (SELECT raw.*, CASE WHEN bad.k IS NULL THEN 'valid' WHEN s > 0.5 THEN 'quarantined' ELSE 'invalid' END
    AS status FROM raw LEFT JOIN bad ON raw.k = bad.k, share)"""
# Only the department can be missing in the ledger.
LEDGER_STATUS = f"""WITH ledger AS ({LEDGER}),
    share AS (SELECT count(*) FILTER (WHERE Department IS NULL) / count(*) AS s FROM ledger),
    checked AS (SELECT ledger.*, CASE WHEN Department IS NOT NULL THEN 'valid' WHEN s > 0.5 THEN 'quarantined'
    ELSE 'invalid' END AS status FROM ledger, share)"""
SUMMARY_SQL = """SELECT v AS valid_records, i AS invalid_records, q AS quarantined_records, v + i AS total_records,
    round(CASE WHEN v + i = 0 THEN 1.0 ELSE v / (v + i) END * 100, 2)::double AS success_rate,
    round(CASE WHEN v + i = 0 THEN 0.0 ELSE q / (v + i) END * 100, 2)::double AS quarantine_rate
    FROM (SELECT count(*) FILTER (WHERE status = 'valid') AS v, count(*) FILTER (WHERE status = 'invalid') AS i,
    count(*) FILTER (WHERE status = 'quarantined') AS q FROM checked)"""


@query(
    "V1_rules",
    f"{TENDER_CHECK} SELECT field, type, count(*) AS rows FROM errors GROUP BY field, type",
)
def v1(spark, d):
    errors = validation_errors(with_errors(adapted(spark, d, TENDERS_RAW), TENDER_RAW), "TenderID")
    return errors.groupBy("field", "type").agg(F.count("*").alias("rows"))


@query("V2_validate", f"{LEDGER_STATUS} SELECT status, count(*) AS rows FROM checked GROUP BY status")
def v2(spark, d):
    checked = validate_transactions(adapted(spark, d, TRANSACTIONS))
    return checked.groupBy(F.col("_status").alias("status")).agg(F.count("*").alias("rows"))


@query("V3_validation_errors", f"{TENDER_CHECK} SELECT TenderID AS record_id, field, type FROM errors")
def v3(spark, d):
    return validation_errors(with_errors(adapted(spark, d, TENDERS_RAW), TENDER_RAW), "TenderID")


@query("V4_validation_summary", f"{TENDER_STATUS} {SUMMARY_SQL}")
def v4(spark, d):
    return validation_summary(validate_tenders(adapted(spark, d, TENDERS_RAW)))


@query("V4_validation_summary_ledger", f"{LEDGER_STATUS} {SUMMARY_SQL}")
def v4_ledger(spark, d):
    return validation_summary(validate_transactions(adapted(spark, d, TRANSACTIONS)))


@query(
    "V4_first_errors",
    f"""{TENDER_CHECK}, counted AS (SELECT TenderID AS record_id, count(*) AS errors FROM errors GROUP BY TenderID)
        SELECT * FROM counted ORDER BY record_id LIMIT 10""",
)
def v4_first(spark, d):
    shown = first_errors(with_errors(adapted(spark, d, TENDERS_RAW), TENDER_RAW), "TenderID")
    return shown.withColumn("errors", F.size("errors"))


@query("V5_validate_tenders", f"{TENDER_STATUS} SELECT k, TenderID, status FROM checked")
def v5(spark, d):
    return validate_tenders(adapted(spark, d, TENDERS_RAW)).select("k", "TenderID", F.col("_status").alias("status"))


@query(
    "V6_validate_transactions",
    f"{LEDGER_STATUS} SELECT TransactionID, AmountLocal::double AS AmountLocal, status FROM checked",
)
def v6(spark, d):
    checked = validate_transactions(adapted(spark, d, TRANSACTIONS))
    return checked.select("TransactionID", "AmountLocal", F.col("_status").alias("status"))


@query(
    "V7_coerce",
    f"""{TENDER_STATUS} SELECT TenderID AS tender_id, ProjectName AS project_name, ClientName AS client_name,
        BusinessDivision AS business_division, TenderStatus AS tender_status,
        TenderReceivedDate::date AS tender_received_date, TenderSubmissionDate::timestamp::date AS tender_submission_date,
        ProjectStartDate::date AS project_start_date, ProjectEndDate::date AS project_end_date,
        coalesce({sql_amount("TenderValue")}, 0) AS tender_value, coalesce({sql_amount("ReportingValue")}, 0) AS reporting_value,
        {sql_probability("ProbabilityPercentage")} AS probability_percentage,
        coalesce({sql_amount("WeightedValue")}, 0) AS weighted_value, ActionOwner AS action_owner,
        coalesce({sql_amount("MonthlyForecast")}, 0) AS monthly_forecast,
        coalesce({sql_amount("QuarterlyForecast")}, 0) AS quarterly_forecast FROM checked WHERE status = 'valid'""",
)
def v7(spark, d):
    return coerce(with_status(validate_tenders(adapted(spark, d, TENDERS_RAW)), "valid"), TENDER_RAW)


@query(
    "V7_coerce_transactions",
    f"""SELECT TransactionID AS transaction_id, Date AS transaction_date, AccountCode AS account_code,
        AccountName AS account_name, Department AS department, CostCenter AS cost_center, Entity AS entity,
        Scenario AS scenario, AmountLocal::double AS amount_local, Currency AS currency, Description AS description
        FROM ({LEDGER})""",
)
def v7_ledger(spark, d):
    return coerce(adapted(spark, d, TRANSACTIONS), TRANSACTION_RAW)
