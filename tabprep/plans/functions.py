"""Queries for the scalar functions (C)."""

from __future__ import annotations

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
    title_case,
    value_tier,
)
from tabprep.plans.adapters import OPPORTUNITIES, TENDERS, TENDERS_RAW, adapted, plain
from tabprep.plans.registry import query

RAW, TYPED, OPPS = plain(TENDERS_RAW), plain(TENDERS), plain(OPPORTUNITIES)

SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def sql_strip(c: str) -> str:
    return f"regexp_replace({c}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def sql_numeric(c: str) -> str:
    return f"try_cast(translate({c}, ',$€£ ', '') AS decimal(38,10))"


def sql_amount(c: str) -> str:
    """Amounts have two decimals, which a double holds exactly rounded."""
    return f"cast(cast({sql_numeric(c)} AS decimal(18,2)) AS double)"


def sql_title(c: str) -> str:
    runs = rf"regexp_extract_all({c}, '(\p{{L}}+|[^\p{{L}}]+)')"
    return f"array_to_string(list_transform({runs}, lambda r: upper(r[1]) || lower(r[2:])), '')"


STATUS_CASES = """CASE lower({c}) WHEN 'lead' THEN 'Lead' WHEN 'qualification' THEN 'Qualification'
 WHEN 'qualified' THEN 'Qualification' WHEN 'proposal' THEN 'Proposal' WHEN 'proposed' THEN 'Proposal'
 WHEN 'negotiation' THEN 'Negotiation' WHEN 'negotiating' THEN 'Negotiation' WHEN 'submitted' THEN 'Submitted'
 WHEN 'won' THEN 'Won' WHEN 'closed won' THEN 'Won' WHEN 'awarded' THEN 'Won' WHEN 'lost' THEN 'Lost'
 WHEN 'closed lost' THEN 'Lost' WHEN 'declined' THEN 'Declined' WHEN 'cancelled' THEN 'Cancelled'
 WHEN 'on hold' THEN 'On Hold' WHEN 'in progress' THEN 'In Progress' WHEN 'active' THEN 'In Progress' END"""


def sql_status(c: str) -> str:
    known = STATUS_CASES.format(c=sql_strip(c))
    return f"CASE WHEN {c} IS NULL OR {c} = '' THEN 'Unknown' ELSE coalesce({known}, {sql_title(c)}) END"


def sql_date(c: str) -> str:
    layouts = "['%Y-%m-%d', '%d/%m/%Y', '%m/%d/%Y', '%Y/%m/%d', '%d-%m-%Y', '%b %d, %Y', '%d %b %Y', '%Y%m%d', "
    layouts += "'%m.%d.%Y', '%d.%m.%Y', '%d-%b-%Y', '%m/%d/%Y %H:%M', '%B %d %Y', '%d %B %Y']"
    return f"coalesce(try_strptime({c}, {layouts}), try_cast({c} AS timestamp))"


def sql_probability(c: str) -> str:
    number = f"try_cast(translate({c}, ',%', '.') AS decimal(18,4))"
    return f"coalesce(CASE WHEN {number} > 1 THEN cast({number} AS double) / 100 ELSE cast({number} AS double) END, 0)"


def sql_tier(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL THEN 'Unknown' WHEN {c} >= 5000000 THEN '5M+' WHEN {c} >= 1000000 THEN '1M-5M' "
        f"WHEN {c} >= 500000 THEN '500K-1M' WHEN {c} >= 100000 THEN '100K-500K' ELSE '<100K' END"
    )


def sql_months(start: str, end: str) -> str:
    return (
        f"CASE WHEN {start} IS NOT NULL AND {end} IS NOT NULL THEN greatest(1, "
        f"(year({end}) - year({start})) * 12 + month({end}) - month({start}) "
        f"- CASE WHEN day({end}) < day({start}) THEN 1 ELSE 0 END) END"
    )


@query(
    "C1_clean_string",
    f"""SELECT k, coalesce({sql_strip("TenderID")}, '') AS tender_id, coalesce({sql_strip("ClientName")}, '') AS client,
        coalesce({sql_strip("TenderStatus")}, '') AS status, cast(k AS varchar) AS key_text FROM ({RAW})""",
)
def c1(spark, d):
    return adapted(spark, d, TENDERS_RAW).select(
        "k",
        clean_string("TenderID").alias("tender_id"),
        clean_string("ClientName").alias("client"),
        clean_string("TenderStatus").alias("status"),
        clean_string("k").alias("key_text"),
    )


@query(
    "C2_clean_numeric",
    f"""SELECT k, {sql_amount("TenderValue")} AS tender, {sql_amount("WeightedValue")} AS weighted,
        {sql_amount("ReportingValue")} AS reporting FROM ({RAW})""",
)
def c2(spark, d):
    return adapted(spark, d, TENDERS_RAW).select(
        "k",
        clean_numeric("TenderValue").cast("decimal(18,2)").alias("tender"),
        clean_numeric("WeightedValue").cast("decimal(18,2)").alias("weighted"),
        clean_numeric("ReportingValue").cast("decimal(18,2)").alias("reporting"),
    )


@query(
    "C3_clean_date",
    f"""SELECT k, cast({sql_date("TenderReceivedDate")} AS date) AS received,
        {sql_date("TenderSubmissionDate")} AS submitted FROM ({RAW})""",
)
def c3(spark, d):
    return adapted(spark, d, TENDERS_RAW).select(
        "k",
        clean_date("TenderReceivedDate").cast("date").alias("received"),
        clean_date("TenderSubmissionDate").alias("submitted"),
    )


@query("C4_standardize_status", f"SELECT k, {sql_status('TenderStatus')} AS status FROM ({RAW})")
def c4(spark, d):
    return adapted(spark, d, TENDERS_RAW).select("k", standardize_status("TenderStatus").alias("status"))


@query(
    "C5_title_case",
    f"""SELECT p_partkey, {sql_title("name")} AS name FROM (
        SELECT p_partkey, p_name || ' o''NEIL-' || lower(p_type) || ' 2nd ' || p_brand AS name FROM part)""",
)
def c5(spark, d):
    part = spark.read.parquet(f"{d}/part.parquet")
    name = F.concat("p_name", F.lit(" o'NEIL-"), F.lower("p_type"), F.lit(" 2nd "), "p_brand")
    return part.select("p_partkey", title_case(name).alias("name"))


@query(
    "C6_parse_probability",
    f"""SELECT k, {sql_probability("ProbabilityPercentage")} AS share, cast(k AS double) AS number FROM ({RAW})""",
)
def c6(spark, d):
    return adapted(spark, d, TENDERS_RAW).select(
        "k", parse_probability("ProbabilityPercentage").alias("share"), parse_probability("k").alias("number")
    )


@query(
    "C7_parse_currency",
    f"""SELECT k, coalesce({sql_amount("TenderValue")}, 0) AS tender,
        coalesce({sql_amount("MonthlyForecast")}, 0) AS forecast FROM ({RAW})""",
)
def c7(spark, d):
    return adapted(spark, d, TENDERS_RAW).select(
        "k",
        parse_currency("TenderValue").cast("decimal(18,2)").alias("tender"),
        parse_currency("MonthlyForecast").cast("decimal(18,2)").alias("forecast"),
    )


@query("C8_value_tier", f"SELECT k, {sql_tier('ReportingValue')} AS tier FROM ({TYPED})")
def c8(spark, d):
    return adapted(spark, d, TENDERS).select("k", value_tier("ReportingValue").alias("tier"))


@query("C9_duration_months", f"SELECT k, {sql_months('ProjectStartDate', 'ProjectEndDate')} AS months FROM ({TYPED})")
def c9(spark, d):
    months = duration_months("ProjectStartDate", "ProjectEndDate")
    return adapted(spark, d, TENDERS).select("k", months.alias("months"))


@query(
    "C10_duration_months_avg",
    f"""SELECT k, cast(round(date_diff('day', ProjectStartDate, ProjectEndDate) / 30.44) AS bigint) AS months
        FROM ({TYPED})""",
)
def c10(spark, d):
    months = duration_months_avg("ProjectStartDate", "ProjectEndDate")
    return adapted(spark, d, TENDERS).select("k", months.alias("months"))


@query(
    "C11_statecode",
    f"""SELECT opportunityid, CASE WHEN statuscode IN ('Open', 'In Progress', 'Qualified') THEN 0::bigint ELSE 1 END
        AS code FROM ({OPPS})""",
)
def c11(spark, d):
    return adapted(spark, d, OPPORTUNITIES).select("opportunityid", statecode("statuscode").alias("code"))
