"""Business tables derived from the star-schema test tables.

Each adapter is one SELECT in plain SQL over integer arithmetic, so that Spark and any other SQL
engine build the same rows from it. ``{orders}`` and the like stand for the input tables.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tabprep.scratch import scratch_dir

MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"

_ORDER_BASE = """
SELECT o_orderkey AS k, c_name, c_mktsegment,
       cast(o_orderdate AS date) AS d,
       year(o_orderdate) AS yy, month(o_orderdate) AS mm, day(o_orderdate) AS dd,
       cast(cast(o_totalprice AS decimal(18,2)) * CASE WHEN o_orderkey % 11 = 0 THEN 10000 ELSE 1000 END AS bigint) AS cents
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

_TENDER_DATES = """
SELECT *,
       d + cast(k % 60 AS int) AS submitted,
       CASE WHEN k % 7 <> 0 THEN d + cast(k % 150 AS int) END AS started,
       CASE WHEN k % 13 <> 0 THEN d + cast(k % 150 + k % 1000 - 5 AS int) END AS ended,
       CASE WHEN k % 17 = 0 THEN 0 ELSE cents - cents % 1000 END AS reporting_cents,
       k % 90 + 10 AS probability
FROM (""" + _ORDER_BASE + ") AS base"


def _text(expression: str) -> str:
    return f"cast({expression} AS string)"


def _padded(expression: str, width: int) -> str:
    return f"lpad({_text(expression)}, {width}, '0')"


def _iso(date: str) -> str:
    return f"{_text(f'year({date})')} || '-' || {_padded(f'month({date})', 2)} || '-' || {_padded(f'day({date})', 2)}"


def _plain_money(cents: str) -> str:
    whole = f"cast(({cents} - {cents} % 100) / 100 AS bigint)"
    return f"{_text(whole)} || '.' || {_padded(f'{cents} % 100', 2)}"


def _grouped_money(cents: str) -> str:
    """With a separator before the last three digits of the whole part."""
    thousands = f"cast(({cents} - {cents} % 100000) / 100000 AS bigint)"
    units = f"cast(({cents} % 100000 - {cents} % 100) / 100 AS bigint)"
    return f"{_text(thousands)} || ',' || {_padded(units, 3)} || '.' || {_padded(f'{cents} % 100', 2)}"


# A register as it arrives: padded, mixed spellings, four date layouts, money as text.
TENDERS_RAW = f"""
SELECT k,
       '  TND-' || {_padded("k", 12)} || ' ' AS TenderID,
       'Project ' || {_text("k")} AS ProjectName,
       chr(9) || c_name || ' ' AS ClientName,
       c_mktsegment AS BusinessDivision,
       CASE WHEN k % 97 = 0 THEN NULL
            ELSE CASE k % 9 WHEN 0 THEN ' won' WHEN 1 THEN 'CLOSED WON' WHEN 2 THEN 'submitted'
                 WHEN 3 THEN 'active' WHEN 4 THEN 'lost' WHEN 5 THEN 'declined ' WHEN 6 THEN 'Cancelled'
                 WHEN 7 THEN 'on hold' ELSE 'in o''review-2b' END END AS TenderStatus,
       CASE WHEN k % 41 = 0 THEN 'TBC'
            WHEN k % 43 = 0 THEN {_text("dd")} || '.' || {_padded("mm", 2)} || '.' || {_text("yy")}
            WHEN k % 43 = 1 THEN {_text("dd")} || '-' || substr('{MONTHS}', cast(mm * 3 - 2 AS int), 3) || '-' || {_text("yy")}
            WHEN k % 43 = 2 THEN {_text("mm")} || '/' || {_text("dd")} || '/' || {_text("yy")} || ' 10:30'
            WHEN k % 43 = 3 THEN 'January ' || {_text("dd")} || ' ' || {_text("yy")}
            WHEN k % 43 = 4 THEN {_text("dd")} || ' December ' || {_text("yy")}
            WHEN k % 4 = 0 THEN {_iso("d")}
            WHEN k % 4 = 1 THEN {_text("dd")} || '/' || {_text("mm")} || '/' || {_text("yy")}
            WHEN k % 4 = 2 THEN substr('{MONTHS}', cast(mm * 3 - 2 AS int), 3) || ' ' || {_text("dd")} || ', ' || {_text("yy")}
            ELSE {_text("yy")} || {_padded("mm", 2)} || {_padded("dd", 2)} END AS TenderReceivedDate,
       CASE WHEN k % 2 = 0 THEN {_iso("submitted")} ELSE {_iso("submitted")} || ' 00:00:00' END AS TenderSubmissionDate,
       {_iso("started")} AS ProjectStartDate,
       {_iso("ended")} AS ProjectEndDate,
       CASE WHEN k % 53 = 0 THEN 'TBC'
            WHEN k % 3 = 0 THEN '$' || {_grouped_money("cents")}
            WHEN k % 3 = 1 THEN {_grouped_money("cents")}
            ELSE '€ ' || {_plain_money("cents")} END AS TenderValue,
       CASE WHEN k % 5 = 0 THEN NULL ELSE {_plain_money("reporting_cents")} END AS ReportingValue,
       CASE WHEN k % 4 = 0 THEN '0.' || {_text("probability")} WHEN k % 23 = 0 THEN 'n/a'
            ELSE {_text("probability")} || '%' END AS ProbabilityPercentage,
       '£' || {_plain_money("cast((cents - cents % 10000) / 100 * probability AS bigint)")} AS WeightedValue,
       CASE WHEN k % 31 = 0 THEN NULL ELSE 'Owner ' || {_text("k % 8")} END AS ActionOwner,
       CASE WHEN k % 10 < 3 THEN NULL ELSE {_plain_money("cents")} END AS MonthlyForecast,
       CASE WHEN k % 10 < 3 THEN NULL ELSE {_plain_money("cents")} END AS QuarterlyForecast
FROM (SELECT k, c_name, c_mktsegment, d, yy, mm, dd, cents, submitted, started, ended, probability,
             cast(reporting_cents AS bigint) AS reporting_cents
      FROM ({_TENDER_DATES}) AS dated) AS src
"""
def _money(cents: str) -> str:
    return f"cast(cast({cents} AS decimal(20,0)) * 0.01 AS decimal(18,2))"


# The same register after cleaning, typed.
TENDERS = f"""
SELECT k,
       'TND-' || {_padded("k", 12)} AS TenderID,
       'Project ' || {_text("k")} AS ProjectName,
       c_name AS ClientName,
       c_mktsegment AS BusinessDivision,
       CASE WHEN k % 97 = 0 THEN NULL
            ELSE CASE k % 9 WHEN 0 THEN 'Won' WHEN 1 THEN 'Won' WHEN 2 THEN 'Submitted'
                 WHEN 3 THEN 'In Progress' WHEN 4 THEN 'Lost' WHEN 5 THEN 'Declined' WHEN 6 THEN 'Cancelled'
                 WHEN 7 THEN 'On Hold' ELSE 'Proposal' END END AS TenderStatus,
       d AS TenderReceivedDate, submitted AS TenderSubmissionDate, started AS ProjectStartDate, ended AS ProjectEndDate,
       {_money("cents")} AS TenderValue,
       CASE WHEN k % 5 = 0 THEN NULL ELSE {_money("reporting_cents")} END AS ReportingValue,
       cast(cast(probability AS decimal(10,0)) * 0.01 AS decimal(10,2)) AS ProbabilityPercentage,
       cast({_money("cast((cents - cents % 10000) / 100 * probability AS bigint)")}
           + cast(k % 97 AS decimal(10,0)) * 0.0001 AS decimal(20,4)) AS WeightedValue,
       'Owner ' || {_text("k % 8")} AS ActionOwner,
       CASE WHEN k % 10 >= 3 THEN {_money("cents")} END AS MonthlyForecast,
       CASE WHEN k % 10 >= 3 THEN {_money("cents - cents % 100")} END AS QuarterlyForecast
FROM ({_TENDER_DATES}) AS src
"""

# A ledger; currencies come in mixed case and padded, the fifth has no rate.
TRANSACTIONS = f"""
SELECT {_text("l_orderkey")} || '-' || {_text("l_linenumber")} AS TransactionID,
       l_orderkey, l_linenumber,
       cast(l_shipdate AS date) AS Date,
       CASE l_returnflag WHEN 'A' THEN '4000' WHEN 'N' THEN '5000' ELSE '6100' END AS AccountCode,
       CASE l_returnflag WHEN 'A' THEN 'Sales of services' WHEN 'N' THEN 'Service delivery'
            ELSE 'Premises' END AS AccountName,
       CASE l_suppkey % 5 WHEN 0 THEN 'Sales' WHEN 1 THEN 'Marketing' WHEN 2 THEN 'Engineering'
            WHEN 3 THEN 'G&A' ELSE NULL END AS Department,
       'CC-' || {_padded("l_suppkey % 5", 3)} AS CostCenter,
       CASE l_linestatus WHEN 'O' THEN 'BR001' ELSE 'US001' END AS Entity,
       CASE l_partkey % 3 WHEN 0 THEN 'Actual' WHEN 1 THEN 'Budget' ELSE 'Forecast' END AS Scenario,
       cast(l_extendedprice AS decimal(18,2)) AS AmountLocal,
       CASE l_suppkey % 6 WHEN 0 THEN 'USD' WHEN 1 THEN ' usd ' WHEN 2 THEN 'EUR' WHEN 3 THEN 'gbp'
            WHEN 4 THEN 'BRL' ELSE 'XXX' END AS Currency,
       l_linestatus || ' ' || l_returnflag AS Description
FROM {{lineitem}}
"""

# Opportunities out of orders.
OPPORTUNITIES = f"""
SELECT 'OPP-' || {_padded("o_orderkey", 12)} AS opportunityid,
       'Opportunity ' || {_text("o_orderkey")} AS name,
       CASE WHEN o_orderkey % 5 IN (1, 2) THEN 1 ELSE 0 END AS statecode,
       CASE o_orderkey % 5 WHEN 0 THEN 'Open' WHEN 1 THEN 'Won' WHEN 2 THEN 'Lost' WHEN 3 THEN 'In Progress'
            ELSE 'Qualified' END AS statuscode,
       CASE o_orderkey % 4 WHEN 0 THEN 'Qualify' WHEN 1 THEN 'Develop' WHEN 2 THEN 'Propose' ELSE 'Close' END AS stepname,
       cast(o_totalprice AS decimal(18,2)) AS estimatedvalue,
       {_iso("o_orderdate")} AS estimatedclosedate,
       CASE WHEN o_orderkey % 5 IN (1, 2) THEN {_iso("o_orderdate")} END AS actualclosedate,
       'ACC-' || {_padded("o_custkey", 12)} AS customerid,
       'OWN-' || {_padded("o_orderkey % 5 + 1", 2)} AS ownerid,
       cast(CASE o_orderkey % 5 WHEN 1 THEN 100 WHEN 2 THEN 0 ELSE 50 END AS int) AS probability,
       {_iso("o_orderdate")} AS createdon,
       {_iso("o_orderdate")} AS modifiedon
FROM {{orders}}
"""

# Runs of ten pipelines, one a day, out of the event stream.
RUNS = f"""
SELECT 'p' || {_text("user_id % 10")} AS pipeline,
       CASE WHEN max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) = 1 THEN 'partial' ELSE 'success' END AS status,
       cast(ts AS date) AS day,
       min(ts) AS started_at, max(ts) AS ended_at,
       cast(sum(cast(value AS decimal(18,2))) AS double) AS duration_seconds,
       count(*) AS records_processed,
       sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) AS records_loaded
FROM {{events}} GROUP BY user_id % 10, cast(ts AS date)
"""


def tables(sql: str) -> list[str]:
    names = ("orders", "customer", "lineitem", "events", "documents", "conversations", "part", "supplier")
    return [n for n in names if "{" + n + "}" in sql]


# Folder and adapter -> where its rows have been landed; only filled within ``landed``.
LANDED: dict[tuple[str, str], str] = {}
_landing = False


@contextmanager
def landed():
    """Within this block adapters are run once and read from Parquet afterwards, as a benchmark wants."""
    global _landing
    _landing = True
    try:
        yield
    finally:
        _landing = False
        LANDED.clear()


def adapted(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run an adapter over the Parquet tables of a folder."""
    inputs = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in tables(sql)}
    rows = spark.sql(sql, **inputs)
    if not _landing:
        return rows
    key = (sf_dir, sql)
    if key not in LANDED:
        path = f"{scratch_dir(spark)}/landed-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        LANDED[key] = path
    return spark.read.schema(rows.schema).parquet(LANDED[key])


def plain(sql: str) -> str:
    """The adapter with the table names themselves, for another engine."""
    return reduce(lambda s, n: s.replace("{" + n + "}", n), tables(sql), sql)
