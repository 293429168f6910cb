"""Queries for merging (B7-B10), diff and profile (K), run metrics (A) and redaction (P)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tabprep.contracts import ALERT, METRIC
from tabprep.operators.diff import (
    compare_keys,
    compare_rows,
    compare_samples,
    compare_shape,
    compare_values,
    profile,
    table_hash,
)
from tabprep.operators.digests import changed_rows, differing_ranges, digest_tree, key_range
from tabprep.operators.merge import append_dedup, assert_key, upsert
from tabprep.operators.metrics import (
    alert_candidates,
    alert_events,
    alerts_with_cooldown,
    metric_context,
    metrics_summary,
    run_metrics,
    step_metrics,
)
from tabprep.operators.redaction import (
    SCAN_LABELS,
    drop_sensitive_columns,
    drop_sensitive_like,
    redact,
    redact_credentials,
    scan_sensitive,
)
from tabprep.operators.validation import validate_transactions
from tabprep.plans.adapters import RUNS, TENDERS, TENDERS_RAW, TRANSACTIONS, adapted, plain
from tabprep.plans.functions import RAW, TYPED
from tabprep.plans.registry import query
from tabprep.plans.tables import LEDGER, LEDGER_STATUS, LINE_KEY
from tabprep.scratch import scratch_dir
from tabprep.sinks.bucketed import read_bucketed, upsert_bucketed, write_bucketed
from tabprep.sinks.files import append_log, read_log, write_quarantine

RUNS_SQL = plain(RUNS)


def scratch_path(spark, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def table(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- merging


@query(
    "B7_assert_key",
    """SELECT l_orderkey, l_linenumber::bigint AS l_linenumber, count(*) AS row_count, 'duplicate' AS violation
        FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def b7(spark, d):
    return assert_key(table(spark, d, "lineitem"), LINE_KEY)


# Customers as last loaded, and a later extract of them that counts their orders.
CUSTOMER_UPDATE = """SELECT c_custkey + 50 AS c_custkey, c_name || ' (new)' AS c_name, c_mktsegment, c_nationkey
    FROM {customer}"""


@query(
    "B8_upsert",
    f"""WITH s AS ({plain(CUSTOMER_UPDATE)})
        SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey,
        CASE WHEN s.c_custkey IS NOT NULL THEN s.c_name ELSE t.c_name END AS c_name,
        (CASE WHEN s.c_custkey IS NOT NULL THEN s.c_nationkey ELSE t.c_nationkey END)::bigint AS c_nationkey,
        t.c_acctbal, CASE WHEN s.c_custkey IS NOT NULL THEN s.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment
        FROM customer t FULL JOIN s ON t.c_custkey = s.c_custkey""",
)
def b8(spark, d):
    return upsert(table(spark, d, "customer"), adapted(spark, d, CUSTOMER_UPDATE), ["c_custkey"])


@query(
    "B8_upsert_columns",
    f"""WITH s AS ({plain(CUSTOMER_UPDATE)})
        SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey,
        CASE WHEN s.c_custkey IS NOT NULL THEN s.c_name ELSE t.c_name END AS c_name,
        (CASE WHEN t.c_custkey IS NOT NULL THEN t.c_nationkey ELSE s.c_nationkey END)::bigint AS c_nationkey,
        t.c_acctbal, CASE WHEN t.c_custkey IS NOT NULL THEN t.c_mktsegment ELSE s.c_mktsegment END AS c_mktsegment
        FROM customer t FULL JOIN s ON t.c_custkey = s.c_custkey""",
)
def b8_columns(spark, d):
    return upsert(table(spark, d, "customer"), adapted(spark, d, CUSTOMER_UPDATE), ["c_custkey"], ["c_name"])


# An extract of the customers that changed: those whose keys share a remainder, and as many new ones.
CUSTOMER_CHANGES = """SELECT c_custkey + CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE 1000000000 END AS c_custkey,
    c_name || ' (changed)' AS c_name, c_nationkey FROM {customer} WHERE c_custkey % 7 = 3"""


@query(
    "B8_upsert_buckets",
    f"""WITH s AS ({plain(CUSTOMER_CHANGES)})
        SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, coalesce(s.c_name, t.c_name) AS c_name,
        coalesce(s.c_nationkey, t.c_nationkey)::bigint AS c_nationkey, t.c_acctbal, t.c_mktsegment
        FROM customer t FULL JOIN s ON t.c_custkey = s.c_custkey""",
)
def b8_buckets(spark, d):
    """Customers in buckets, of which the source's are rewritten in place."""
    path = scratch_path(spark, "customers")
    write_bucketed(table(spark, d, "customer"), path, ["c_custkey"], 16)
    upsert_bucketed(spark, path, adapted(spark, d, CUSTOMER_CHANGES), ["c_custkey"])
    return read_bucketed(spark, path)


@query(
    "B9_append_dedup",
    f"""SELECT l_orderkey, l_linenumber::bigint AS l_linenumber, AmountLocal::double AS AmountLocal, version FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY batch DESC, AmountLocal DESC) AS rn
        FROM (SELECT 0 AS batch, l_orderkey, l_linenumber, AmountLocal, 'old' AS version FROM ({LEDGER})
              UNION ALL SELECT 1, l_orderkey + 100, l_linenumber, AmountLocal, 'new' FROM ({LEDGER}))) WHERE rn = 1""",
)
def b9(spark, d):
    ledger = adapted(spark, d, TRANSACTIONS).select(*LINE_KEY, "AmountLocal")
    newer = ledger.withColumns({"l_orderkey": F.col("l_orderkey") + 100, "version": F.lit("new")})
    return append_dedup(ledger.withColumn("version", F.lit("old")), newer, LINE_KEY, ["AmountLocal"])


@query(
    "B10_write_quarantine",
    f"""{LEDGER_STATUS} SELECT TransactionID, AmountLocal::double AS AmountLocal,
        CASE WHEN status = 'valid' THEN NULL ELSE 'Validation failed' END AS reason FROM checked""",
)
def b10(spark, d):
    path = scratch_path(spark, "quarantine")
    good = write_quarantine(validate_transactions(adapted(spark, d, TRANSACTIONS)), path)
    bad = spark.read.parquet(path)
    return good.select("TransactionID", "AmountLocal", F.lit(None).cast("string").alias("reason")).unionByName(
        bad.select("TransactionID", "AmountLocal", F.col("_quarantine_reason").alias("reason"))
    )


# --- diff: two versions of the lines, some re-keyed and some revised

# The first order gets all lines of supplier 1, a key repeated many times over, with large amounts.
_HOT = "l_suppkey = 1"
_AMOUNT = f"CASE WHEN {_HOT} THEN 1000000000 ELSE 0 END + cast(l_extendedprice AS decimal(18,2))"
VERSION_1 = f"""SELECT CASE WHEN {_HOT} THEN 0 ELSE l_orderkey END AS l_orderkey,
    CASE WHEN {_HOT} THEN 0 ELSE l_linenumber END AS l_linenumber, l_quantity, l_returnflag,
    cast({_AMOUNT} AS decimal(18,2)) AS amount, l_tax, cast({_AMOUNT} AS decimal(38,10)) AS exact_amount
    FROM {{lineitem}}"""
VERSION_2 = f"""SELECT CASE WHEN {_HOT} THEN 0 ELSE l_orderkey END AS l_orderkey,
    cast(CASE WHEN {_HOT} THEN 0 WHEN l_partkey % 20 = 0 THEN l_linenumber + 7 ELSE l_linenumber END AS int)
    AS l_linenumber, CASE WHEN l_suppkey % 10 = 0 THEN l_quantity + 0.5 ELSE l_quantity END AS l_quantity,
    CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
    cast({_AMOUNT} + CASE WHEN l_partkey % 9 = 0 THEN 1 ELSE 0 END AS decimal(18,2)) AS amount, l_tax,
    cast({_AMOUNT} + CASE WHEN l_partkey % 9 = 0 THEN 0.0000000005 ELSE 0 END AS decimal(38,10)) AS exact_amount
    FROM {{lineitem}}"""
PAIRED = f"""({plain(VERSION_1)}) a JOIN ({plain(VERSION_2)}) b
    ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber"""


def _versions(spark, d):
    return adapted(spark, d, VERSION_1), adapted(spark, d, VERSION_2)


@query(
    "K1_table_hash",
    """SELECT substr(sha256('o_orderkey,o_custkey,o_orderstatus|' || count(*) || '|' ||
        sum(('0x' || substr(h, 1, 15))::bigint) || '|' || sum(('0x' || substr(h, 16, 15))::bigint)), 1, 16) AS hash
        FROM (SELECT sha256('{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"'
        || o_orderstatus || '"}') AS h FROM orders)""",
)
def k1(spark, d):
    return table_hash(table(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus"])


@query(
    "K2a_compare_shape",
    """SELECT (SELECT count(*) FROM lineitem) AS rows_1, (SELECT count(*) FROM orders) AS rows_2, 11::bigint AS columns_1,
        6::bigint AS columns_2, false AS shape_match, false AS columns_match""",
)
def k2a(spark, d):
    return compare_shape(table(spark, d, "lineitem"), table(spark, d, "orders"))


@query(
    "K2b_compare_keys",
    f"""WITH one AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM ({plain(VERSION_1)}) GROUP BY ALL),
        two AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM ({plain(VERSION_2)}) GROUP BY ALL)
        SELECT (SELECT sum(n) FROM one ANTI JOIN two USING (l_orderkey, l_linenumber))::double AS rows_only_in_1,
        (SELECT sum(n) FROM two ANTI JOIN one USING (l_orderkey, l_linenumber))::double AS rows_only_in_2,
        (SELECT count(*) FROM {PAIRED})::double AS rows_in_both""",
)
def k2b(spark, d):
    return compare_keys(*_versions(spark, d), LINE_KEY)


@query(
    "K2c_compare_values",
    f"""SELECT * FROM (SELECT 'l_quantity' AS "column", count(*) FILTER (WHERE abs(a.l_quantity - b.l_quantity) > 1e-10)::double
            AS differences FROM {PAIRED}
        UNION ALL SELECT 'l_returnflag', count(*) FILTER (WHERE a.l_returnflag IS DISTINCT FROM b.l_returnflag)::double FROM {PAIRED}
        UNION ALL SELECT 'amount', count(*) FILTER (WHERE abs(a.amount - b.amount) > 1e-10)::double FROM {PAIRED}
        UNION ALL SELECT 'exact_amount', count(*) FILTER (WHERE abs(a.exact_amount - b.exact_amount) > 0.0000000001)::double FROM {PAIRED}
        UNION ALL SELECT 'l_tax', count(*) FILTER (WHERE abs(a.l_tax - b.l_tax) > 1e-10)::double FROM {PAIRED})
        WHERE differences > 0""",
)
def k2c(spark, d):
    return compare_values(*_versions(spark, d), LINE_KEY)


@query(
    "K2c_compare_samples",
    f"""WITH both_sides AS (SELECT DISTINCT a.l_orderkey, a.l_linenumber, a.l_returnflag AS f1, b.l_returnflag AS f2,
            a.amount AS a1, b.amount AS a2 FROM {PAIRED}),
        long AS (SELECT DISTINCT l_orderkey, l_linenumber, 'l_returnflag' AS "column", f1 AS value_1, f2 AS value_2,
                NULL::decimal(18,2) AS x, NULL::decimal(18,2) AS y FROM both_sides WHERE f1 IS DISTINCT FROM f2 UNION ALL
            SELECT DISTINCT l_orderkey, l_linenumber, 'amount', a1::varchar, a2::varchar, a1, a2 FROM both_sides WHERE a1 <> a2)
        SELECT * EXCLUDE (rn, x, y) REPLACE (l_linenumber::bigint AS l_linenumber) FROM (SELECT *, row_number() OVER (
            PARTITION BY "column" ORDER BY l_orderkey, l_linenumber, x, y, value_1 NULLS FIRST, value_2 NULLS FIRST) AS rn FROM long)
        WHERE rn <= 5""",
)
def k2c_samples(spark, d):
    one, two = (v.select(*LINE_KEY, "l_returnflag", "amount") for v in _versions(spark, d))
    return compare_samples(one, two, LINE_KEY)


def _sql_equal(a: str, b: str) -> str:
    either = f"(SELECT * FROM ({a}) EXCEPT ALL SELECT * FROM ({b})) UNION ALL (SELECT * FROM ({b}) EXCEPT ALL SELECT * FROM ({a}))"
    return f"(SELECT count(*) = 0 FROM ({either}))"


@query(
    "K2d_compare_rows",
    f"""SELECT {_sql_equal(plain(VERSION_1), plain(VERSION_1))} AS same, {_sql_equal(plain(VERSION_1), plain(VERSION_2))} AS revised,
        false AS retyped""",
)
def k2d(spark, d):
    one, two = _versions(spark, d)
    same = compare_rows(one, one.repartition("l_orderkey"))
    revised = compare_rows(one, two)
    retyped = compare_rows(one, one.withColumn("l_linenumber", F.col("l_linenumber").cast("decimal(10,0)")))
    return same.select(F.col("data_equal").alias("same"), revised.scalar().alias("revised"), retyped.scalar().alias("retyped"))


# The lines after a few corrections: one amount changed, one order gone, one line twice.
CORRECTED = """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_orderkey % 1997 = 3 AND l_linenumber = 1
    THEN l_quantity + 1 ELSE l_quantity END AS l_quantity, l_shipdate FROM {lineitem} WHERE l_orderkey % 2003 <> 5
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate FROM {lineitem}
    WHERE l_orderkey % 1999 = 7 AND l_linenumber = 1"""
_LINES = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate"]
_CHANGED_SQL = f"""one AS (SELECT {", ".join(_LINES)} FROM lineitem), two AS ({plain(CORRECTED)}),
        gone AS (SELECT * FROM one EXCEPT ALL SELECT * FROM two), added AS (SELECT * FROM two EXCEPT ALL SELECT * FROM one)"""
#: Bits of a range of order keys, and of its place among those of the next level.
_RANGE_BITS, _LEVELS, _STEP = 6, 3, 3


@query(
    "K2_differing_ranges",
    f"""WITH {_CHANGED_SQL}, levels AS (SELECT unnest(range({_LEVELS})) AS level),
        differing AS (SELECT DISTINCT level, l_orderkey >> ({_RANGE_BITS} + {_STEP} * level) AS "range"
            FROM (SELECT * FROM gone UNION ALL SELECT * FROM added), levels),
        counted AS (SELECT level, l_orderkey >> ({_RANGE_BITS} + {_STEP} * level) AS "range", count(*) FILTER (WHERE side = 1) AS rows_1,
            count(*) FILTER (WHERE side = 2) AS rows_2
            FROM (SELECT l_orderkey, 1 AS side FROM one UNION ALL SELECT l_orderkey, 2 FROM two), levels GROUP BY ALL)
        SELECT level, "range", rows_1, rows_2 FROM differing JOIN counted USING (level, "range")""",
)
def k2_ranges(spark, d):
    leaf = key_range("l_orderkey", _RANGE_BITS)
    one, two = (digest_tree(t, leaf, levels=_LEVELS, step=_STEP) for t in (table(spark, d, "lineitem").select(*_LINES), adapted(spark, d, CORRECTED)))
    return differing_ranges(one, two, _LEVELS, _STEP)


@query(
    "K2_changed_rows",
    f"""WITH {_CHANGED_SQL} SELECT * REPLACE (l_linenumber::bigint AS l_linenumber, l_quantity::double AS l_quantity), 1::bigint AS only_in,
        count(*) AS copies FROM gone GROUP BY ALL
        UNION ALL SELECT * REPLACE (l_linenumber::bigint AS l_linenumber, l_quantity::double AS l_quantity), 2, count(*) FROM added GROUP BY ALL""",
)
def k2_changed(spark, d):
    return changed_rows(table(spark, d, "lineitem").select(*_LINES), adapted(spark, d, CORRECTED), key_range("l_orderkey", _RANGE_BITS))


_RAW_TYPES = [("k", "bigint")] + [
    (c, "string")
    for c in (
        "TenderID ProjectName ClientName BusinessDivision TenderStatus TenderReceivedDate TenderSubmissionDate "
        "ProjectStartDate ProjectEndDate TenderValue ReportingValue ProbabilityPercentage WeightedValue ActionOwner "
        "MonthlyForecast QuarterlyForecast"
    ).split()
]


def _sql_profile(source: str) -> str:
    rows = " UNION ALL ".join(
        f"""SELECT {i}::bigint AS position, '{c}' AS "column", '{t}' AS type, count(*) - count({c}) AS null_count,
            count(*) AS row_count FROM src"""
        for i, (c, t) in enumerate(_RAW_TYPES)
    )
    return f"WITH src AS ({source}) {rows}"


@query("K3_profile", _sql_profile(RAW))
def k3(spark, d):
    return profile(adapted(spark, d, TENDERS_RAW))


# --- run metrics

METRIC_EVENTS = """SELECT event_id, event_type AS name, value, ts AS timestamp,
    map('pipeline', 'p' || cast(user_id % 10 AS string)) AS tags, event_type || '/s' AS unit FROM {events}"""

STEPS = """SELECT 'p' || cast(user_id % 10 AS string) AS pipeline, event_type AS step, 'success' AS status,
    max(ts) AS ended_at, cast(sum(cast(value AS decimal(18,2))) AS double) AS duration_seconds,
    count(*) AS records_out FROM {events} GROUP BY user_id % 10, event_type, cast(ts AS date)"""


def _flat(metrics):
    tags = F.col("tags")
    return metrics.select(
        "name",
        "value",
        "timestamp",
        tags["pipeline"].alias("pipeline"),
        tags["step"].alias("step"),
        tags["status"].alias("status"),
        "unit",
    )


RUN_METRICS_SQL = f"""WITH runs AS ({RUNS_SQL})
    SELECT 'pipeline_start' AS name, 1::double AS value, started_at AS timestamp, pipeline, NULL::varchar AS step,
        'started' AS status, '' AS unit FROM runs
    UNION ALL SELECT 'pipeline_end', 1, ended_at, pipeline, NULL, status, '' FROM runs
    UNION ALL SELECT 'pipeline_duration_seconds', duration_seconds, ended_at, pipeline, NULL, status, 'seconds' FROM runs
    UNION ALL SELECT 'records_processed', records_processed, ended_at, pipeline, NULL, NULL, 'records' FROM runs
    UNION ALL SELECT 'records_loaded', records_loaded, ended_at, pipeline, NULL, NULL, 'records' FROM runs
    UNION ALL SELECT 'success_rate', CASE WHEN records_processed > 0 THEN records_loaded::double / records_processed
        ELSE 0 END, ended_at, pipeline, NULL, NULL, 'percent' FROM runs"""
STEP_METRICS_SQL = f"""WITH steps AS ({plain(STEPS)})
    SELECT 'step_duration_seconds' AS name, duration_seconds AS value, ended_at AS timestamp, pipeline, step, status,
        'seconds' AS unit FROM steps
    UNION ALL SELECT 'step_throughput', CASE WHEN duration_seconds > 0 THEN records_out / duration_seconds ELSE 0 END,
        ended_at, pipeline, step, NULL, 'records/sec' FROM steps"""


@query("A1_run_metrics", RUN_METRICS_SQL)
def a1(spark, d):
    return _flat(run_metrics(adapted(spark, d, RUNS)))


@query("A2_step_metrics", STEP_METRICS_SQL)
def a2(spark, d):
    return _flat(step_metrics(adapted(spark, d, STEPS)))


def _sql_summary(where: str) -> str:
    return f"""SELECT event_type AS name, count(*) AS count, min(value) AS min, max(value) AS max, round(avg(value), 6) AS avg,
        arg_max(value, (ts, event_id)) AS latest, event_type || '/s' AS unit FROM events WHERE {where} GROUP BY event_type"""


@query("A3_metrics_summary", _sql_summary("ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOUR"))
def a3(spark, d):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    summary = metrics_summary(adapted(spark, d, METRIC_EVENTS), now, order_by=["timestamp", "event_id"])
    return summary.withColumn("avg", F.round("avg", 6))


@query(
    "A3_metrics_summary_tagged",
    _sql_summary("ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 500 HOUR AND user_id % 10 = 3"),
)
def a3_tagged(spark, d):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    events = adapted(spark, d, METRIC_EVENTS)
    summary = metrics_summary(events, now, "p3", 500, order_by=["timestamp", "event_id"])
    return summary.withColumn("avg", F.round("avg", 6))


CANDIDATES_SQL = f"""SELECT pipeline, timestamp, 'pipeline_duration_high' AS alert, 'warning' AS severity, 3600::bigint
        AS cooldown_seconds FROM ({RUN_METRICS_SQL}) WHERE name = 'pipeline_duration_seconds' AND value > 1800
    UNION ALL SELECT pipeline, timestamp, 'success_rate_low', 'critical', 1800 FROM ({RUN_METRICS_SQL})
        WHERE name = 'success_rate' AND value < 0.95
    UNION ALL SELECT pipeline, timestamp, 'no_records_processed', 'warning', 3600 FROM ({RUN_METRICS_SQL})
        WHERE name = 'records_processed' AND value = 0
    UNION ALL SELECT pipeline, timestamp, 'step_throughput_low', 'info', 1800 FROM (
        SELECT pipeline, timestamp, max(value) AS value FROM ({STEP_METRICS_SQL}) WHERE name = 'step_throughput'
        GROUP BY pipeline, timestamp) WHERE value < 100"""


def _candidates(spark, d):
    metrics = run_metrics(adapted(spark, d, RUNS)).unionByName(step_metrics(adapted(spark, d, STEPS)))
    return alert_candidates(metric_context(metrics))


@query("A4_alert_candidates", CANDIDATES_SQL)
def a4(spark, d):
    return _candidates(spark, d).select("pipeline", "timestamp", "alert", "severity", "cooldown_seconds")


def _sql_cooldown(candidates: str) -> str:
    return f"""WITH RECURSIVE c AS ({candidates}),
        fired AS (SELECT alert, min(timestamp) AS timestamp FROM c GROUP BY alert
            UNION ALL SELECT f.alert, min(c.timestamp) FROM fired f JOIN c ON c.alert = f.alert
                AND c.timestamp >= f.timestamp + to_seconds(c.cooldown_seconds) GROUP BY f.alert, f.timestamp)
        SELECT alert, timestamp FROM fired"""


@query("A5_alerts_with_cooldown", _sql_cooldown(CANDIDATES_SQL))
def a5(spark, d):
    return alerts_with_cooldown(_candidates(spark, d))


@query(
    "A5_cooldown_events",
    _sql_cooldown("SELECT event_type AS alert, ts AS timestamp, 3600 AS cooldown_seconds FROM events"),
)
def a5_events(spark, d):
    events = table(spark, d, "events")
    return alerts_with_cooldown(
        events.select(F.col("event_type").alias("alert"), F.col("ts").alias("timestamp"), F.lit(3600).alias("cooldown_seconds"))
    )


@query(
    "A6_metric_log",
    """SELECT event_type AS name, value, ts AS timestamp, 'p' || user_id % 10 AS pipeline, event_type || '/s' AS unit
        FROM events""",
)
def a6(spark, d):
    path = scratch_path(spark, "metric-log")
    append_log(adapted(spark, d, METRIC_EVENTS).select(*METRIC.fieldNames()), path)
    logged = read_log(spark, path, METRIC)
    return logged.select("name", "value", "timestamp", F.col("tags")["pipeline"].alias("pipeline"), "unit")


@query(
    "A6_alert_log",
    f"""WITH RECURSIVE c AS ({CANDIDATES_SQL}),
        fired AS (SELECT alert, min(timestamp) AS timestamp FROM c GROUP BY alert
            UNION ALL SELECT f.alert, min(c.timestamp) FROM fired f JOIN c ON c.alert = f.alert
                AND c.timestamp >= f.timestamp + to_seconds(c.cooldown_seconds) GROUP BY f.alert, f.timestamp),
        context AS (SELECT pipeline, timestamp, max(value) FILTER (WHERE name = 'success_rate') AS rate,
            max(value) FILTER (WHERE name = 'pipeline_duration_seconds') AS duration
            FROM (SELECT * FROM ({RUN_METRICS_SQL}) UNION ALL SELECT * FROM ({STEP_METRICS_SQL})) GROUP BY pipeline, timestamp)
        SELECT f.alert AS name, min(c.severity) AS severity, f.timestamp AS timestamp,
            arg_min_null(context.rate, c.pipeline) AS success_rate, arg_min_null(context.duration, c.pipeline) AS duration
        FROM fired f JOIN c ON c.alert = f.alert AND c.timestamp = f.timestamp
        JOIN context ON context.pipeline = c.pipeline AND context.timestamp = c.timestamp GROUP BY f.alert, f.timestamp""",
)
def a6_alerts(spark, d):
    path = scratch_path(spark, "alert-log")
    candidates = _candidates(spark, d)
    append_log(alert_events(candidates, alerts_with_cooldown(candidates)), path)
    logged = read_log(spark, path, ALERT)
    return logged.select(
        "name",
        "severity",
        "timestamp",
        F.col("context")["success_rate"].alias("success_rate"),
        F.col("context")["pipeline_duration_seconds"].alias("duration"),
    )


# --- sensitive data

CONTACTS = """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS email, c_acctbal AS balance, c_name AS _source_file,
    c_nationkey AS tender_key, c_mktsegment AS Work_Phone FROM {customer}"""


@query(
    "P1_drop_sensitive_columns",
    f"""SELECT id, name, balance, tender_key::bigint AS tender_key, Work_Phone FROM ({plain(CONTACTS)})""",
)
def p1(spark, d):
    return drop_sensitive_columns(adapted(spark, d, CONTACTS))


@query("P2_drop_sensitive_like", f"SELECT id, name, balance, _source_file FROM ({plain(CONTACTS)})")
def p2(spark, d):
    return drop_sensitive_like(adapted(spark, d, CONTACTS))


def sql_redacted(c: str) -> str:
    steps = (
        (r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}", "[EMAIL REDACTED]"),
        (r"(\+?\d{1,3}[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}", "[PHONE REDACTED]"),
        (r"\b\d{3}\.?\d{3}\.?\d{3}-?\d{2}\b", "[CPF REDACTED]"),
        (r"\b\d{2}\.?\d{3}\.?\d{3}/\d{4}-?\d{2}\b", "[CNPJ REDACTED]"),
        (r"sk-[a-zA-Z0-9]{48}", "[API KEY REDACTED]"),
        (r"Bearer\s+[a-zA-Z0-9._-]+", "[TOKEN REDACTED]"),
    )
    for pattern, replacement in steps:
        c = f"regexp_replace({c}, '{pattern}', '{replacement}', 'g')"
    return c


@query("P3_redact", f"SELECT doc_id, {sql_redacted('text')} AS text, {sql_redacted('source')} AS source FROM documents")
def p3(spark, d):
    return redact(table(spark, d, "documents").select("doc_id", "text", "source"))


@query("P3_redact_conversations", f"SELECT conv_id, turn, {sql_redacted('text')} AS text FROM conversations")
def p3_conversations(spark, d):
    return redact(table(spark, d, "conversations").select("conv_id", "turn", "text"))


_NAMES = "(password|secret|token|key|api_key|client_secret)"


@query(
    "P4_redact_credentials",
    rf"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '{_NAMES}\s*:\s*\S+', '\1: [REDACTED]', 'gi'),
        '{_NAMES}\s*=\s*\S+', '\1=[REDACTED]', 'gi'), '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{{2,}}',
        '[EMAIL REDACTED]', 'gi') AS text FROM documents""",
)
def p4(spark, d):
    return redact_credentials(table(spark, d, "documents").select("doc_id", "text"), ["text"])


def _sql_scan(name: str, key: str, text: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT {key}, '{label}' AS label, len(regexp_extract_all({text}, '(?i){pattern}'))::bigint AS matches FROM {name}"
        for label, pattern in SCAN_LABELS.items()
    )
    return f"SELECT * FROM ({parts}) WHERE matches > 0"


@query("P5_scan_sensitive", _sql_scan("documents", "doc_id", "text"))
def p5(spark, d):
    return scan_sensitive(table(spark, d, "documents"), "text", "doc_id")


@query("P5_scan_sensitive_pages", _sql_scan("pages", "page_id", "html"))
def p5_pages(spark, d):
    return scan_sensitive(table(spark, d, "pages"), "html", "page_id")
