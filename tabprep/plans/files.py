"""Queries for sources (S), sinks (B), recipes (L), folder sanitizing (P6) and the streaming forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabprep.contracts import OPPORTUNITY
from tabprep.operators.diff import profile
from tabprep.plans.adapters import OPPORTUNITIES, TENDERS, TENDERS_RAW, TRANSACTIONS, adapted
from tabprep.plans.functions import OPPS, RAW, TYPED, sql_date
from tabprep.plans.operations import _sql_cooldown, scratch_path, sql_redacted, table
from tabprep.plans.recipe import run_recipe
from tabprep.plans.registry import query
from tabprep.plans.reporting import CALENDAR, CLEAN_ENRICHED, FISCAL, LABELS, sql_periods
from tabprep.plans.tables import LEDGER_STATUS
from tabprep.sinks.files import write_csv, write_formats, write_json, write_parquet, write_tables
from tabprep.sinks.sanitize import sanitize_dir
from tabprep.sinks.workbook import write_excel
from tabprep.sources import synthetic
from tabprep.sources.database import read_query
from tabprep.sources.files import add_lineage, normalize_headers, read_any, read_csv
from tabprep.sources.incremental import read_incremental
from tabprep.sources.odata import count_odata_rows, read_odata_chains, read_odata_pages, read_odata_rows
from tabprep.sources.workbook import read_excel
from tabprep.streaming.alerts import fired_alerts, start_alerts
from tabprep.streaming.incremental import current_rows, retire, snapshot, start_incremental

RAW_COLUMNS = [f.strip() for f in (
    "TenderID, ProjectName, ClientName, BusinessDivision, TenderStatus, TenderReceivedDate, TenderSubmissionDate, "
    "ProjectStartDate, ProjectEndDate, TenderValue, ReportingValue, ProbabilityPercentage, WeightedValue, "
    "ActionOwner, MonthlyForecast, QuarterlyForecast"
).split(",")]


# --- sources


@query(
    "S1_read_csv",
    f"""SELECT k::varchar AS k, TenderID, ClientName, TenderStatus, TenderValue, ReportingValue, ActionOwner,
        {sql_date("TenderReceivedDate")} AS TenderReceivedDate, {sql_date("ProjectStartDate")} AS ProjectStartDate
        FROM ({RAW})""",
)
def s1(spark, d):
    path = scratch_path(spark, "s1")
    write_csv(adapted(spark, d, TENDERS_RAW), path, delimiter=";")
    read = read_csv(spark, path, delimiter=";", parse_dates=["TenderReceivedDate", "ProjectStartDate"])
    return read.select(
        "k", "TenderID", "ClientName", "TenderStatus", "TenderValue", "ReportingValue", "ActionOwner",
        "TenderReceivedDate", "ProjectStartDate",
    )


@query(
    "S2_read_excel",
    f"""SELECT k, TenderID, TenderStatus, TenderValue::double AS TenderValue, ProjectStartDate::timestamp AS ProjectStartDate,
        ReportingValue::double AS ReportingValue FROM ({TYPED})""",
)
def s2(spark, d):
    path = scratch_path(spark, "s2")
    tenders = adapted(spark, d, TENDERS)
    columns = ["k", "TenderID", "TenderStatus", "TenderValue", "ProjectStartDate", "ReportingValue"]
    write_excel(tenders.select(*columns), path, "Register", rows_per_workbook=2000)
    kinds = {"k": "int", "TenderValue": "decimal", "ReportingValue": "decimal"}
    read = read_excel(spark, path, "Register", dtypes=kinds, parse_dates=["ProjectStartDate"], lineage=False)
    return read.select(*columns)


@query("S1_csv_with_line_breaks", "SELECT doc_id::varchar AS doc_id, text FROM documents")
def s1_lines(spark, d):
    path = scratch_path(spark, "s1-lines")
    write_csv(table(spark, d, "documents").select("doc_id", "text"), path)
    return read_csv(spark, path, lineage=False, multi_line=True)


@query(
    "S2_excel_rewritten",
    "SELECT o_orderkey::varchar AS o_orderkey, o_orderpriority || chr(13) || chr(1) AS o_orderpriority FROM orders WHERE o_orderkey % 3 = 0",
)
def s2_rewritten(spark, d):
    """Written twice, the second time with fewer rows in fewer workbooks, and odd characters."""
    path = scratch_path(spark, "s2-again")
    odd = F.concat("o_orderpriority", F.lit("\r\x01")).alias("o_orderpriority")
    orders = table(spark, d, "orders").select("o_orderkey", odd)
    write_excel(orders, path, rows_per_workbook=1000)
    write_excel(orders.filter("o_orderkey % 3 = 0"), path, rows_per_workbook=5000)
    return read_excel(spark, path, lineage=False)


@query("S3_normalize_headers", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def s3(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return normalize_headers(orders.toDF(" o_orderkey", "\to_custkey ", "o_totalprice\n"))


@query("S4_add_lineage", "SELECT o_orderkey, 'orders.parquet' AS _source_file, true AS stamped FROM orders")
def s4(spark, d):
    tracked = add_lineage(table(spark, d, "orders"))
    return tracked.select("o_orderkey", "_source_file", F.col("_extracted_at").isNotNull().alias("stamped"))


def _land_pages(spark, d) -> str:
    """Opportunities as JSON pages of 500, one page per line."""
    path = scratch_path(spark, "pages")
    page = F.floor(F.substring("opportunityid", 5, 12).cast("bigint") / 500)
    rows = adapted(spark, d, OPPORTUNITIES).withColumn("page", page)
    pages = rows.groupBy("page").agg(F.collect_list(F.struct(*OPPORTUNITY.fieldNames())).alias("value"))
    link = F.concat(F.lit("opportunities?page="), (F.col("page") + 1).cast("string")).alias("@odata.nextLink")
    pages.select("value", link).write.json(path)
    return path


@query(
    "S5_read_odata_pages",
    f"""SELECT opportunityid, statuscode, estimatedvalue::double AS estimatedvalue FROM ({OPPS}) WHERE statecode = 0
        ORDER BY opportunityid LIMIT 5000""",
)
def s5(spark, d):
    wanted = ["opportunityid", "statuscode", "estimatedvalue"]
    return read_odata_pages(spark, _land_pages(spark, d), filter="statecode = 0", select=wanted, top=5000)


@query("S5_read_odata_all", f"SELECT opportunityid, statuscode FROM ({OPPS}) WHERE statecode = 0")
def s5_all(spark, d):
    return read_odata_pages(spark, _land_pages(spark, d), filter="statecode = 0", select=["opportunityid", "statuscode"])


@query("S5_count_odata_rows", f"SELECT count(*) AS count FROM ({OPPS}) WHERE probability >= 50")
def s5_count(spark, d):
    return count_odata_rows(read_odata_rows(spark, _land_pages(spark, d), filter="probability >= 50"))


_CHAINS, _PAGE_ROWS = 7, 20


@query(
    "S5_follow_links",
    f"""WITH RECURSIVE counted AS (SELECT o_orderkey % {_CHAINS} AS chain, o_orderkey // {_CHAINS} // {_PAGE_ROWS} AS page, count(*) AS n
        FROM orders GROUP BY ALL),
      pages AS (SELECT chain, page, n, CASE WHEN page < last THEN page + 1 WHEN chain = 2 THEN 1 END AS next
        FROM (SELECT *, max(page) OVER (PARTITION BY chain) AS last FROM counted) WHERE NOT (chain = 1 AND page = 2)),
      walk AS (SELECT chain, 0::bigint AS page FROM range({_CHAINS}) r(chain)
        UNION ALL SELECT chain, next FROM walk JOIN pages USING (chain, page) WHERE next = page + 1)
      SELECT walk.chain::bigint AS chain, 'orders/' || walk.chain || '/' || walk.page AS address, walk.page AS position,
        CASE WHEN n IS NULL THEN 'missing' WHEN next <= walk.page THEN 'cycle' ELSE 'read' END AS status, coalesce(n, 0) AS records
        FROM walk LEFT JOIN pages USING (chain, page)
      UNION ALL SELECT NULL, 'orders/' || chain || '/' || page, NULL, 'orphan', 0 FROM pages ANTI JOIN walk USING (chain, page)""",
)
def s5_links(spark, d):
    """Orders as shuffled JSON pages of several chains: of one a page is missing, another one leads back."""
    path = scratch_path(spark, "chains")
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", (F.col("o_orderkey") % _CHAINS).alias("chain"))
    pages = orders.groupBy("chain", F.expr(f"o_orderkey div {_CHAINS} div {_PAGE_ROWS}").alias("page")).agg(
        F.collect_list(F.struct("o_orderkey", "o_totalprice")).alias("value")
    )
    last = orders.groupBy("chain").agg(F.expr(f"max(o_orderkey) div {_CHAINS} div {_PAGE_ROWS}").alias("last"))
    following = F.when(F.col("page") < F.col("last"), F.col("page") + 1).when(F.col("chain") == 2, 1)
    named = pages.join(last, "chain").filter("not (chain = 1 and page = 2)").select(
        F.concat_ws("/", F.lit("orders"), "chain", "page").alias("@odata.context"),
        F.when(following.isNotNull(), F.concat_ws("/", F.lit("orders"), "chain", following)).alias("@odata.nextLink"),
        "value",
    )
    named.repartition(F.xxhash64("`@odata.context`")).write.json(path)
    starts = spark.range(_CHAINS).select(F.col("id").alias("chain"), F.concat(F.lit("orders/"), "id", F.lit("/0")).alias("address"))
    records, report = read_odata_chains(spark, path, starts, orders.select("o_orderkey", "o_totalprice").schema, strict=False)
    counts = records.groupBy("chain", "position").agg(F.count("*").alias("records"))
    found = report.join(counts, ["chain", "position"], "left")
    return found.select("chain", "address", "position", "status", F.coalesce("records", F.lit(0)).alias("records"))


_FORMATS = ("parquet", "csv", "json", "xlsx")


@query(
    "S6_read_any",
    " UNION ALL ".join(f"SELECT '{f}' AS format, s_suppkey::varchar AS s_suppkey, s_name FROM supplier" for f in _FORMATS),
)
def s6(spark, d):
    path = scratch_path(spark, "s6")
    suppliers = table(spark, d, "supplier").select("s_suppkey", "s_name")
    write_formats(suppliers, path, ["parquet", "csv", "json", "excel"])
    read = None
    for fmt in _FORMATS:
        rows = read_any(spark, f"{path}.{fmt}")
        rows = rows.select(F.lit(fmt).alias("format"), F.col("s_suppkey").cast("string").alias("s_suppkey"), "s_name")
        read = rows if read is None else read.unionByName(rows)
    return read


@query(
    "S7_read_query",
    "SELECT o_orderpriority, count(*) AS orders FROM orders WHERE o_totalprice > 100000 AND o_orderstatus <> 'P' GROUP BY 1",
)
def s7(spark, d):
    sql = f"""SELECT o_orderpriority, count(*) AS orders FROM parquet.`{d}/orders.parquet`
        WHERE o_totalprice > :low AND o_orderstatus <> :status GROUP BY 1"""
    return read_query(spark, sql, {"low": 100000, "status": "P"})


_LINEITEM_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}


@query(
    "S9_source_profile",
    " UNION ALL ".join(
        f"""SELECT {i}::bigint AS position, '{c}' AS "column", '{t}' AS type, count(*) - count({c}) AS null_count,
        count(*) AS row_count FROM lineitem"""
        for i, (c, t) in enumerate(_LINEITEM_TYPES.items())
    ),
)
def s9(spark, d):
    return profile(table(spark, d, "lineitem"))


class _SqlDraw:
    """The row-number arithmetic of the generators in SQL."""

    def __init__(self, row: str, seed: int = 42):
        self.row, self.seed = row, seed

    def below(self, n: int, salt: int) -> str:
        p = synthetic.PRIME
        x = f"((({self.row} % {p}) * 48271 + {(self.seed * 69621 + salt * 40692) % p}) % {p})"
        y = f"(({x} * {x} + {x}) % {p})"
        return f"(((({y} * 16807 + {salt}) % {p}) // 65536) % {n})"

    def between(self, low: int, high: int, salt: int) -> str:
        return f"({self.below(high - low + 1, salt)} + {low})"

    def pick(self, values, salt: int) -> str:
        items = ", ".join("'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v) for v in values)
        return f"([{items}])[{self.below(len(values), salt)} + 1]"


_s = _SqlDraw("o_orderkey")
_received = f"CASE WHEN {_s.below(100, 1)} >= 15 THEN DATE '2025-01-01' + {_s.between(0, 300, 2)}::int END"
GENERATED_TENDERS = f"""SELECT o_orderkey AS k, received, submission, start, start + {_s.between(90, 1000, 5)}::int AS finish
    FROM (SELECT *, submission + {_s.between(30, 180, 4)}::int AS start FROM (
        SELECT *, received + {_s.between(1, 60, 3)}::int AS submission FROM (SELECT o_orderkey, {_received} AS received FROM orders)))"""


@query(
    "S10_gen_tenders",
    f"""SELECT 'TND-2025-' || lpad(k::varchar, 12, '0') AS TenderID,
        {_s.pick(synthetic.PROJECT_KINDS, 10)} || ' Project ' || k AS ProjectName,
        {_s.pick(synthetic.CLIENTS, 11)} AS ClientName, {_s.pick(synthetic.DIVISIONS, 12)} AS BusinessDivision,
        {_s.pick(synthetic.STATUSES, 13)} AS TenderStatus, received AS TenderReceivedDate,
        submission AS TenderSubmissionDate, start AS ProjectStartDate, finish AS ProjectEndDate,
        round({_s.between(10_000_000, 1_000_000_000, 6)} / 100, 2) AS TenderValue,
        {_s.between(10, 90, 7)} / 100 AS ProbabilityPercentage,
        {_s.between(10_000_000, 1_000_000_000, 6)} * {_s.between(80, 120, 8)} / 10000 AS ReportingValue,
        {_s.between(10_000_000, 1_000_000_000, 6)} * {_s.between(10, 90, 7)} / 10000 AS WeightedValue,
        {_s.pick(synthetic.OWNERS, 14)} AS ActionOwner,
        {_s.below(100, 9)} >= 30 AS HasForecast FROM ({GENERATED_TENDERS}) JOIN orders ON k = o_orderkey""",
)
def s10(spark, d):
    tenders = synthetic.tenders_for(table(spark, d, "orders"), "o_orderkey")
    return tenders.withColumn("HasForecast", F.col("MonthlyForecast").isNotNull()).drop("MonthlyForecast", "QuarterlyForecast")


_account = _s.below(len(synthetic.ACCOUNTS), 1)
_kinds = [a[2] for a in synthetic.ACCOUNTS]


def _sql_account(part: int) -> str:
    return "(['" + "', '".join(a[part] for a in synthetic.ACCOUNTS) + f"'])[{_account} + 1]"


def _sql_generated_amount() -> str:
    cases = "".join(
        f" WHEN {_sql_account(2)} = '{kind}' THEN {_s.between(low * 100, high * 100, 2)}"
        for kind, (low, high) in synthetic.AMOUNT_RANGES.items()
    )
    low, high = synthetic.OTHER_AMOUNTS
    return f"(CASE{cases} ELSE {_s.between(low * 100, high * 100, 2)} END) / 100"


@query(
    "S11_gen_transactions",
    f"""SELECT 'TXN-2025-' || lpad(o_orderkey::varchar, 12, '0') AS TransactionID,
        DATE '2025-01-01' + {_s.between(0, 364, 4)}::int AS Date, {_sql_account(0)} AS AccountCode,
        {_sql_account(1)} AS AccountName, {_sql_account(2)} AS AccountType, {_sql_account(3)} AS StatementSection,
        {_s.pick(synthetic.DEPARTMENTS, 3)} AS Department,
        'CC-' || upper(substr({_s.pick(synthetic.DEPARTMENTS, 3)}, 1, 3)) || '-00' || {_s.between(1, 3, 5)} AS CostCenter,
        {_s.pick(synthetic.ENTITIES, 6)} AS Entity, {_s.pick(synthetic.SCENARIOS, 7)} AS Scenario,
        {_sql_generated_amount()} AS AmountLocal, {_s.pick(synthetic.CURRENCIES, 8)} AS Currency,
        {_s.pick(synthetic.SCENARIOS, 7)} || ' - ' || {_sql_account(1)} || ' - ' || {_s.pick(synthetic.DEPARTMENTS, 3)}
        AS Description FROM orders""",
)
def s11(spark, d):
    return synthetic.transactions_for(table(spark, d, "orders"), "o_orderkey")


_status = _s.pick(synthetic.OPPORTUNITY_STATUSES, 1)
_created = f"(DATE '2023-01-01' + {_s.between(0, 600, 2)}::int)"


@query(
    "S12_gen_opportunities",
    f"""SELECT 'OPP-' || lpad(o_orderkey::varchar, 12, '0') AS opportunityid,
        'Opportunity ' || o_orderkey || ' - Client ' || {_s.between(1, 20, 4)} AS name,
        CASE WHEN {_status} IN ('Won', 'Lost') THEN 1::bigint ELSE 0 END AS statecode, {_status} AS statuscode,
        {_s.pick(synthetic.STAGES, 6)} AS stepname, {_s.between(500_000, 50_000_000, 5)} / 100 AS estimatedvalue,
        strftime({_created} + {_s.between(30, 180, 7)}::int, '%Y-%m-%d') AS estimatedclosedate,
        strftime(CASE {_status} WHEN 'Won' THEN {_created} + {_s.between(30, 200, 3)}::int
            WHEN 'Lost' THEN {_created} + {_s.between(30, 150, 3)}::int END, '%Y-%m-%d') AS actualclosedate,
        'ACC-' || lpad({_s.between(1, 20, 8)}::varchar, 3, '0') AS customerid,
        'OWN-' || lpad({_s.between(1, 5, 9)}::varchar, 2, '0') AS ownerid,
        (CASE {_status} WHEN 'Won' THEN 100 WHEN 'Lost' THEN 0
            ELSE {_s.pick(synthetic.OPEN_PROBABILITIES, 10)} END)::bigint AS probability,
        strftime({_created}, '%Y-%m-%d') AS createdon,
        strftime({_created} + {_s.between(0, 100, 11)}::int, '%Y-%m-%d') AS modifiedon FROM orders""",
)
def s12(spark, d):
    return synthetic.opportunities_for(table(spark, d, "orders"), "o_orderkey")


@query("S13_read_incremental", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '2000-06-01'")
def s13(spark, d):
    last = F.lit("2000-06-01").cast("timestamp_ntz")
    return read_incremental(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), last, "o_orderdate").rows


@query("S13_next_watermark", "SELECT max(ts) AS watermark FROM events")
def s13_watermark(spark, d):
    last = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return read_incremental(table(spark, d, "events"), last, "ts").watermark


@query(
    "S13_stream_incremental",
    f"""SELECT opportunityid, statuscode || ' again' AS statuscode, customerid, strftime(modifiedon::date + 30, '%Y-%m-%d')
        AS modifiedon FROM ({OPPS})""",
)
def s13_stream(spark, d):
    """Two versions of every opportunity arrive as files; the later one is current."""
    landing, log, checkpoint = (scratch_path(spark, n) for n in ("landing", "changes", "checkpoint"))
    first = adapted(spark, d, OPPORTUNITIES).select("opportunityid", "statuscode", "customerid", "modifiedon")
    second = first.withColumns(
        {
            "statuscode": F.concat("statuscode", F.lit(" again")),
            "modifiedon": F.date_add(F.col("modifiedon").cast("date"), 30).cast("string"),
        }
    )
    write_json(first.unionByName(second).repartition("opportunityid"), landing)
    start_incremental(spark, landing, first.schema, log, checkpoint, ["opportunityid"], max_files=3).awaitTermination()
    return current_rows(spark, log, ["opportunityid"])


@query(
    "S13_compacted",
    f"""SELECT opportunityid, CASE WHEN substr(opportunityid, 16, 1) IN ('1', '2') THEN statuscode || ' again' ELSE statuscode END
        AS statuscode, customerid, modifiedon FROM ({OPPS})""",
)
def s13_compacted(spark, d):
    """A log is loaded, compacted while it goes on, and read as its snapshot and the batches since."""
    landing, log, checkpoint = (scratch_path(spark, n) for n in ("landing", "changes", "checkpoint"))
    first = adapted(spark, d, OPPORTUNITIES).select("opportunityid", "statuscode", "customerid", "modifiedon")
    last_digit = F.substring("opportunityid", 16, 1)
    for digit in (None, "1", "2"):
        # The same watermark: the later batch wins.
        again = first if digit is None else first.where(last_digit == digit).withColumn("statuscode", F.concat("statuscode", F.lit(" again")))
        again.repartition("opportunityid").write.mode("append").json(landing)
        start_incremental(spark, landing, first.schema, log, checkpoint, ["opportunityid"]).awaitTermination()
        if digit != "2":
            snapshot(spark, log, ["opportunityid"])
    retire(spark, log)
    return current_rows(spark, log, ["opportunityid"])


@query(
    "A5_stream_cooldown",
    _sql_cooldown("SELECT event_type AS alert, ts AS timestamp, 3600 AS cooldown_seconds FROM events"),
)
def a5_stream(spark, d):
    """The streaming form over the whole event table, which arrives in three parts one after the other."""
    landing, log, checkpoint = (scratch_path(spark, n) for n in ("events", "fired", "checkpoint"))
    events = table(spark, d, "events").select("event_type", "ts")
    cuts = events.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    third, two_thirds = cuts.agg(F.percentile_approx("t", [1 / 3, 2 / 3])).first()[0] or (0, 0)
    moment = F.unix_micros(F.col("ts").cast("timestamp"))
    for part in (moment <= third, (moment > third) & (moment <= two_thirds), moment > two_thirds):
        events.filter(part).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(events.schema).parquet(landing)
        candidates = stream.select(F.col("event_type").alias("alert"), F.col("ts").alias("timestamp"), F.lit(3600).alias("cooldown_seconds"))
        start_alerts(candidates, log, checkpoint).awaitTermination()
    return fired_alerts(spark.read.parquet(log))


# --- sinks


@query(
    "B1_write_csv",
    f"""SELECT k::varchar AS k, ClientName, strftime(ProjectStartDate, '%d/%m/%Y') AS ProjectStartDate,
        TenderValue::varchar AS TenderValue FROM ({TYPED})""",
)
def b1(spark, d):
    path = scratch_path(spark, "b1")
    tenders = adapted(spark, d, TENDERS).select("k", "ClientName", "ProjectStartDate", "TenderValue")
    write_csv(tenders, path, delimiter="|", date_format="dd/MM/yyyy")
    return read_csv(spark, path, delimiter="|", lineage=False)


@query("B2_write_parquet", f"SELECT k, TenderID, TenderValue::double AS TenderValue, ProjectEndDate FROM ({TYPED})")
def b2(spark, d):
    path = scratch_path(spark, "b2")
    write_parquet(adapted(spark, d, TENDERS).select("k", "TenderID", "TenderValue", "ProjectEndDate"), path, "zstd")
    return spark.read.parquet(path)


@query("B3_write_json", "SELECT event_id, ts, event_type, value, props FROM events")
def b3(spark, d):
    path = scratch_path(spark, "b3")
    events = table(spark, d, "events").select("event_id", "ts", "event_type", "value", "props")
    write_json(events, path)
    return spark.read.schema(events.schema).json(path)


@query(
    "B4_write_formats",
    " UNION ALL ".join(f"SELECT '{f}' AS format, c_custkey::varchar AS c_custkey, c_name FROM customer" for f in _FORMATS[:3]),
)
def b4(spark, d):
    saved = write_formats(table(spark, d, "customer").select("c_custkey", "c_name"), scratch_path(spark, "b4"), ["csv", "json", "parquet", "other"])
    read = None
    for fmt, path in saved.items():
        rows = read_any(spark, path).select(F.lit(fmt).alias("format"), F.col("c_custkey").cast("string").alias("c_custkey"), "c_name")
        read = rows if read is None else read.unionByName(rows)
    return read


@query(
    "B5_write_tables",
    """SELECT 'parts' AS name, count(*) AS rows, count(*) AS written FROM part
        UNION ALL SELECT 'suppliers', count(*), count(*) FROM supplier""",
)
def b5(spark, d):
    path = scratch_path(spark, "b5")
    written = write_tables({"parts": table(spark, d, "part"), "suppliers": table(spark, d, "supplier")}, path)
    counts = None
    for name, n in written.items():
        rows = spark.read.parquet(f"{path}/{name}").agg(F.count("*").alias("rows"))
        rows = rows.select(F.lit(name).alias("name"), "rows", F.lit(n).alias("written"))
        counts = rows if counts is None else counts.unionByName(rows)
    return counts


# --- recipes and folders


def _step(name: str, kind: str, config: dict, *depends_on: str, optional: bool = False) -> dict:
    return {"name": name, "type": kind, "config": config, "depends_on": list(depends_on), "optional": optional}


@query(
    "L1_run_recipe",
    f"""SELECT TenderID, TenderStatus, TenderValue, ReportingValue, months AS ProjectDurationMonths, MonthlySpread,
        WeightedMonthlySpread, HasMissingDates, MissingDateFields, IsActive, IsWon, IsLost, ValueTier
        FROM ({CLEAN_ENRICHED})""",
)
def l1(spark, d):
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "fact")
    write_csv(adapted(spark, d, TENDERS_RAW).select(*RAW_COLUMNS), landing)

    run_recipe(
        spark,
        {
            "name": "tenders",
            "transforms": [
                _step("extract_raw", "extract", {"extractor": "csv", "file_path": landing}),
                _step("validate_schema", "transform", {"transform": "validate"}, "extract_raw"),
                _step("clean_data", "transform", {"transform": "clean_tender"}, "validate_schema"),
                _step("calculate_spreads", "transform", {"transform": "calculate_spreads"}, "clean_data"),
                _step("add_fields", "transform", {"transform": "add_calculated_fields"}, "calculate_spreads"),
                _step("load_fact", "load", {"loader": "parquet", "output_path": out}, "add_fields"),
            ],
        },
    )
    return spark.read.parquet(out).select(
        "TenderID", "TenderStatus", "TenderValue", "ReportingValue", "ProjectDurationMonths", "MonthlySpread",
        "WeightedMonthlySpread", "HasMissingDates", "MissingDateFields", "IsActive", "IsWon", "IsLost", "ValueTier",
    )


@query(
    "L2_transform_by_name",
    f"SELECT o_orderkey, {sql_periods('o_orderdate', 10)} FROM orders",
)
def l2(spark, d):
    out = scratch_path(spark, "periods")
    periods = {"transform": "add_financial_periods", "date_column": "o_orderdate", "fiscal_year_start_month": 10}
    steps = [
        _step("raw", "extract", {"extractor": "file", "file_path": f"{d}/orders.parquet"}),
        _step("periods", "transform", periods, "raw"),
        _step("load", "load", {"loader": "parquet", "output_path": out}, "periods"),
    ]
    run_recipe(spark, {"name": "periods", "transforms": steps})
    return spark.read.parquet(out).select("o_orderkey", *CALENDAR, *FISCAL, *LABELS)


@query(
    "L2_validate_ledger",
    f"{LEDGER_STATUS} SELECT TransactionID, AmountLocal::double AS AmountLocal FROM checked WHERE status = 'valid'",
)
def l2_ledger(spark, d):
    """A ledger checked by its own contract; only good rows go on."""
    landing, out = scratch_path(spark, "ledger"), scratch_path(spark, "valid")
    write_parquet(adapted(spark, d, TRANSACTIONS), f"{landing}.parquet")
    steps = [
        _step("raw", "extract", {"extractor": "file", "file_path": f"{landing}.parquet"}),
        _step("check", "transform", {"transform": "validate", "contract": "transaction", "mode": "split"}, "raw"),
        _step("load", "load", {"loader": "parquet", "output_path": out}, "check"),
    ]
    run_recipe(spark, {"name": "ledger", "transforms": steps})
    return spark.read.parquet(out).select("TransactionID", "AmountLocal")


@query(
    "L3_custom_step",
    "SELECT o_orderpriority, count(*) AS orders, sum(o_totalprice::decimal(18,2))::double AS value FROM orders GROUP BY 1",
)
def l3(spark, d):
    def by_priority(frames, config):
        value = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("value")
        return frames["raw"].groupBy(config["by"]).agg(F.count("*").alias("orders"), value)

    out = scratch_path(spark, "priorities")
    steps = [
        _step("raw", "extract", {"extractor": "file", "file_path": f"{d}/orders.parquet"}),
        _step("grouped", "aggregate", {"by": "o_orderpriority"}, "raw"),
        _step("load", "load", {"loader": "parquet", "output_path": out}, "grouped"),
    ]
    run_recipe(spark, {"name": "priorities", "transforms": steps}, custom={"aggregate": by_priority})
    return spark.read.parquet(out)


@query(
    "L4_optional_step",
    "SELECT 'partial' AS status, 'upload' AS failed, c_mktsegment, count(*) AS customers FROM customer GROUP BY ALL",
)
def l4(spark, d):
    out = scratch_path(spark, "customers")
    steps = [
        _step("raw", "extract", {"extractor": "file", "file_path": f"{d}/customer.parquet"}),
        _step("upload", "load", {"loader": "carrier pigeon", "output_path": out}, "raw", optional=True),
        _step("load", "load", {"loader": "json", "output_path": out}, "raw"),
    ]
    run = run_recipe(spark, {"name": "customers", "transforms": steps})
    counts = spark.read.json(out).groupBy("c_mktsegment").agg(F.count("*").alias("customers"))
    return counts.withColumns({"status": F.lit(run.status), "failed": F.lit(",".join(run.steps_failed))})


@query(
    "L6_run_counters",
    """SELECT (SELECT count(*) FROM supplier) + (SELECT count(*) FROM part) AS records_processed,
        (SELECT count(*) FROM supplier) + 2 * (SELECT count(*) FROM part) AS records_loaded""",
)
def l6(spark, d):
    out = scratch_path(spark, "counted")
    steps = [
        _step("parts", "extract", {"extractor": "file", "file_path": f"{d}/part.parquet"}),
        _step("suppliers", "extract", {"extractor": "file", "file_path": f"{d}/supplier.parquet"}),
        _step("a", "load", {"loader": "parquet", "output_path": f"{out}/a"}, "parts"),
        _step("b", "load", {"loader": "csv", "output_path": f"{out}/b"}, "parts"),
        _step("c", "load", {"loader": "json", "output_path": f"{out}/c"}, "suppliers"),
    ]
    run = run_recipe(spark, {"name": "counted", "transforms": steps})
    counters = [(run.metrics["records_processed"], run.metrics["records_loaded"])]
    return spark.createDataFrame(counters, "records_processed bigint, records_loaded bigint")


@query(
    "P6_sanitize_dir",
    f"""SELECT 'documents' AS name, doc_id AS id, {sql_redacted("text")} AS text FROM documents
        UNION ALL SELECT 'customers', c_custkey, c_name || chr(10) || c_mktsegment FROM customer
        UNION ALL SELECT 'notes', NULL, s_name FROM supplier""",
)
def p6(spark, d):
    """A table, below it a CSV whose values hold line breaks, and files of another kind."""
    source, target = scratch_path(spark, "outputs"), scratch_path(spark, "sanitized")
    documents = table(spark, d, "documents").select("doc_id", "text", F.col("source").alias("email"))
    write_parquet(documents, f"{source}/documents.parquet")
    lines = F.concat_ws("\n", "c_name", "c_mktsegment").alias("lines")
    customers = table(spark, d, "customer").select("c_custkey", lines, F.col("c_mktsegment").alias("api_key"))
    write_csv(customers, f"{source}/crm/customers.csv")
    table(spark, d, "supplier").select("s_name").write.text(f"{source}/crm/notes.txt")
    sanitize_dir(spark, source, target)
    clean = spark.read.parquet(f"{target}/documents.parquet").select(F.lit("documents").alias("name"), F.col("doc_id").alias("id"), "text")
    rows = read_csv(spark, f"{target}/crm/customers.csv", lineage=False, multi_line=True)
    notes = spark.read.text(f"{target}/crm/notes.txt")
    return (
        clean.unionByName(rows.select(F.lit("customers").alias("name"), F.col("c_custkey").cast("bigint").alias("id"), F.col("lines").alias("text")))
        .unionByName(notes.select(F.lit("notes").alias("name"), F.lit(None).cast("bigint").alias("id"), F.col("value").alias("text")))
    )
