from __future__ import annotations

import datetime as dt
import json
import zipfile
from decimal import Decimal
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tabprep.plans.recipe import check_steps, load_config, run_recipe
from tabprep.scratch import drop_scratch, materialize, scratch_dir
from tabprep.sinks.database import jdbc_options, write_jdbc
from tabprep.sinks.files import (
    append_log,
    read_log,
    write_csv,
    write_formats,
    write_json,
    write_parquet,
    write_tables,
)
from tabprep.sinks.sanitize import sanitize_dir
from tabprep.sinks.workbook import write_excel
from tabprep.contracts import METRIC
from tabprep.sources.database import bind, read_query, table_info
from tabprep.sources.files import add_lineage, normalize_headers, read_any, read_csv
from tabprep.sources.incremental import read_incremental
from tabprep.sources import synthetic
from tabprep.sources.odata import count_odata_rows, read_odata_pages, read_odata_rows
from tabprep.sources.synthetic import gen_opportunities, gen_tenders, gen_transactions
from tabprep.sources.workbook import read_excel
from tabprep.streaming.alerts import fired_alerts, start_alerts
from tabprep.streaming.incremental import compact, current_rows, retire, snapshot, start_incremental

NOON = dt.datetime(2024, 1, 1, 12, 0, 0, 123456)


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- sources


def test_read_csv(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text(' id ;Code;When\n1;0042;15/01/2025\n2;"x;""y""";TBC\n', encoding="utf-8")
    df = read_csv(spark, str(file), delimiter=";", dtypes={"id": "int"}, parse_dates=["When"])
    first, second = df.orderBy("id").collect()
    assert (first.id, first.Code, first.When) == (1, "0042", dt.datetime(2025, 1, 15))
    assert (second.Code, second.When, second._source_file) == ('x;"y"', None, "a.csv")
    assert first._extracted_at == second._extracted_at


def test_read_csv_encoding_and_schema(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_bytes("id,name\n1,café\n".encode("latin-1"))
    df = read_csv(spark, str(file), "id int, name string", encoding="latin1", lineage=False)
    assert as_set(df) == [(1, "café")]


def test_headers_and_lineage(spark, tmp_path):
    assert normalize_headers(spark.range(1).toDF(" a\t")).columns == ["a"]
    write_parquet(spark.range(3), str(tmp_path / "p"))
    assert add_lineage(spark.read.parquet(str(tmp_path / "p"))).where("_source_file like 'part-%'").count() == 3


def page(n, *rows):
    return {"value": [{"opportunityid": r, "statecode": i, "statuscode": "Open"} for i, r in enumerate(rows)], "@odata.nextLink": f"?{n}"}


@pytest.mark.parametrize("multi_line", [True, False])
def test_odata_pages(spark, tmp_path, multi_line):
    for n, rows in enumerate([("c", "a"), ("b", "d")]):
        text = json.dumps(page(n, *rows), indent=2 if multi_line else None)
        (tmp_path / f"{n}.json").write_text(text)
    (tmp_path / "9.json").write_text('{"value": []}')
    read = read_odata_pages(spark, str(tmp_path), select=["opportunityid"], top=3, multi_line=multi_line)
    assert [r.opportunityid for r in read.collect()] == ["a", "b", "c"]
    rows = read_odata_rows(spark, str(tmp_path), filter="statecode = 0", multi_line=multi_line)
    assert sorted(r.opportunityid for r in rows.collect()) == ["b", "c"] and count_odata_rows(rows).first()["count"] == 2
    assert read_odata_pages(spark, str(tmp_path), top=None, multi_line=multi_line).count() == 4


def test_read_any(spark, tmp_path):
    df = spark.createDataFrame([("1", "x"), ("2", "y")], "a string, b string")
    saved = write_formats(df, str(tmp_path / "t"), ["parquet", "csv", "json", "excel"])
    assert saved["excel"].endswith("t.xlsx")
    for fmt in ("parquet", "csv", "json", "xlsx"):
        assert as_set(read_any(spark, str(tmp_path / f"t.{fmt}"))) == [("1", "x"), ("2", "y")]
    (tmp_path / "array.json").write_text('[{"a": 1}, {"a": 2}]')
    assert read_any(spark, str(tmp_path / "array.json")).count() == 2
    (tmp_path / "pretty.json").write_text(json.dumps([{"a": 1}, {"a": 2}], indent=2))
    assert read_any(spark, str(tmp_path / "pretty.json"), multi_line=True).count() == 2
    with pytest.raises(ValueError, match="unsupported"):
        read_any(spark, str(tmp_path / "t.docx"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_any(spark, str(tmp_path / "none.parquet"))


def test_queries(spark):
    spark.range(5).createOrReplaceTempView("numbers")
    assert read_query(spark, "SELECT * FROM numbers WHERE id > :low", {"low": 2}).count() == 2
    with pytest.raises(Exception):
        read_query(spark, "SELECT * FROM no_such_table").collect()
    sql = "SELECT a::int, ':x' FROM t WHERE b = :name AND c > :n AND d = :day AND e IS :none"
    params = {"name": "O'Neil", "n": 1.5, "day": dt.date(2025, 1, 2), "none": None}
    assert bind(sql, params) == (
        "SELECT a::int, ':x' FROM t WHERE b = 'O''Neil' AND c > 1.5 AND d = DATE '2025-01-02' AND e IS NULL"
    )
    with pytest.raises(KeyError):
        bind("SELECT :missing", {})


def test_table_info(spark):
    spark.createDataFrame([(1, "x")], "a int not null, b string").createOrReplaceTempView("described")
    assert as_set(table_info(spark, "described")) == [(0, "a", "int", False), (1, "b", "string", True)]


def test_incremental(spark):
    df = spark.createDataFrame([(i, f"2025-01-0{i}") for i in range(1, 6)], "id int, modifiedon string")
    rows, watermark = read_incremental(df, "2025-01-03")
    assert sorted(r.id for r in rows.collect()) == [4, 5] and watermark.first().watermark == "2025-01-05"
    rows, watermark = read_incremental(df, "2025-02-01")
    assert rows.isEmpty() and watermark.first().watermark == "2025-02-01"
    assert read_incremental(df).rows.count() == 5


# --- workbooks


def test_workbook_round_trip(spark, tmp_path):
    rows = [(i, f"<n&{i}>", dt.date(2025, 1, 1 + i), dt.datetime(2025, 1, 1, 10, 30), Decimal("1.50"), i % 2 == 0, None) for i in range(9)]
    df = spark.createDataFrame(rows, "i int, `name ` string, d date, t timestamp_ntz, m decimal(9,2), b boolean, e string")
    assert write_excel(df.repartition(2), str(tmp_path / "x"), "Data & more", rows_per_workbook=3) == 9
    files = sorted(p.name for p in (tmp_path / "x").iterdir())
    assert len(files) >= 3 and all(f.endswith(".xlsx") for f in files)
    read = read_excel(spark, str(tmp_path / "x"), "Data & more", dtypes={"i": "int", "m": "decimal", "b": "bool"}, parse_dates=["d", "t"])
    assert read.columns == ["i", "name", "d", "t", "m", "b", "e", "_source_file", "_extracted_at"]
    r = read.where("i = 3").first()
    assert (r.name, r.d, r.t, r.m, r.b, r.e) == ("<n&3>", dt.datetime(2025, 1, 4), dt.datetime(2025, 1, 1, 10, 30), Decimal("1.5"), False, None)
    assert read.count() == 9 and r._source_file in files


SHEET = """<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>
<row r="1"><c r="A1" t="s"><v>0</v></c></row>
<row r="3"><c r="A3" t="s"><v>1</v></c><c r="C3" t="s"><v>1</v></c><c r="D3" t="inlineStr"><is><t> Day </t></is></c></row>
<row r="4"><c r="A4"><v>1</v></c><c r="B4" t="str"><v>text</v></c><c r="D4" s="1"><v>45672</v></c></row>
<row r="6"><c r="A6" t="b"><v>1</v></c><c r="C6" t="e"><v>#N/A</v></c><c r="D6" s="2"><v>45672.5</v></c></row>
</sheetData></worksheet>"""
MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def foreign_workbook(path):
    """As other programs write them: shared strings, a title, gaps, custom date formats."""
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(
            "xl/workbook.xml",
            f'<workbook {MAIN} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>'
            '<sheet name="Cover" sheetId="1" r:id="a"/><sheet name="Data" sheetId="2" r:id="b"/></sheets></workbook>',
        )
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="a" Target="worksheets/sheet1.xml"/><Relationship Id="b" Target="/xl/worksheets/sheet2.xml"/></Relationships>',
        )
        z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}><si><t>Title</t></si><si><r><t>I</t></r><r><t>D</t></r></si></sst>")
        z.writestr(
            "xl/styles.xml",
            f'<styleSheet {MAIN}><numFmts><numFmt numFmtId="170" formatCode="[$-409]d\\ mmm"/></numFmts>'
            '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/></cellXfs></styleSheet>',
        )
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {MAIN}><sheetData/></worksheet>")
        z.writestr("xl/worksheets/sheet2.xml", SHEET)


def test_foreign_workbook(spark, tmp_path):
    foreign_workbook(tmp_path / "f.xlsx")
    # Rows are numbered with the blank ones: the header is the third.
    df = read_excel(spark, str(tmp_path / "f.xlsx"), "Data", header_row=2, lineage=False)
    assert df.columns == ["ID", "Unnamed: 1", "ID.1", "Day"]
    assert as_set(df) == sorted(
        [("1", "text", None, "2025-01-15"), (None, None, None, None), ("true", None, None, "2025-01-15 12:00:00")], key=repr
    )
    skipped = read_excel(spark, str(tmp_path / "f.xlsx"), 1, header_row=0, skip_rows=[0, 1, 4], lineage=False)
    assert skipped.count() == 2
    assert read_excel(spark, str(tmp_path / "f.xlsx"), 0, columns=["a"], lineage=False).count() == 0
    with pytest.raises(Exception, match="no sheet"):
        read_excel(spark, str(tmp_path / "f.xlsx"), "Other")


# --- synthetic tables


def test_generators(spark):
    tenders = gen_tenders(spark, 2000)
    assert tenders.count() == 2000 and tenders.select("TenderID").distinct().count() == 2000
    assert as_set(tenders.limit(0).union(gen_tenders(spark, 50))) == as_set(gen_tenders(spark.newSession(), 50).repartition(3))
    assert as_set(gen_tenders(spark, 50, seed=1)) != as_set(gen_tenders(spark, 50, seed=2))
    undated = tenders.where("TenderReceivedDate is null").count() / 2000
    unforecast = tenders.where("MonthlyForecast is null").count() / 2000
    assert 0.12 < undated < 0.18 and 0.26 < unforecast < 0.34
    assert tenders.where("WeightedValue != TenderValue * ProbabilityPercentage or ProjectEndDate <= ProjectStartDate").isEmpty()
    counts = [r["count"] for r in tenders.groupBy("BusinessDivision").count().collect()]
    assert len(counts) == 5 and min(counts) > 300
    assert tenders.groupBy("BusinessDivision", "TenderStatus").count().count() == 35


def test_ledger_generator(spark):
    ledger = gen_transactions(spark, 2000)
    assert ledger.count() == 2000 and ledger.select("AccountCode").distinct().count() == len(synthetic.ACCOUNTS)
    assert ledger.select("CostCenter").distinct().count() == 3 * len(synthetic.DEPARTMENTS)
    low, high = synthetic.AMOUNT_RANGES["OpEx"]
    odd = f"substr(CostCenter, 4, 3) != upper(substr(Department, 1, 3)) or (AccountType = 'OpEx' and AmountLocal not between {low} and {high})"
    assert ledger.where(odd).isEmpty()
    odd = "(statuscode = 'Won') != (probability = 100) or (actualclosedate is null) != (statecode = 0)"
    assert gen_opportunities(spark, 500).where(odd).isEmpty()


# --- sinks


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, ' a "q", b ', dt.date(2025, 1, 2), NOON), (2, None, None, None)], "i int, s string, d date, t timestamp_ntz")
    assert write_csv(df, str(tmp_path / "c"), delimiter=";", date_format="dd.MM.yyyy") == 2
    read = read_csv(spark, str(tmp_path / "c"), delimiter=";", lineage=False)
    assert as_set(read) == [("1", ' a "q", b ', "02.01.2025", "01.01.2024"), ("2", None, None, None)]


def test_json_keeps_microseconds(spark, tmp_path):
    df = spark.createDataFrame([(1, NOON)], "i int, t timestamp_ntz")
    assert write_json(df, str(tmp_path / "j")) == 1
    assert as_set(spark.read.schema(df.schema).json(str(tmp_path / "j"))) == [(1, NOON)]


def test_formats_and_tables(spark, tmp_path, caplog):
    df = spark.range(4)
    assert list(write_formats(df, str(tmp_path / "t"), ["csv", "xml", "json"])) == ["csv", "json"]
    assert "xml" in caplog.text
    assert write_formats(df, str(tmp_path / "u")) == {"parquet": f"{tmp_path}/u.parquet"}
    assert write_tables({"a": df, "b": df.limit(1)}, str(tmp_path / "many")) == {"a": 4, "b": 1}


def test_log_appends(spark, tmp_path):
    events = spark.createDataFrame([("m", 1.0, NOON, {"pipeline": "p"}, "s")], METRIC)
    for _ in range(2):
        append_log(events, str(tmp_path / "log"))
    assert as_set(read_log(spark, str(tmp_path / "log"), METRIC)) == [("m", 1.0, NOON, {"pipeline": "p"}, "s")] * 2


def test_jdbc_settings(spark):
    options = jdbc_options("jdbc:x", "t", "staging", 500, {"user": "u"})
    assert options == {"user": "u", "url": "jdbc:x", "dbtable": "staging.t", "batchsize": "500"}
    with pytest.raises(ValueError):
        write_jdbc(spark.range(1), "jdbc:x", "t", if_exists="merge")


def test_sanitize_dir(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    df = spark.createDataFrame([(1, "a@b.co", "x")], "id int, note string, api_key string")
    write_parquet(df, f"{source}/t.parquet")
    write_csv(df, f"{source}/t.csv")
    write_excel(df, f"{source}/t.xlsx")
    (source / "s.yaml").write_text("password:\n  hunter2\nname: x\n")
    (source / "readme.md").write_text("x")
    (source / "sub/deep dir").mkdir(parents=True)
    write_parquet(df, f"{source}/sub/deep dir/n.parquet")
    write_csv(spark.createDataFrame([("two\nlines, a@b.co", "x")], "note string, email string"), f"{source}/sub/lines.csv")
    (source / "sub/notes.txt").write_text("kept as it is\n")
    (source / "sub/s.yaml").write_text("token: abc\n")
    done = sanitize_dir(spark, str(source), str(target))
    assert done == {
        "t.parquet": "parquet", "t.csv": "csv", "t.xlsx": "xlsx", "s.yaml": "settings", "readme.md": "copied",
        "sub/deep dir/n.parquet": "parquet", "sub/lines.csv": "csv", "sub/notes.txt": "copied", "sub/s.yaml": "settings",
    }
    assert as_set(spark.read.parquet(f"{target}/t.parquet")) == [(1, "[EMAIL REDACTED]")]
    assert as_set(read_any(spark, f"{target}/t.xlsx")) == [("1", "[EMAIL REDACTED]")]
    assert "".join(p.read_text() for p in (target / "s.yaml").glob("part-*")) == "password: [REDACTED]\nname: x\n"
    assert as_set(spark.read.parquet(f"{target}/sub/deep dir/n.parquet")) == [(1, "[EMAIL REDACTED]")]
    assert as_set(read_any(spark, f"{target}/sub/lines.csv", multi_line=True)) == [("two\nlines, [EMAIL REDACTED]",)]
    assert (target / "sub/notes.txt").read_text() == "kept as it is\n" and (target / "readme.md").read_text() == "x"
    assert "".join(p.read_text() for p in (target / "sub/s.yaml").glob("part-*")) == "token: [REDACTED]\n"
    assert not (target / "_settings").exists()


def test_sanitize_dir_with_equal_names(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    texts = {"settings.json": "a: 1\n", "conf/settings.json": "b: 2\n", "conf/x y/settings.json": "c: 3\n", "zz/conf/settings.json": "d: 4\n", "zz/in/settings.json": "e: 5\n"}
    for name, text in texts.items():
        (source / name).parent.mkdir(parents=True, exist_ok=True)
        (source / name).write_text(text)
    assert sanitize_dir(spark, str(source), str(target)) == dict.fromkeys(sorted(texts), "settings")
    assert {n: "".join(p.read_text() for p in (target / n).glob("part-*")) for n in texts} == texts


def test_sanitize_dir_of_many_small_tables(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    expected = {}
    for i in range(30):
        email, folder = f"a{i}@b.co", source / f"d{i % 3} x"
        folder.mkdir(parents=True, exist_ok=True)
        rows = [] if i % 10 == 7 else [(i, email), (None, f"{i} \n kept")]
        columns = {"n": [r[0] for r in rows], "note": [r[1] for r in rows], "_unit": ["u"] * len(rows)}
        pq.write_table(pa.table(columns, pa.schema([("n", pa.int64()), ("note", pa.string()), ("_unit", pa.string())])), folder / f"p{i}.parquet")
        header = "n,note,email" if i % 2 else "note,n"
        (folder / f"c{i}.csv").write_text(header + "\n" + "".join(f'{i},"x\ny {email}",e\n' if i % 2 else f'"x\ny {email}",{i}\n' for _ in rows[:1]))
        (folder / f"blob{i}.bin").write_bytes(bytes(range(256)) * i)
        (folder / f"empty{i}.csv").touch()
        expected[f"d{i % 3} x/p{i}.parquet"] = [(r[0], "[EMAIL REDACTED]" if r[1] == email else r[1], "u") for r in rows]
    tracker, group = spark.sparkContext.statusTracker(), "many small tables"
    spark.sparkContext.setJobGroup(group, group)
    done = sanitize_dir(spark, str(source), str(target))
    jobs = tracker.getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("", "")
    assert len(done) == 120 and len(jobs) <= 30
    for name, rows in expected.items():
        assert as_set(spark.read.parquet(f"{target}/{name}")) == sorted(rows, key=repr)
    for i in range(30):
        place = f"d{i % 3} x"
        read = read_any(spark, f"{target}/{place}/c{i}.csv", multi_line=True)
        assert read.columns == (["n", "note"] if i % 2 else ["note", "n"])
        wanted = {"n": str(i), "note": "x\ny [EMAIL REDACTED]"}
        assert [r.asDict() for r in read.collect()] == ([] if i % 10 == 7 else [wanted])
        assert (target / place / f"blob{i}.bin").read_bytes() == bytes(range(256)) * i
        assert (target / place / f"empty{i}.csv").stat().st_size == 0
    assert sorted(p.name for p in target.iterdir()) == ["d0 x", "d1 x", "d2 x"]


def test_workbooks_are_replaced(spark, tmp_path):
    path = str(tmp_path / "book.xlsx")
    assert write_excel(spark.range(100).repartition(4), path) == 100
    (tmp_path / "book.xlsx/part-00009.xlsx.1.tmp").write_text("left behind")
    assert write_excel(spark.range(10).repartition(1), f"file://{path}") == 10
    assert read_any(spark, path).count() == 10 and not list((tmp_path / "book.xlsx").glob("_temporary*"))
    broken = spark.range(5).selectExpr("raise_error('no') AS x")
    with pytest.raises(Exception, match="no"):
        write_excel(broken, path)
    assert read_any(spark, path).count() == 10 and not list((tmp_path / "book.xlsx").glob("_temporary*"))


def test_workbook_keeps_odd_characters(spark, tmp_path):
    texts = ["a\x00b\x0b", "line\r\nbreak", "_x000D_", "_x00", "\ufffe", " é "]
    write_excel(spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1), str(tmp_path / "o.xlsx"))
    assert sorted(r.t for r in read_any(spark, str(tmp_path / "o.xlsx")).collect()) == sorted(texts)


def test_recipe_validates_by_contract(spark, tmp_path):
    write_csv(gen_transactions(spark, 5), str(tmp_path / "ledger.csv"))
    steps = [
        {"name": "raw", "type": "extract", "config": {"extractor": "csv", "file_path": str(tmp_path / "ledger.csv")}},
        {"name": "check", "type": "transform", "config": {"transform": "validate", "contract": "transaction", "mode": "split"}, "depends_on": ["raw"]},
    ]
    run = run_recipe(spark, {"transforms": steps})
    assert run.frames["check"].count() == 5 and run.summaries["check"].first().valid_records == 5
    steps[1]["config"]["contract"] = "other"
    with pytest.raises(ValueError, match="unknown contract"):
        run_recipe(spark, {"transforms": steps})


def test_scratch(spark):
    df = materialize(spark.range(3))
    assert scratch_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir")) and df.count() == 3


@pytest.mark.parametrize("master", ["local[2]", "spark://host:7077"])
def test_scratch_without_a_folder(master):
    context = SimpleNamespace(master=master, applicationId=f"app-{master}")
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)
    if master.startswith("local"):
        assert scratch_dir(session) == scratch_dir(session)
    else:
        with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
            scratch_dir(session)


# --- recipes

STEPS = [
    {"name": "load", "type": "load", "config": {"loader": "parquet"}, "depends_on": ["fields"]},
    {"name": "raw", "type": "extract", "config": {"extractor": "excel"}},
    {"name": "check", "type": "transform", "config": {"transform": "validate"}, "depends_on": ["raw"]},
    {"name": "clean", "type": "transform", "config": {"transform": "clean_tender"}, "depends_on": ["check"]},
    {"name": "spread", "type": "transform", "config": {"transform": "calculate_spreads"}, "depends_on": ["clean"]},
    {"name": "fields", "type": "transform", "config": {"transform": "add_calculated_fields", "source_type": "tender"}, "depends_on": ["spread"]},
]
COMPUTED = ["ProjectDurationMonths", "MonthlySpread", "QuarterlySpread", "WeightedMonthlySpread", "HasMissingDates", "IsActive", "IsWon", "ValueTier"]


def recipe(spark, tmp_path, n=20, **extra):
    write_excel(gen_tenders(spark, n), str(tmp_path / "in.xlsx"))
    steps = json.loads(json.dumps(STEPS))
    steps[0]["config"]["output_path"] = str(tmp_path / "out")
    steps[1]["config"]["file_path"] = str(tmp_path / "in.xlsx")
    return {"name": "r", "transforms": steps + extra.pop("more", []), **extra}


def test_recipe(spark, tmp_path):
    run = run_recipe(spark, recipe(spark, tmp_path))
    assert (run.status, len(run.steps_completed), run.errors) == ("success", 6, [])
    assert (run.metrics["records_processed"], run.metrics["records_loaded"]) == (20, 20)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert set(COMPUTED) <= set(out.columns) and out.count() == 20
    assert run.summaries["check"].first().valid_records == 20


def test_recipe_flags_missing_dates(spark, tmp_path):
    def blank(frames, config):
        start = F.when(F.col("TenderID").endswith("1"), F.lit(None)).otherwise(F.col("ProjectStartDate"))
        return frames["check"].withColumn("ProjectStartDate", start)

    config = recipe(spark, tmp_path, 10, more=[{"name": "blank", "type": "custom", "depends_on": ["check"]}])
    config["transforms"][3]["depends_on"] = ["blank"]
    run = run_recipe(spark, config, custom={"custom": blank})
    assert spark.read.parquet(str(tmp_path / "out")).where("HasMissingDates").count() >= 1 and run.status == "success"


def test_optional_steps(spark, tmp_path):
    database = {"name": "db", "type": "load", "optional": True, "depends_on": ["fields"], "config": {"loader": "database", "table": "t"}}
    run = run_recipe(spark, recipe(spark, tmp_path, more=[database]))
    assert (run.status, run.steps_failed) == ("partial", ["db"]) and run.metrics["records_loaded"] == 20
    del database["optional"]
    with pytest.raises(KeyError):
        run_recipe(spark, recipe(spark, tmp_path, more=[database]))


def test_dry_run_writes_nothing(spark, tmp_path):
    run = run_recipe(spark, recipe(spark, tmp_path), dry_run=True)
    assert len(run.steps_completed) == 6 and not (tmp_path / "out").exists()
    assert set(COMPUTED) <= set(run.frames["fields"].columns)


def test_split_and_two_sinks(spark, tmp_path):
    bad = gen_tenders(spark, 10).withColumn("ClientName", F.when(~F.col("TenderID").endswith("3"), F.col("ClientName")))
    write_csv(bad, str(tmp_path / "in"))
    config = {
        "transforms": [
            {"name": "raw", "type": "extract", "config": {"extractor": "csv", "file_path": str(tmp_path / "in")}},
            {"name": "ok", "depends_on": ["raw"], "config": {"transform": "validate", "mode": "split", "quarantine_path": str(tmp_path / "q")}},
            {"name": "a", "type": "load", "depends_on": ["ok"], "config": {"loader": "csv", "output_path": str(tmp_path / "a")}},
            {"name": "b", "type": "load", "depends_on": ["ok"], "config": {"loader": "json", "output_path": str(tmp_path / "b")}},
        ]
    }
    run = run_recipe(spark, config)
    assert run.metrics["records_loaded"] == 18 and spark.read.parquet(str(tmp_path / "q")).count() == 1


def test_dependency_checks(spark):
    def step(name, *deps):
        return {"name": name, "type": "transform", "depends_on": list(deps), "config": {}}

    assert check_steps([step("a"), step("b", "a")]) == []
    assert check_steps([step("a", "zz")]) == ["a: unknown dependency zz"]
    assert check_steps([step("a"), step("b", "c"), step("c", "b")]) == ["cannot resolve dependencies of: b, c"]
    with pytest.raises(ValueError, match="unknown dependency"):
        run_recipe(spark, {"transforms": [step("a", "zz")]})


@pytest.mark.parametrize("kind, config", [("transform", {"transform": "shuffle"}), ("other", {}), ("extract", {"extractor": "ftp", "file_path": "x"})])
def test_unknown_names_are_errors(spark, tmp_path, kind, config):
    write_parquet(spark.range(1), str(tmp_path / "t.parquet"))
    first = {"name": "raw", "type": "extract", "config": {"extractor": "file", "file_path": str(tmp_path / "t.parquet")}}
    with pytest.raises(ValueError, match="unknown"):
        run_recipe(spark, {"transforms": [first, {"name": "x", "type": kind, "depends_on": ["raw"], "config": config}]})


def test_yaml(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "r.yaml").write_text("name: r\ntransforms:\n  - name: a\n    type: extract\n    config: {extractor: csv}\n")
    assert load_config(str(tmp_path / "r.yaml"))["transforms"][0]["config"]["extractor"] == "csv"


# --- streams


def test_stream_incremental(spark, tmp_path):
    landing, log, checkpoint = (str(tmp_path / n) for n in ("landing", "log", "checkpoint"))
    schema = "id string, v int, modifiedon string"

    def land(*rows):
        spark.createDataFrame(rows, schema).write.mode("append").json(landing)

    def load():
        start_incremental(spark, landing, schema, log, checkpoint, ["id"], max_files=1).awaitTermination()
        return as_set(current_rows(spark, log, ["id"]))

    land(("a", 1, "2025-01-01"), ("b", 1, "2025-01-01"), ("a", 2, "2025-01-02"))
    assert load() == [("a", 2, "2025-01-02"), ("b", 1, "2025-01-01")]
    # An older version that arrives late does not win.
    land(("b", 9, "2024-12-01"), ("a", 3, "2025-01-03"), ("c", 1, "2025-01-03"))
    expected = [("a", 3, "2025-01-03"), ("b", 1, "2025-01-01"), ("c", 1, "2025-01-03")]
    assert load() == expected and load() == expected
    compact(spark, log, ["id"], str(tmp_path / "table"))
    assert as_set(spark.read.parquet(str(tmp_path / "table"))) == expected


def test_snapshots_of_a_live_log(spark, tmp_path):
    landing, log, checkpoint = (str(tmp_path / n) for n in ("landing", "log", "checkpoint"))
    schema = "id string, v int, modifiedon string"
    read = lambda: as_set(current_rows(spark, log, ["id"]))

    def load(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(landing)
        start_incremental(spark, landing, schema, log, checkpoint, ["id"]).awaitTermination()

    assert snapshot(spark, log, ["id"]) is None
    load(("a", 1, "2025-01-01"), ("b", 1, "2025-01-01"), (None, 7, "2025-01-01"))
    load(("a", 2, "2025-01-02"))
    assert snapshot(spark, log, ["id"]) == snapshot(spark, log, ["id"]) == 1
    expected = [("a", 2, "2025-01-02"), ("b", 1, "2025-01-01"), (None, 7, "2025-01-01")]
    assert read() == expected
    # Batches after the snapshot; one that is not finished; an older row and one of equal time.
    load(("b", 2, "2024-01-01"), ("a", 3, "2025-01-02"), ("c", 1, None))
    unfinished = tmp_path / "log/batch_id=3"
    spark.createDataFrame([("a", 9, "2026-01-01")], schema).write.parquet(str(unfinished))
    (unfinished / "_SUCCESS").unlink()
    expected = [("a", 3, "2025-01-02"), ("b", 1, "2025-01-01"), ("c", 1, None), (None, 7, "2025-01-01")]
    assert read() == expected
    retire(spark, log)
    assert sorted(p.name for p in (tmp_path / "log").glob("batch_id=*")) == ["batch_id=2", "batch_id=3"] and read() == expected
    files = [f for f in current_rows(spark, log, ["id"]).inputFiles()]
    assert {"/".join(f.split("/")[-3:-1]) for f in files} == {"_snapshots/through=1", "log/batch_id=2"}
    assert snapshot(spark, log, ["id"]) == 2 and read() == expected
    retire(spark, log)
    assert [p.name for p in (tmp_path / "log/_snapshots").iterdir()] == ["through=2"] and read() == expected
    # The stream goes on where it was.
    load(("c", 5, "2025-02-01"))
    assert read() == [*expected[:2], ("c", 5, "2025-02-01"), expected[3]]


def test_stream_alerts(spark, tmp_path):
    landing, log, checkpoint = (str(tmp_path / n) for n in ("landing", "log", "checkpoint"))
    schema = "alert string, timestamp timestamp_ntz, cooldown_seconds int"
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)

    def run(*seconds):
        spark.createDataFrame([("a", at(s), 10) for s in seconds], schema).coalesce(1).write.mode("append").parquet(landing)
        source = spark.readStream.schema(schema).parquet(landing)
        start_alerts(source, log, checkpoint).awaitTermination()
        return [(r.timestamp - at(0)).total_seconds() for r in fired_alerts(spark.read.parquet(log)).orderBy("timestamp").collect()]

    assert run(0, 3, 9, 12, 15) == [0, 12]
    # The cooldown carries over, and a late candidate never fires.
    assert run(5, 21, 22, 25) == [0, 12, 22]
    assert run(31) == [0, 12, 22]
    assert run(32, 40, 41, 42) == [0, 12, 22, 32, 42]


def test_scratch_is_dropped_last(spark):
    materialize(spark.range(1))
    assert drop_scratch(spark)


# --- workbooks as a data source


def sheet_of(rows):
    """A sheet's rows, given as (number or none, text or none)."""
    out = []
    for number, text in rows:
        cell = '<c s="1"/>' if text is None else f'<c t="inlineStr"><is><t>{text}</t></is></c>'
        out.append(f"<row{'' if number is None else f' r="{number}"'}>{cell}</row>")
    return "".join(out)


def workbook_of(path, sheet, encoding="utf-8"):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(
            "xl/workbook.xml",
            f'<workbook {MAIN} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>'
            '<sheet name="S" sheetId="1" r:id="a"/></sheets></workbook>',
        )
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="a" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        z.writestr("xl/worksheets/sheet1.xml", sheet.encode(encoding))


NUMBERED = [(1, "a")] + [(i, None if i % 5 == 0 else f"t{i}") for i in range(2, 400) if i % 7]
MARKUP = {
    "plain": f"<worksheet {MAIN}><sheetData>{sheet_of(NUMBERED)}</sheetData></worksheet>",
    "prefixed": f"<x:worksheet {MAIN.replace('xmlns', 'xmlns:x')}><x:sheetData>"
    + sheet_of(NUMBERED).replace("</", "</x:").replace("<", "<x:").replace("<x:/x:", "</x:")
    + "</x:sheetData></x:worksheet>",
    "text that looks like rows": f"<worksheet {MAIN}><!-- <row r='1'> --><sheetData>"
    + sheet_of(NUMBERED).replace(">t9<", "><![CDATA[<row r='3'></sheetData>]]><").replace('<row r="12">', '<!--<v>1</v><row>--><row r="12">')
    + "</sheetData><rowBreaks/></worksheet>",
    "wide": f"<?xml version='1.0' encoding='UTF-16'?><worksheet {MAIN}><sheetData>{sheet_of(NUMBERED)}</sheetData></worksheet>",
    "unnumbered": f"<worksheet {MAIN}><sheetData>{sheet_of([(None, t) for _, t in NUMBERED])}</sheetData></worksheet>",
    "empty": f"<worksheet {MAIN}><sheetData/></worksheet>",
}


@pytest.mark.parametrize("blocks", [1, 2, 7, 1000])
@pytest.mark.parametrize("kind", MARKUP)
def test_sheet_blocks_make_the_whole(tmp_path, kind, blocks):
    """However a sheet is cut, its blocks give each row once, blank ones too."""
    from tabprep.sources import workbook

    workbook_of(tmp_path / "b.xlsx", MARKUP[kind], "utf-16" if kind == "wide" else "utf-8")
    rows, named = [], set()
    with zipfile.ZipFile(tmp_path / "b.xlsx") as book:
        for block in range(blocks):
            part = workbook.SheetRows(book, 0, 0, frozenset([3]), block, blocks)
            found = list(part)
            rows += found
            named |= {tuple(part.names)} if found else set()
    if kind == "empty":
        assert rows == []
        return
    texts = {n - 1: t for n, t in NUMBERED if t is not None}
    if kind == "unnumbered":  # blank rows without a number leave no trace
        texts = dict(enumerate(t for _, t in NUMBERED if t is not None))
    if kind == "text that looks like rows":
        texts[8] = "<row r='3'></sheetData>"
    assert rows == [{0: texts[n]} if n in texts else {} for n in range(1, max(texts) + 1) if n != 3]
    assert named == {("a",)}


def test_a_large_sheet_is_read_by_several_tasks(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "one")
    wide = spark.range(0, 20000, 1, 1).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"))
    assert write_excel(wide, path) == 20000
    read = read_excel(spark, path, lineage=False, block_bytes=100_000)
    sizes = [r.n for r in read.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 8 and max(sizes) < 5000
    assert read.exceptAll(wide.select(F.col("id").cast("string"), "text")).isEmpty() and read.count() == 20000


def test_small_workbooks_share_tasks_and_large_ones_are_cut():
    from tabprep.workbooks import plan_blocks

    small = plan_blocks([("r", f"f{i}", 1000) for i in range(1000)], 8, 8 << 20)
    assert 8 <= len(small) <= 9 and sum(len(p.blocks) for p in small) == 1000
    large = plan_blocks([("r", "a", 100 << 20), ("r", "b", 10)], 8, 8 << 20)
    assert sorted(b for p in large for b in p.blocks) == [*(("r", "a", i, 13) for i in range(13)), ("r", "b", 0, 1)]
    assert plan_blocks([], 8, 100) == []


class Broken:
    """A file system that fails at a certain change."""

    def __init__(self, store, left):
        self.store, self.left = store, left

    def __getattr__(self, name):
        call = getattr(self.store, name)
        if name not in ("move", "delete_file"):
            return call

        def counted(*args):
            if not self.left:
                raise OSError("lost")
            self.left -= 1
            return call(*args)

        return counted


@pytest.mark.parametrize("left", range(8))
def test_a_write_that_stops_anywhere_leaves_a_whole_table(spark, tmp_path, left):
    from pyarrow import fs

    from tabprep import workbooks

    path, hidden = tmp_path / "t", tmp_path / "t" / "_temporary-x"
    hidden.mkdir(parents=True)
    for i in range(3):
        (hidden / f"old{i}").write_text("o")
    workbooks.publish(fs.LocalFileSystem(), str(path), str(hidden), [f"old{i}" for i in range(3)])
    (path / "part-00000-000.xlsx").write_text("from before there were versions")
    (path / "notes.xlsx").write_text("of no version")
    for i in range(4):
        (hidden / f"new{i}").write_text("n")
    with pytest.raises(OSError, match="lost"):
        workbooks.publish(Broken(fs.LocalFileSystem(), left), str(path), str(hidden), [f"new{i}" for i in range(4)])

    def table():
        return sorted(open(f).read() for f, _ in workbooks.workbook_files(str(path)))

    assert table() == sorted(["of no version", *("n" * 4 if left >= 4 else "o" * 3)])
    # The next write carries on from there.
    (hidden / "last").write_text("l")
    workbooks.publish(fs.LocalFileSystem(), str(path), str(hidden), ["last"])
    assert table() == ["l", "of no version"]
    assert sorted(p.name for p in path.glob("part-*")) == [f"part-v{2 + (left > 0):06d}-00000-of-00001.xlsx"]


def test_workbooks_by_pattern_and_of_partition_folders(spark, tmp_path):
    for day, n in (("d=1", 3), ("d=2", 4)):
        write_excel(spark.range(n).repartition(2), str(tmp_path / "days" / day))
    (tmp_path / "days/other").mkdir()
    foreign_workbook(tmp_path / "days/other/f.xlsx")
    assert read_excel(spark, str(tmp_path / "days"), lineage=False).count() == 7
    assert read_excel(spark, str(tmp_path / "days/d=*/*.xlsx"), lineage=False).count() == 7
    assert read_excel(spark, [str(tmp_path / "days/d=1"), f"file://{tmp_path}/days/d=2"], lineage=False).count() == 7
    assert write_excel(spark.range(5).where("id > 9"), str(tmp_path / "days/d=1")) == 0
    assert read_excel(spark, str(tmp_path / "days/d=1"), columns=["id"], lineage=False).count() == 0
    twice = spark.range(2).select("id", F.lit("x").alias("id"))
    write_excel(twice, str(tmp_path / "twice"))
    assert read_excel(spark, str(tmp_path / "twice"), lineage=False).columns == ["id", "id.1"]
    with pytest.raises(Exception, match="nowhere"):
        read_excel(spark, str(tmp_path / "nowhere"), columns=["id"]).count()
    with pytest.raises(Exception, match="overwrite"):
        spark.range(1).write.format("workbook").mode("append").save(str(tmp_path / "twice"))
