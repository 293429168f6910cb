"""Excel output: one workbook per partition, or several where a partition exceeds a sheet."""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from xml.sax.saxutils import escape

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSourceArrowWriter, WriterCommitMessage

from tabprep.workbooks import FORMAT, file_system, publish, register

SHEET_ROWS = 1_048_575

HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
SPREADSHEET = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
TYPES = "application/vnd.openxmlformats-officedocument.spreadsheetml"
DAY, MOMENT = 1, 2


def write_excel(df: DataFrame, path: str, sheet_name: str = "Data", rows_per_workbook: int = SHEET_ROWS) -> int:
    """Write ``part-*.xlsx`` files into a folder and return the row count; earlier workbooks there are replaced.

    Any file system that Arrow knows will do, if all executors reach it. Tasks write into a hidden
    folder of the run, each attempt under a name of its own. When the job has succeeded the finished
    files move up as the folder's next version, and the earlier ones are deleted; the names of the
    files, not their contents, come to the driver. Whenever a run fails or its driver is lost, also
    amid the moving, ``read_excel`` finds either all old workbooks or all new ones. One write at a time.
    """
    register(df.sparkSession)
    seen = Observation()
    # Columns go by place, as a sheet may have two of one name.
    rows = df.toDF(*(f"c{i}" for i in range(len(df.columns)))).observe(seen, F.count(F.lit(1)).alias("records"))
    options = {"path": path, "sheet": sheet_name, "names": json.dumps(df.columns), "rowsPerWorkbook": str(rows_per_workbook)}
    rows.write.format(FORMAT).mode("overwrite").options(**options).save()
    return seen.get["records"]


@dataclass
class Written(WriterCommitMessage):
    """Names of the workbooks that a task attempt has finished."""

    attempts: list[str]


class WorkbookWriter(DataSourceArrowWriter):
    """Writes workbooks in a hidden folder; ``commit`` makes them the folder's newest version."""

    def __init__(self, options: Mapping[str, str], columns: Sequence[str]):
        self.path, self.sheet = options["path"], options.get("sheet", "Data")
        self.names = json.loads(options["names"]) if "names" in options else list(columns)
        self.rows = int(options.get("rowsPerWorkbook", SHEET_ROWS))
        self.run = f"_temporary-{uuid.uuid4().hex}"

    def _place(self) -> tuple[fs.FileSystem, str, str]:
        store, folder = file_system(self.path)
        return store, folder, f"{folder}/{self.run}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        task = TaskContext.get()
        store, _, hidden = self._place()
        store.create_dir(hidden)
        attempts = []
        for number, rows in enumerate(_blocks(iterator, self.rows)):
            attempts.append(f"{task.partitionId():05d}-{number:05d}-{task.taskAttemptId()}.xlsx")
            _write_workbook(store, f"{hidden}/{attempts[-1]}", self.sheet, self.names, rows)
        return Written(attempts)

    def commit(self, messages: list[Written]) -> None:
        store, folder, hidden = self._place()
        store.create_dir(hidden)
        publish(store, folder, hidden, sorted(a for m in messages for a in m.attempts))
        store.delete_dir(hidden)

    def abort(self, messages: list[Written | None]) -> None:
        store, _, hidden = self._place()
        if store.get_file_info(hidden).type == fs.FileType.Directory:
            store.delete_dir(hidden)


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Iterator[tuple]]:
    """Consecutive runs of at most ``size`` rows, read as they are consumed."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    for first in rows:

        def block(first: tuple = first) -> Iterator[tuple]:
            yield first
            for _ in range(size - 1):
                row = next(rows, None)
                if row is None:
                    return
                yield row

        yield block()


def _write_workbook(store: fs.FileSystem, path: str, sheet: str, names: list[str], rows: Iterator[tuple]) -> int:
    records = 0
    with store.open_output_stream(path) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in _parts(sheet).items():
            book.writestr(name, HEAD + text)
        with book.open("xl/worksheets/sheet1.xml", "w") as xml:
            xml.write(f'{HEAD}<worksheet xmlns="{SPREADSHEET}"><sheetData>'.encode())
            xml.write(_row_xml(names).encode())
            for row in rows:
                xml.write(_row_xml(row).encode())
                records += 1
            xml.write(b"</sheetData></worksheet>")
    return records


# What XML cannot hold or would change, and text that looks like its code.
_UNHELD = re.compile("[\x00-\x08\x0b\x0c\x0d\x0e-\x1f\ufffe\uffff]|_(?=x[0-9A-Fa-f]{4}_)")


def encode(text: str) -> str:
    """Characters that a sheet cannot hold, as ``_xHHHH_``."""
    return _UNHELD.sub(lambda m: f"_x{ord(m.group()):04X}_", text)


def _row_xml(values) -> str:
    return "<row>" + "".join(map(_cell_xml, values)) + "</row>"


def _cell_xml(value) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, int | float | Decimal):
        return f"<c><v>{value}</v></c>"
    if isinstance(value, dt.datetime):
        days = (value.replace(tzinfo=None) - dt.datetime(1899, 12, 30)) / dt.timedelta(days=1)
        return f'<c s="{MOMENT}"><v>{days!r}</v></c>'
    if isinstance(value, dt.date):
        return f'<c s="{DAY}"><v>{(value - dt.date(1899, 12, 30)).days}</v></c>'
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(encode(str(value)))}</t></is></c>'


def _parts(sheet: str) -> dict[str, str]:
    """The fixed parts around the sheet data."""
    name = escape(sheet, {'"': "&quot;"})
    return {
        "[Content_Types].xml": (
            f'<Types xmlns="{PACKAGE}/content-types">'
            '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            f'<Override PartName="/xl/workbook.xml" ContentType="{TYPES}.sheet.main+xml"/>'
            f'<Override PartName="/xl/worksheets/sheet1.xml" ContentType="{TYPES}.worksheet+xml"/>'
            f'<Override PartName="/xl/styles.xml" ContentType="{TYPES}.styles+xml"/></Types>'
        ),
        "_rels/.rels": (
            f'<Relationships xmlns="{PACKAGE}/relationships">'
            f'<Relationship Id="rId1" Type="{OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>'
        ),
        "xl/workbook.xml": (
            f'<workbook xmlns="{SPREADSHEET}" xmlns:r="{OFFICE}"><sheets>'
            f'<sheet name="{name}" sheetId="1" r:id="rId1"/></sheets></workbook>'
        ),
        "xl/_rels/workbook.xml.rels": (
            f'<Relationships xmlns="{PACKAGE}/relationships">'
            f'<Relationship Id="rId1" Type="{OFFICE}/worksheet" Target="worksheets/sheet1.xml"/>'
            f'<Relationship Id="rId2" Type="{OFFICE}/styles" Target="styles.xml"/></Relationships>'
        ),
        "xl/styles.xml": (
            f'<styleSheet xmlns="{SPREADSHEET}"><numFmts count="2">'
            '<numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/>'
            '<numFmt numFmtId="165" formatCode="yyyy\\-mm\\-dd\\ hh:mm:ss"/></numFmts>'
            '<fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders>'
            '<cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="3"><xf numFmtId="0"/>'
            '<xf numFmtId="164" applyNumberFormat="1"/><xf numFmtId="165" applyNumberFormat="1"/></cellXfs></styleSheet>'
        ),
    }
