"""Excel workbooks as a source: a sheet is cut into blocks of rows, and a task decodes some blocks.

A workbook is a compressed archive, so a task unpacks a sheet from its start, but it parses only the rows of its block.
"""

from __future__ import annotations

import codecs
import datetime as dt
import json
import re
import zipfile
from collections.abc import Callable, Iterator, Mapping, Sequence
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSourceReader

from tabprep.functions.dates import clean_date
from tabprep.operators.cleaning import enforce_schema
from tabprep.workbooks import BLOCK_BYTES, FILE, FORMAT, SheetBlocks, file_system, plan_blocks, register, workbook_files

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
EPOCH = dt.datetime(1899, 12, 30)
# Built-in number formats that show a date or time.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
CHUNK = 10_000
#: Unpacked bytes of a sheet that are looked at together.
PIECE = 1 << 20


def read_excel(
    spark: SparkSession,
    paths: str | Sequence[str],
    sheet_name: int | str = 0,
    header_row: int = 0,
    skip_rows: Sequence[int] = (),
    columns: Sequence[str] | None = None,
    dtypes: Mapping[str, str] | None = None,
    parse_dates: Sequence[str] = (),
    lineage: bool = True,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Rows of one sheet of every workbook under ``paths``, as text columns unless ``dtypes`` says otherwise.

    Rows are numbered after leaving out ``skip_rows``; the one at ``header_row`` names the columns
    and what is above it is dropped. Without ``columns`` a first pass over the header rows alone
    finds them, the union over all workbooks. Workbooks of more than ``block_bytes`` are read by
    several tasks each. Of a folder that ``write_excel`` filled, the newest whole version is read.
    """
    register(spark)
    options = {
        "paths": json.dumps([paths] if isinstance(paths, str) else list(paths)),
        "sheet": json.dumps(sheet_name),
        "header": str(header_row),
        "skip": json.dumps(list(skip_rows)),
        "tasks": str(spark.sparkContext.defaultParallelism),
        "blockBytes": str(block_bytes),
    }
    source = spark.read.format(FORMAT).options(**options)
    if columns is None:
        # As many rows as the sheets have columns.
        found = source.load().groupBy("name").agg(F.min("position").alias("p")).orderBy("p", "name")
        columns = [r.name for r in found.collect()]
    rows = spark.read.format(FORMAT).options(**options, columns=json.dumps(list(columns))).load()
    df = rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], FILE)
    if dtypes:
        df = enforce_schema(df, dtypes)
    df = df.withColumns({c: clean_date(c) for c in parse_dates if c in columns})
    if not lineage:
        return df.drop(FILE)
    return df.withColumnRenamed(FILE, "_source_file").withColumn("_extracted_at", F.current_timestamp())


class WorkbookReader(DataSourceReader):
    """Reads the names of columns, or rows, by blocks of sheets."""

    def __init__(self, options: Mapping[str, str]):
        self.paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
        self.sheet = json.loads(options.get("sheet", "0"))
        self.header = int(options.get("header", 0))
        self.skip = frozenset(json.loads(options.get("skip", "[]")))
        self.columns = json.loads(options["columns"]) if "columns" in options else None
        self.tasks = int(options.get("tasks", 1))
        self.most = int(options.get("blockBytes", BLOCK_BYTES))

    def partitions(self) -> list[SheetBlocks]:
        files = [(root, file, size) for root in self.paths for file, size in workbook_files(root)]
        return plan_blocks(files, self.tasks, self.most, whole=self.columns is None) or [SheetBlocks([])]

    def read(self, partition: SheetBlocks) -> Iterator[pa.RecordBatch]:
        for root, file, block, blocks in partition.blocks:
            store, _ = file_system(root)
            with store.open_input_file(file) as data, zipfile.ZipFile(data) as book:
                rows = SheetRows(book, self.sheet, self.header, self.skip, block, blocks)
                if self.columns is None:
                    yield _header_batch(rows)
                else:
                    yield from self._batches(rows, file.rsplit("/", 1)[-1])

    def _batches(self, rows: SheetRows, file: str) -> Iterator[pa.RecordBatch]:
        names = [*(f"c{i}" for i in range(len(self.columns))), FILE]
        chunk: list[dict[int, str]] = []

        def pack() -> pa.RecordBatch:
            at = {name: i for i, name in enumerate(rows.names)}
            places = [at.get(c) for c in self.columns]
            texts = [pa.array([cells.get(p) for cells in chunk], pa.string()) for p in places]
            return pa.record_batch([*texts, pa.array([file] * len(chunk), pa.string())], names=names)

        for cells in rows:
            chunk.append(cells)
            if len(chunk) == CHUNK:
                yield pack()
                chunk = []
        if chunk:
            yield pack()


def _header_batch(rows: SheetRows) -> pa.RecordBatch:
    # The first row below the header, if there is one, comes when the header has been read.
    next(iter(rows), None)
    return pa.record_batch(
        [pa.array(rows.names, pa.string()), pa.array(range(len(rows.names)), pa.int32())], names=["name", "position"]
    )


class SheetRows:
    """The rows below the header that begin in one of several equal parts of a sheet's markup.

    A row is the text of its filled cells by column number. Blank rows count as rows up to the last filled one, and belong
    to the block of the filled row that follows them. ``names`` are the columns, once the first row has been given.
    """

    def __init__(self, book: zipfile.ZipFile, sheet: int | str, header: int, skip: frozenset[int], block: int = 0, blocks: int = 1):
        self.book, self.skip = book, skip
        self.entry = book.getinfo(_sheet_path(book, sheet))
        self.start, self.end = (self.entry.file_size * b // blocks for b in (block, block + 1))
        self.last = block + 1 == blocks
        self.names: list[str] = []
        # Rows are numbered from 0, blank ones too, so the header's number is known.
        self.header = -1
        for _ in range(header + 1):
            self.header += 1
            while self.header in skip:
                self.header += 1

    def __iter__(self) -> Iterator[dict[int, str]]:
        with self.book.open(self.entry) as xml:
            marked = _marked_rows(_pieces(xml))
            parse = _RowParser(next(marked), self.book)
            following = 0  # number of the row after the last filled one
            for offset, markup in marked:
                if offset >= self.end and not self.last:
                    return
                given = _NUMBER.match(markup)
                number = int(given[1]) - 1 if given else following
                mine = offset >= self.start
                if not mine and number != self.header:
                    # A row before the block matters only by its number.
                    filled = _is_filled(markup)
                    if filled or filled is None and parse(markup):
                        following = number + 1
                    continue
                cells = parse(markup)
                if not cells:
                    continue
                if mine:
                    yield from ({} for blank in range(max(following, self.header + 1), number) if blank not in self.skip)
                if number == self.header:
                    self.names = _names(cells)
                elif number > self.header and number not in self.skip:
                    yield cells
                following = number + 1


# A row's start, the end of all rows, or what may hold text that looks like either.
_MARK = re.compile(rb"<(?:[\w.-]+:)?row(?=[\s/>])|</(?:[\w.-]+:)?sheetData\s*>|<(?:[\w.-]+:)?sheetData\s*/>|<!--|<!\[CDATA\[")
_ENDS = {b"<!--": b"-->", b"<![CDATA[": b"]]>"}
_NUMBER = re.compile(rb"""<[^>]*?\sr\s*=\s*["'](\d+)""")
_VALUE = re.compile(rb"[<:](?:v|is)[\s/>]")
_FILLED = re.compile(rb"[<:]v>[^<]")
#: Bytes that a mark, or a tag's beginning before it is known to be one, may take.
LONGEST = 256


def _pieces(xml) -> Callable[[], bytes]:
    """Reader of a sheet's markup by pieces, in an encoding that agrees with ASCII."""
    start = xml.read(2)
    if start in (codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE):
        decoder = codecs.getincrementaldecoder("utf-16")()
        decoder.decode(start)

        def wide() -> bytes:
            text = ""
            while not text and (piece := xml.read(PIECE)):
                text = decoder.decode(piece)
            return re.sub(r"(<\?xml[^>]*?)\sencoding\s*=\s*[\"'][^\"']*[\"']", r"\1", text).encode()

        return wide
    first = [start]
    return lambda: (first.pop() if first else b"") + xml.read(PIECE)


def _marked_rows(read: Callable[[], bytes]) -> Iterator:
    """What stands before the rows, then the place and the markup of each row."""
    buffer, base, at, opened, before = b"", 0, 0, None, True
    while True:
        mark = _MARK.search(buffer, at)
        stop = -1
        if mark and mark.group() in _ENDS:
            end = _ENDS[mark.group()]
            stop = buffer.find(end, mark.end())
            if stop >= 0:
                at = stop + len(end)
                continue
        if not mark or mark.group() in _ENDS:
            more = read()
            if not more:
                if before:
                    yield buffer
                return
            at = mark.start() if mark else max(at, len(buffer) - LONGEST)
            done = opened or 0
            buffer, base, at = buffer[done:] + more, base + done, at - done
            opened = None if opened is None else 0
            continue
        if before:
            yield buffer[: mark.start()]
            before = False
        if opened is not None:
            yield base + opened, buffer[opened : mark.start()]
        if not mark.group().endswith(b"row"):
            return
        opened, at = mark.start(), mark.end()


def _is_filled(markup: bytes) -> bool | None:
    """Whether a row has a filled cell, as far as its markup shows without parsing."""
    if not _VALUE.search(markup):
        return False
    if b"<!" in markup or b'"e"' in markup or b"'e'" in markup:
        return None
    return True if _FILLED.search(markup) else None


class _RowParser:
    """Filled cells of rows, given the markup before all rows, for its namespaces."""

    def __init__(self, before: bytes, book: zipfile.ZipFile):
        self.parser = ET.XMLPullParser(("start", "end"))
        self.book, self.shared = book, None
        self.dated = _date_styles(book)
        self.sheet_data = None
        self(before)

    def __call__(self, markup: bytes) -> dict[int, str]:
        self.parser.feed(markup)
        if hasattr(self.parser, "flush"):
            self.parser.flush()
        cells: dict[int, str] = {}
        for event, element in self.parser.read_events():
            if event == "start":
                if element.tag == MAIN + "sheetData":
                    self.sheet_data = element
            elif element.tag == MAIN + "row":
                for i, cell in enumerate(element.iter(MAIN + "c")):
                    text = self._text(cell)
                    if text is not None:
                        cells[_column(cell.get("r"), i)] = text
                # A row that is done leaves the tree, so that a sheet of any size needs the memory of one row.
                self.sheet_data.clear()
        return cells

    def _text(self, cell: ET.Element) -> str | None:
        if cell.get("t") == "s" and self.shared is None:
            self.shared = _shared_strings(self.book)
        return _cell_text(cell, self.shared or [], self.dated)


def _names(cells: dict[int, str]) -> list[str]:
    names: list[str] = []
    for i in range(max(cells, default=-1) + 1):
        name = cells[i].strip() if i in cells else f"Unnamed: {i}"
        repeats = sum(1 for other in names if re.fullmatch(re.escape(name) + r"(\.\d+)?", other))
        names.append(f"{name}.{repeats}" if name in names else name)
    return names


def _column(reference: str | None, default: int) -> int:
    if not reference:
        return default
    number = 0
    for letter in re.match("[A-Z]+", reference).group():
        number = number * 26 + ord(letter) - 64
    return number - 1


def _cell_text(cell: ET.Element, shared: list[str], dated: set[int]) -> str | None:
    kind, value = cell.get("t", "n"), cell.findtext(MAIN + "v")
    if kind == "inlineStr":
        return decode("".join(t.text or "" for t in cell.iter(MAIN + "t")))
    if value is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return "true" if value == "1" else "false"
    if kind == "n" and int(cell.get("s", 0)) in dated:
        moment = EPOCH + dt.timedelta(milliseconds=round(float(value) * 86_400_000))
        return moment.date().isoformat() if moment.time() == dt.time() else moment.isoformat(sep=" ")
    return value


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    texts: list[str] = []
    with book.open("xl/sharedStrings.xml") as xml:
        events = ET.iterparse(xml, events=("start", "end"))
        _, root = next(events)
        for event, item in events:
            if event == "end" and item.tag == MAIN + "si":
                texts.append(decode("".join(t.text or "" for t in item.iter(MAIN + "t"))))
                root.clear()
    return texts


def decode(text: str) -> str:
    """Characters that stand as ``_xHHHH_``, since XML cannot hold them."""
    return re.sub("_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m.group(1), 16)), text)


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ET.fromstring(book.read("xl/styles.xml"))
    custom = {
        int(f.get("numFmtId"))
        for f in root.iter(MAIN + "numFmt")
        if re.search("[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", "").lower()))
    }
    styles = root.find(MAIN + "cellXfs")
    formats = [] if styles is None else [int(x.get("numFmtId", 0)) for x in styles]
    return {i for i, f in enumerate(formats) if f in DATE_FORMATS or f in custom}


def _sheet_path(book: zipfile.ZipFile, sheet: int | str) -> str:
    sheets = list(ET.fromstring(book.read("xl/workbook.xml")).iter(MAIN + "sheet"))
    chosen = [s for i, s in enumerate(sheets) if sheet in (i, s.get("name"))]
    if not chosen:
        raise ValueError(f"no sheet {sheet!r}")
    targets = {
        r.get("Id"): r.get("Target") for r in ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    }
    target = targets[chosen[0].get(RELATION)]
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
