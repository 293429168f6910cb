"""Workbooks as a Spark data source: which files make up a table, how reading is cut into tasks, how writing commits.

A table is a folder of workbooks. One write is one version of it, and the names of its files say which version they
belong to and how many files that has. The newest version whose files are all there is the table; so a new version
becomes the table with its last file, whatever happens before or after, and nothing else has to be replaced.
"""

from __future__ import annotations

import json
import os
import re
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from pathlib import PurePosixPath

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

FORMAT = "workbook"
FILE = "_file"
#: Compressed bytes of one sheet block: a task decodes about ten times as much markup.
BLOCK_BYTES = 8 << 20
#: A workbook below this size is not cut, however many tasks there are.
LEAST_BYTES = 1 << 20

_WORKBOOK = re.compile(r"(?i).*\.xls[xm]$")
_VERSIONED = re.compile(r"part-v(\d+)-(\d+)-of-(\d+)\.xlsx$")
#: Names that writes without versions gave.
_UNVERSIONED = re.compile(r"part-\d+-\d+\.xlsx$")


class WorkbookFormat(DataSource):
    """``workbook``: sheets as text columns, and folders of workbooks as a target.

    Options to read: ``paths`` (JSON list) or ``path``, ``sheet`` (JSON: number or name), ``header`` (number of the row
    that names the columns), ``skip`` (JSON list of row numbers), ``columns`` (JSON list of names; the columns are
    ``c0``, ``c1``, ... and ``_file``). Without ``columns`` the rows are the names of each workbook's columns and their
    positions. ``tasks`` is the parallelism to aim at, ``blockBytes`` the most that a task decodes.

    Options to write, with mode overwrite: ``path``, ``sheet`` (name), ``names`` (JSON list), ``rowsPerWorkbook``.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        if "columns" not in self.options:
            return "name string, position int"
        columns = json.loads(self.options["columns"])
        return ", ".join([*(f"c{i} string" for i in range(len(columns))), f"{FILE} string"])

    def reader(self, schema: StructType) -> DataSourceReader:
        from tabprep.sources.workbook import WorkbookReader

        return WorkbookReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        from tabprep.sinks.workbook import WorkbookWriter

        if not overwrite:
            raise ValueError("a folder of workbooks is replaced as a whole: write it with mode overwrite")
        return WorkbookWriter(self.options, schema.fieldNames())


@dataclass
class SheetBlocks(InputPartition):
    """Blocks of sheets that one task reads, as (root, file, block, number of the file's blocks)."""

    blocks: list[tuple[str, str, int, int]]

    def __init__(self, blocks: list[tuple[str, str, int, int]]):
        super().__init__(None)
        self.blocks = blocks


def register(spark: SparkSession) -> None:
    """Make the format known to a session; again does no harm."""
    spark.dataSource.register(WorkbookFormat)


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    store, folder = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))
    return store, folder.rstrip("/")


def workbook_files(path: str) -> list[tuple[str, int]]:
    """Workbooks under a file, folder or pattern, with their sizes, in the order of their names.

    Of a folder, its own files count and those in folders named ``key=value``. Files of versions that are not whole, or
    not the newest whole one of their folder, are left out, as are hidden files and all that is no workbook.
    """
    store, name = file_system(path)
    info = store.get_file_info(name)
    if info.type == fs.FileType.File:
        return [(info.path, info.size)]
    parts = PurePosixPath(name).parts
    fixed = next((i for i, p in enumerate(parts) if re.search(r"[*?\[]", p)), None)
    if info.type == fs.FileType.Directory:
        base = name
    elif fixed:
        base = str(PurePosixPath(*parts[:fixed]))
    else:
        raise FileNotFoundError(path)
    listed = store.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
    files = [i for i in listed if i.type == fs.FileType.File and _WORKBOOK.match(i.path)]
    found = []
    for i in _newest_whole(files):
        inner = PurePosixPath(i.path[len(base) :].lstrip("/")).parts
        if any(p.startswith(("_", ".")) for p in inner if "=" not in p):
            continue
        if base == name:
            wanted = all("=" in p for p in inner[:-1])
        else:
            # A pattern may name the files, or folders of them.
            own = PurePosixPath(i.path)
            wanted = own.match(name) or own.parent.match(name)
        if wanted:
            found.append((i.path, i.size))
    if not found and base != name:
        raise FileNotFoundError(path)
    return sorted(found)


def _newest_whole(files: Sequence[fs.FileInfo]) -> list[fs.FileInfo]:
    """Files of the newest whole version of each folder, and those that belong to no version."""
    versions: dict[tuple[str, int, int], int] = defaultdict(int)
    for i in files:
        if m := _VERSIONED.match(i.base_name):
            versions[_folder(i), int(m[1]), int(m[3])] += 1
    newest: dict[str, int] = {}
    for (folder, version, wanted), there in versions.items():
        if there == wanted:
            newest[folder] = max(version, newest.get(folder, version))
    kept = []
    for i in files:
        m = _VERSIONED.match(i.base_name)
        if m:
            if newest.get(_folder(i)) == int(m[1]):
                kept.append(i)
        elif _folder(i) not in newest or not _UNVERSIONED.match(i.base_name):
            kept.append(i)
    return kept


def _folder(info: fs.FileInfo) -> str:
    return info.path[: -len(info.base_name)]


def plan_blocks(files: Sequence[tuple[str, str, int]], tasks: int, most: int, whole: bool = False) -> list[SheetBlocks]:
    """Files as (root, file, size), cut into blocks and dealt to tasks in order.

    A task gets an equal part of all bytes, but no more than ``most``; a file above that is cut, and one of some size
    also where there would be fewer parts than tasks. ``whole`` files are never cut.
    """
    share = max(1, min(most, sum(size for *_, size in files) // max(1, tasks)))
    planned: list[SheetBlocks] = []
    filled = share
    for root, file, size in files:
        number = 1 if whole else max(1, -(-size // max(share, min(most, LEAST_BYTES))))
        for block in range(number):
            if filled >= share:
                planned.append(SheetBlocks([]))
                filled = 0
            planned[-1].blocks.append((root, file, block, number))
            filled += size // number
    return planned


def publish(store: fs.FileSystem, folder: str, hidden: str, attempts: Sequence[str]) -> None:
    """Make finished files the newest version of a folder, then delete the versions before it."""
    old = [
        i
        for i in store.get_file_info(fs.FileSelector(folder))
        if i.type == fs.FileType.File and i.base_name.startswith("part-") and i.extension == "xlsx"
    ]
    version = 1 + max((int(m[1]) for i in old if (m := _VERSIONED.match(i.base_name))), default=0)
    for number, attempt in enumerate(attempts):
        store.move(f"{hidden}/{attempt}", f"{folder}/part-v{version:06d}-{number:05d}-of-{len(attempts):05d}.xlsx")
    # The oldest go first: at no time is a version before the newest the only whole one.
    for info in sorted(old, key=lambda i: i.path):
        store.delete_file(info.path)
