"""Sanitizing a folder of outputs."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyarrow import parquet
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.operators.redaction import drop_sensitive_columns, drop_sensitive_like, redact, redact_credentials
from tabprep.scratch import unused
from tabprep.sinks.files import CSV_QUOTING, format_dates, write_csv, write_parquet
from tabprep.sinks.workbook import file_system, write_excel
from tabprep.sources.files import read_csv
from tabprep.sources.workbook import read_excel

TABLES = ("parquet", "csv", "xlsx", "xlsm")
SETTINGS = ("yaml", "yml", "json")
UNIT = "_unit"
#: Bytes of a CSV file in which its header is looked for, and bytes that a copying task holds.
HEADER_BYTES, COPY_BYTES = 1 << 20, 8 << 20


def outputs_in(spark: SparkSession, path: str) -> DataFrame:
    """Tables and files anywhere below a folder: ``name``, its path below the folder, and ``kind``.

    The first part of a path that ends like a table names a table, be it a file or a folder of files;
    what belongs to no table is a file by itself, and so is a file without a byte, whatever its name.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    suffix = F.lower(F.substring_index("name", ".", -1))
    kind = F.when(suffix.isin(*SETTINGS), "settings").when(suffix.isin(*TABLES), suffix).otherwise("copied")
    found = files.select(_name(F.col("path"), path).alias("name")).distinct().withColumn("kind", kind)
    # Spark passes over empty files when it reads, not when it lists.
    listed = spark.createDataFrame([(p,) for p in files.inputFiles()], "path string")
    alone = listed.select(_name(F.col("path"), path).alias("name"), _below(F.col("path"), path).alias("_itself")).where("name = _itself")
    return found.unionByName(alone.select("name", F.lit("copied").alias("kind")).join(found.select("name"), "name", "left_anti"))


def _below(file: Column, root: str) -> Column:
    """The path of a file below a folder."""
    root = root.rstrip("/").removeprefix("file:") + "/"
    return F.regexp_replace(F.url_decode(F.replace(F.substring_index(file, root, -1), F.lit("+"), F.lit("%2B"))), "/+", "/")


def _name(file: Column, root: str) -> Column:
    """What a file below a folder belongs to: the first part of its path there that ends like a table, else itself."""
    below = _below(file, root)
    table = F.regexp_extract(below, rf"(?i)^(.*?\.({'|'.join(TABLES + SETTINGS)}))(/|$)", 1)
    return F.when(table != "", table).otherwise(below)


def sanitize_dir(spark: SparkSession, source: str, target: str) -> dict[str, str]:
    """Sanitize everything below ``source`` into ``target``, at the same places.

    Tables (Parquet, CSV) lose sensitive columns and get their text redacted, workbooks lose
    every column with a sensitive name, settings files get their credentials blanked, and all other
    files are copied as they are, by tasks. Returns what was done by name. Tables of one format and equal
    columns are one job together, tables in partition folders and workbooks one each, all settings one, all
    copies one. The names of tables and files come to the driver, nothing else does. Files are copied, and
    columns looked up, through Arrow's file systems.
    """
    source, target = source.rstrip("/"), target.rstrip("/")
    found = {r.name: r.kind for r in outputs_in(spark, source).collect()}
    for (kind, columns), names in _alike(spark, source, found).items():
        if columns and len(names) > 1:
            _clean_tables(spark, source, target, kind, names)
            continue
        for name in names:
            held, out = f"{source}/{name}", f"{target}/{name}"
            if kind == "parquet":
                write_parquet(_clean(spark.read.parquet(held)), out)
            else:
                # Values may hold line breaks.
                write_csv(_clean(read_csv(spark, held, lineage=False, multi_line=True)), out)
    for name in sorted(n for n, kind in found.items() if kind in ("xlsx", "xlsm")):
        write_excel(redact(drop_sensitive_like(read_excel(spark, f"{source}/{name}", lineage=False))), f"{target}/{name}")
    settings = sorted(name for name, kind in found.items() if kind == "settings")
    if settings:
        _clean_settings(spark, source, target, settings)
    copied = sorted(name for name, kind in found.items() if kind == "copied")
    if copied:
        copy_files(spark, source, target, copied)
    return dict(sorted(found.items()))


def _clean(df: DataFrame) -> DataFrame:
    return redact(drop_sensitive_columns(df))


def _alike(spark: SparkSession, source: str, found: dict[str, str]) -> dict[tuple[str, str], list[str]]:
    """Names of Parquet and CSV tables by format and columns, as far as these are told by one look at each file.

    The columns are empty for tables that must be read alone: of partition folders, of files that differ, or of a
    header that is not on one line.
    """
    if not any(kind in ("parquet", "csv") for kind in found.values()):
        return {}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source).select("path", "length")
    files = files.withColumn("name", _name(F.col("path"), source)).withColumn("kind", F.lower(F.substring_index("name", ".", -1)))
    files = files.where(F.col("kind").isin("parquet", "csv"))
    parts = max(1, min(sum(kind in ("parquet", "csv") for kind in found.values()), int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def look(batches):
        for batch in batches:
            rows = batch.to_pylist()
            columns = [_columns_of(r["path"], r["name"], r["kind"], r["length"]) for r in rows]
            yield pa.record_batch([pa.array([r["name"] for r in rows]), pa.array([r["kind"] for r in rows]), pa.array(columns)], names=["name", "kind", "columns"])

    seen = files.repartition(parts, "path").mapInArrow(look, "name string, kind string, columns string")
    told = seen.groupBy("name", "kind").agg(F.min("columns").alias("one"), F.max("columns").alias("other")).collect()
    alike: dict[tuple[str, str], list[str]] = {}
    for r in sorted(told):
        alike.setdefault((r.kind, r.one if r.one == r.other else ""), []).append(r.name)
    return alike


def _columns_of(path: str, name: str, kind: str, length: int) -> str:
    """The schema of a Parquet file or the header of a CSV file, as text; empty if it doesn't tell."""
    store, file = file_system(_plain(path))
    if "=" in file.rsplit(f"{name}/", 1)[-1] or not length:
        return ""
    if kind == "parquet":
        with store.open_input_file(file) as held:
            return parquet.read_schema(held).remove_metadata().to_string(show_schema_metadata=False)
    with store.open_input_stream(file) as held:
        line, end, _ = held.read(HEADER_BYTES).partition(b"\n")
    # Bytes of other encodings are told apart just as well.
    return line.hex() if (end or len(line) == length) and line.count(b'"') % 2 == 0 else ""


def _plain(path: str) -> str:
    """A path of the local file system without its scheme, since names need not be URI-encoded; others as they are."""
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


def _clean_tables(spark: SparkSession, source: str, target: str, kind: str, names: list[str]) -> None:
    """Clean tables of one format and equal columns by one job, which writes a folder for each; those are then moved."""
    paths = [f"{source}/{n}" for n in names]
    rows = spark.read.parquet(*paths) if kind == "parquet" else read_csv(spark, paths, lineage=False, multi_line=True)
    unit = unused(UNIT, rows.columns)
    name, file = unused("_name", rows.columns), unused("_path", rows.columns)
    numbers = spark.createDataFrame(list(enumerate(names)), f"{unit} int, {name} string")
    rows = rows.withColumn(file, F.col("_metadata.file_path")).withColumn(name, _name(F.col(file), source)).drop(file)
    # Names may look like something to be redacted: only the number goes on.
    clean = _clean(rows.join(numbers, name).drop(name))
    clean = format_dates(clean) if kind == "csv" else clean
    together = f"{target}/_tables-{uuid.uuid4().hex}"
    writer = clean.write.partitionBy(unit)
    if kind == "parquet":
        writer.option("compression", "snappy").parquet(together)
    else:
        writer.options(**CSV_QUOTING, header=True).csv(together)
    store, path_of = _store(spark, target)
    empty = None
    for i, n in enumerate(names):
        written, out = path_of(f"{together}/{unit}={i}"), path_of(f"{target}/{n}")
        store.mkdirs(out.getParent())
        store.delete(out, True)
        if store.exists(written):
            store.rename(written, out)
            continue
        if empty is None:  # tables without rows, which have no folder: all alike
            empty = f"{together}/_empty"
            none = clean.drop(unit).limit(0)
            write_parquet(none, empty) if kind == "parquet" else write_csv(none, empty)
        copy_folder(spark, empty, f"{target}/{n}")
    store.delete(path_of(together), True)


def _clean_settings(spark: SparkSession, source: str, target: str, names: list[str]) -> None:
    """Blank credentials in all settings files by one job, which writes a folder for each; those are then moved."""
    # Whole texts: a value may stand on the line below its name.
    texts = spark.read.text([f"{source}/{n}" for n in names], wholetext=True).select("value", "_metadata.file_path")
    numbers = spark.createDataFrame(list(enumerate(names)), f"{UNIT} int, _name string")
    texts = texts.withColumn("_name", _name(F.col("file_path"), source)).join(numbers, "_name")
    clean = redact_credentials(texts, ["value"])
    # The writer ends each text with a line break of its own.
    clean = clean.select(F.regexp_replace("value", r"\n\z", "").alias("value"), UNIT)
    together = f"{target}/_settings"
    clean.write.mode("overwrite").partitionBy(UNIT).text(together)
    store, path_of = _store(spark, target)
    for i, name in enumerate(names):
        out = path_of(f"{target}/{name}")
        store.mkdirs(out.getParent())
        store.delete(out, True)
        store.rename(path_of(f"{together}/{UNIT}={i}"), out)
    store.delete(path_of(together), True)


def _store(spark: SparkSession, path: str):
    """File system of a path, and what makes a path for it."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    return path_of(path).getFileSystem(spark._jsc.hadoopConfiguration()), path_of


def copy_folder(spark: SparkSession, source: str, target: str) -> None:
    """Copy a small folder, such as that of a table without rows."""
    (one, path_of), (two, _) = _store(spark, source), _store(spark, target)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(one, path_of(source), two, path_of(target), False, True, spark._jsc.hadoopConfiguration())


def copy_files(spark: SparkSession, source: str, target: str, names: Sequence[str]) -> int:
    """Copy files from below one folder to below another by tasks, and return how many bytes they have.

    Each attempt of a task writes under a name of its own in a hidden folder and moves the finished file to its place,
    so that a lost executor leaves nothing half written. A file is streamed in blocks of ``COPY_BYTES``.
    """
    hidden = f"{target.rstrip('/')}/_copying-{uuid.uuid4().hex}"
    parts = max(1, min(len(names), int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def run(batches):
        task = TaskContext.get()
        for batch in batches:
            for number, name in enumerate(batch.column("name").to_pylist()):
                store, held = file_system(_plain(f"{source}/{name}"))
                place, out = file_system(_plain(f"{target}/{name}"))
                _, folder = file_system(_plain(hidden))
                place.create_dir(folder)
                place.create_dir(out.rsplit("/", 1)[0])
                attempt, size = f"{folder}/{task.taskAttemptId()}-{number}", 0
                with store.open_input_stream(held) as read, place.open_output_stream(attempt) as write:
                    while block := read.read(COPY_BYTES):
                        size += write.write(block)
                place.move(attempt, out)
                yield pa.record_batch([pa.array([size], pa.int64())], names=["bytes"])

    listed = spark.createDataFrame([(n,) for n in names], "name string").repartition(parts, "name")
    total = listed.mapInArrow(run, "bytes bigint").agg(F.sum("bytes")).first()[0]
    store, path_of = _store(spark, target)
    store.delete(path_of(hidden), True)
    return total
