"""Writing CSV, Parquet and JSON, one or several formats or tables at a time."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.operators.validation import STATUS, VALID, with_status
from tabprep.scratch import materialize
from tabprep.sinks.workbook import write_excel
from tabprep.sources.files import CSV_QUOTING, charset

log = logging.getLogger(__name__)

DATE_PATTERN = "yyyy-MM-dd"
# ISO times down to the microsecond; the default pattern would cut them to milliseconds.
JSON_TIMES = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
}


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame and an observation of its row count, known once it has been written."""
    seen = Observation()
    return df.observe(seen, F.count("*").alias("records")), seen


def format_dates(df: DataFrame, date_format: str = DATE_PATTERN) -> DataFrame:
    """All date and timestamp columns as text."""
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DatetimeType)]
    return df.withColumns({c: F.date_format(c, date_format) for c in dates})


def write_csv(
    df: DataFrame,
    path: str,
    encoding: str = "utf-8",
    delimiter: str = ",",
    date_format: str = DATE_PATTERN,
    mode: str = "overwrite",
) -> int:
    """Delimited files with a header; dates are written in one pattern. Returns the row count."""
    rows, seen = counted(format_dates(df, date_format))
    options = {**CSV_QUOTING, "header": True, "sep": delimiter, "encoding": charset(encoding)}
    rows.write.mode(mode).options(**options).csv(path)
    return seen.get["records"]


def write_parquet(df: DataFrame, path: str, compression: str = "snappy", mode: str = "overwrite") -> int:
    rows, seen = counted(df)
    rows.write.mode(mode).option("compression", compression).parquet(path)
    return seen.get["records"]


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """One JSON record per line, dates in ISO form."""
    rows, seen = counted(df)
    rows.write.mode(mode).options(**JSON_TIMES).json(path)
    return seen.get["records"]


WRITERS = {"parquet": write_parquet, "csv": write_csv, "json": write_json, "excel": write_excel}
SUFFIXES = {"excel": "xlsx"}


def write_formats(df: DataFrame, path: str, formats: Sequence[str] = ("parquet",)) -> dict[str, str]:
    """Write ``path.<suffix>`` for each format and return the paths; unknown formats are skipped.

    Each is complete or absent by the commit protocol of the writer. With several formats the
    rows are computed once: they are taken from the Parquet output or from a scratch table.
    """
    for fmt in formats:
        if fmt not in WRITERS:
            log.warning("unsupported format skipped: %s", fmt)
    wanted = [fmt for fmt in formats if fmt in WRITERS]
    saved = {fmt: f"{path}.{SUFFIXES.get(fmt, fmt)}" for fmt in wanted}
    if "parquet" in wanted:
        write_parquet(df, saved["parquet"])
        df = df.sparkSession.read.schema(df.schema).parquet(saved["parquet"])
        wanted.remove("parquet")
    elif len(wanted) > 1:
        df = materialize(df)
    for fmt in wanted:
        WRITERS[fmt](df, saved[fmt])
    return saved


def write_tables(tables: Mapping[str, DataFrame], path: str, fmt: str = "parquet") -> dict[str, int]:
    """Write each named frame to its own folder below ``path``; returns the row counts."""
    return {name: WRITERS[fmt](df, f"{path}/{name}") for name, df in tables.items()}


def write_quarantine(validated: DataFrame, path: str, reason: str = "Validation failed") -> DataFrame:
    """Write the rows that are not valid, with reason and time, and return the valid ones."""
    bad = validated.where(F.col(STATUS) != VALID).drop("_errors", STATUS)
    marked = bad.withColumns({"_quarantine_reason": F.lit(reason), "_quarantined_at": F.current_timestamp()})
    write_parquet(marked, path)
    return with_status(validated, VALID)


def append_log(events: DataFrame, path: str) -> None:
    """Append metric or alert events as JSON lines."""
    events.write.mode("append").options(**JSON_TIMES).json(path)


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Events of a log under its declared schema."""
    return spark.read.schema(schema).options(**JSON_TIMES).json(path)
