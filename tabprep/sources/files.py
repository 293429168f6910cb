"""Reading delimited, Parquet and JSON files, with header clean-up and lineage."""

from __future__ import annotations

import codecs
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.dates import clean_date
from tabprep.operators.cleaning import enforce_schema
from tabprep.operators.redaction import suffix_of

# Quotes inside a value are doubled and white space is kept, on reading and on writing.
CSV_QUOTING = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


# Codec name -> the name Spark knows it by, where they differ.
CHARSETS = {"ascii": "us-ascii", "iso8859-1": "iso-8859-1", "utf-8-sig": "utf-8"}


def charset(encoding: str) -> str:
    """Spark's name of an encoding given in any usual spelling."""
    name = codecs.lookup(encoding).name
    return CHARSETS.get(name, name)


def normalize_headers(df: DataFrame) -> DataFrame:
    """Column names without surrounding white space."""
    return df.toDF(*[c.strip() for c in df.columns])


def add_lineage(df: DataFrame) -> DataFrame:
    """Add the name of the file each row came from and one extraction time.

    Must come directly on a file source, where the file metadata is still at hand.
    """
    return df.select(
        "*", F.col("_metadata.file_name").alias("_source_file"), F.current_timestamp().alias("_extracted_at")
    )


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str | T.StructType | None = None,
    encoding: str = "utf-8",
    delimiter: str = ",",
    dtypes: Mapping[str, str] | None = None,
    parse_dates: Sequence[str] = (),
    lineage: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Delimited files with a header.

    Without a schema all columns land as text, which saves the pass that inference would take
    and keeps codes such as ``0042``; ``dtypes`` then casts by column. Line breaks inside quoted
    values need ``multi_line``, at the price that a file is no longer split.
    """
    options = {**CSV_QUOTING, "header": True, "sep": delimiter, "encoding": charset(encoding), "multiLine": multi_line}
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path if isinstance(path, str) else list(path))
    if lineage:
        df = add_lineage(df)
    df = normalize_headers(df)
    if dtypes:
        df = enforce_schema(df, dtypes)
    return df.withColumns({c: clean_date(c) for c in parse_dates if c in df.columns})


def read_any(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Read by suffix: Parquet, CSV, Excel workbooks, or JSON.

    JSON may hold a record or an array of records per line; ``multi_line`` reads one document of
    any layout per file. A missing path or an unknown suffix is an error.
    """
    suffix = suffix_of(path)
    if suffix == "parquet":
        return spark.read.parquet(path)
    if suffix == "csv":
        return read_csv(spark, path, lineage=False, multi_line=multi_line)
    if suffix in ("xlsx", "xlsm"):
        from tabprep.sources.workbook import read_excel

        return read_excel(spark, path, lineage=False)
    if suffix in ("json", "jsonl"):
        return spark.read.option("multiLine", multi_line).json(path)
    raise ValueError(f"unsupported file format: {suffix or path}")
