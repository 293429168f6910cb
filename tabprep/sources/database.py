"""Queries and table descriptions."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession


def read_query(
    spark: SparkSession,
    query: str,
    params: Mapping[str, object] | None = None,
    url: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Result of a query with ``:name`` parameters.

    Without ``url`` it runs in Spark, which binds the parameters. With one the database runs it;
    pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` with
    ``dbtable`` in ``options`` to read a large table in parallel. Errors are raised.
    """
    if url is None:
        return spark.sql(query, args=dict(params or {}))
    reader = spark.read.format("jdbc").option("url", url).options(**dict(options or {}))
    if "dbtable" not in (options or {}):
        reader = reader.option("query", bind(query, params or {}))
    return reader.load()


def bind(query: str, params: Mapping[str, object]) -> str:
    """Put parameters into a query as SQL literals; quoted text in the query is left alone."""

    def value(match: re.Match[str]) -> str:
        if match.group(1) is None:
            return match.group(0)
        return sql_literal(params[match.group(1)])

    return re.sub(r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|::|(?<!\w):([A-Za-z_]\w*)", value, query)


def sql_literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int | float | Decimal):
        return str(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


def table_info(spark: SparkSession, table: str | DataFrame) -> DataFrame:
    """Column position, name, type and nullability of a catalog table or a frame."""
    df = table if isinstance(table, DataFrame) else spark.table(table)
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column string, type string, nullable boolean")
