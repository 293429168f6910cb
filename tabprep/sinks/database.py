"""Writing to a database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tabprep.sinks.files import counted

# What to do when the table exists -> writer mode.
IF_EXISTS = {"fail": "error", "replace": "overwrite", "append": "append"}


def jdbc_options(
    url: str, table: str, schema: str | None = "staging", chunk_size: int = 10000, properties: Mapping[str, str] | None = None
) -> dict[str, str]:
    name = f"{schema}.{table}" if schema else table
    return {**dict(properties or {}), "url": url, "dbtable": name, "batchsize": str(chunk_size)}


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    schema: str | None = "staging",
    if_exists: str = "append",
    chunk_size: int = 10000,
    connections: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> int:
    """Write a frame to a table and return the row count.

    Every partition opens one connection; ``connections`` bounds them for a small database. The
    database schema must exist.
    """
    if if_exists not in IF_EXISTS:
        raise ValueError(f"if_exists must be one of {', '.join(IF_EXISTS)}, not {if_exists!r}")
    options = jdbc_options(url, table, schema, chunk_size, properties)
    if connections is not None:
        options["numPartitions"] = str(connections)
    rows, seen = counted(df)
    rows.write.format("jdbc").options(**options).mode(IF_EXISTS[if_exists]).save()
    return seen.get["records"]
