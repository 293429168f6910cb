"""Pages of an OData service that were landed as JSON files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.contracts import OPPORTUNITY
from tabprep.scratch import materialize


def read_odata_rows(
    spark: SparkSession,
    path: str,
    schema: T.StructType = OPPORTUNITY,
    filter: Column | str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """All records of all pages under ``path`` that pass the filter.

    A page is an object with a ``value`` array and maybe an ``@odata.nextLink``. Pages are one per
    line, or with ``multi_line`` one per file in any layout.
    """
    page = T.StructType([T.StructField("value", T.ArrayType(schema))])
    pages = spark.read.schema(page).option("multiLine", multi_line).json(path)
    rows = pages.select(F.inline("value"))
    return rows if filter is None else rows.where(filter)


def read_odata_pages(
    spark: SparkSession,
    path: str,
    schema: T.StructType = OPPORTUNITY,
    filter: Column | str | None = None,
    select: Sequence[str] | None = None,
    top: int | None = None,
    order_by: Sequence[str] = ("opportunityid",),
    multi_line: bool = False,
) -> DataFrame:
    """All matching records, or the first ``top`` of them in key order.

    That cut is a distributed top-k: every task keeps at most ``top`` rows.
    """
    rows = read_odata_rows(spark, path, schema, filter, multi_line)
    if top is not None:
        rows = rows.orderBy(*order_by).limit(top)
    return rows.select(*select) if select else rows


def follow_links(pages: DataFrame, starts: DataFrame) -> DataFrame:
    """Where each page lies on the chains of links that begin at the start pages.

    ``pages`` has a row ``(address, next)`` per landed page, ``next`` null at the end of a chain; ``starts`` has
    distinct rows ``(chain, address)``. Returns a row per chain and page that it reaches, and one per page that no
    chain reaches: ``chain``, ``address``, ``position`` (from 0), ``status``. The status is ``read``, ``missing`` (a
    link or start names a page that was not landed), ``cycle`` (read, and its link leads back to a page of the same
    chain), or ``orphan`` (landed but not reached, chain and position null). Pages without an address are left
    out; of pages that repeat an address the one with the least link counts, nulls last.

    Links are followed by pointer doubling: each round joins the reached pages with jumps twice as long, so a
    chain of n pages takes log2(n) rounds of joins over one narrow row per page, and no task walks a chain.
    """
    pages = materialize(pages.filter("address is not null").groupBy("address").agg(F.min("next").alias("next")))
    reached = materialize(starts.select("chain", "address", F.lit(0).cast("bigint").alias("position")))
    # The page that 2 ** k links lead to; a jump that leaves the landed pages ends there.
    jumps, length, before = materialize(pages.filter("next is not null").select("address", F.col("next").alias("to"))), 1, 0
    count = reached.count()
    while count > before:
        onward = reached.join(jumps, "address").select("chain", F.col("to").alias("address"), (F.col("position") + length).alias("position"))
        # On a cycle a page is met again and again; its first position counts.
        reached = materialize(reached.union(onward).groupBy("chain", "address").agg(F.min("position").alias("position")))
        further = jumps.select(F.col("address").alias("to"), F.col("to").alias("beyond"))
        jumps = materialize(jumps.join(further, "to").select("address", F.col("beyond").alias("to")))
        length, before, count = 2 * length, count, reached.count()
    placed = reached.join(pages.withColumn("landed", F.lit(True)), "address", "left")
    # A link leads back if the page that it names was reached no later.
    named = reached.select("chain", F.col("address").alias("next"), F.col("position").alias("next_position"))
    placed = placed.join(named, ["chain", "next"], "left")
    status = F.when(F.col("landed").isNull(), "missing").when(F.col("next_position") <= F.col("position"), "cycle").otherwise("read")
    placed = placed.select("chain", "address", "position", status.alias("status"))
    orphans = pages.join(reached, "address", "left_anti").select(
        F.lit(None).cast(starts.schema["chain"].dataType).alias("chain"), "address", F.lit(None).cast("bigint").alias("position"), F.lit("orphan").alias("status")
    )
    return placed.union(orphans)


def read_odata_chains(
    spark: SparkSession,
    path: str,
    starts: DataFrame,
    schema: T.StructType = OPPORTUNITY,
    address: str = "@odata.context",
    strict: bool = True,
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The records of the pages that chains of ``@odata.nextLink`` reach, and the report of ``follow_links``.

    Every landed page names the address it was read from in the field ``address``. Records get the columns
    ``chain`` and ``position``. Pages that no chain reaches are left out; a missing page or a cycle is an error
    unless ``strict`` is off, as the records would be incomplete. Of pages landed twice under one address each
    record comes twice, as they cannot be told apart.
    """
    fields = [T.StructField(address, T.StringType()), T.StructField("@odata.nextLink", T.StringType()), T.StructField("value", T.ArrayType(schema))]
    pages = spark.read.schema(T.StructType(fields)).option("multiLine", multi_line).json(path)
    pages = pages.select(F.col(f"`{address}`").alias("address"), F.col("`@odata.nextLink`").alias("next"), "value")
    report = materialize(follow_links(pages.select("address", "next"), starts))
    broken = report.filter("status in ('missing', 'cycle')").limit(5).collect()
    if strict and broken:
        raise ValueError("incomplete pages: " + ", ".join(f"{r.status} {r.address}" for r in broken))
    reached = report.filter("status in ('read', 'cycle')").select("chain", "position", "address")
    return pages.join(reached, "address").select("chain", "position", F.inline("value")), report


def count_odata_rows(rows: DataFrame) -> DataFrame:
    """Number of records before any cut, as one row."""
    return rows.agg(F.count("*").alias("count"))
