"""Star schema: dense keys, dimensions and fact tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.dates import as_date
from tabprep.scratch import BUCKET, cut_ranges, materialize, null_safe_join, place_of

# Dimension name -> (columns in the ledger, name of its key in the fact table).
DIMENSIONS = {
    "account": (("AccountCode", "AccountName"), "account_key"),
    "department": (("Department",), "department_key"),
    "cost_center": (("CostCenter",), "cost_center_key"),
    "entity": (("Entity",), "entity_key"),
    "scenario": (("Scenario",), "scenario_key"),
}


def dense_key(
    df: DataFrame, key: str, order_by: Sequence[str], partition_by: Sequence[str] = (), unique: bool = False
) -> DataFrame:
    """Number the rows 1..N in ``order_by`` order, per partition if there are some.

    A window over all rows would send them through one task. Rows are cut into ranges instead;
    each range numbers its own rows and adds the row count of the ranges before it. ``unique``
    says that no two rows tie.
    """
    groups = list(partition_by)
    ranged = cut_ranges(df, [*groups, *order_by], unique)
    before = Window.partitionBy(*groups).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(BUCKET, *groups)
        .agg(F.count("*").alias("n"))
        .select(BUCKET, *groups, F.sum("n").over(before).alias("_offset"))
        .where(F.col("_offset").isNotNull())
    )
    inside = Window.partitionBy(BUCKET, *groups).orderBy(*order_by, *place_of(ranged))
    # Only a partition that goes on from an earlier range has an offset: fewer rows than ranges.
    numbered = null_safe_join(ranged, F.broadcast(offsets), [BUCKET, *groups]).withColumn(
        key, F.coalesce("_offset", F.lit(0)) + F.row_number().over(inside)
    )
    return numbered.select(key, *df.columns)


def hash_key(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """64-bit hash key: no exchange at all, but not proof against collisions in very large tables."""
    return df.select(F.xxhash64(*columns).alias(key), *df.columns)


def to_tender_fact(df: DataFrame, source_file: str = "", load_timestamp: str | None = None) -> DataFrame:
    """Fact rows of the tender register with a dense ``tender_key`` in ``TenderID`` order.

    ``df`` is the register with calculated fields. The load time is one value per run.
    """
    loaded = F.current_timestamp() if load_timestamp is None else F.lit(load_timestamp).cast("timestamp")
    start, end = as_date("ProjectStartDate"), as_date("ProjectEndDate")
    rows = df.select(
        F.col("TenderID").alias("tender_id"),
        F.col("ProjectName").alias("project_name"),
        F.col("ClientName").alias("client_name"),
        F.col("BusinessDivision").alias("business_division"),
        F.col("TenderStatus").alias("tender_status"),
        as_date("TenderReceivedDate").alias("tender_received_date"),
        as_date("TenderSubmissionDate").alias("tender_submission_date"),
        start.alias("project_start_date"),
        end.alias("project_end_date"),
        F.col("TenderValue").alias("tender_value"),
        F.col("ReportingValue").alias("reporting_value"),
        F.col("ProbabilityPercentage").alias("probability"),
        F.col("WeightedValue").alias("weighted_value"),
        F.col("ActionOwner").alias("action_owner"),
        F.col("MonthlyForecast").alias("monthly_forecast"),
        F.col("QuarterlyForecast").alias("quarterly_forecast"),
        F.datediff(end, start).cast("bigint").alias("project_duration_days"),
        F.col("ProjectDurationMonths").alias("project_duration_months"),
        F.col("MonthlySpread").alias("monthly_spread"),
        F.col("QuarterlySpread").alias("quarterly_spread"),
        F.col("IsActive").alias("is_active"),
        F.col("HasMissingDates").alias("has_missing_dates"),
        F.lit(source_file).alias("source_file"),
        loaded.alias("load_timestamp"),
    )
    return dense_key(rows, "tender_key", ["tender_id"])


def dimensions(df: DataFrame, names: Sequence[str] = tuple(DIMENSIONS)) -> dict[str, DataFrame]:
    """Distinct members of each dimension with dense keys in member order, written down.

    One pass collects the members of all dimensions: their combinations are reduced on the map
    side, so what is exchanged is those and not the rows, and only they are expanded to grouping sets. Being tables of known size, the
    results are broadcast by Spark where they fit the threshold and exchanged where they do not.
    """
    columns = [c for name in names for c in DIMENSIONS[name][0]]
    sets = [list(DIMENSIONS[name][0]) for name in names]
    members = df.select(*columns).distinct().groupingSets(sets, *columns).agg(F.grouping_id().alias("_set"))
    # The rows are aggregated once; members are numbered from the written result.
    numbered = materialize(dense_key(materialize(members), "_key", columns, ["_set"], unique=True), ("_set",))
    result = {}
    for name, kept in zip(names, sets, strict=True):
        # Bits of the grouping id, first column highest, mark the columns left out.
        number = int("".join("0" if c in kept else "1" for c in columns), 2)
        result[name] = numbered.where(F.col("_set") == number).select(F.col("_key").alias(DIMENSIONS[name][1]), *kept)
    return result


def register_members(members: DataFrame, columns: Sequence[str], key: str, path: str, version: int) -> DataFrame:
    """Stable keys: the registry of all members seen so far, kept as Parquet below ``path``.

    Members of ``columns`` that the registry has keep their keys; new ones get the numbers after the highest, in
    member order. What a load adds is a file folder of its own, ``version=<n>``, and nothing else is written
    again, so old facts go on pointing at the same members. Loads are numbered from 1 by the caller, one at a
    time; a load that is repeated under its number replaces what it had added, and gives the same keys. Null
    members are members; repeated ones count once.
    """
    spark = members.sparkSession
    schema = T.StructType([T.StructField(key, T.LongType()), *(members.schema[c] for c in columns), T.StructField("version", T.IntegerType())])
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        files.mkdirs(folder)
    known = spark.read.schema(schema).option("basePath", path).parquet(path).filter(F.col("version") < version)
    highest = known.agg(F.max(key)).first()[0] or 0
    distinct = members.select(*columns).distinct()
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}"))
    unseen = materialize(distinct.alias("new").join(known.alias("old"), same, "left_anti"))
    numbered = dense_key(unseen, key, columns, unique=True).withColumn(key, (F.col(key) + highest).cast("bigint"))
    numbered.write.mode("overwrite").parquet(f"{path}/version={version}")
    return spark.read.schema(schema).option("basePath", path).parquet(path).filter(F.col("version") <= version).drop("version")


def dimension(df: DataFrame, name: str) -> DataFrame:
    """One dimension alone."""
    return dimensions(df, [name])[name]


def to_transaction_fact(df: DataFrame, dims: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Fact rows of the ledger: integer keys, local and converted amount, rate.

    ``df`` is the ledger after currency conversion. The transaction key is dense in the order of
    the transaction id; the other columns only settle the order of repeated ids.
    """
    dims = dims or dimensions(df)
    fact = df
    for name, (columns, _) in DIMENSIONS.items():
        fact = null_safe_join(fact, dims[name], columns)
    rows = fact.select(
        "TransactionID",
        F.date_format(as_date("Date"), "yyyyMMdd").cast("int").alias("date_key"),
        *[key for _, key in DIMENSIONS.values()],
        F.col("AmountLocal").alias("amount_local"),
        F.col("AmountEUR").alias("amount_eur"),
        F.col("FXRateUsed").alias("fx_rate"),
    )
    # Cuts and offsets are found from the written rows: joins and conversion are done once.
    return dense_key(materialize(rows), "transaction_key", rows.columns).drop("TransactionID")
