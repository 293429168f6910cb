"""Intermediate tables that outlive the executors which wrote them.

A few operators have to fix a range partitioning, or cut a growing plan, before they go on. They
write the rows to the shared folder named by ``spark.checkpoint.dir`` and read them back, so a
lost executor costs a re-read and nothing is kept on a worker's own disk.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, TimestampType

BUCKET = "_bucket"
PLACE = ["_file", "_row"]
TIE = "_tie"
#: Bytes of written rows, and rows, that a range holds at most, about.
RANGE_BYTES, RANGE_ROWS = 256 << 20, 4 << 20


# Application -> folder, for local runs that name none.
_local_roots: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _local_roots:
            _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="tabprep-")
        root = _local_roots[context.applicationId]
    return f"{root.rstrip('/')}/tabprep/{context.applicationId}"


def materialize(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a frame to the scratch folder and read it back with its exact size known."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    if (passing := _passing.get()) is not None:
        passing.append(path)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> bool:
    """Delete this application's intermediate tables."""
    return _delete(spark, scratch_dir(spark))


def _delete(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.delete(path, True)


# The intermediate tables written so far within ``passing``.
_passing: ContextVar[list[str] | None] = ContextVar("_passing", default=None)
#: Whether Spark deletes the shuffle files of a query when it ends, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """A block whose frames are all settled within it: what they have written and exchanged goes when they are done."""
    before, token = spark.conf.get(_CLEANUP, None), _passing.set(written := [])
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        _passing.reset(token)
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
        for path in written:
            _delete(spark, path)


def range_buckets(df: DataFrame, order_by: Sequence[str], unique: bool = False) -> DataFrame:
    """Rows cut into ranges of the sort key, the number of the range kept in ``_bucket``.

    Spark samples the key to find the cuts, so ranges hold similar numbers of rows. There are at
    most as many as shuffle partitions, and adjacent small ones are merged by adaptive execution,
    unless the rows ask for more: they are written down first, and a range holds ``RANGE_BYTES`` of
    them or ``RANGE_ROWS``, about, whichever is less, since a range may have to fit one pandas frame.
    Unless the key is known to be ``unique``, the rows' place in
    the files, ``_file`` and ``_row``, ends the key: equal keys, were they a third of all rows,
    then spread over ranges like any others, and the resulting order is total. The numbers are
    written down with the rows because a second run of the same exchange may sample other cuts.
    """
    order = list(order_by)
    df = materialize(df)
    # Both are known from the files.
    wanted = max(-(-_written_bytes(df) // RANGE_BYTES), -(-df.count() // RANGE_ROWS))
    number = [wanted] if wanted > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []
    if not unique:
        df = df.select("*", F.col("_metadata.file_name").alias(PLACE[0]), F.col("_metadata.row_index").alias(PLACE[1]))
        order += PLACE
    return materialize(df.repartitionByRange(*number, *order).withColumn(BUCKET, F.spark_partition_id()))


#: Rows that are drawn for each range to find the cuts, and most ranges: cuts become part of the plan.
DRAWN, MOST_RANGES = 64, 2000


def cut_ranges(df: DataFrame, order_by: Sequence[str], unique: bool = False) -> DataFrame:
    """Rows with the number of their range of the sort key in ``_bucket``; nothing is exchanged or written.

    The cuts are found once, from rows drawn by hash, and put into the plan as literals. So a row's range is an
    expression of the row alone: every pass over the frame, on whatever executor, finds the same one, and counts
    or edges per range are plain aggregates that combine on the map side. ``df`` must give the same rows each
    time it is computed.

    Unless the key is ``unique``, a hash of all columns, ``_tie``, ends it, so that equal keys spread over ranges
    too. Rows that are equal in all columns stay together; where the drawn rows show that they would fill more
    than a range, ``range_buckets`` is used, which tells them apart by their place in written files.
    Cuts hold no more columns than it takes to tell them apart: rows that agree in those fill less than two ranges.
    Ranges are sized by the estimated bytes of the rows, ``RANGE_BYTES`` each, and are as many as shuffle
    partitions at least.
    """
    spark = df.sparkSession
    order = list(order_by)
    keyed = df
    if not unique:
        keyed, order = df.withColumn(TIE, F.xxhash64(*df.columns)), [*order, TIE]
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    seen = Observation()
    pool = DRAWN * min(least, MOST_RANGES)
    # Equal rows have equal hashes and would enter or miss the draw together, so the draw is by chance.
    # Times come to the driver as numbers: as clock times two of them could change places.
    types = [keyed.schema[c].dataType for c in order]
    keys = [(F.unix_micros(c) if isinstance(t, TimestampType) else F.col(c)).alias(c) for c, t in zip(order, types, strict=True)]
    types = [LongType() if isinstance(t, TimestampType) else t for t in types]
    drawn = keyed.select(*keys).observe(seen, F.count(F.lit(1)).alias("rows")).orderBy(F.rand(7)).limit(pool)
    rows = drawn.orderBy(*order).collect()
    row_bytes = sum(20 if isinstance(f.dataType, StringType | BinaryType) else 8 for f in df.schema) + 8
    wanted = min(MOST_RANGES, max(least, -(-seen.get["rows"] * row_bytes // RANGE_BYTES)))
    step = max(1, len(rows) // wanted)
    picked = rows[step::step][: wanted - 1] if len(rows) > step else []
    if any(a == b for a, b in zip(picked, picked[1:])):
        return range_buckets(df, order_by, unique)
    if not picked:
        # One range; were it a literal, joins on it would lose their only key.
        return keyed.withColumn(BUCKET, F.pmod(F.xxhash64(*order), F.lit(1)).cast("int"))
    # As texts NaN equals itself, too.
    widths = (w for w in range(1, len(order)) if all(a[:w] != b[:w] and str(a[:w]) != str(b[:w]) for a, b in zip(picked, picked[1:])))
    width = next(widths, len(order))
    cuts = [F.struct(*(F.lit(row[i]).cast(types[i]).alias(order[i]) for i in range(width))) for row in picked]
    return keyed.withColumn(BUCKET, _range_of(F.struct(*keys[:width]), cuts, 0, len(cuts)))


def _range_of(key: Column, cuts: list[Column], low: int, high: int) -> Column:
    """Number of cuts that do not exceed the key, as a tree of comparisons."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(key < cuts[middle], _range_of(key, cuts, low, middle)).otherwise(_range_of(key, cuts, middle + 1, high))


def _written_bytes(df: DataFrame) -> int:
    """Size of the files of a frame that ``materialize`` has returned, as the file system reports it."""
    sizes = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s")).distinct()
    return sizes.agg(F.sum("s")).first()[0] or 0


def place_of(ranged: DataFrame) -> list[str]:
    """The columns that settle the order of equal keys in a range table."""
    return [c for c in (TIE, *PLACE) if c in ranged.columns]


def unused(name: str, *columns: Sequence[str]) -> str:
    """The name, with as many underscores before it as it takes to be none of the columns, in whatever case."""
    taken = {c.lower() for some in columns for c in some}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def null_safe_join(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str = "left") -> DataFrame:
    """Join on columns of equal name, nulls matching each other; the columns are kept once."""
    names = {c: f"_right_{c}" for c in columns}
    same = F.lit(True)
    for c, renamed in names.items():
        same = same & F.col(c).eqNullSafe(F.col(renamed))
    joined = left.join(right.withColumnsRenamed(names), same, how)
    if how == "full_outer":
        joined = joined.withColumns({c: F.coalesce(F.col(c), F.col(renamed)) for c, renamed in names.items()})
    return joined.drop(*names.values())
