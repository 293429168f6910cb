"""Exact top-k search by inner product with a pivot-distance index.

Vectors of different lengths are brought onto one sphere by an extra coordinate, so that the largest
inner product with a query belongs to the smallest distance from it. Each vector is keyed by its
nearest pivot and its distance from that pivot, and the table is sorted by this key: a block of it is
a set of annuli around pivots. A query first looks into the annuli of its own pivot next to its own
distance, which gives it a k-th best score. By the triangle inequality a better vector must lie, for
every pivot, in an annulus whose distances differ from the query's by no more than that score
allows. Only these are expanded.

Pivots are a bounded sample. All else covers every vector; queries and vectors meet in blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.common import rows_of
from tabprep.scratch import materialize

#: Pivots, vectors they are chosen from, vectors of an index block, and queries of a query block.
PIVOTS, SAMPLE, BLOCK, QUERY_BLOCK = 16, 2000, 8192, 1024


def _pad(vectors: list, dimensions: int, kind: type = np.float64) -> np.ndarray:
    out = np.zeros((len(vectors), dimensions), kind)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _lift(x: np.ndarray, square: float) -> np.ndarray:
    """The vectors with the coordinate that gives all of them the same length."""
    return np.column_stack([x, np.sqrt(np.maximum(square - (x * x).sum(axis=1), 0))])


def _pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Sample vectors far from each other, chosen one by one."""
    chosen = [0]
    nearest = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(sample)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * x @ pivots.T, 0))


def _chunks(batches, size, *columns):
    rows = []
    for row in rows_of(batches, *columns):
        rows.append(row)
        if len(rows) >= size:
            yield rows
            rows = []
    if rows:
        yield rows


def _keyed(batches, pivots, square, dimensions):
    for rows in _chunks(batches, BLOCK, "vec_id", "v"):
        x = _pad([v for _, v in rows], dimensions)
        d = _distances(_lift(x, square), pivots)
        cell = d.argmin(axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in rows], pa.int64()), pa.array([v for _, v in rows], pa.list_(pa.int64())),
             pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell])],
            ["vec_id", "v", "cell", "d"],
        )


_PACKED = "cell int, low double, high double, n int, ids binary, x binary"


def _packed(batches, size, dimensions, kind):
    """Blocks of vectors of one cell, in the order of their distance from its pivot."""

    def block(rows):
        ids = np.array([r[0] for r in rows], np.int64)
        return {"cell": rows[0][2], "low": rows[0][3], "high": rows[-1][3], "n": len(rows), "ids": ids.tobytes(), "x": _pad([r[1] for r in rows], dimensions, kind).tobytes()}

    schema = pa.schema([("cell", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("n", pa.int32()), ("ids", pa.binary()), ("x", pa.binary())])
    rows = []
    for row in rows_of(batches, "vec_id", "v", "cell", "d"):
        if rows and (row[2] != rows[0][2] or len(rows) >= size):
            yield pa.RecordBatch.from_pylist([block(rows)], schema)
            rows = []
        rows.append(row)
    if rows:
        yield pa.RecordBatch.from_pylist([block(rows)], schema)


def _best(batches, k, dimensions, kind):
    """The k best of each index block for each query of a block, unless they are worse than ``floor``."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    none = np.iinfo(np.int64).min if kind is np.int64 else -np.inf
    for q_ids, q_x, floors, ids, x in rows_of(batches, "q_ids", "q_x", "floors", "ids", "x"):
        q_ids, ids = np.frombuffer(q_ids, np.int64), np.frombuffer(ids, np.int64)
        q, x = np.frombuffer(q_x, kind).reshape(len(q_ids), dimensions), np.frombuffer(x, kind).reshape(len(ids), dimensions)
        floor = np.frombuffer(floors, kind) if floors else np.full(len(q_ids), none, kind)
        by_id = np.argsort(ids, kind="stable")
        ids, x = ids[by_id], x[by_id]
        for at in range(0, len(q_ids), 256):
            part = slice(at, at + 256)
            scores = q[part] @ x.T
            scores[q_ids[part, None] == ids] = none
            scores[scores < floor[part, None]] = none
            # The k-th best of a row, and all that reach it; ties are settled by the smaller id, which comes first.
            best = np.argsort(~scores if kind is np.int64 else -scores, axis=1, kind="stable")[:, :k]
            found = np.take_along_axis(scores, best, axis=1)
            row, col = np.nonzero(found != none)
            if len(row):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[part][row]), pa.array(ids[best[row, col]]), pa.array(found[row, col].astype(np.int64))], schema=schema
                )


def _rounding(square: float, dimensions: int) -> float:
    """A bound of the rounding error of a squared distance of vectors whose squares add up to ``square``."""
    return 8 * (dimensions + 4) * float(np.finfo(np.float64).eps) * square


def _expansions(batches, pivots, square, dimensions, kind):
    """For each query block and pivot the annulus, from ``low_d`` to ``high_d``, that can hold better vectors."""
    schema = pa.schema(
        [("block", pa.int64()), ("cell", pa.int32()), ("low_d", pa.float64()), ("high_d", pa.float64()), ("q_ids", pa.binary()), ("q_x", pa.binary()), ("floors", pa.binary())]
    )
    for block, ids, x, known in rows_of(batches, "block", "ids", "x", "known"):
        ids_ = np.frombuffer(ids, np.int64)
        q = np.frombuffer(x, kind).reshape(len(ids_), dimensions).astype(np.float64)
        score = {r["query_id"]: r["kth"] for r in known or []}
        least = np.iinfo(np.int64).min if kind is np.int64 else -np.inf
        floors = np.array([score.get(i, least) for i in ids_.tolist()], kind)
        unknown = np.array([i not in score for i in ids_.tolist()])
        square_q = (q * q).sum(axis=1)
        # Squared distance of a vector with the k-th best score; more, for the rounding of it and of both distances.
        error = _rounding(2 * (square + square_q), dimensions)
        reach = np.maximum(square_q + square - 2 * floors.astype(np.float64), 0) + error
        radius = np.where(unknown, np.inf, np.sqrt(reach) + 2 * np.sqrt(error)) + 1e-6
        d = _distances(np.column_stack([q, np.zeros(len(q))]), pivots)
        for cell in range(len(pivots)):
            yield pa.RecordBatch.from_pylist(
                [{"block": block, "cell": cell, "low_d": float((d[:, cell] - radius).min()), "high_d": float((d[:, cell] + radius).max()),
                  "q_ids": ids, "q_x": x, "floors": floors.tobytes()}], schema,
            )


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5, pivots: int = PIVOTS) -> DataFrame:
    """For each query its ``k`` vectors with the largest inner product: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Both tables have ``vec_id`` (bigint) and ``v`` (array of bigint). A query is not compared with the vector of
    its own id; ties go to the smaller id; a query with fewer candidates gets all of them. Shorter vectors count
    as padded with zeros. Rows without an id or vector, or with a null component, take no part; of rows that
    repeat an id one counts, the one with the smallest vector. Other columns are ignored, and without queries or
    candidates the result is empty.

    Scores are exact: products are formed in doubles where the lengths of the vectors prove all sums to stay below
    2**53, in 64-bit integers where they prove them to stay below 2**63, and are refused with an error beyond.
    """
    spark = vectors.sparkSession

    def valid(df: DataFrame) -> DataFrame:
        df = df.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("v").cast("array<bigint>").alias("v"))
        return df.dropna().filter(~F.exists("v", lambda x: x.isNull())).groupBy("vec_id").agg(F.min("v").alias("v"))

    table, asked = materialize(valid(vectors)), materialize(valid(queries))
    length = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    sizes = table.agg(F.max(F.size("v")).alias("n"), F.max(length).alias("square"), F.count("*").alias("rows")).first()
    asked_sizes = asked.agg(F.max(F.size("v")).alias("n"), F.max(length).alias("square"), F.count("*").alias("rows")).first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if not sizes.rows or not asked_sizes.rows:
        return empty
    dimensions = max(sizes.n, asked_sizes.n, 1)
    square = float(sizes.square)
    # No partial sum of a product exceeds the product of the lengths; a little more, for its own rounding.
    largest = (square * float(asked_sizes.square)) ** 0.5 * (1 + 1e-9)
    if largest >= 2.0**63:
        raise ValueError(f"inner products may reach {largest:.4g}, which a bigint score cannot hold")
    kind = np.float64 if largest < 2.0**53 and max(square, float(asked_sizes.square)) < 2.0**106 else np.int64
    sample = table.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    handed = spark.sparkContext.broadcast(_pivots(_lift(_pad([r.v for r in sample], dimensions), square), pivots))

    def blocks(df: DataFrame, rows: int, size: int) -> DataFrame:
        keyed = df.mapInArrow(lambda b: _keyed(b, handed.value, square, dimensions), "vec_id bigint, v array<bigint>, cell int, d double")
        parts = max(1, -(-rows // (4 * size)))
        ranged = keyed.repartitionByRange(parts, "cell", "d", "vec_id").sortWithinPartitions("cell", "d", "vec_id")
        packed = ranged.mapInArrow(lambda b: _packed(b, size, dimensions, kind), _PACKED)
        return materialize(packed.withColumn("block", F.monotonically_increasing_id()))

    index, query_blocks = blocks(table, sizes.rows, BLOCK), blocks(asked, asked_sizes.rows, QUERY_BLOCK)
    product = "query_id bigint, vec_id bigint, score bigint"

    def best(pairs: DataFrame) -> DataFrame:
        pairs = pairs.select("q_ids", "q_x", "floors", "ids", "x")
        return pairs.mapInArrow(lambda b: _best(b, k, dimensions, kind), product)

    # The block of the own pivot that is next to the query block's distances.
    own = query_blocks.selectExpr("block", "cell", "low AS q_low", "high AS q_high", "ids AS q_ids", "x AS q_x", "CAST(NULL AS BINARY) AS floors")
    gap = "greatest(low - q_high, q_low - high, 0D)"
    near = own.select("block", "cell", "q_low", "q_high").join(index.select("cell", "low", "high", F.col("block").alias("at")), "cell")
    near = near.groupBy("block").agg(F.expr(f"min_by(at, struct({gap}, abs(low + high - q_low - q_high), at))").alias("at"))
    near = materialize(near)
    first = own.join(near, "block").join(index.select(F.col("block").alias("at"), "ids", "x"), "at")
    first = materialize(best(first))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = first.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    located = asked_in(query_blocks).join(kth, "query_id")
    known = located.groupBy("block").agg(F.collect_list(F.struct("query_id", "kth")).alias("known"))
    expanded = query_blocks.select("block", "ids", "x").join(known, "block", "left").mapInArrow(
        lambda b: _expansions(b, handed.value, square, dimensions, kind),
        "block bigint, cell int, low_d double, high_d double, q_ids binary, q_x binary, floors binary",
    )
    # Blocks that were looked into first need not be met again.
    annuli = expanded.join(index.withColumnRenamed("block", "at"), "cell").filter("low <= high_d AND high >= low_d")
    annuli = annuli.join(near, ["block", "at"], "left_anti")
    found = first.union(best(annuli))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def asked_in(query_blocks: DataFrame) -> DataFrame:
    """``query_id`` and ``block`` of every query in the blocks."""

    def unpack(batches):
        for block, ids in rows_of(batches, "block", "ids"):
            found = np.frombuffer(ids, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.full(len(found), block))], ["query_id", "block"])

    return query_blocks.select("block", "ids").mapInArrow(unpack, "query_id bigint, block bigint")


def whole_numbers(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", factor: int = 256) -> DataFrame:
    """``vec_id`` and ``v``, the components ``x`` as ``floor(factor * x)``.

    Vectors that are null or hold null or non-finite components are left out. Components beyond 64 bits become the
    largest or smallest bigint, which ``top_k`` refuses where it could matter.
    """
    x = F.transform(F.col(vector_column), lambda c: c.cast("double"))
    rows = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), x.alias("x")).filter(F.col("x").isNotNull())
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = rows.filter(~bad)
    return rows.select("vec_id", F.transform("x", lambda c: F.floor(c * factor)).alias("v"))
