"""Helpers shared by the operators of this folder: words, rolling hashes, components, bitmaps.

A word is a maximal run of bytes outside ``20 09-0D`` (hexadecimal), in every operator that works
on words. Hashes have 64 bits; that two different spans of one comparison agree by chance has a
probability of about 5e-20.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.scratch import materialize

#: Rows that a task puts into one Arrow batch of its output.
BATCH_ROWS = 100_000
#: Bits of a membership bitmap: one megabyte, whatever the input.
BITMAP_BITS = 1 << 23

_STEP = np.uint64(0x9E3779B97F4A7C15)
_KEPT_POWERS = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
_INVERSE = np.uint64(pow(int(_STEP), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the step and of its inverse, modulo 2**64."""
    kept = _powers.get("up")
    if kept is None or len(kept) < n:
        size = max(n, min(_KEPT_POWERS, 1 << 16 if kept is None else 2 * len(kept)))
        up, down = np.full(size, _STEP), np.full(size, _INVERSE)
        up[0] = down[0] = 1
        np.multiply.accumulate(up, out=up)
        np.multiply.accumulate(down, out=down)
        if size > _KEPT_POWERS:
            return up[:n], down[:n]
        _powers["up"], _powers["down"] = up, down
    return _powers["up"][:n], _powers["down"][:n]


class Words:
    """The words of a text, joined by one space, with the byte range of each."""

    def __init__(self, data: bytes | None, lower: bool = False):
        data = data or b""
        self.words = (data.lower() if lower else data).split()
        self.n = len(self.words)
        self.joined = b" ".join(self.words)
        self._sums = None

    def _prepare(self) -> None:
        codes = np.frombuffer(self.joined, np.uint8)
        gaps = np.flatnonzero(codes == 32)
        self.starts = np.concatenate(([0], gaps + 1))
        self.ends = np.concatenate((gaps, [len(codes)]))
        up, self._down = _power_tables(len(codes) + 1)
        self._sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_BYTES[codes] * up[:-1], out=self._sums[1:])

    def hashes(self, first: np.ndarray, size: int) -> np.ndarray:
        """Hash of ``size`` consecutive words for each number of a first word."""
        if self._sums is None:
            self._prepare()
        a, b = self.starts[first], self.ends[first + size - 1]
        h = (self._sums[b] - self._sums[a]) * self._down[a]
        return mix(h + (b - a).astype(np.uint64) * _STEP)


def shingles(words: Words, size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``size`` words; of the whole text if it has fewer words."""
    if not words.n:
        return np.empty(0, np.uint64)
    size = min(size, words.n)
    return np.unique(words.hashes(np.arange(words.n - size + 1), size))


def rows_of(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Values of the named columns, row by row; texts come as UTF-8 bytes.

    Few rows at a time become Python objects, as texts may be long.
    """
    for batch in batches:
        places = [batch.schema.get_field_index(name) for name in columns]
        for at in range(0, batch.num_rows, 64):
            taken = []
            for column in (batch.column(i).slice(at, 64) for i in places):
                if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
                    column = column.cast(pa.large_binary())
                taken.append(column.to_pylist())
            yield from zip(*taken, strict=True)
    # A worker is used again, by tasks that may need other memory than this one did.
    pa.default_memory_pool().release_unused()


class Output:
    """Collects rows, given as arrays per column, into Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema, limit: int = BATCH_ROWS):
        self.schema, self.limit = schema, limit
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.rows = 0

    def add(self, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(columns)
        self.rows += len(columns[0])
        if self.rows >= self.limit:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [np.concatenate(c) for c in zip(*self.parts, strict=True)]
            arrays = [pa.array(c, type=f.type) for c, f in zip(columns, self.schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)
            self.parts, self.rows = [], 0


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a few rows, so that what is made of them stays small beside them."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()


def bitmap(members: DataFrame, value: str) -> DataFrame:
    """Which of ``BITMAP_BITS`` slots the hashes of a column fall into, as ``(bucket, bits)``.

    Together the rows have one megabyte, whatever the input, so they can be handed to every task.
    """
    slot = _slot(F.col(value))
    rows = members.select(slot.alias("slot")).filter("slot is not null").groupBy(F.bitmap_bucket_number("slot").alias("_bucket"))
    return materialize(rows.agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("_bits")))


def _slot(value: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(value), 64 - (BITMAP_BITS.bit_length() - 1)) + F.lit(1).cast("bigint")


def likely(rows: DataFrame, value: str, found: DataFrame, without: bool = False) -> DataFrame:
    """The rows whose value is (most likely) a member of a bitmap, or those that surely are not.

    No member is missed; how many others pass depends on how full the bitmap is. The test is part of the plan,
    so that the rows that fail it are not handed to Python.
    """
    slot = _slot(F.col(value))
    place = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring("_bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    member = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    met = rows.join(F.broadcast(found), F.bitmap_bucket_number(slot) == F.col("_bucket"), "left")
    return met.filter(~member if without else member).drop("_bucket", "_bits")


def components(links: DataFrame) -> DataFrame:
    """Connected components of links ``(a, b)``: rows ``(node, component)``, the smallest node.

    Large and small stars alternate until every edge points from a node that has no other edge to the
    smallest node of its component, in a number of rounds that grows with the logarithm of the longest
    path. Each round is written to the scratch folder; only counts come to the driver. A node with very
    many links is met by aggregates and joins, which adaptive execution splits, and never by a window.
    """
    edges = materialize(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while not edges.isEmpty():
        sides = edges.union(edges.select("v", "u"))
        least = sides.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = sides.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.union(least).distinct())
        kinds = edges.selectExpr("u AS node", "1 AS out", "0 AS into").union(edges.selectExpr("v", "0", "1"))
        ends = kinds.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        if ends.filter("out > 1 or (out = 1 and into = 1)").isEmpty():
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
