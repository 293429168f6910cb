"""Conflict-constrained best-fit packing of documents into bins of fixed size.

Open bins of a shard are kept in the order of their free room, each with a bitmap of the sources and
one of the duplicate clusters it holds. A document goes to the tightest bin that has room and neither
its source nor its cluster: the search starts at the first bin with enough room and passes on from
one to the next until a bin is compatible, else it opens a new bin. Documents come by falling size.

Bins are filled within shards of a bounded number of documents, drawn by a hash, so that no task
meets more than a shard, whatever the input; how many documents have one source doesn't matter.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a bin, and documents of a shard (about).
CAPACITY, SHARD = 8192, 4096


def text_cluster(text: Column) -> Column:
    """Cluster of texts with the same words, but for case; null for a null or empty text."""
    words = F.trim(F.regexp_replace(F.lower(text), "[ \\t-\\r]+", " "))
    return F.when(words != "", F.xxhash64(words))


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each item; items of one bin differ in source and in cluster (None: no conflict)."""
    numbers: tuple[dict, dict] = ({}, {})
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    order: list[tuple[int, int]] = []
    held: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        bits = [0 if v is None else 1 << known.setdefault(v, len(known)) for known, v in zip(numbers, (sources[i], clusters[i]), strict=True)]
        at = bisect_left(order, (sizes[i], -1))
        while at < len(order) and (held[order[at][1]][0] & bits[0] or held[order[at][1]][1] & bits[1]):
            at += 1
        if at < len(order):
            room, b = order.pop(at)
        else:
            room, b = capacity, len(held)
            held.append([0, 0])
        bins[i], offsets[i] = b, capacity - room
        held[b][0] |= bits[0]
        held[b][1] |= bits[1]
        if room > sizes[i]:
            insort(order, (room - sizes[i], b))
    return bins, offsets


_PACKED = "doc_id bigint, part bigint, start bigint, n_bytes bigint, bin_id bigint, offset bigint"


def _pack_shard(capacity: int):
    def pack(key, table):
        order = [("doc_id", "ascending"), ("part", "ascending"), ("cluster", "ascending"), ("source", "ascending")]
        table = table.sort_by(order)
        bins, offsets = best_fit(*(table.column(c).to_pylist() for c in ("n_bytes", "source", "cluster")), capacity)
        base = key[0].as_py() << 32
        table = table.select(["doc_id", "part", "start", "n_bytes"])
        table = table.append_column("bin_id", pa.array([base + b for b in bins], pa.int64()))
        return table.append_column("offset", pa.array(offsets, pa.int64()))

    return pack


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    cluster: Column | None = None,
    shard: int = SHARD,
    size: Column | None = None,
) -> DataFrame:
    """Where each document lies: ``doc_id``, ``part``, ``start``, ``n_bytes``, ``bin_id``, ``offset``.

    Sizes are UTF-8 bytes. A text of more than ``capacity`` bytes is cut into parts (``start`` is the part's
    first byte in the text): full ones have a bin to themselves, with an odd number, and the rest is packed
    like any other text. Bins of packed parts have even numbers and never hold two parts of one source or
    cluster (texts with the same words, unless a ``cluster`` column is given); a null source or cluster
    conflicts with none. Null and empty texts need no room: one row with null bin and offset. Repeated rows
    are packed each by itself; other columns are ignored; an empty table gives an empty result. With a ``size``
    (bytes) and a ``cluster`` column the text itself is not needed.
    """
    size = F.coalesce(F.octet_length(F.col(text_column)) if size is None else size, F.lit(0)).cast("bigint")
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.col(source_column).cast("string").alias("source"),
        (text_cluster(F.col(text_column)) if cluster is None else cluster).cast("string").alias("cluster"),
        size.alias("size"),
        # Numbers rows apart, so that rows repeated many times spread over shards too.
        F.xxhash64(F.monotonically_increasing_id()).alias("row"),
    )
    empty = rows.filter("size = 0").selectExpr(
        "doc_id", "0L AS part", "0L AS start", "0L AS n_bytes", "CAST(NULL AS BIGINT) AS bin_id", "CAST(NULL AS BIGINT) AS offset"
    )
    full = rows.filter(f"size >= {capacity}").selectExpr("doc_id", "row", f"explode(sequence(0L, size div {capacity} - 1)) AS part")
    alone = full.selectExpr(
        "doc_id", "part", f"part * {capacity} AS start", f"{capacity}L AS n_bytes",
        # Odd, and distinct for the parts of all rows but with a probability of about rows^2 / 2^63.
        "xxhash64(row, part) | 1L AS bin_id", "0L AS offset",
    )
    rest = rows.filter(f"size % {capacity} > 0").selectExpr(
        "doc_id", f"size div {capacity} AS part", f"size - size % {capacity} AS start", f"size % {capacity} AS n_bytes", "source", "cluster", "row"
    )
    shards = max(1, -(-docs.count() // shard))
    rest = rest.withColumn("shard", F.pmod("row", F.lit(shards))).drop("row")
    packed = rest.groupBy("shard").applyInArrow(_pack_shard(capacity), _PACKED)
    packed = packed.withColumn("bin_id", F.col("bin_id") * 2)
    return packed.union(alone).union(empty)
