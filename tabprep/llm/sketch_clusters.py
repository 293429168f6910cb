"""Clusters of near duplicates from sketches, for callers that need no exact similarities.

Each document gives a fixed number of super-shingles, each the hash of the least values that a few random
functions take on its shingles. Documents that share a super-shingle are in one cluster. Of two documents
with similarity s a super-shingle of ``DEPTH`` values is shared with probability s ** DEPTH, so with ``BANDS``
of them a pair is met with probability 1 - (1 - s ** DEPTH) ** BANDS: 0.96 at s = 0.75, 0.9999 at 0.9, 0.32 at
0.5 and 0.002 at 0.2. One scan of the texts is all that it takes; then only sketches are moved.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import Words, components, mix, rows_of, shingles
from tabprep.scratch import materialize

WORDS, BANDS, DEPTH = 5, 12, 5
#: Shingles that are put under all functions at once.
_BLOCK = 1 << 13

_SKETCH = "doc_id bigint, source string, size bigint, key bigint, bands array<bigint>"


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    drawn = mix(np.arange(1, 2 * n + 1, dtype=np.uint64))
    return drawn[:n] | np.uint64(1), drawn[n:]


def sketch(found: np.ndarray, bands: int, depth: int) -> tuple[int, np.ndarray]:
    """A key of a set of shingles, equal for equal sets, and its super-shingles."""
    factors, added = _functions(bands * depth)
    least = np.full(len(factors), np.iinfo(np.uint64).max)
    for at in range(0, len(found), _BLOCK):
        # The high bits of a product depend on all bits of the hash.
        values = found[at : at + _BLOCK, None] * factors + added
        least = np.minimum(least, values.min(axis=0))
    rows = least.reshape(bands, depth)
    hashed = np.arange(bands, dtype=np.uint64)
    for k in range(depth):
        hashed = mix(hashed ^ rows[:, k])
    return int(mix(np.bitwise_xor.reduce(mix(found), keepdims=True) + np.uint64(len(found))).view(np.int64)[0]), hashed.view(np.int64)


def _sketches(batches, words, bands, depth):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("source", pa.string()), ("size", pa.int64()), ("key", pa.int64()), ("bands", pa.list_(pa.int64()))]
    )
    rows = []
    for doc_id, source, text in rows_of(batches, "doc_id", "source", "text"):
        found = shingles(Words(text, lower=True), words)
        key, hashed = sketch(found, bands, depth) if len(found) else (None, None)
        rows.append((doc_id, None if source is None else source.decode(), len(text or b""), key, hashed))
        if len(rows) >= 2_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def near_clusters(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    words: int = WORDS,
    bands: int = BANDS,
    depth: int = DEPTH,
) -> DataFrame:
    """``doc_id``, ``source``, ``size`` (UTF-8 bytes) and ``cluster`` of every row.

    Clusters are numbered by a key of one of their shingle sets. Texts with equal sets always share one, whatever
    their ids; near duplicates do with the probability above, and documents that are less alike may. A text of
    fewer than ``words`` words is one shingle; null and empty texts have no cluster. Repeated rows repeat the
    result; other columns are ignored; an empty table gives an empty one.
    """
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(source_column).cast("string").alias("source"), F.col(text_column).alias("text")
    )
    rows = materialize(rows.mapInArrow(lambda b: _sketches(b, words, bands, depth), _SKETCH))
    # Equal sets have equal sketches, so one row of each is enough.
    sets = rows.filter("key is not null").groupBy("key").agg(F.first("bands").alias("bands"))
    entries = sets.select("key", F.explode("bands").alias("h"))
    lowest = entries.groupBy("h").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low < high")
    links = entries.join(lowest, "h").filter("key <> low").select(F.col("low").alias("a"), F.col("key").alias("b"))
    groups = components(links)
    clustered = rows.join(groups.withColumnRenamed("node", "key"), "key", "left")
    return clustered.select("doc_id", "source", "size", F.coalesce("component", "key").alias("cluster"))
