"""Target-distribution importance resampling over hashed n-grams, with a head and a tail vocabulary.

A feature is a run of consecutive words; its bucket is the checksum of its bytes. Word frequencies are very
uneven, so the frequent words, the head, are found first and handed to every task with their exact CRC
states, and so are the buckets of frequent pairs. A run of head words continues from the state of its
first word; pairs of the pair table need no checksum at all; all other features, the tail, take the CRC of
their bytes. Both feed the same exact totals per bucket, so the choice of the head changes the speed only.

A bucket's gain is the logarithm of its smoothed share in the target over its share in the corpus. The
weight of a document is the mean gain of its features, and a document's score adds Gumbel noise that is
drawn from its id, so that the highest scores are a sample without replacement.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.common import rows_of
from tabprep.scratch import materialize

BUCKETS, SEED, MIN_WORDS, PERCENT = 10_000, 2024, 20, 10
#: Words, and pairs, of the head, and the most bytes of one: a few megabytes, whatever the input.
HEAD_WORDS, HEAD_PAIRS, HEAD_BYTES = 20_000, 20_000, 48
#: Different words or pairs that a task counts before it drops the rare ones, and how many it passes on.
COUNTED, PASSED = 200_000, 30_000
#: Bytes of a long text that are cut into words at once.
BLOCK_BYTES = 1 << 20

# Lower case for A-Z; all bytes but digits, letters and parts of characters beyond ASCII become a blank.
_PLAIN = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)


def _word_blocks(text: bytes | None):
    """The words of a text, in lists of bounded size."""
    plain = (text or b"").translate(_PLAIN)
    at = 0
    while at < len(plain):
        end = plain.find(b" ", at + BLOCK_BYTES)
        end = len(plain) if end < 0 else end
        words = plain[at:end].split()
        if words:
            yield words
        at = end + 1


class Features:
    """Buckets of the runs of 1 to ``longest`` words of a text."""

    def __init__(self, longest: int, buckets: int, states: dict[bytes, int] | None = None, pairs: dict[tuple[bytes, bytes], int] | None = None):
        self.longest, self.buckets = longest, buckets
        self.states, self.pairs = states or {}, pairs or {}
        self.single = {w: s % buckets for w, s in self.states.items()}

    def of(self, text: bytes | None) -> tuple[int, list[np.ndarray]]:
        """Number of words, and arrays of buckets."""
        n, before, parts = 0, [], []
        for words in _word_blocks(text):
            n += len(words)
            found = list(map(self.single.get, words))
            if None in found:
                found = [zlib.crc32(w) % self.buckets if b is None else b for w, b in zip(words, found, strict=True)]
            parts.append(np.array(found, np.int64))
            if self.longest > 1:
                # The last words of a block start runs that end in the next one.
                joined = before + words
                parts.append(np.array(list(self._runs(joined, len(before))), np.int64))
                before = joined[1 - self.longest :]
        return n, parts

    def _runs(self, words: list[bytes], old: int):
        """Buckets of the runs of two words and more that end after the first ``old`` words."""
        for size in range(2, self.longest + 1):
            for first in range(max(0, old - size + 1), len(words) - size + 1):
                yield self._run(words[first : first + size])

    def _run(self, words: list[bytes]) -> int:
        known = self.pairs.get((words[0], words[1])) if len(words) == 2 else None
        if known is not None:
            return known
        state = self.states.get(words[0])
        state = zlib.crc32(words[0]) if state is None else state
        for word in words[1:]:
            state = zlib.crc32(word, zlib.crc32(b" ", state))
        return state % self.buckets


def _frequent(batches, pairs: bool):
    """Words, or pairs of words, that are frequent among the rows of a task, with about how often they occur."""
    found: Counter = Counter()
    for (text,) in rows_of(batches, "text"):
        before = []
        for words in _word_blocks(text):
            if max(map(len, words)) > HEAD_BYTES:
                words = [w if len(w) <= HEAD_BYTES else b"" for w in words]
            found.update(zip(before + words, (before + words)[1:]) if pairs else words)
            before = words[-1:]
            if len(found) > COUNTED:
                # What is rarer than the frequent ones found so far loses, as later ones would against it.
                found = Counter(dict(found.most_common(COUNTED // 2)))
    top = [(w if pairs else (w,), n) for w, n in found.most_common(PASSED)]
    top = [(w, n) for w, n in top if all(w) and sum(map(len, w)) <= HEAD_BYTES]
    yield pa.RecordBatch.from_arrays(
        [pa.array([list(w) for w, _ in top], pa.list_(pa.binary())), pa.array([n for _, n in top], pa.int64())], ["words", "n"]
    )


def _head(texts: DataFrame, size: int, pairs: bool) -> list[list[bytes]]:
    """The most frequent words or pairs; at most ``size`` short ones come to the driver."""
    counted = texts.mapInArrow(lambda b: _frequent(b, pairs), "words array<binary>, n bigint")
    top = counted.groupBy("words").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "words").limit(size)
    return [[bytes(w) for w in row.words] for row in top.collect()]


def head_features(texts: DataFrame, longest: int, buckets: int, head_words: int = HEAD_WORDS, head_pairs: int = HEAD_PAIRS) -> Features:
    """The head vocabulary of a column ``text``: CRC states of frequent words, buckets of frequent pairs.

    Which words are frequent is found from all texts, by bounded counters in every task; a word that they miss
    is a tail word, with the same bucket.
    """
    states = {w: zlib.crc32(w) for (w,) in _head(texts, head_words, False)}
    pairs = {}
    if longest > 1:
        pairs = {(a, b): zlib.crc32(b, zlib.crc32(b" ", states.get(a, zlib.crc32(a)))) % buckets for a, b in _head(texts, head_pairs, True)}
    return Features(longest, buckets, states, pairs)


def _totals(batches, features):
    totals = np.zeros(features.buckets, np.int64)
    for (text,) in rows_of(batches, "text"):
        for part in features.of(text)[1]:
            totals += np.bincount(part, minlength=features.buckets)
    used = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(totals[used], pa.int64())], ["bucket", "n"])


def bucket_totals(texts: DataFrame, features) -> DataFrame:
    """Exact number of features per bucket, ``(bucket, n)``; a task passes on one sum per bucket."""
    counted = texts.select("text").mapInArrow(lambda b: _totals(b, features.value), "bucket int, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Gain of each bucket in thousandths, from both totals: one number per bucket, whatever the input."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for totals, counts in ((corpus, s), (target, t)):
        for bucket, n in totals.collect():
            counts[bucket] = n
    all_s, all_t = s.sum(), t.sum()
    return np.array([math.floor(1000 * math.log((b + 1) * (all_s + buckets) / ((a + 1) * (all_t + buckets)))) for a, b in zip(s, t)], np.int64)


def _weights(batches, features, gain):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])
    rows = []
    for doc_id, text in rows_of(batches, "doc_id", "text"):
        n, parts = features.of(text)
        size = sum(map(len, parts))
        # Whole numbers: the mean goes down, also below zero.
        rows.append((doc_id, n, size, sum(int(gain[p].sum()) for p in parts) // size if size else 0))
        if len(rows) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the id; a null id counts as an empty one."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000


def scores(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_column: str = "text",
    longest: int = 1,
    buckets: int = BUCKETS,
    seed: int = SEED,
    head_words: int = HEAD_WORDS,
    head_pairs: int = HEAD_PAIRS,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` and ``score`` of every row of ``docs``.

    Words are runs of digits, letters and characters beyond ASCII, A-Z in lower case; features are the runs of
    1 to ``longest`` of them, repeats counted. Null and empty texts have none and a weight of 0. A null id draws
    the noise of an empty id. Rows that repeat an id are scored each by its text; other columns are ignored. An
    empty target or table has no features; an empty table gives an empty result. A long text is cut into words
    block by block.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    features = spark.sparkContext.broadcast(head_features(texts, longest, buckets, head_words, head_pairs))
    wanted = bucket_totals(target.select(F.col(target_column).alias("text")), features)
    gain = spark.sparkContext.broadcast(gains(bucket_totals(texts, features), wanted, buckets))
    weighed = texts.mapInArrow(lambda b: _weights(b, features.value, gain.value), "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    return weighed.withColumn("score", F.col("weight") + F.floor(_noise(F.col("doc_id"), seed)))


def ranked(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``scores`` with the ``rank`` of those that are drawn, null for the others.

    Of the N rows with at least ``min_words`` words the floor(percent * N / 100) highest scores are drawn, ties
    to the smaller id, null ids last. Scores are whole thousandths of a logarithm, so there are some ten
    thousands of different ones, whatever the input: how many rows lie above each is a small table, and places
    among equal scores are settled score by score. Equal rows are counted, not sorted.
    """
    scored = materialize(scored)
    able = scored.filter(F.col("n_words") >= min_words)
    by_score = able.groupBy("score").agg(F.count("*").alias("rows"))
    above = F.sum("rows").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    table = materialize(by_score.select("score", (above - F.col("rows")).alias("above")))
    total = able.count()
    drawn = percent * total // 100
    chosen = able.join(F.broadcast(table.filter(F.col("above") < drawn)), "score")
    same = ["score", "above", "doc_id", "n_words", "n_features", "weight"]
    order = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_features", "n_words", "weight")
    before = F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("copies")
    places = chosen.groupBy(*same).agg(F.count("*").alias("copies")).withColumn("before", F.col("above") + before)
    places = places.withColumn("rank", F.explode(F.sequence(F.col("before") + 1, F.col("before") + F.col("copies"))))
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    places = places.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    others = scored.join(F.broadcast(table.filter(F.col("above") < drawn).select(F.col("score").alias("taken"))), F.col("score") == F.col("taken"), "left")
    others = others.filter((F.col("n_words") < min_words) | F.col("taken").isNull())
    return places.union(others.select(*columns, F.lit(None).cast("bigint").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, id_column: str = "doc_id", percent: int = PERCENT, min_words: int = MIN_WORDS, **options) -> DataFrame:
    """The documents that are drawn, all columns kept; ids are expected to be distinct, rows without one go.

    ``options`` are those of ``scores``.
    """
    drawn = ranked(scores(docs, target, id_column, **options), percent, min_words).filter("rank is not null and doc_id is not null")
    drawn = materialize(drawn.select(F.col("doc_id").alias("id")).distinct())
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.toDF(*names.values())
    return plain.join(drawn, F.col(names[id_column]).cast("bigint") == F.col("id"), "left_semi").toDF(*docs.columns)
