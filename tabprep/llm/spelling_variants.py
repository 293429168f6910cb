"""Spelling variant grouping by dense tiles of code-point matrices.

Words of a tile are the rows of a matrix of code points, padded to one width, and of a second one that is
aligned at the last code point. Two blocks of rows are compared at once: the length of the common prefix,
read from the first matrix, and that of the common suffix, read from the second, reach the longer length
minus one exactly if the words differ by one inserted, deleted or replaced code point.

Tiles are kept small without losing a pair. Of two words that differ by one edit, the shorter of length L,
either the first L // 2 code points are equal or the last L - L // 2. So a word is dealt to tiles by
(L, half, those code points), once as the shorter and once as the longer word, and a pair is reported by
the tile of the first half if it is there and by the other if not: each pair once. A tile that holds more
rows than a block is cut into blocks, and pairs of blocks are tiles of their own, spread over tasks.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import rows_of
from tabprep.scratch import materialize

#: Least code points and occurrences of a word, and by how much a form must be more frequent.
LENGTH, OCCURRENCES, RATIO = 6, 5, 5
#: One of so many runs of a document loses a code point.
DROPPED = 199
#: Rows of a block, fewer where words are long: a block has at most CELLS code points.
BLOCK, CELLS = 1024, 1 << 22
#: Pairs of rows that a task compares, about.
TASK_PAIRS = 50_000_000
#: Words whose occurrences a task adds up before it passes them on.
HELD = 200_000
#: Code points of a text from which its runs are counted as they are found.
LONG = 1 << 20

_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def _occurrences(batches, length, dropped):
    """Occurrences of the results of each document's runs, added up for blocks of documents."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
    found: Counter = Counter()

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], schema=schema)

    for doc_id, text in rows_of(batches, "doc_id", "text"):
        if not text:
            continue
        state = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
        # Lower case of bytes is that of A-Z alone.
        text = text.lower().decode()
        runs = _RUN.findall(text) if len(text) < LONG else (m.group() for m in _RUN.finditer(text))
        for run, n in Counter(runs).items():
            if len(run) >= length:
                h = zlib.crc32(run.encode(), state)
                if dropped and h % dropped == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                    if len(run) < length:
                        continue
                found[run] += n
        if len(found) >= HELD:
            yield flush()
            found.clear()
    if found:
        yield flush()


def vocabulary(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    occurrences: int = OCCURRENCES,
    dropped: int = DROPPED,
) -> DataFrame:
    """``word`` and ``n`` of the words of all documents with enough code points and occurrences.

    Words are runs of the letters ``A-Z a-z U+00C0-U+00FF``, A-Z in lower case. A run whose checksum with the
    document's id is a multiple of ``dropped`` loses one code point (0: none does). Null and empty texts have
    none; a null id counts as an empty one; repeated rows count again.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    found = rows.mapInArrow(lambda b: _occurrences(b, length, dropped), "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= occurrences)


def _tile_keys(length: Column, word: Column) -> Column:
    """The four tiles of a word: as the shorter and as the longer one, by first half and by second half."""

    def pair(shorter: Column) -> list[Column]:
        first = F.floor(shorter / 2).cast("int")
        return [
            F.struct(shorter.alias("shorter"), F.lit(0).alias("half"), F.substring(word, F.lit(1), first).alias("part")),
            F.struct(shorter.alias("shorter"), F.lit(1).alias("half"), F.substring(word, length - (shorter - first) + 1, shorter - first).alias("part")),
        ]

    return F.explode(F.array(*pair(length), *pair(length - 1)))


def _tiles(words: DataFrame) -> tuple[DataFrame, int]:
    """Rows ``(tile, shorter, half, i, j, side, word, n)``, the two blocks i <= j of each pair of blocks of a tile, and the pairs of words."""
    length = F.length("word")
    rows = words.select("word", "n", _tile_keys(length, F.col("word")).alias("t")).select("word", "n", "t.shorter", "t.half", F.xxhash64("t").alias("tile"))
    rows = materialize(rows.filter("shorter > 0"))
    sizes = rows.groupBy("tile", "shorter", "half").agg(F.count("*").alias("rows"))
    block = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.lit(CELLS) / (F.col("shorter") + 1))).cast("int")
    large = materialize(sizes.withColumn("blocks", F.ceil(F.col("rows") / block).cast("int")).filter("rows > 1"))
    compared = large.agg(F.sum(F.col("rows").cast("double") * F.col("rows") / 2)).first()[0] or 0
    large = large.select("tile", "shorter", "half", "blocks")
    dealt = rows.join(large, ["tile", "shorter", "half"]).withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least("own", k).alias("i"), F.greatest("own", k).alias("j"), F.when(k < F.col("own"), 1).otherwise(0).alias("side")),
    )
    dealt = dealt.withColumn("pair", F.explode(pairs))
    return dealt.select("tile", "shorter", "half", "pair.i", "pair.j", "pair.side", "word", "n"), int(compared)


class _Matrix:
    """Words of one tile class as padded code points, aligned at the first and at the last one."""

    def __init__(self, words: list[str], shorter: int):
        width = shorter + 1
        data = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le"), np.uint32)
        dense = np.dtype(np.uint16 if data.max() < 0xFFFF else np.uint32)
        self.lengths = np.array([len(w) for w in words])
        # Padding is a number that no code point has.
        padding = np.arange(width) >= self.lengths[:, None]
        self.first = np.where(padding, np.iinfo(dense).max, data.reshape(-1, width)).astype(dense)
        self.shorter = self.lengths == shorter
        # The shorter words move by one place to the right.
        self.last = np.where(self.shorter[:, None], np.roll(self.first, 1, axis=1), self.first)

    def near(self, a: np.ndarray, b: np.ndarray, half: int) -> np.ndarray:
        """Which rows a and b differ by one edit, and are to be reported by tiles of this half."""
        longer = np.maximum(self.lengths[a], self.lengths[b])
        prefix = _common(self.first[a] == self.first[b], longer)
        suffix = _common((self.last[a] == self.last[b])[:, ::-1], longer)
        shares_first = prefix >= (self.first.shape[1] - 1) // 2
        return (prefix + suffix >= longer - 1) & (prefix < longer) & (shares_first if half == 0 else ~shares_first)


def _common(equal: np.ndarray, longest: np.ndarray) -> np.ndarray:
    """Number of leading equal places, of which padding counts for none."""
    return np.minimum(np.where(equal.all(axis=1), equal.shape[1], np.argmin(equal, axis=1)), longest)


def _compare(batches):
    """Near pairs of the tiles of a partition, which come sorted by tile, class, half and blocks."""
    schema = pa.schema([("a", pa.string()), ("a_n", pa.int64()), ("b", pa.string()), ("b_n", pa.int64())])
    columns = ("shorter", "half", "tile", "i", "j", "side", "word", "n")

    def compared(rows):
        shorter, half = rows[0][0], rows[0][1]
        words, ns = [r[6].decode() for r in rows], np.array([r[7] for r in rows], np.int64)
        matrix = _Matrix(words, shorter)
        place = np.arange(len(rows))
        new = np.array([True, *(x[2:5] != y[2:5] for x, y in zip(rows, rows[1:]))])
        ends = np.append(np.flatnonzero(new)[1:], len(rows))[np.cumsum(new) - 1]
        side = np.array([r[5] for r in rows])
        across = np.array([r[3] != r[4] for r in rows])
        # Each row meets the next one of its tile, then the one after it, until no tile has rows left.
        step = max(1, CELLS // (len(rows) * (shorter + 1)))
        active, shift = place, 1
        while True:
            active = active[active + shift < ends[active]]
            if not len(active):
                return
            reach = np.minimum(step, ends[active] - active - shift)
            a = np.repeat(active, reach)
            b = a + shift + np.arange(len(a)) - np.repeat(np.cumsum(reach) - reach, reach)
            # Rows of one block meet in the block's own tile, two longer words in the class of their length.
            apart = (~across[a] | (side[a] != side[b])) & (matrix.shorter[a] | matrix.shorter[b])
            a, b = a[apart], b[apart]
            hit = matrix.near(a, b, half)
            if hit.any():
                a, b = a[hit], b[hit]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([words[k] for k in a]), pa.array(ns[a]), pa.array([words[k] for k in b]), pa.array(ns[b])], schema=schema
                )
            shift += step

    held, cells = [], 0
    for row in rows_of(batches, *columns):
        if held and (row[:2] != held[-1][:2] or (cells > CELLS // 4 and row[2:5] != held[-1][2:5])):
            yield from compared(held)
            held, cells = [], 0
        held.append(row)
        cells += row[0] + 1
    if held:
        yield from compared(held)


def near_words(words: DataFrame) -> DataFrame:
    """Pairs ``(a, a_n, b, b_n)`` of distinct words that differ by one edit, each once; see the module."""
    tiles, pairs = _tiles(words)
    # Tasks are sized by the pairs that they compare, not by the few bytes that they read.
    parts = max(-(-pairs // TASK_PAIRS), int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sorted_tiles = tiles.repartition(parts, "tile", "i", "j").sortWithinPartitions("shorter", "half", "tile", "i", "j", "side", "word")
    return sorted_tiles.mapInArrow(_compare, "a string, a_n bigint, b string, b_n bigint")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """The form and root of each word of a table ``(word, n)``.

    Returns ``word``, ``form`` (the near word of largest n, ties to the smallest in code-point order, if its n is
    at least ``ratio`` times the word's; else null), ``root`` (the last word that forms lead to, the word itself
    if it has none), ``n``, ``n_near`` and ``form_n``. Words are distinct and not null; an empty table gives an
    empty one; other columns are ignored. With a ratio above 1 forms never run in a circle.
    """
    if ratio < 2:
        raise ValueError("forms may run in circles unless the ratio is above 1")
    words = materialize(words.select("word", "n"))
    pairs = materialize(near_words(words))
    sides = pairs.selectExpr("a AS word", "b AS other", "b_n AS other_n").union(pairs.selectExpr("b", "a", "a_n"))
    best = sides.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"))).alias("best"))
    found = words.join(best, "word", "left").withColumn("form_n", -F.col("best.less"))
    fits = F.col("form_n") >= ratio * F.col("n")
    found = materialize(
        found.select(
            "word", F.when(fits, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(fits, F.col("form_n")).alias("form_n")
        )
    )
    steps = materialize(found.filter("form is not null").selectExpr("word", "form AS root"))
    # Every step multiplies n by the ratio, so a few doublings reach the end of the longest chain.
    while True:
        onward = steps.toDF("root", "next")
        longer = materialize(steps.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        steps = longer.select("word", "root")
        if longer.filter("moved").isEmpty():
            break
    rooted = found.join(steps, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
