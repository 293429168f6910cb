"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence matrix.

The matrix has a row per distinct shingle set (exact copies share one) and a column per shingle.
Columns are put in one global order, rare ones first. A row with n shingles needs only its first
``n - ceil(t n) + 1`` columns: two rows that reach the similarity t meet in one of them. Column
frequencies come from one fixed-size sketch of all documents; any order is exact, the sketch only
keeps frequent shingles out of the product.

The product is done in two blocks. The first multiplies every column by its smallest row only, and
takes of the rows that a row meets so the one that it meets most often: no more pairs than rows,
however many copies a column holds. Overlaps of these pairs are counted in full and the links are
closed to components. The second block takes the columns whose rows still lie in different
components and multiplies rows across components. Where near copies would make very many such pairs,
rows are first multiplied by random neighbours in their columns, again one partner for each row,
round after round, which joins dense groups soon. Rows of one component need no
further comparison, so groups of near copies that are linked never form all their pairs.

Pairs are discarded by bounds: the sizes must be within the similarity, from a shared column on
enough shingles must be left on either side, and the odd sketches of the two sets, a bit or less for
each byte of shingle hashes, must not differ in more places than the similarity allows. The last one
settles nearly all pairs that fall short by little, so that whole sets are read for few others than links.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.common import Output, Words, bitmap, components, likely, rows_of, shingles
from tabprep.scratch import materialize

WORDS, PERCENT = 5, 75
#: Counters of the frequency sketch, and how many of them make one output row.
SKETCH_BITS, CHUNK = 18, 1 << 14

#: Bits of an odd sketch for each shingle, at least; they are a power of two, so that sketches can be folded.
ODD_BITS = 4

#: First columns that two rows must share at least, where their sizes leave room for that.
SHARED = 4

#: Orders in which a round looks for neighbours, and parts of a column with very many entries.
ORDERS, SALTS = 12, 64

#: Pairs for each entry, from which on rounds of neighbours come before all pairs.
DENSE = 8

_DOC, _SKETCH = 0, 1
_PASS_ONE = "kind int, doc_id bigint, n bigint, key bigint, odd array<bigint>, chunk int, counts binary"


def _key(found: np.ndarray) -> int:
    """64-bit key of a sorted shingle set."""
    return int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True)


def _odd(found: np.ndarray) -> list[int]:
    """Odd sketch of a shingle set, as 64-bit numbers: a bit for each slot that an odd number of shingles falls into."""
    bits = max(64, 1 << (ODD_BITS * len(found) - 1).bit_length())
    counts = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(bool)).view(np.int64).tolist()


def _scan(batches, size):
    """One row per document, then this task's counts of shingles per sketch counter."""
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    schema = pa.schema(
        [("kind", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), ("odd", pa.list_(pa.int64())),
         ("chunk", pa.int32()), ("counts", pa.binary())]
    )
    rows = []
    for doc_id, text in rows_of(batches, "doc_id", "text"):
        found = shingles(Words(text, lower=True), size)
        if len(found):
            np.add.at(counts, (found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
        rows.append((_DOC, doc_id, len(found), _key(found) if len(found) else None, _odd(found) if len(found) else None, None, None))
        if len(rows) >= 2_000:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)
            rows = []
    for chunk in range(len(counts) // CHUNK):
        part = counts[chunk * CHUNK : (chunk + 1) * CHUNK]
        if part.any():
            rows.append((_SKETCH, None, None, None, None, chunk, zlib.compress(part.tobytes(), 1)))
    if rows:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)


def _add_sketches(batches):
    """Sums of the counters of each chunk over all tasks; a chunk lies in one partition."""
    totals: dict[int, np.ndarray] = {}
    for chunk, data in rows_of(batches, "chunk", "counts"):
        totals[chunk] = totals.get(chunk, 0) + np.frombuffer(zlib.decompress(data), np.int64)
    chunks, sums = list(totals), [t.tobytes() for t in totals.values()]
    yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int32()), pa.array(sums, pa.binary())], ["chunk", "total"])


def _levels(rows: list) -> np.ndarray:
    """Rank of each sketch counter: 0 up to six deviations above the mean, then one more per doubling."""
    totals = np.zeros(1 << SKETCH_BITS, np.int64)
    for chunk, total in rows:
        totals[chunk * CHUNK : (chunk + 1) * CHUNK] = np.frombuffer(bytes(total), np.int64)
    usual = np.median(totals)
    excess = np.maximum(totals - usual, 0) / (6 * np.sqrt(usual + 1) + 1)
    return np.where(excess < 1, 0, 1 + np.log2(np.maximum(excess, 1))).astype(np.uint8)


def _postings(batches, size, percent, levels):
    """``(h, key, n, left, heavy)`` for the first columns of each row.

    ``left`` counts the shingles from the column on; ``heavy`` columns are those the sketch ranks above 0.
    """
    schema = pa.schema([("h", pa.int64()), ("key", pa.int64()), ("n", pa.int32()), ("left", pa.int32()), ("heavy", pa.bool_())])
    out = Output(schema)
    for _, text in rows_of(batches, "doc_id", "text"):
        found = shingles(Words(text, lower=True), size)
        n = len(found)
        if n:
            need = -(-percent * n // 100)
            level = levels[found >> np.uint64(64 - SKETCH_BITS)]
            order = np.lexsort((found, level))[: n - need + 1]
            k = len(order)
            yield from out.add(
                found[order].view(np.int64), np.full(k, _key(found)), np.full(k, n, np.int32), (n - np.arange(k)).astype(np.int32), level[order] > 0
            )
    yield from out.flush()


def _sets(batches, size):
    """Shingle sets of documents."""
    schema = pa.schema([("key", pa.int64()), ("found", pa.list_(pa.int64()))])
    keys, parts, held = [], [], 0

    def flush():
        ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
        found = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts).view(np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), found], schema=schema)

    for (text,) in rows_of(batches, "text"):
        found = shingles(Words(text, lower=True), size)
        if len(found):
            keys.append(_key(found))
            parts.append(found)
            held += len(found)
        if held > 1 << 20:
            yield flush()
            keys, parts, held = [], [], 0
    if keys:
        yield flush()


def _possible(percent: int, n: Column, left: Column, m: Column, m_left: Column) -> Column:
    """Whether sizes, and the shingles left from a shared column on, allow the similarity."""
    return (F.least(left, m_left) * (100 + percent) >= percent * (n + m)) & (
        F.least(n, m) * 100 >= F.greatest(n, m) * percent
    )


def similar_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Groups of documents linked by shingle sets of a Jaccard similarity of ``percent`` or more.

    Returns a row per input row: ``doc_id``, ``n_shingles`` (size of the set), ``component_id`` (the
    smallest id reachable by links). A text with fewer than ``words`` words is one shingle; null and
    empty texts have none and are linked with nothing. Rows that repeat an id are one document and
    share a component. A row without an id keeps its size, is never linked and has a null component.
    Copies of a row repeat its result; other columns are ignored; an empty table gives an empty one.
    """
    docs = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    spark = docs.sparkSession
    scan = materialize(docs.mapInArrow(lambda b: _scan(b, words), _PASS_ONE), ("kind",))
    rows = scan.filter(F.col("kind") == _DOC).select("doc_id", "n", "key")
    named = rows.filter("doc_id is not null and n > 0")
    sketch = scan.filter(F.col("kind") == _SKETCH).select("chunk", "counts")
    totals = sketch.repartition("chunk").mapInArrow(_add_sketches, "chunk int, total binary")
    # 2 ** SKETCH_BITS counters, whatever the input.
    levels = spark.sparkContext.broadcast(_levels(totals.collect()))

    texts = docs.filter("doc_id is not null")
    postings = texts.mapInArrow(
        lambda b: _postings(b, words, percent, levels.value), "h bigint, key bigint, n int, left int, heavy boolean"
    )
    shared = _shared(postings)
    first = named.groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    odd = scan.filter("kind = 0 and doc_id is not null and n > 0").select("key", "n", "odd")

    def near(pairs: DataFrame) -> DataFrame:
        """The pairs that their odd sketches leave possible."""
        pairs = materialize(pairs)
        ids = pairs.select(F.col("a").alias("key")).union(pairs.select("b"))
        return materialize(_close(pairs, likely(odd, "key", bitmap(ids, "key")).dropDuplicates(["key"]), percent))

    def linked(pairs: DataFrame) -> DataFrame:
        """The pairs that the similarity links, their overlaps counted in full."""
        ids = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct().join(first, "key")
        wanted = likely(texts, "doc_id", bitmap(ids, "doc_id")).select("text")
        sets = wanted.mapInArrow(lambda b: _sets(b, words), "key bigint, found array<bigint>").dropDuplicates(["key"])
        sides = pairs.join(sets.withColumnsRenamed({"key": "b", "found": "second"}), "b")
        sides = sides.join(sets.withColumnsRenamed({"key": "a", "found": "first"}), "a")
        common = F.size(F.array_intersect("first", "second"))
        return sides.filter(common * (100 + percent) >= (F.size("first") + F.size("second")) * percent).select("a", "b")

    possible = _possible(percent, F.col("n"), F.col("left"), F.col("low_n"), F.col("low_left"))
    tried = _one_partner(shared.filter("key <> low").filter(possible).select("key", F.col("low").alias("partner")))
    # Rows that share an id belong together too.
    same_id = named.groupBy("doc_id").agg(F.min("key").alias("a"), F.max("key").alias("b")).filter("a <> b")
    same_id = named.join(same_id.select("doc_id", "a"), "doc_id").filter("key <> a").select("a", F.col("key").alias("b"))
    entries = materialize(shared.select("h", "key", "n", "left").distinct())
    groups = components(linked(near(tried)).union(same_id))

    rest = _undecided(entries, groups)
    (held, across), before, turn = _sizes(rest), None, 0
    # Rounds of neighbours, while very many pairs are left and a round still settles a fifth of them.
    while across > DENSE * held and (before is None or across < 0.8 * before):
        groups = components(linked(near(_neighbours(rest, turn, percent))).union(groups.toDF("a", "b")))
        rest = _undecided(rest.drop("component"), groups)
        before, turn = across, turn + 1
        held, across = _sizes(rest)
    if across:
        met = near(_across(rest, percent))
        # One partner for each row first, the one with which it shares most columns.
        best = met.groupBy("a").agg(F.max(F.struct("times", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
        best = materialize(best)
        groups = components(linked(best).union(groups.toDF("a", "b")))
        met = materialize(_apart(met.join(best, ["a", "b"], "left_anti"), groups))
        if not met.isEmpty():
            groups = components(linked(met).union(groups.toDF("a", "b")))

    label = F.coalesce("component", "key")
    of_key = named.join(groups.withColumnRenamed("node", "key"), "key", "left").withColumn("component", label)
    smallest = of_key.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_key = of_key.select("key", "component").distinct().join(smallest, "component").select("key", "component_id")
    linkable = rows.withColumn("own", F.when(F.col("doc_id").isNotNull(), F.col("key")))
    joined = linkable.join(of_key.withColumnRenamed("key", "own"), "own", "left")
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _shared(postings: DataFrame) -> DataFrame:
    """Entries of columns with two rows or more, beside the column's smallest row.

    A light column has few entries, by the sketch, and is looked at as one group. A heavy one may
    have as many as there are documents, so its entries are salted; they are written down with the
    others, and its smallest row is an aggregate that is joined back. All takes one exchange.
    """
    entry, column = F.struct("key", "n", "left"), Window.partitionBy("h", "salt")
    salted = postings.withColumn("salt", F.when(F.col("heavy"), F.pmod("key", F.lit(SALTS))).otherwise(0))
    found = salted.withColumns({"low": F.min(entry).over(column), "high": F.max("key").over(column)})
    found = materialize(found.filter("heavy or low.key <> high").drop("salt"))
    light, heavy = found.filter("not heavy"), found.filter("heavy").drop("low", "high")
    lowest = heavy.groupBy("h").agg(F.min(entry).alias("low"), F.max("key").alias("high"))
    both = light.union(heavy.join(lowest, "h").select(light.columns)).filter("low.key <> high")
    return both.selectExpr("h", "key", "n", "left", "low.key AS low", "low.n AS low_n", "low.left AS low_left")


def _one_partner(met: DataFrame) -> DataFrame:
    """Of the partners ``(key, partner)`` that a row meets the one that it meets most often, as a pair ``(a, b)``.

    Others are put off, not dropped: columns that still meet two components stay undecided.
    """
    counted = met.groupBy("key", "partner").agg(F.count("*").alias("times"))
    best = counted.groupBy("key").agg(F.max(F.struct("times", "partner")).alias("best"))
    return best.select(F.least("key", "best.partner").alias("a"), F.greatest("key", "best.partner").alias("b")).distinct()


def _close(pairs: DataFrame, odd: DataFrame, percent: int) -> DataFrame:
    """The pairs whose odd sketches, ``(key, n, odd)``, leave the similarity possible.

    Where the sketches of two sets differ, a shingle of that slot is in one set only. So the sets differ by as
    many shingles at least, and no linked pair is lost. Sketches of sizes that the similarity allows have equal
    lengths, or one has twice the other's; its halves are folded onto each other.
    """
    mine, yours = (odd.toDF(k, f"{k}_n", f"{k}_odd") for k in "ab")
    fits = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent
    met = pairs.join(mine, "a").join(yours, "b").filter(fits)
    half = F.least(F.size("a_odd"), F.size("b_odd"))

    def folded(sketch: str) -> Column:
        other = F.slice(sketch, half + 1, half)
        return F.when(F.size(sketch) == half, F.col(sketch)).otherwise(F.zip_with(F.slice(sketch, F.lit(1), half), other, _differing))

    ones = F.transform(F.zip_with(folded("a_odd"), folded("b_odd"), _differing), F.bit_count)
    differ = F.aggregate(ones, F.lit(0), lambda total, x: total + x)
    return met.filter(differ * (100 + percent) <= (F.col("a_n") + F.col("b_n")) * (100 - percent)).select(pairs.columns)


def _differing(x: Column, y: Column) -> Column:
    return x.bitwiseXOR(y)


def _undecided(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """The entries, with the component of their row, of columns that meet more than one component."""
    # Most rows are in no group; they are told by a bitmap and not exchanged for their component.
    found, own = bitmap(groups, "node"), F.col("key")
    members = likely(entries, "key", found).join(groups.withColumnRenamed("node", "key"), "key", "left")
    members = members.withColumn("component", F.coalesce("component", own))
    located = members.unionByName(likely(entries, "key", found, without=True).withColumn("component", own))
    mixed = located.groupBy("h").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    return materialize(located.join(mixed.select("h"), "h"))


def _sizes(rest: DataFrame) -> tuple[int, int]:
    """Number of entries, and of pairs of entries of one column and different components."""
    count = F.count("*").cast("double")
    by_component = rest.groupBy("h", "component").agg(count.alias("n"))
    by_column = by_component.groupBy("h").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("within"))
    n, pairs = by_column.agg(F.sum("n"), F.sum((F.col("n") * F.col("n") - F.col("within")) / 2)).first()
    return int(n or 0), int(pairs or 0)


def _neighbours(rest: DataFrame, turn: int, percent: int) -> DataFrame:
    """Possible pairs of each entry and the next one of its column in an order drawn anew every turn.

    Columns with many entries are cut at random, so that no task holds more than a few thousand.
    """
    parts = rest.groupBy("h").agg(F.ceil(F.count("*") / 2000).alias("parts"))
    # Columns of a row are in one of a few orders, so that it meets as many neighbours.
    drawn = F.xxhash64("key", F.pmod("h", F.lit(ORDERS)), F.lit(turn))
    rows = rest.join(parts, "h").withColumn("part", F.pmod(F.xxhash64(drawn), F.col("parts")))
    order = Window.partitionBy("h", "part").orderBy(drawn)
    rows = rows.withColumn("next", F.lead(F.struct("key", "n", "left", "component")).over(order))
    rows = rows.filter("next.component <> component").filter(
        _possible(percent, F.col("n"), F.col("left"), F.col("next.n"), F.col("next.left"))
    )
    return _one_partner(rows.select("key", F.col("next.key").alias("partner")))


def _across(located: DataFrame, percent: int) -> DataFrame:
    """Possible pairs ``(a, b)`` of rows of different components that share columns, with the number of them as ``times``.

    The smaller row of a pair looks for partners in its own size band and the next: a band spans the
    ratio of sizes that the similarity allows.

    Rows whose overlap must be ``needed`` share a column from which on that many shingles are left in both. Where
    ``least - 1`` columns more are looked at, they share ``least``: of the two rows, the one whose columns end
    earlier has ``needed - least`` shingles behind them, and meets the other's with no more than these and the shared.
    """
    band = F.floor(F.ln(F.col("n").cast("double")) / F.ln(F.lit(100 / percent)) + F.lit(1e-9))
    larger = located.withColumn("band", band).withColumnsRenamed(
        {"key": "b", "n": "m", "left": "m_left", "component": "other"}
    )
    smaller = located.withColumnRenamed("key", "a").withColumn("band", F.explode(F.array(band, band + 1)))
    needed = F.ceil((F.col("n") + F.col("m")) * percent / (100 + percent))
    # Columns that are no row's first ones are not there; the larger row's end first.
    least = 1 + F.least(F.lit(SHARED - 1), needed - F.ceil(F.col("m") * percent / 100))
    pairs = smaller.join(larger, ["h", "band"]).filter("component <> other and (n < m or n = m and a < b)")
    pairs = pairs.filter(F.col("n") * 100 >= F.col("m") * percent).filter(F.least("left", "m_left") > needed - least)
    met = pairs.groupBy("a", "b").agg(F.count("*").alias("times"), F.max(least).alias("least"))
    return met.filter("times >= least").select("a", "b", "times")


def _apart(met: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs whose rows still lie in different components."""
    a, b = (groups.select(F.col("node").alias(k), F.col("component").alias(f"{k}_now")) for k in "ab")
    located = met.join(a, "a", "left").join(b, "b", "left")
    return located.filter(F.coalesce("a_now", "a") != F.coalesce("b_now", "b")).drop("a_now", "b_now")

