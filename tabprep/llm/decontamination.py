"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A mask selects some of eight consecutive words and ignores the others. Benchmark items are hashed
under both masks at every position, documents under one mask at even positions and under the other
at odd ones, and equal hashes are joined. Around each hit the words are compared on the hit's
diagonal: an overlap is a run of 13 words of the item (the whole item, if it is shorter) of which at
most 2 are substituted. For 13 words, however 2 substitutions lie and at whichever parity the run
starts, a mask at one of its positions meets none of them, so every overlap is found. Items of 8 to
12 words, of which 1 may be substituted, have seeds of their own in a second join, which is left out
if there are none: four consecutive words at every position, of which one half or the other of an
item is always unchanged. Items of fewer than 8 words must stand in a document as they are: a third
join, again only if there are any, compares hashes of whole sequences of the lengths that occur.

The benchmark's hashes are broadcast in blocks of a fixed number of rows; documents are never
exchanged, only the hits are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.scratch import materialize

MASKS = ((0, 1, 2, 6, 7), (0, 1, 4, 6, 7))
SPAN = 8
#: The mask of items of fewer than OVERLAP words: no more than half of the shortest.
SHORT_MASKS, SHORT_SPAN = ((0, 1, 2, 3),), 4
OVERLAP, SUBSTITUTIONS = 13, 2
#: Rows of one broadcast: a seed hash, an item, a place and the words around it, under 300 bytes each.
BLOCK_SEEDS = 100_000


def _words(text: Column) -> Column:
    """Hashes of the lower-case words of a text; none for a null one."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[ \\t-\\r]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _starts(span: int) -> Column:
    """Positions at which a mask fits."""
    last = F.size("words") - span
    return F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def _under(masks: tuple, number: int, at: Column) -> Column:
    """Hash of the words at a position under a mask."""
    return F.xxhash64(F.lit(number), *(F.get(F.col("words"), at + o) for o in masks[number]))


def _around(words: str, at: Column, reach: int, span: int) -> Column:
    """The words from ``reach`` before a seed to ``reach`` after it; null beyond the ends."""
    return F.transform(F.sequence(F.lit(-reach), F.lit(span - 1 + reach)), lambda k: F.get(F.col(words), at + k))


def _hits(rows: DataFrame, items: DataFrame, masks: tuple, span: int, overlap: int, substitutions: int) -> DataFrame:
    """Seeds of items in documents that lie in an overlap: ``doc_id``, ``item_id``, ``at``, ``matched``."""
    reach = max(overlap - span, 0)
    items = items.withColumn("at", F.explode(_starts(span)))
    items = items.withColumn("h", F.explode(F.array(*(_under(masks, k, F.col("at")) for k in range(len(masks))))))
    seeds = items.select(
        "h",
        "item_id",
        _around("words", F.col("at"), reach, span).alias("expected"),
        F.least(F.size("words"), F.lit(overlap)).alias("length"),
    )
    seeds = materialize(seeds.distinct())
    blocks = max(1, -(-seeds.count() // BLOCK_SEEDS))
    if len(masks) == 1:
        hashes = F.transform(_starts(span), lambda i: _under(masks, 0, i))
    else:
        hashes = F.transform(_starts(span), lambda i: F.when(i % 2 == 0, _under(masks, 0, i)).otherwise(_under(masks, 1, i)))
    rows = rows.select("doc_id", "words", F.posexplode(hashes).alias("at", "h"))

    hits = None
    for number in range(blocks):
        # A block of a hash split holds about BLOCK_SEEDS rows.
        block = seeds if blocks == 1 else seeds.filter(F.pmod(F.xxhash64("h", "item_id"), F.lit(blocks)) == number)
        found = rows.join(F.broadcast(block), "h").select(
            "doc_id", "item_id", "at", "expected", "length", _around("words", F.col("at"), reach, span).alias("found")
        )
        hits = found if hits is None else hits.union(found)
    same = F.zip_with("expected", "found", lambda x, y: F.when(x.eqNullSafe(y) & x.isNotNull(), 1).otherwise(0))
    # Every run of the needed length that holds the seed.
    runs = F.transform(
        F.sequence(F.lit(0), F.lit(2 * reach + span) - F.col("length")),
        lambda k: F.aggregate(F.slice("same", k + 1, F.col("length")), F.lit(0), lambda total, x: total + x),
    )
    return (
        hits.select("doc_id", "item_id", "at", "length", same.alias("same"))
        .select("doc_id", "item_id", "at", "length", F.array_max(runs).alias("matched"))
        .filter(F.col("length") - F.col("matched") <= substitutions * F.col("length") / overlap)
        .drop("length")
    )


def _whole(rows: DataFrame, items: DataFrame) -> DataFrame:
    """Places where an item of fewer than ``SPAN`` words stands unchanged: ``doc_id``, ``item_id``, ``at``, ``matched``."""
    # At most SPAN - 1 lengths.
    lengths = sorted(r.n for r in items.select(F.size("words").alias("n")).distinct().collect())
    seeds = materialize(items.select(F.xxhash64("words").alias("h"), "item_id", F.size("words").alias("matched")).distinct())
    blocks = max(1, -(-seeds.count() // BLOCK_SEEDS))

    def runs(n: int) -> Column:
        return F.transform(_starts(n), lambda i: F.struct(i.alias("at"), F.xxhash64(F.slice("words", i + 1, F.lit(n))).alias("h"), F.lit(n).alias("matched")))

    rows = rows.select("doc_id", F.inline(F.flatten(F.array(*(runs(n) for n in lengths)))))
    hits = None
    for number in range(blocks):
        block = seeds if blocks == 1 else seeds.filter(F.pmod(F.xxhash64("h", "item_id"), F.lit(blocks)) == number)
        found = rows.join(F.broadcast(block), ["h", "matched"]).select("doc_id", "item_id", "at", "matched")
        hits = found if hits is None else hits.union(found)
    return hits


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    overlap: int = OVERLAP,
    substitutions: int = SUBSTITUTIONS,
    least_words: int = 1,
) -> DataFrame:
    """Overlaps of documents with benchmark items, one row per document and item.

    Columns: ``doc_id``, ``item_id``, ``n_hits`` (distinct places of the document where a seed lies in an
    overlap), ``first_word`` (the first of them) and ``matched`` (the most equal words of an overlap). Items of
    fewer than ``SPAN`` words match wherever all their words stand in a row, unchanged. Items of fewer than
    ``least_words`` words, null and empty texts match nothing.
    Repeated rows add nothing, a null id is reported as such, other columns are ignored, and empty tables
    give an empty result. With other ``overlap`` or ``substitutions`` than the defaults the masks still find
    every overlap that leaves eight words around a mask unchanged, or four of an item shorter than ``overlap``.
    """
    items = benchmark.select(F.col(item_column).alias("item_id"), _words(F.col(item_text_column)).alias("words"))
    items = items.filter(F.size("words") >= max(least_words, 1))
    rows = docs.select(F.col(id_column).alias("doc_id"), _words(F.col(text_column)).alias("words"))
    tiny, items = items.filter(F.size("words") < SPAN), items.filter(F.size("words") >= SPAN)
    short = items.filter(F.size("words") < overlap)
    verified = _hits(rows, items.filter(F.size("words") >= overlap), MASKS, SPAN, overlap, substitutions)
    if not short.isEmpty():
        verified = verified.union(_hits(rows, short, SHORT_MASKS, SHORT_SPAN, overlap, substitutions))
    if not tiny.isEmpty():
        verified = verified.union(_whole(rows, tiny))
    return verified.groupBy("doc_id", "item_id").agg(
        F.count_distinct("at").alias("n_hits"), F.min("at").cast("bigint").alias("first_word"), F.max("matched").cast("bigint").alias("matched")
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of documents that overlap with no benchmark item, all columns kept; rows without an id stay."""
    marked = contaminated(docs, benchmark, id_column, text_column).select(F.col("doc_id").alias("_marked")).dropna().distinct()
    marked = materialize(marked)
    return docs.join(marked, docs[id_column] == marked["_marked"], "left_anti")
