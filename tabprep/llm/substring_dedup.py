"""Substring dedup by difference-cover anchors.

A difference cover is a set of residues modulo a period such that any two positions can be moved by
one common shift, smaller than the period, onto residues of the set. Anchors, runs of
``window - period + 1`` words, are hashed at cover positions only (6 of 31). Two equal windows then
hold an equal anchor at the same place, wherever in their documents they start. Anchors that lie in
one text only are dropped. Each one left is extended to the windows that contain it, and a window
counts as a repeat when an extended window with the same words starts in a document with a smaller
id. No pairs are formed: the smallest id of an anchor's or a window's occurrences is an aggregate.

Texts with equal words are one text, held by its smallest id; later copies are repeats as a whole.
"""

from __future__ import annotations

import hashlib
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from tabprep.llm.common import Output, Words, bitmap, likely, rows_of, slices
from tabprep.scratch import materialize

WINDOW, PERIOD = 50, 31


@cache
def difference_cover(period: int) -> tuple[int, ...]:
    """A smallest set of residues whose differences are all residues modulo ``period``."""
    size = 1
    while size * (size - 1) + 1 < period:
        size += 1
    while True:
        for rest in combinations(range(1, period), size - 1):
            chosen = (0, *rest)
            if len({(a - b) % period for a in chosen for b in chosen}) == period:
                return chosen
        size += 1


def _key(words: Words) -> int:
    """64-bit key of a word sequence."""
    return int.from_bytes(hashlib.blake2b(words.joined, digest_size=8).digest(), "little", signed=True)


def _scan(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), ("whole", pa.string())])
    rows = []
    for doc_id, text in rows_of(batches, "doc_id", "text"):
        words = Words(text)
        rows.append((doc_id, words.n, _key(words), hashlib.sha256(words.joined).hexdigest()))
        if len(rows) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _anchors(batches, window, period):
    size = window - period + 1
    cover = np.zeros(period, bool)
    cover[list(difference_cover(period))] = True
    out = Output(pa.schema([("h", pa.int64()), ("key", pa.int64()), ("pos", pa.int32())]))
    for (text,) in rows_of(batches, "text"):
        words = Words(text)
        if words.n >= window:
            at = np.arange(words.n - size + 1)
            at = at[cover[at % period]]
            yield from out.add(words.hashes(at, size).view(np.int64), np.full(len(at), _key(words)), at.astype(np.int32))
    yield from out.flush()


def _extended(batches, window, period):
    """Windows around the shared anchors of a text, as ``(h, doc_id, key, pos)``."""
    out = Output(pa.schema([("h", pa.int64()), ("doc_id", pa.int64()), ("key", pa.int64()), ("pos", pa.int32())]))
    for doc_id, text, key, anchors in rows_of(batches, "doc_id", "text", "key", "anchors"):
        words = Words(text)
        if _key(words) != key:
            continue  # another row under the same id
        opened = np.zeros(words.n + 1, np.int64)
        at = np.array(anchors)
        np.add.at(opened, np.maximum(at - period + 1, 0), 1)
        np.add.at(opened, at + 1, -1)
        starts = np.flatnonzero(np.cumsum(opened)[: words.n - window + 1] > 0)
        if len(starts):
            yield from out.add(
                words.hashes(starts, window).view(np.int64), np.full(len(starts), doc_id), np.full(len(starts), key), starts.astype(np.int32)
            )
    yield from out.flush()


def _covered(n: int, starts: list[int], window: int) -> np.ndarray:
    """Which of n words lie in a window that starts at one of the given words."""
    edges = np.zeros(n + 1, np.int64)
    at = np.unique(np.array(starts, np.int64))
    edges[at] += 1
    np.add.at(edges, at + window, -1)
    return np.cumsum(edges)[:n] > 0


def _cut(batches, window, schema):
    """Rows with repeated words cut out of the text, and what was cut.

    ``starts`` null means that the whole text repeats.
    """
    for batch in slices(batches, 64):
        kept = {"text": [], "_removed": [], "_sha": [], "_spans": []}
        take = []
        for i, (text, key, starts) in enumerate(rows_of([batch], "text", "_key", "_starts")):
            words = Words(text)
            if _key(words) != key:
                continue
            gone = _covered(words.n, starts, window) if starts is not None else np.ones(words.n, bool)
            edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
            left = b" ".join(w for w, g in zip(words.words, gone.tolist()) if not g)
            take.append(i)
            kept["text"].append(left)
            kept["_removed"].append(int(gone.sum()))
            kept["_sha"].append(hashlib.sha256(left).hexdigest())
            kept["_spans"].append([{"first": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)])
        if take:
            rest = batch.select([f.name for f in schema if f.name not in kept]).take(pa.array(take))
            columns = [_column(kept[f.name], f.type) if f.name in kept else rest.column(f.name) for f in schema]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _column(values: list, kind: pa.DataType) -> pa.Array:
    """Values as an array; texts are given as UTF-8 bytes."""
    return pa.array(values, pa.large_binary()).cast(kind) if values and isinstance(values[0], bytes) else pa.array(values, kind)


class Repeats:
    """What repeats in a table of documents: ``rows`` by document, and ``marks``, the repeated windows by text."""

    def __init__(self, docs: DataFrame, window: int, period: int):
        if not 0 < period <= window:
            raise ValueError("the period must not exceed the window")
        spark = docs.sparkSession
        self.docs, self.window = docs, window
        self.rows = materialize(docs.mapInArrow(_scan, "doc_id bigint, n bigint, key bigint, whole string"))
        self.first = self.rows.filter(f"doc_id is not null and n >= {window}").groupBy("key").agg(F.min("doc_id").alias("first_id"))

        texts = docs.filter("doc_id is not null")
        anchors = texts.mapInArrow(lambda b: _anchors(b, window, period), "h bigint, key bigint, pos int")
        shared = anchors.groupBy("h").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low <> high")
        hits = anchors.join(shared.select("h"), "h").groupBy("key").agg(F.collect_set("pos").alias("anchors"))
        hits = materialize(hits.join(self.first, "key").withColumnRenamed("first_id", "doc_id"))
        windows = self._texts(hits).mapInArrow(
            lambda b: _extended(b, window, period), "h bigint, doc_id bigint, key bigint, pos int"
        )
        low = windows.groupBy("h").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high")
        repeated = windows.join(low.select("h", "low"), "h").filter("doc_id > low")
        self.marks = materialize(repeated.groupBy("doc_id", "key").agg(F.collect_set("pos").alias("starts")))
        self.spark = spark

    def _texts(self, marked: DataFrame) -> DataFrame:
        """Texts of the marked ids, beside the marks; others are left out before the exchange."""
        texts = self.docs.filter("doc_id is not null").select("doc_id", "text")
        return likely(texts, "doc_id", bitmap(marked, "doc_id")).join(marked, "doc_id")


def _named(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))


def repeated_words(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, period: int = PERIOD) -> DataFrame:
    """What is left of each document without the windows that start in a document with a smaller id.

    Returns a row per input row: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` (of the kept words,
    joined by one space) and ``removed``, the runs of removed words as ``{first, end}``. Windows are judged on
    the input. Null and empty texts have no words. Rows that share an id never remove each other's words; a
    row without an id takes no part and keeps its words. Repeated rows repeat the result; other columns are
    ignored; an empty table gives an empty one.
    """
    found = Repeats(_named(docs, id_column, text_column), window, period)
    cut_type = "doc_id bigint, _key bigint, _removed bigint, _sha string, _spans array<struct<first:bigint,end:bigint>>"
    schema = pa.schema(
        [("doc_id", pa.int64()), ("_key", pa.int64()), ("_removed", pa.int64()), ("_sha", pa.string()),
         ("_spans", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))]
    )
    texts = found._texts(found.marks).withColumnsRenamed({"key": "_key", "starts": "_starts"})
    cut = texts.mapInArrow(lambda b: _cut(b, window, schema), cut_type).dropDuplicates(["doc_id", "_key"])
    rows = found.rows.join(found.first, "key", "left")
    rows = rows.join(cut.select(F.col("doc_id").alias("_id"), *cut.columns[1:]), (F.col("doc_id") == F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    whole = F.col("doc_id") > F.col("first_id")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    one_run = F.array(F.struct(F.lit(0).cast("bigint").alias("first"), F.col("n").alias("end")))
    return rows.select(
        "doc_id",
        F.col("n").alias("n_words"),
        F.when(whole, F.col("n")).otherwise(F.coalesce("_removed", F.lit(0).cast("bigint"))).alias("n_removed"),
        F.when(whole, nothing).otherwise(F.coalesce("_sha", "whole")).alias("kept_sha256"),
        F.when(whole, one_run).otherwise(F.coalesce("_spans", F.array().cast("array<struct<first:bigint,end:bigint>>"))).alias("removed"),
    )


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, period: int = PERIOD) -> DataFrame:
    """The table with repeated words cut out of its texts, all columns kept.

    Texts without repeats stay as they are, white space included; from others the kept words remain, joined by
    one space. A document of which nothing remains goes. Rows without an id, and texts shorter than a window
    (empty and null ones too), stay. Other columns may have any names.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.toDF(*names.values())
    own_id, own_text = names[id_column], names[text_column]
    found = Repeats(_named(docs, id_column, text_column), window, period)
    copies = found.rows.join(found.first, "key").filter("doc_id > first_id")
    copies = copies.select("doc_id", "key", F.lit(None).cast("array<int>").alias("starts"))
    marks = materialize(found.marks.union(copies).dropDuplicates(["doc_id", "key"]))
    found_ids = bitmap(marks, "doc_id")
    numbered = plain.withColumn("_own", F.col(own_id).cast("bigint"))
    untouched = likely(numbered, "_own", found_ids, without=True).drop("_own")
    marked = likely(numbered, "_own", found_ids)
    marked = marked.mapInArrow(lambda b: _keyed(b, own_text), StructType([*marked.schema, StructField("_key", LongType())]))
    marked = marked.join(
        marks.select(F.col("doc_id").alias("_id"), F.col("key").alias("_marked"), F.col("starts").alias("_starts"), F.lit(True).alias("_found")),
        (F.col("_own") == F.col("_id")) & (F.col("_key") == F.col("_marked")),
        "left",
    ).drop("_own")
    same = marked.filter("_found is null").select(*untouched.columns)
    cut = marked.filter("_found").withColumnRenamed(own_text, "text").drop("_id", "_marked", "_found")
    kept = cut.drop("_key", "_starts").withColumn("_removed", F.lit(0).cast("bigint")).schema
    arrow = to_arrow_schema(cut.drop("_key", "_starts").schema)
    cut = cut.mapInArrow(lambda b: _cut(b, window, arrow.append(pa.field("_removed", pa.int64()))), kept)
    cut = cut.filter("text <> ''").drop("_removed").withColumnRenamed("text", own_text).select(*untouched.columns)
    return untouched.union(same).union(cut).toDF(*docs.columns)


def _keyed(batches, text):
    """The rows with the key of their text."""
    for batch in slices(batches):
        keys = [_key(Words(data)) for (data,) in rows_of([batch], text)]
        yield batch.append_column("_key", pa.array(keys, pa.int64()))
