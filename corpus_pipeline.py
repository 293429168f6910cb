"""Preparation of a training corpus: five stages from ``documents`` to packed bins.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``. Rows without
an id pass all stages that decide by id; empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm import decontamination, language_id, ngram_join, packing, sketch_clusters, substring_dedup
from tabprep.llm.common import read_table
from tabprep.scratch import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is like that of a language; the languages are learned from ``lang``.

    Null texts, texts without letters and texts that resemble no language go, as those in a script that no
    language has; see ``language_id.learn_floors``. Every text is compared, whether its language is given or not: a
    text that resembles nothing that was learned is no text of the language that it is given out for. If no row
    has a language, all texts with letters stay.
    """
    profiles = language_id.learn_profiles(docs)
    if not profiles.names:
        return docs.filter(F.col("text").rlike("\\p{L}"))
    return language_id.resembling(docs, profiles, language_id.learn_floors(docs, profiles))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of similar texts; texts without words stay.

    Of rows that repeat an id the one whose text has the least hash stays.
    """
    groups = materialize(ngram_join.similar_groups(docs))
    others = materialize(groups.filter("doc_id <> component_id").select(F.col("doc_id").alias("_other")).distinct())
    repeated = groups.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1")
    repeated = materialize(repeated.select(F.col("doc_id").alias("_again")))
    # The table's own columns get names that clash with none of these.
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    own_id, own_text = F.col(names["doc_id"]), F.col(names["text"])
    plain = docs.toDF(*names.values())
    kept = plain.join(others, own_id == F.col("_other"), "left_anti")
    if not repeated.isEmpty():
        once = kept.join(repeated, own_id == F.col("_again"), "left_anti")
        again = kept.join(repeated, own_id == F.col("_again"), "left_semi")
        first = F.min_by(F.struct(*names.values()), F.struct(F.xxhash64(own_text), own_text))
        kept = once.union(again.groupBy(own_id.alias("_id")).agg(first.alias("row")).select("row.*"))
    return kept.toDF(*docs.columns)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words or more that a document with a smaller id has; emptied ones go."""
    return substring_dedup.without_repeats(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no item of ``benchmark``."""
    return decontamination.clean(docs, read_table(spark, sf_dir, "benchmark"))


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document lies in bins of 8192 bytes, apart from its near duplicates; see ``packing.pack``.

    The stages before leave no documents of a similarity of 0.75, but those that cutting has made alike or that have no id.
    """
    rows = materialize(sketch_clusters.near_clusters(docs))
    return packing.pack(rows, cluster=F.col("cluster"), size=F.col("size"))


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_benchmark_leaks),
    ("best_fit_packing", pack_bins),
]

#: SQL can't express components, learned languages and best fit; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
