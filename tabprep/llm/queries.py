"""Registered queries of this folder: thin callers of the operators over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm import (
    chat_format,
    decontamination,
    html_extraction,
    importance,
    language_id,
    ngram_join,
    oracles,
    packing,
    sketch_clusters,
    spelling_variants,
    substring_dedup,
    token_counts,
    topk_search,
    toxicity,
    warc,
)
from tabprep.llm.common import read_table
from tabprep.scratch import materialize


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _part(of: int):
    """Remainder of the checksum of a document's id, by which rows are held out."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins whose documents differ in source and in cluster of near duplicates."""
    rows = materialize(sketch_clusters.near_clusters(read_table(spark, sf_dir, "documents")))
    return packing.pack(rows, cluster=F.col("cluster"), size=F.col("size"))


#: A conversation that is added to the table: its texts hold the template's own control strings.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    return chat_format.conversation_digests(chat_format.format_turns(given.union(added)))


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk_search.whole_numbers(read_table(spark, sf_dir, "embeddings"))
    return topk_search.top_k(vectors.filter("vec_id % 50 = 0"), vectors)


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(read_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(_part(3) == 1, F.lit(False)))
    profiles = language_id.learn_profiles(docs.filter(_part(3) != 1))
    texts = docs.select("doc_id", "held_out", "text")
    return language_id.identify(texts, profiles, keep_text=False).select("doc_id", "held_out", "lang_pred", "score")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_words(read_table(spark, sf_dir, "documents")).drop("removed")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").filter(_part(5) != 0)
    model = toxicity.learn_toxicity(docs, labels)
    docs = docs.withColumn("held_out", F.coalesce(_part(5) == 0, F.lit(False)))
    scored = toxicity.score_toxicity(docs, model, keep_text=False)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = importance.scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return importance.ranked(scored).select("doc_id", "n_features", "weight", "score", "rank")


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.deduplicate(warc.write_responses(read_table(spark, sf_dir, "pages")))
    found = warc.referred(warc.read_headers(files))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(spelling_variants.vocabulary(read_table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_topk_search": op4_topk_search,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_decontamination": op6_decontamination,
    "op7_language_id": op7_language_id,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_toxicity": op10_toxicity,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_warc": op12_warc,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES: dict[str, str] = {
    "op3_chat_formatting": oracles.OP3,
    "op4_topk_search": oracles.OP4,
    "op5_ngram_jaccard_join": oracles.OP5,
    "op8_substring_dedup": oracles.OP8,
    "op11_importance_resampling": oracles.OP11,
    "op12_warc": oracles.OP12,
    "op13_spelling_variants": oracles.OP13,
}
