"""The numbered operators as queries over the given tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, table
from tidemark.llm.decontamination import find_leaks
from tidemark.llm.html_text import extract_text
from tidemark.llm.jaccard import near_duplicates
from tidemark.llm.language import identify_language
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.metric_join import near_vectors
from tidemark.llm.mixing import mix
from tidemark.llm.multi_index import hard_negatives
from tidemark.llm.periodic_runs import find_runs, longest_run, looped, runs_digest
from tidemark.llm.pivot_search import top_k_products
from tidemark.llm.suffix_dedup import remove_repeats
from tidemark.llm.toxicity import toxicity
from tidemark.llm.url_rules import judge_urls, rules_frame

Query = Callable[[SparkSession, str], DataFrame]

# The rules of the url contract.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"), rules_frame(spark, URL_RULES))


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents")).drop("text_hash", "component")


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity(docs, table(spark, folder, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return identify_language(docs).select("doc_id", "held_out", "lang_pred", "score")


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    small_batches(spark)
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("text_hash")


def op5_html_text(spark: SparkSession, folder: str) -> DataFrame:
    small_batches(spark)
    return extract_text(table(spark, folder, "pages").select("page_id", "html"))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).drop("source", "text_hash")


def op10_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k_products(table(spark, folder, "embeddings"))


def op11_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))


def relabelled(vectors: DataFrame) -> DataFrame:
    """The next of ten labels where the id is divisible by 7."""
    other = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return vectors.withColumn("label", other)


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives(relabelled(table(spark, folder, "embeddings")))


def run_columns(found: DataFrame) -> DataFrame:
    """The number of runs, the longest run and the hashes of the contract."""
    ranked = found.withColumn("__top", longest_run(F.col("runs")))
    top = [F.col(f"__top.{name}").alias(name) for name in ("start", "length", "period")]
    milli = F.floor(F.lit(1000) * F.col("__top.length") / F.col("__top.period")).alias("exponent_milli")
    return ranked.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *top, milli, runs_digest(F.col("runs")).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return run_columns(find_runs(docs.withColumn("text", looped(F.col("doc_id"), F.col("text")))))


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_toxicity": op2_toxicity,
    "op3_language_id": op3_language_id,
    "op4_decontamination": op4_decontamination,
    "op5_html_text": op5_html_text,
    "op6_line_dedup": op6_line_dedup,
    "op7_mixing": op7_mixing,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_url_filters": op9_url_filters,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_embedding_near_dedup": op11_embedding_near_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_periodic_runs": op13_periodic_runs,
}
