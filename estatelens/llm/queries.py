"""The operators as queries over the given tables: callables and SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelens.llm import bpe, chat, decontaminate, exact_dedup, html_extract, language, packing, prefix_trie, simhash, substring_dedup, suffix_dedup, url_filter, whitening


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark contamination of every document."""
    found = decontaminate.contamination(_documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return decontaminate.judged(found).drop("text_key")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    model = language.fit(_documents(spark, sf_dir, "doc_id", "text", "lang"))
    out = language.predict(_documents(spark, sf_dir, "doc_id", "text"), model)
    return out.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url: given rules, then rules mined from labels."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    shown = pages.select(url_filter.document_id(F.col("url")).alias("page_id"), "url")
    rules = url_filter.mine(shown, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return url_filter.url_filter(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and near-duplicate components of all documents."""
    found = simhash.simhash_components(_documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of power-of-two length."""
    return packing.pack(_documents(spark, sf_dir, "doc_id", "text"), with_ids=False)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word windows that occur twice, removed from all documents."""
    found = substring_dedup.substring_dedup(_documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later copies of byte strings, removed from all documents."""
    found = suffix_dedup.suffix_dedup(_documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents, dropped rows included."""
    found = exact_dedup.exact_dedup(_documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dialogue from every participant's perspective."""
    found = chat.rotate(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    mask = F.array_join(F.transform("mask", lambda m: F.concat_ws("+", m["first"].cast("string"), m["length"].cast("string"))), ",")
    return found.select("conv_id", "speaker", "part", "lane", "n_turns", "text", mask.alias("mask"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings whitened on up to 16 components."""
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations."""
    return prefix_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text they decode to."""
    found = bpe.encode(_documents(spark, sf_dir, "doc_id", "text"), decoded_col="decoded")
    ids = F.array_join(F.col("input_ids").cast("array<string>"), ",")
    return found.select("doc_id", F.size("input_ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_decontaminate, op2_language, op3_url_filter, op4_simhash, op5_packing, op6_substring_dedup, op7_suffix_dedup,
        op8_html_extract, op9_exact_dedup, op10_chat_format, op11_whitening, op12_prefix_trie, op13_bpe)
}
