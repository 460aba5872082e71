"""The queries op1 … op10 and `pipeline` over the test tables, and the SQL they are compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardspark.llm import decontamination, fingerprints, labelled, language_id, mixing, quality, toxicity, url_filter
from cardspark.llm import filter_audit, packing, vector_codes
from cardspark.llm import near_dedup as near
from cardspark.llm import substring_dedup as substring
from cardspark.llm import suffix_dedup as suffix
from cardspark.llm.shipping import ship


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: (host, path, verdict) of the rules for pages
URL_RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
]


def op1_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return url_filter.filter_urls(table(spark, folder, "pages"), URL_RULES)


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every text."""
    docs = table(spark, folder, "documents")
    return toxicity.toxicity(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words left after the removal of every repeated 35-word window."""
    return substring.substring_dedup(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every text."""
    docs = table(spark, folder, "documents")
    return quality.quality(docs, quality.fit(docs, table(spark, folder, "labels")))


def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """The benchmark items that documents contain."""
    return decontamination.contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose shingle sets have a similarity of 0.85 or more."""
    return near.near_dedup(table(spark, folder, "documents"))


def op8_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all texts and edited texts."""
    return fingerprints.edited_fingerprints(table(spark, folder, "documents"))


def op9_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes left after the removal of every 50-byte string that an earlier document has."""
    return suffix.suffix_dedup(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every text, learned from the documents outside one of three folds."""
    docs = table(spark, folder, "documents").withColumn("held_out", labelled.held_out("doc_id", 3, 1))
    model = language_id.learn(docs.filter("NOT held_out"))
    found = language_id.identify(docs, model, folds=(3, 1))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Product code of every whole embedding: 16 parts, 64 entries a part, 2 rounds."""
    return vector_codes.compress(table(spark, folder, "embeddings")).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Documents kept and removed by each step of every order of the five filters, per source."""
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels")).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
        "shapley")


def op13_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents packed into sequences of 4096 tokens at most."""
    return packing.pack(table(spark, folder, "documents"))


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_toxicity": op2_toxicity,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_source_mixing": op6_source_mixing,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_document_fingerprints": op8_document_fingerprints,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_language_id": op10_language_id,
    "op11_vector_codes": op11_vector_codes,
    "op12_filter_audit": op12_filter_audit,
    "op13_best_fit_packing": op13_best_fit_packing,
}
