"""The registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.llm.common import table


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of documents as token ids in grammar-compressed shards, read back."""
    from gridcast.llm.tokens import default_tokenizer, tokenize
    return tokenize(table(spark, sf_dir, "documents"), default_tokenizer())


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, exact or edited, with the alignment score."""
    from gridcast.llm.decontaminate import contaminated
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents left when every 20-word window with an earlier equal one is removed."""
    from gridcast.llm.substrings import dedup_substrings, digest
    return digest(dedup_substrings(table(spark, sf_dir, "documents")))


def op4_format_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in the chat template, read back, with digests of turns and loss text."""
    from gridcast.llm.chat import format_conversations
    return format_conversations(table(spark, sf_dir, "conversations"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents chosen under the hierarchical budget: a row per document and epoch that takes it."""
    from gridcast.llm.mixing import mix_documents
    rows, added = mix_documents(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", *(F.col(added[c]).alias(c) for c in ("epoch", "domain", "lang", "source", "tokens")))


def op6_language_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text of documents, learned from those that are not held out."""
    from gridcast.llm.ppm import predict_languages
    return predict_languages(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document under 5-word shingle Jaccard links of 0.8 or more."""
    from gridcast.llm.jaccard import jaccard_components
    return jaccard_components(table(spark, sf_dir, "documents"))


def op8_toxicity_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of documents from its nearest labelled examples."""
    from gridcast.llm.toxicity import score_documents
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted", "evidence")


def op9_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of documents; a source is an owner, a document a repository."""
    from gridcast.llm.secrets import secrets
    return secrets(table(spark, sf_dir, "documents"))


def op10_repetition_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition coverage and quality rules over every whole text of documents."""
    from gridcast.llm.quality import quality
    return quality(table(spark, sf_dir, "documents"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every 64-component vector of embeddings after ten exact integer rounds over subvector dictionaries."""
    from gridcast.llm.centroids import cluster_vectors
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def op12_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, found through the two-level capture index and read back by range."""
    from gridcast.llm.warc import archive_pages
    return archive_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-byte codes of every vector of embeddings from codebooks trained in four exact integer rounds."""
    from gridcast.llm.vector_codes import vector_codes
    return vector_codes(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_token_shards, op2_decontaminate, op3_substring_dedup, op4_format_chat, op5_mix_sources, op6_language_ppm,
    op7_ngram_jaccard, op8_toxicity_knn, op9_secret_ownership, op10_repetition_quality,
    op11_centroid_clusters, op12_warc_index, op13_vector_codes)}
