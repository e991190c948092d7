"""The registered queries of the corpus operators: each takes ``(spark, sf_dir)`` and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowsmith.llm.common import documents
from rowsmith.llm.decontaminate import contamination_report
from rowsmith.llm.lang_hierarchy import identify_languages
from rowsmith.llm.line_dedup import line_dedup_report
from rowsmith.llm.line_rules import line_frequency_rules
from rowsmith.llm.lookup_clusters import cluster_vectors
from rowsmith.llm.part_codes import compress_vectors
from rowsmith.llm.quality_knn import classify
from rowsmith.llm.secret_scan import secret_report
from rowsmith.llm.sentencepiece_sampling import encode
from rowsmith.llm.sharding import shard_by_splitters
from rowsmith.llm.simhash_gray import near_duplicates
from rowsmith.llm.substring_dedup import remove_repeats
from rowsmith.llm.toxicity import score_documents


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document by the clause grammar."""
    return score_documents(documents(spark, sf_dir), documents(spark, sf_dir, "labels"), "toxic", 0.3)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampled segmentation of every document, seeded by its id, and whether it decodes to the text."""
    return encode(documents(spark, sf_dir))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 20-word windows that start earlier elsewhere."""
    return remove_repeats(documents(spark, sf_dir), 20, with_text=False)


def op4_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by the nearest labelled latent-semantic vectors."""
    return classify(documents(spark, sf_dir), documents(spark, sf_dir, "labels"), "quality", 0.7)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words inside 10-word passages of the benchmark items."""
    return contamination_report(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"), 10)


def op6_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, links within 3 bits."""
    return near_duplicates(documents(spark, sf_dir), 3, 3)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equal bytes by sampled splitters."""
    return shard_by_splitters(documents(spark, sf_dir), 16)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document from cross-document line frequency per source."""
    return line_frequency_rules(documents(spark, sf_dir))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document, judged by how many sources hold each value."""
    return secret_report(documents(spark, sf_dir))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without near copies of lines that occur earlier."""
    return line_dedup_report(documents(spark, sf_dir))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document: its family, then machines between the family's languages."""
    return identify_languages(documents(spark, sf_dir))


def op12_lookup_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every embedding: 8 integer centroids, 10 rounds by lookup tables."""
    return cluster_vectors(documents(spark, sf_dir, "embeddings"))


def op13_part_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product code of every embedding: 8 parts, 16 entries, 6 active-entry rounds."""
    return compress_vectors(documents(spark, sf_dir, "embeddings"))


_QUERIES = (
    op1_toxicity,
    op2_sentencepiece,
    op3_substring_dedup,
    op4_quality_knn,
    op5_decontamination,
    op6_simhash_gray,
    op7_sharding,
    op8_quality_rules,
    op9_secret_scan,
    op10_line_dedup,
    op11_language_id,
    op12_lookup_clusters,
    op13_part_codes,
)


def queries() -> dict:
    return {f.__name__: f for f in _QUERIES}
