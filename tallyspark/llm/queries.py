"""One query per operator over the given tables, returning the columns that its contract fixes first."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import (
    centroid_clusters,
    decontamination,
    html_text,
    language_id,
    lexical_search,
    mixing,
    ngram_join,
    pii,
    quality,
    repeats,
    token_counts,
    toxicity,
    url_filter,
)
from tallyspark.llm.shared import new_path

TOKENIZER = "piece_bpe_32k.model"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark words found in every document."""
    found = decontamination.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op2_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(_table(spark, folder, "pages"))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, through a cache that starts empty in the shared folder."""
    import public_tokenizers

    cache = new_path(spark, "token-counts")
    return token_counts.count_tokens(_table(spark, folder, "documents"), cache, public_tokenizers.path(TOKENIZER))


def op4_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return ngram_join.similar_groups(_table(spark, folder, "documents"))


def op4_link_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and numbers of links of all documents; the statement of `op4_ngram_join` has no such number."""
    return ngram_join.link_counts(_table(spark, folder, "documents"))


def op5_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without strings of 100 bytes that start earlier."""
    cut = repeats.remove_repeats(_table(spark, folder, "documents"), with_rest=False)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts on every page's URL."""
    judged = url_filter.judge_urls(_table(spark, folder, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    return pii.find(_table(spark, folder, "documents"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document."""
    scored = quality.score(_table(spark, folder, "documents"))
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lost_words"
    )


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document."""
    mixed = mixing.mix(_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document."""
    found = language_id.identify(_table(spark, folder, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    judged = toxicity.judge(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return judged.select("doc_id", "held_out", "score", "predicted")


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return lexical_search.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op13_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Eight clusters of the embeddings after ten rounds."""
    found = centroid_clusters.cluster(_table(spark, folder, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_html_text": op2_html_text,
    "op3_token_counts": op3_token_counts,
    "op4_ngram_join": op4_ngram_join,
    "op4_link_counts": op4_link_counts,
    "op5_repeats": op5_repeats,
    "op6_url_filter": op6_url_filter,
    "op7_personal_data": op7_personal_data,
    "op8_quality_rules": op8_quality_rules,
    "op9_mixing": op9_mixing,
    "op10_language": op10_language,
    "op11_toxicity": op11_toxicity,
    "op12_lexical_search": op12_lexical_search,
    "op13_centroid_clusters": op13_centroid_clusters,
}
