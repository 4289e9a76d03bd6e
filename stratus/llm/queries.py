"""The operators of this package applied to the given tables, and their SQL.

Every query reads its whole tables. Where SQL cannot express an operator the
tests compare it with a brute-force version instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import align_tokenizers
from .decontaminate import decontaminate
from .frames import text_columns
from .html import extract_text
from .jaccard import jaccard_groups
from .licenses import scan_licenses
from .lmscore import score_texts
from .pieces import encode_pieces
from .quality import quality_rules
from .sharding import shard_documents
from .suffixdedup import remove_repeats
from .tokencounts import count_tokens
from .urltree import filter_urls
from .whitening import whitened_rows

#: Where the public vocabulary files are; another place can be passed to the queries that use one.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_LEVEL_PATH = "/opt/tokenizers/byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return text_columns(spark.read.parquet(f"{sf_dir}/{name}.parquet"), *columns)


def model_bytes(path: str = MODEL_PATH) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents", "doc_id", "text"), cleaned=False)
    return out.drop("text")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"), shards=8)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    out = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), cleaned=False)
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages", "page_id", "url"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), cleaned=False)
    return out.drop("text")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: English ones lie in their source's directory, others in one by language below it."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    below = F.when(F.col("lang") != "en", F.col("lang"))
    files = docs.withColumn("path", F.concat_ws("/", "source", below, F.concat(F.col("doc_id"), F.lit(".txt"))))
    return scan_licenses(files, "path").drop("text", "lang", "source")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages", "page_id", "html")).drop("html")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str = MODEL_PATH) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    out = encode_pieces(docs, model_bytes(model_path))
    return out.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_pieces"),
        F.xxhash64("piece_ids").alias("ids_hash"),
        (F.col("decoded_text") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )


def op10_token_counts(spark: SparkSession, sf_dir: str, model_path: str = MODEL_PATH) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"), model_bytes(model_path)).drop("text")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_rows(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), "vec_id", "embedding")


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str, a_path: str = BYTE_LEVEL_PATH, b_path: str = MODEL_PATH) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    figures, _ = align_tokenizers(docs, model_bytes(a_path), model_bytes(b_path))
    return figures.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_sharding, op3_decontamination, op4_url_filter, op5_suffix_array_dedup,
        op6_license_scan, op7_html_extraction, op8_jaccard_join, op9_sentencepiece, op10_token_counts,
        op11_embedding_whitening, op12_tokenizer_alignment, op13_lm_scoring,
    )
}
