"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Each stage takes (spark, docs, sf_dir) and works on all that the one before has
kept. All but the last return the columns of ``documents``; rows that share an
id count as one document from the second stage on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm.decontaminate import decontaminate
from stratus.llm.frames import Scratch, small_side
from stratus.llm.jaccard import BROADCAST_ROWS, jaccard_groups
from stratus.llm.pieces import encode_pieces
from stratus.llm.quality import quality_rules
from stratus.llm.queries import model_bytes
from stratus.llm.suffixdedup import remove_repeats


def _packed(docs: DataFrame) -> DataFrame:
    """Id, text, and the other columns as one, so that none of them meets a column that an operator adds."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*rest).alias("row"))


def _unpacked(packed: DataFrame, like: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``like``; if another column has become the text, ``n_chars`` is its length."""
    own = {"doc_id": F.col("doc_id"), "text": F.col(text)}
    if text != "text":
        own["n_chars"] = F.char_length(text).cast("long")
    return packed.select(*[own.get(c, F.col(f"row.`{c}`")).alias(c) for c in like.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that break a rule go, then documents that fail or lose too much; null and empty texts fail."""
    return _unpacked(quality_rules(_packed(docs)).where("kept"), docs, "cleaned_text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts stays, the one with the smallest id.

    Rows that share an id are one document: of several the smallest row by its
    columns stays. Rows with a null id belong to no group and stay.
    """
    scratch = Scratch(spark)
    groups = jaccard_groups(docs)
    chosen = groups.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("copies"))
    ids = scratch.store(chosen)
    once, several = ids.where("copies = 1").select("doc_id"), ids.where("copies > 1").select("doc_id")
    columns = [F.col(f"`{c}`") for c in docs.columns]  # any name, also one with a dot
    out = docs.join(small_side(once, BROADCAST_ROWS), "doc_id", "left_semi").select(*columns)
    repeated = docs.join(small_side(several, BROADCAST_ROWS), "doc_id", "left_semi").select(*columns)
    row = F.struct(*columns)
    first = repeated.groupBy(F.col("doc_id").alias("_id")).agg(F.min(row).alias("row")).select("row.*")
    return out.unionByName(first).unionByName(docs.where("doc_id IS NULL"))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 200 bytes or more that start at two places are cut out; a text may become empty."""
    return _unpacked(remove_repeats(_packed(docs)), docs, "cleaned_text")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go in which words of benchmark windows reach the limit; the others stay as they are."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _unpacked(decontaminate(_packed(docs), items, cleaned=False).where("NOT contaminated"), docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text's pieces, whose decoding has been compared with the text."""
    out = encode_pieces(docs.select("doc_id", "lang", "source", "text"), model_bytes())
    return out.select(
        "doc_id", "lang", "source", "piece_ids", F.size("piece_ids").cast("long").alias("n_pieces"),
        (F.col("decoded_text") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("suffix-array dedup", repeats),
    ("benchmark decontamination", benchmark),
    ("piece encoding", pieces),
]

#: The last stage's merges cannot be written as SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.store(stage(spark, docs, sf_dir))
    return docs
