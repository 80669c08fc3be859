"""The registered queries of this subpackage, each over its whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm import byte_bpe, pii, token_files
from hearth.llm.common import documents
from hearth.llm.decontaminate import contained_items
from hearth.llm.filter_audit import audit
from hearth.llm.main_text import main_text
from hearth.llm.neighbours import nearest_neighbours
from hearth.llm.ngram_join import ngram_components
from hearth.llm.oracle import ORACLE as ORACLE
from hearth.llm.substring_dedup import dedup_passages
from hearth.llm.token_counts import token_counts
from hearth.llm.topk_search import top_k
from hearth.llm.toxicity import toxicity
from hearth.llm.whitening import whiten

#: Id that ends each document in the token files.
END_ID = 2
NEIGHBOURS = 5


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file, the same on every worker."""
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(documents(spark, sf_dir))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest_neighbours(vectors, vectors.where("vec_id % 50 = 0"), NEIGHBOURS)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_passages(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(documents(spark, sf_dir), tokenizer_path("byte_bpe_multi_50k.tiktoken"), tokenizer_pattern())


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.digests(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), END_ID)


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(documents(spark, sf_dir))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interactions of five filters over all documents, for each source, order and step."""
    return audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, whitened along their first 16 principal axes."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best five rows by inner product for each embedding whose id is divisible by 50."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), NEIGHBOURS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_personal_data": op2_personal_data,
    "op3_decontamination": op3_decontamination,
    "op4_neighbours": op4_neighbours,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_token_files": op8_token_files,
    "op9_main_text": op9_main_text,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_filter_audit": op11_filter_audit,
    "op12_whitening": op12_whitening,
    "op13_topk_search": op13_topk_search,
}
