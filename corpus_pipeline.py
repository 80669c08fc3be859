"""A corpus pipeline over ``documents``: toxic texts go, one of each group of near copies
stays, texts that hold benchmark items go, personal data are masked, and what is left is
encoded.  Each stage is written as Parquet and read again as the next one's input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hearth.llm import byte_bpe
from hearth.llm.common import Scratch, documents
from hearth.llm.decontaminate import drop_contaminated
from hearth.llm.ngram_join import one_per_group
from hearth.llm.pii import sanitise
from hearth.llm.queries import tokenizer_path, tokenizer_pattern
from hearth.llm.toxicity import drop_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id."""
    return one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and what reveals them are masked; ``n_chars`` follows the text."""
    return sanitise(docs)


def byte_bpe_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit) of each document, with digests of them and of
    what they decode to."""
    ranks = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode(docs, ranks, tokenizer_pattern(), hashes=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("byte_bpe", byte_bpe_ids),
]

#: A trained classifier and a tokenizer are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    scratch, docs, before = Scratch(spark), documents(spark, sf_dir), None
    for _, stage in STAGES:
        written = scratch.write(stage(spark, docs, sf_dir))
        if before:
            before.drop()
        docs, before = written.df, written
    return docs
