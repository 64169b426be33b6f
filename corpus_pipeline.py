"""A training corpus from raw documents: five operators, each on all that the one before kept.

Every stage's rows are written as Parquet in the shared folder and read again as the next
one's documents, so a lost executor costs at most the stage that is running.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pairloom.llm import decontaminate, linededup, neardup, packing, quality
from pairloom.staging import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line matches go from the texts; all documents stay."""
    return linededup.dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that similarities of 0.8 or more join, by five-word shingles, stays.

    Candidates meet by operator 1's ball hashing, and by MinHash bands where they differ in more bits than it reaches.
    """
    return neardup.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go, and shorter benchmark passages from the others."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in windows: a row for each piece."""
    # Executors hold what the stages before have touched: a small cache of token ids.
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), cache_pieces=100_000)


STAGES: list[tuple[str, Stage]] = [
    ("quality", drop_poor),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_benchmark),
    ("pack", pack),
]

#: A trained model, a hash that SQL lacks and a tokenizer: SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the ``documents`` in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
