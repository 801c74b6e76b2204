"""The corpus pipeline: quality, near duplicates, repeated lines, benchmark passages, tokens.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its result is written as Parquet and
read again as the next one's docs. All but the last return the columns of ``documents``. Rows with null texts
count as empty texts, empty tables pass through, and columns beside doc_id and text are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelens.llm import byte_bpe, decontaminate, importance, line_dedup, simhash
from carelens.llm.common import quoted, ship
from carelens.llm.queries import tokenizer_file, tokenizer_pattern
from carelens.session import materialise

#: The stages' operators work on hashes, samples and automata that SQL does not have.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels, rejects go."""
    ship(spark)
    return importance.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: three words to a shingle, at most 3 bits apart."""
    ship(spark)
    return simhash.keep_one(docs, shingle=3, distance=3)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines, sentences and passages that an earlier document (or line) has are cut out; every document stays."""
    ship(spark)
    return line_dedup.remove_repeats(docs, line_words=line_dedup.LINE_WORDS).select(*map(quoted, docs.columns))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with the digests of ids and decoded bytes."""
    ship(spark)
    ranks = byte_bpe.load_ranks(tokenizer_file("byte_bpe_multi_50k.tiktoken"))
    return byte_bpe.round_trip(docs, ranks, tokenizer_pattern(), with_ids=True, remember=100_000)  # other stages' memory is not all given back


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_lines", repeated_lines),
    ("benchmark_passages", benchmark_passages),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each on its predecessor's written result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
