"""From raw documents to token files: quality, near duplicates, benchmark leaks, source mix, tokens.

Every stage works on all rows that the stage before it kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelmill.llm import token_files
from panelmill.llm.decontaminate import without_benchmark
from panelmill.llm.mixing import mixed
from panelmill.llm.ngram_join import keep_one
from panelmill.llm.quality import good
from panelmill.llm.queries import tokenizer_path
from panelmill.llm.shared import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted to the labelled ones, doesn't reject."""
    return good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of smallest doc_id, of each group of near duplicates."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, once or twice."""
    return mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back: where each begins, its length and checksum."""
    return token_files.round_trip(docs, tokenizer_path())


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    out = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = table(stage(spark, out, sf_dir), name)
    return out


#: A fitted discriminant and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
