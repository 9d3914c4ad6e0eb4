"""From raw documents to token ids: the stages of a training corpus, each a Spark job of its own.

Null, empty and blank texts go in the first stage; rows that repeat a doc_id, or have none, are
rows like others throughout, and ties are decided as the operators' docstrings say. Texts are
whole rows of any length. An empty table gives empty results. Extra columns of any name travel
to the stage before the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import chosen_path, languages, line_runs, mixing, pieces
from corpusloom.llm.runtime import documents, scratch


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents without a letter, and those between two languages, go."""
    return languages.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: later copies of repeated line runs go; n_chars follows the text."""
    return line_runs.dedup_documents(docs)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: one document of each class of near duplicates stays."""
    return chosen_path.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents as often as the mix takes them."""
    return mixing.take(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: doc_id and the ids of its text."""
    return pieces.encode(docs, pieces.model_file())


STAGES = [
    ("language ID", identify_language),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", join_near_duplicates),
    ("mixing", mix_sources),
    ("SentencePiece", tokenise),
]

#: Trained language models and tokenisation have no SQL form; a brute-force version tests the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        where = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(where)
        docs = spark.read.parquet(where)
    where = scratch(spark, STAGES[-1][0])
    STAGES[-1][1](spark, docs, sf_dir).write.parquet(where)
    return spark.read.parquet(where)
