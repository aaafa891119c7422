"""The corpus pipeline: each stage takes (spark, docs, sf_dir) and returns a DataFrame, written and read again for the next.

Every stage works on all that its predecessor kept; all but the last return the columns of ``documents``. Rows with NULL
ids, empty texts, repeated rows and empty tables are treated as the operators say in their docstrings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import decontamination, jaccard, mixing, token_files, toxicity
from tidemill.llm.queries import END_ID, TARGETS, vocabulary_path
from tidemill.llm.shared import new_path, table


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each Jaccard component stays."""
    return jaccard.deduplicated(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn so that token shares meet the targets."""
    return mixing.sampled(docs, TARGETS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files of the documents; returned are their digests, read from the files."""
    path = new_path(spark, "token-files")
    token_files.write_token_files(docs, path, vocabulary_path(), END_ID)
    return token_files.token_file_digests(spark, path)


STAGES = [
    ("toxicity", toxic_documents),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("mixing", source_mixing),
    ("token_output", token_output),
]

#: Log-odds, calibration and raking are fits; the stages are tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``, each result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
