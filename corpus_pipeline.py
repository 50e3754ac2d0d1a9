"""From raw documents to a training mix: each stage's result is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchspark.llm import decontaminate, langid, mixing, neardup, pii
from matchspark.llm._shared import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, and those whose language is in doubt, go.

    Dictionaries are learned from this stage's input. Null and empty texts and texts without a letter go; where nothing can
    be learned (no row has lang, text and doc_id) all go. Rows are judged one by one, so repeated rows and ids share their
    fate; ties go to the language that is first by code point, and are in doubt. No rows give no rows. No column changes,
    whatever its name.
    """
    learned = langid.learn(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.keep_sure(docs, learned)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8.

    The row of the smallest doc_id stays (null last, then by text). Texts without words, null ones too, are linked with
    nothing and stay, but for rows that repeat both doc_id and text. Different texts that share a doc_id, or have none, are
    different documents. No rows give no rows. No column changes.
    """
    return neardup.deduplicate(docs, k=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go: a passage of weighted similarity 0.8 or more on shingles of five words.

    Null and empty texts, on either side, match nothing and stay. Rows are judged one by one; rows of one text share their
    fate. No rows, or an empty benchmark, change nothing. No column changes.
    """
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows.

    No row goes. Null texts stay null with a null n_chars, empty ones stay empty with 0. Overlapping spans count as the
    first one. Rows are independent but for the model, which all rows train. No rows give no rows. Other columns stay.
    """
    return pii.redact(docs, length_col="n_chars")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, numbered in `copy` (copy_ where docs has a copy).

    Null sources are one source. Null and empty texts have size 0 and are sampled like others. Rows that share an id are
    sampled on their own. Ties in size are broken by hash of id and text. No rows give no rows.
    """
    return mixing.mix(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("personal_data", personal_data), ("mix", mix)]

#: Compression sizes and fitted models are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
