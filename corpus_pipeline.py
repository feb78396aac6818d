"""A corpus pipeline over documents: language, toxicity, near-duplicates, mixing and token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes what it returns as Parquet below the shared
folder, gives what it reads from there to the next and removes what no stage needs any more. Stages judge their own input: classifiers learn from labelled
rows of the tables in sf_dir and score every row they get. Rows with a null in any column go through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, jaccard_join, language_id, mixing, toxicity
from ledgerloom.llm.queries import WEIGHTS, bpe_digests
from ledgerloom.storage import new_folder, remove, scratch


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has letters and a language; the language is learnt from docs' own lang."""
    model = language_id.fit(docs, ~language_id.held_out("doc_id", 5, 0))
    return language_id.keep_identified(docs, model)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs.select("doc_id", "text"), labels, ~language_id.held_out("doc_id", 3, 1))
    return toxicity.keep_clean(docs, model)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of a Jaccard similarity of 0.8 or more join."""
    return jaccard_join.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, each as often as the mix of sources takes it."""
    return mixing.emit(docs, WEIGHTS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    return bpe_digests(bpe.round_trip(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [("language", language), ("clean", clean), ("distinct", distinct), ("mixed", mixed), ("encoded", encoded)]

#: The classifiers' scores can't be had from SQL, so tests/llm holds the stages against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        with scratch(spark):  # what a stage settles is not needed once its result is written
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
