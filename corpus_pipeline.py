"""From raw documents to packed token sequences, in five stages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tablecraft.llm import packing, pii, quality, simhash, toxicity
from tablecraft.llm.resources import tokenizer_file
from tablecraft.plans.lineage import checkpoint_home
from tablecraft.session import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, does not hold toxic."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules and whose host does."""
    return quality.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: four-word shingles, at most four differing bits."""
    return simhash.drop_near_copies(docs, words=4, radius=4)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without personal data; n_chars follows the new text."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens, cut and placed in sequences of 2,048."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"), 2048, ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("simhash", drop_near_copies),
    ("pii", redact),
    ("packing", pack),
]

#: The trained classifier and the tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written as Parquet and read again by the next."""
    docs, home = table(spark, sf_dir, "documents"), f"{checkpoint_home(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{home}/{name}")
        docs = spark.read.parquet(f"{home}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
