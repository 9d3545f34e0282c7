"""Registered queries of the training-text operators, with their SQL where SQL can express them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tablecraft.llm import infill, lm, merkle, minhash, neighbours, packing, pii, quality, sampling, toxicity, urlfilter, warc
from tablecraft.llm.resources import tokenizer_file
from tablecraft.llm.simhash import near_copies
from tablecraft.plans.lineage import checkpoint_home
from tablecraft.session import table

QUERIES, ORACLE = {}, {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE["op5_quality"] = quality.SQL


@query
def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(table(spark, folder, "documents"))


@query
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_texts(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"))


@query
def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = f"{checkpoint_home(spark).rstrip('/')}/archives-{uuid.uuid4().hex}"
    warc.write_pages(table(spark, folder, "pages"), archives)
    return warc.page_captures(warc.assemble(warc.read_records(spark, archives, payloads=False)))


ORACLE["op8_warc"] = warc.SQL


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL


@query
def op2_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, folder, "pages"), urlfilter.RULES)


ORACLE["op2_urls"] = urlfilter.SQL



@query
def op6_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op10_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score_documents(table(spark, folder, "documents"))


@query
def op7_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.digest(table(spark, folder, "documents"), tokenizer_file("piece_bpe_32k.model"))


ORACLE["op3_pii"] = pii.SQL


@query
def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.audit(table(spark, folder, "documents"))


ORACLE["op11_merkle"] = merkle.SQL


@query
def op12_infill(spark: SparkSession, folder: str) -> DataFrame:
    return infill.digest(table(spark, folder, "documents"))


ORACLE["op12_infill"] = infill.SQL


@query
def op13_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_copies(table(spark, folder, "documents"), words=2)


ORACLE["op13_minhash"] = minhash.SQL
