"""Queries of this subpackage and their SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from specflow.llm import (
    cotraining,
    decontaminate,
    fingerprints,
    langid,
    linededup,
    negatives,
    packing,
    pfor,
    resampling,
    simhash,
    unigram,
    vectors,
    warc,
)
from specflow.session import table_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {
    "op5_line_windows": linededup.ORACLE,
    "op12_resampling": resampling.ORACLE,
    "op13_hard_negatives": negatives.ORACLE,
}


def query(func):
    QUERIES[func.__name__] = func
    return func


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_language(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op2_token_blocks(spark, sf_dir):
    path = table_path(spark, "token-blocks")
    pfor.write_token_blocks(table(spark, sf_dir, "documents"), path)
    return pfor.read_token_blocks(spark, path)


@query
def op3_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op5_line_windows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.drop_repeated_windows(docs, counts=True)


@query
def op9_decontamination(spark, sf_dir):
    return decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_embeddings(spark, sf_dir):
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op7_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return cotraining.score_documents(docs, cotraining.train(docs, table(spark, sf_dir, "labels")))


@query
def op8_token_counts(spark, sf_dir):
    return unigram.count_tokens(table(spark, sf_dir, "documents"))


@query
def op10_warc(spark, sf_dir):
    path = table_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path)


@query
def op11_fingerprints(spark, sf_dir):
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


@query
def op12_resampling(spark, sf_dir):
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_hard_negatives(spark, sf_dir):
    return negatives.mine(table(spark, sf_dir, "embeddings"))
