"""A corpus from raw documents to packed training sequences, as stages that are each written and reread.

Every stage works on all rows its predecessor kept.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specflow.llm import decontaminate, langid, linededup, packing, simhash
from specflow.session import materialize, scratch, table_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any word, and those most of whose words no learned language knows, go."""
    return langid.keep_known(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of three-line windows go; documents of which nothing is left go too."""
    cut = linededup.drop_repeated_windows(docs)
    cut = cut.where(F.col("text").rlike(r"\S"))
    return cut.withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose SimHash differs in at most three bits the one with the smallest doc_id stays."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("sequences", sequences),
]

ORACLE_SQL = None  # a learned model and edit distances: tested against a plain version instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = table_path(spark, f"stage-{name}")
        with scratch(spark):  # what a stage writes besides its result goes with it
            docs = materialize(stage(spark, docs, sf_dir), name, path)
    return docs
