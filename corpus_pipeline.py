"""The corpus pipeline: stages over ``documents``, each written and read again by the next.

1. language ID: documents whose text is null or has no letter go; any other is given to
   the nearest learned language and stays, whatever language it is in;
2. SimHash near-dedup: of each group of near copies the smallest doc_id stays;
3. substring dedup: passages of 20 words and more that stand earlier are cut out;
4. benchmark decontamination: documents that contain a test item go;
5. byte-level BPE: token ids of every remaining text, and what they decode to.

All but the last return the columns of ``documents``; ``n_chars`` follows a cut text.
SQL cannot express the stages: ``tests/llm/test_pipeline.py`` holds them against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelworks.llm import bpe, decontaminate, language, simhash, substrings
from labelworks.operators.keep import keep


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substrings.cut_repeats(docs, window=20)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
