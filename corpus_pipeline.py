"""The corpus pipeline: raw documents to token counts, each stage written as Parquet and read again by the next.

1. ``language``: documents without a recognisable language go.
2. ``near_duplicates``: one document of each group of near copies stays.
3. ``decontamination``: documents that hold a window of a benchmark item go.
4. ``personal_data``: personal data is replaced by its kind.
5. ``tokens``: texts are encoded and decoded again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgate.llm import bpe, decontaminate, langid, minhash, pii
from corpusgate.plans.projection import materialise


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs, langid.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tokenizer = bpe.Tokenizer.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.encode(docs, tokenizer, ["doc_id"], with_ids=False)


STAGES = [
    ("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("personal_data", personal_data), ("tokens", tokens),
]

#: A trained network and a trained span model are not SQL; tests/llm checks the result against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
