"""A training corpus from ``documents``: stages applied in turn, each to all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet in the shared checkpoint folder and read back as the next stage's ``docs``.
All stages but the last return the columns they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.llm import bpe, mixing, pii, quality, simhash
from changelake.llm.common import fresh
from changelake.session import read_table, scratch_dir

#: The rank file of the last stage and its pre-token pattern.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = read_table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels)
    score = fresh(docs, "quality_score")
    scored = docs.withColumn(score, quality.scorer(model, spark)(F.col("text")))
    return scored.where(F.col(score) >= quality.THRESHOLD).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to its kind in angle brackets."""
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in equal shares by repetition, in a global random order."""
    copy, key = fresh(docs, "copy"), fresh(docs, "shuffle_key")
    return mixing.mix(docs, copy_col=copy, key_col=key).drop(copy, key)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and the hash of what they decode to."""
    vocabulary = bpe.load(public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    ids, raw = fresh(docs, "ids"), fresh(docs, "decoded")
    rows = bpe.decode(bpe.encode(docs, vocabulary, out_col=ids), vocabulary, ids_col=ids, out_col=raw)
    return rows.withColumns({fresh(docs, "n_tokens"): F.size(ids).cast("bigint"),
                             fresh(docs, "decoded_sha256"): F.sha2(raw, 256)}).drop(raw)


STAGES = [
    ("quality_filter", quality_filter),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: A learned classifier and iterated graphs decide what stays, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
