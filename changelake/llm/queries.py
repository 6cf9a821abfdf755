"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.llm import bpe, cws, langid, lattice, mixing, neighbours, pii, quality, ranked, simhash, substrings, turns, warc
from changelake.llm.common import crc_fold
from changelake.session import read_table, scratch_dir

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


ORACLES["op1_mix"] = mixing.oracle("documents", "doc_id, text, lang, source, n_chars")


@query
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = crc_fold("doc_id", 3) == 1
    net = langid.fit(docs.where(~held_out))
    return langid.predict(docs.select("doc_id", "text", held_out.alias("held_out")), net) \
        .select("doc_id", "held_out", "lang_pred", "score")


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [pii.count_kind("base", k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select(F.col("id").alias("doc_id"), *counts,
                        F.sha2(pii.listed("base").cast("binary"), 256).alias("base_sha256"),
                        pii.listed("spans").alias("spans"))


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.select("doc_id", simhash.hex64("fp").alias("fingerprint"), F.col("component").alias("component_id"))


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = crc_fold("doc_id", 4) == 2
    model = quality.fit(docs, labels, where=~held_out)
    return docs.select("doc_id", held_out.alias("held_out"), quality.scorer(model, spark)("text").alias("score")) \
        .withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = bpe.decode(bpe.encode(docs, vocabulary).drop("text"), vocabulary)
    return rows.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2("bytes", 256).alias("decoded_sha256"))


@query
def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cws.compare_with_next(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumnRenamed("id", "doc_id")


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    warc.write_archives(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    whole = F.col("payload").isNotNull()
    return warc.read_archives(spark, path).select(
        F.col("page").cast("bigint").alias("page_id"),
        F.when(whole, F.octet_length("payload").cast("bigint")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(whole, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", F.col("refers_to").cast("bigint").alias("refers_to"))


ORACLES["op4_warc"] = """
    WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
    f AS (SELECT d, min(page_id) AS lead FROM p WHERE n >= 100 GROUP BY d)
    SELECT p.page_id, p.n::BIGINT AS payload_bytes, p.d AS payload_digest,
           CASE WHEN f.lead <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN f.lead <> p.page_id THEN f.lead END AS refers_to
    FROM p LEFT JOIN f ON p.d = f.d"""


@query
def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"),
                              F.col("vec_id") % 100 == 0)


@query
def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query
def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations")
    repaired = turns.repair(turns.damage(rows))
    return turns.report(rows.select(F.col("conv_id").alias("conv")), repaired).withColumnRenamed("conv", "conv_id")


@query
def op12_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                         read_table(spark, sf_dir, "benchmark").select("item_id", "text"))


ORACLES["op12_ranked"] = ranked.oracle()
