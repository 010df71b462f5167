"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sacctlens.llm import (bitsliced, cgk, langid, linechunks, maskedlm, mixing, packing, parityjoin, periodic, phrases, quality, superkmers,
                           surrogates)
from sacctlens.llm.common import table
from sacctlens.llm.oracle import MIX


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.pseudonymise(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cgk.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmers.remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parityjoin.near_copies(table(spark, sf_dir, "documents"))


def op7_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    words = maskedlm.count_words(docs)
    return maskedlm.score(docs, *maskedlm.fit(docs, words=words), words=words)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return bitsliced.search(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linechunks.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed_lines", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return periodic.digests(periodic.collapse(docs.select("doc_id", periodic.repeat_tail(F.col("text"), F.col("doc_id")).alias("text"))))


QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_pii_surrogates, op3_decontaminate, op4_substring_dedup, op5_language_id, op6_jaccard_join, op7_masked_lm, op8_quality,
    op9_exact_top_k, op10_line_dedup, op11_phrases, op12_packing, op13_periodic_runs)}


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_sources": MIX}
