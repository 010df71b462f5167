"""The corpus pipeline: documents through five stages, each an operator of sacctlens.llm.

Every stage is (spark, docs, sf_dir) -> DataFrame, works on all rows that its
predecessor kept, and returns the columns of ``documents`` (the last one returns
the mixing plan).  ``run`` writes each stage's rows as Parquet into the session's
shared checkpoint folder and reads them back as the next stage's documents, so a
lost executor repeats one stage at most.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from sacctlens.llm import cgk, langid, linechunks, mixing, parityjoin
from sacctlens.llm.common import held_out, table, unused
from sacctlens.session import checkpoint_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or further from every language than its own documents are, go; all others stay as they are.

    Null and empty texts go (no letters); texts of one language tie with nothing; rows
    without an id teach nothing but are judged; repeated rows share their fate; without
    any labelled document nothing is learned and all go.  Extra columns ride along.
    """
    langs, prototypes, bound = langid.learn_bound(docs.filter(~held_out(F.col("doc_id"))))
    return langid.accepted(docs, langs, prototypes, bound=bound)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of two or more lines go from the texts but for their first occurrence (by id, then place); documents of which nothing is left go.

    A null text stays; an empty one is one empty line and stays; rows equal in id and
    text are one document and keep the same lines; null ids come last; n_chars is that of
    the text that is left where lines went.  Extra columns ride along, whatever their names.
    """
    lines, removed = unused(docs.columns, "_lines_before", "_lines_removed")
    return (linechunks.dedup(docs, counts=(lines, removed)).filter((F.col(removed) < F.col(lines)) | (F.col(removed) == 0))
            .withColumn("n_chars", F.when(F.col(removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
            .select(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id.

    Null and empty texts have no words and are near nothing; rows without an id, and all
    rows of an id that stays, stay.  Extra columns ride along.
    """
    return parityjoin.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts hold none and stay; so does everything where the benchmark is
    empty; repeated rows share their fate.  Extra columns ride along.
    """
    return cgk.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of what is left: how many words are taken of each document.

    Null and empty texts have size 0 and nothing is taken of them; the null source is one
    source, after all others; repeated rows count each; an empty table gives no rows.
    """
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
]

#: SQL cannot express the language and benchmark stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
