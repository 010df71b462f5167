"""Configuration summary documents (one JSON document per configuration).

Shape: ``{"runs": [{run, config, wall_time_s, ...}, ...],
"summary": {config, n_runs, mean: {...}, std: {...}}}``.  Files that are not
valid JSON are reported by ``unreadable_summaries`` and skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sacctlens import schema as S

_METRICS = T.StructType([T.StructField(m, T.DoubleType()) for m in S.RUN_METRIC_COLUMNS])

SUMMARY_DOC_SCHEMA = T.StructType([
    T.StructField("runs", T.ArrayType(T.StructType([
        T.StructField("run", T.LongType()),
        T.StructField("config", T.StringType()),
        *[T.StructField(f.name, f.dataType) for f in S.RUN_METRICS_SCHEMA.fields
          if f.name not in ("run", "config")],
    ]))),
    T.StructField("summary", T.StructType([
        T.StructField("config", T.StringType()),
        T.StructField("n_runs", T.LongType()),
        T.StructField("mean", _METRICS),
        T.StructField("std", _METRICS),
    ])),
    T.StructField("_corrupt_record", T.StringType()),
])


def read_summary_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document file, with ``source_file``; malformed ones keep ``_corrupt_record``.

    ``path`` is a glob, a file, or a folder searched recursively for ``*.json``.
    """
    reader = (spark.read.schema(SUMMARY_DOC_SCHEMA)
              .option("multiLine", True)
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", "_corrupt_record"))
    if not any(ch in path for ch in "*?[{"):
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    return reader.json(path).select("*", F.col("_metadata.file_name").alias("source_file"))


def unreadable_summaries(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("_corrupt_record").isNotNull() | F.col("summary").isNull()).select("source_file")


def summary_runs(docs: DataFrame) -> DataFrame:
    """Run rows of all readable documents (config taken from the summary)."""
    ok = docs.where(F.col("_corrupt_record").isNull() & F.col("summary").isNotNull())
    return ok.select(F.col("summary.config").alias("config"), F.explode("runs").alias("r")) \
             .select("config", "r.run", *[f"r.{m}" for m in S.RUN_METRIC_COLUMNS])


def summary_table(docs: DataFrame) -> DataFrame:
    """The stored summaries flattened to (config, n_runs, mean_<m>, std_<m>)."""
    ok = docs.where(F.col("_corrupt_record").isNull() & F.col("summary").isNotNull())
    return ok.select(
        F.col("summary.config").alias("config"), F.col("summary.n_runs").alias("n_runs"),
        *[c for m in S.RUN_METRIC_COLUMNS for c in
          (F.col(f"summary.mean.{m}").alias(f"mean_{m}"), F.col(f"summary.std.{m}").alias(f"std_{m}"))])
