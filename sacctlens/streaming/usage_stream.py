"""Incremental usage accounting with Structured Streaming.

Accounting files keep landing (a new ``jobs_<Mon>.txt`` per month, or
per-day exports).  Re-reading every file for every report is wasteful at
scale; this stream folds each new file into the month grain
(year, month, cluster -> six metrics) exactly once:

    readStream.csv(landing dir) -> enrich -> groupBy(year, month, cluster)
      -> complete-mode state (one row per month x cluster, a few hundred rows
         per decade) -> foreachBatch into a new version folder of the grain table.

Reports then run on the newest version (``read_month_grain``,
``periods.windows_from_grain``); a batch that fails leaves the last one intact.  The
checkpoint lives under the cluster's shared ``spark.checkpoint.dir`` so the
query survives driver and executor loss; ``availableNow`` processes what has
landed and stops, which suits a scheduled job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sacctlens import schema as S
from sacctlens.functions import calendar as C
from sacctlens.functions import enrich as E
from sacctlens.operators.usage import six_metric_aggs
from sacctlens.session import checkpoint_dir
from sacctlens.sources.jobs import FILE_GLOB, FILE_PATTERN


def _stream_schema(file_columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in file_columns])


def job_file_stream(spark: SparkSession, landing_dir: str, year: int,
                    file_columns: Sequence[str], max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming raw accounting rows (typed 7 columns + year, month).

    A stream needs the file layout up front: ``file_columns`` is the header of
    the export in file order (the seven job columns must be among them).
    """
    missing = [c for c in S.JOB_COLUMNS if c not in file_columns]
    if missing:
        raise ValueError(f"file_columns lacks {missing}")
    reader = (spark.readStream.schema(_stream_schema(file_columns))
              .option("sep", "|").option("header", True)
              .option("pathGlobFilter", FILE_GLOB))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.csv(landing_dir.rstrip("/"))
    period = F.regexp_extract(F.col("_metadata.file_name"), FILE_PATTERN, 1)
    typed = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in S.JOB_SCHEMA.fields]
    month = F.coalesce(C.month_from_abbr(period), F.raise_error(F.concat(F.lit("no month (Jan .. Dec): "), F.col("_metadata.file_name"))).cast("int"))
    return df.select(*typed, F.lit(int(year)).alias("year"), month.alias("month"))


def month_grain_stream(raw_stream: DataFrame) -> DataFrame:
    """Streaming month grain: (year, month, cluster) -> six metrics."""
    return E.enrich(raw_stream).groupBy("year", "month", "cluster").agg(*six_metric_aggs())


def start_month_grain(spark: SparkSession, landing_dir: str, year: int, file_columns: Sequence[str],
                      grain_path: str, name: str = "month_grain",
                      checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Start the stream; each micro-batch writes the (small) grain as a new version, one file."""
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(f"{grain_path}/version={batch_id}")

    writer = (month_grain_stream(job_file_stream(spark, landing_dir, year, file_columns))
              .writeStream.outputMode("complete")
              .option("checkpointLocation", ckpt)
              .foreachBatch(publish))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_month_grain(spark: SparkSession, grain_path: str) -> DataFrame:
    """The newest complete version of the grain."""
    versions = spark.read.parquet(grain_path)
    newest = versions.agg(F.max("version").alias("newest")).scalar()
    return versions.where(F.col("version") == newest).drop("version")
