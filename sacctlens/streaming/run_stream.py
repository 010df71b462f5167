"""Run figures of event logs that are still being written, with Structured Streaming.

    logs as they grow (``sources.logstream``: every line once, by byte offsets)
      -> run events -> groupBy(config, log): the same min / max / sum / count aggregates as
         the batch way, kept as state (one row per log, combined in tasks before the shuffle)
      -> update mode -> foreachBatch: the logs that changed, as a version of a table.

``read_run_aggregates`` takes each log's newest row.  Once an application has ended, its
row equals that of ``operators.compare.log_run_aggregates``; before, it has what its log
holds so far (of compressed logs: its complete parts), with ``still_open``.

A batch that is repeated after a failure overwrites its own version.  The checkpoint lies
under the cluster's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sacctlens.operators import compare as CMP
from sacctlens.operators import runs as R
from sacctlens.session import checkpoint_dir
from sacctlens.sources import eventlogs as EL
from sacctlens.sources import logsource, logstream


def event_log_stream(spark: SparkSession, logs_dir: str, split: int = logsource.SPLIT) -> DataFrame:
    """Streaming event rows with the columns of ``eventlogs.scan_event_logs``."""
    spark.dataSource.register(logstream.EventLogStream)
    rows = spark.readStream.format(logstream.FORMAT).option("split", split).load(logs_dir.rstrip("/"))
    return EL.parsed_lines(rows)


def start_run_aggregates(spark: SparkSession, logs_dir: str, config: str, table_path: str, name: str = "run_aggregates",
                         checkpoint: str | None = None, available_now: bool = True, split: int = logsource.SPLIT) -> StreamingQuery:
    """Start the stream; each micro-batch writes the logs it changed as ``version=<batch>``."""
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table_path}/version={batch_id}")

    writer = (CMP.scanned_run_aggregates(event_log_stream(spark, logs_dir, split), config, streamed=True)
              .writeStream.outputMode("update")
              .option("checkpointLocation", ckpt)
              .foreachBatch(publish))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_run_aggregates(spark: SparkSession, table_path: str) -> DataFrame:
    """Every log's newest row: the columns of ``compare.log_run_aggregates``."""
    versions = spark.read.parquet(table_path)
    columns = [c for c in versions.columns if c != "version"]
    return (versions.groupBy("config", "log_id").agg(F.max_by(F.struct(*columns), "version").alias("newest"))
            .select("newest.*"))


def read_run_metrics(spark: SparkSession, table_path: str) -> DataFrame:
    """The published metrics of every log, as ``compare.log_run_metrics`` gives them."""
    return R.metrics_from_aggregates(read_run_aggregates(spark, table_path), ("config", "log_id", "readable"))
