"""Spark event logs -> normalised run events.

Layouts accepted under one directory:

* flat log files (``app-20250101…``, ``…​.gz``, ``…​.zst`` / ``…​.zstd``, plain);
* rolling logs ``<folder>/events_<n>_<app>[.zstd]`` in a folder of any name — all
  parts of a folder belong to one run (the folder is the run id); parts directly
  in the log directory belong to the application in their name.

Compression is chosen by Spark from the file extension.  Lines are parsed
with an explicit schema; malformed lines land in ``_bad`` and are counted and
dropped, blank lines are skipped by the reader, ``.crc`` and ``appstatus_``
files are ignored.  Everything is distributed: files are split across tasks
and the per-run figures are algebraic aggregates (see ``operators.runs``).

Two readers:

* ``scan_event_logs`` — the normal way: one pass gives the events and every file's
  status (``sources.logsource``); no file fails the job, whatever its size or state;
* ``read_event_logs`` — Spark's own JSON reader; a file that cannot be read to its end
  fails the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sacctlens import schema as S
from sacctlens.sources import logsource, logstream

ROLLED_PART = r"^events_\d+_"
_COMPRESSION_SUFFIX = r"\.(gz|zst|zstd|lz4|snappy|lzf|inprogress)$"

EVENT_KINDS = {
    "SparkListenerApplicationStart": "app_start",
    "SparkListenerApplicationEnd": "app_end",
    "SparkListenerStageSubmitted": "stage_submitted",
    "SparkListenerTaskStart": "task_start",
    "SparkListenerTaskEnd": "task_end",
}


def _log_file_filter_and_id(path, name, logs_dir: str):
    top = logs_dir.rstrip("/").rsplit("/", 1)[-1]
    parent = F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)
    rolled = name.rlike(ROLLED_PART)
    keep = ~name.endswith(".crc") & ~name.startswith(".") & ~name.startswith("appstatus_")
    plain = F.regexp_replace(name, _COMPRESSION_SUFFIX, "")
    log_id = F.when(rolled & (parent != top), parent).otherwise(F.regexp_replace(plain, ROLLED_PART, ""))
    return keep, log_id


def read_event_logs(spark: SparkSession, logs_dir: str, leave_out: Sequence[str] = ()) -> DataFrame:
    """Raw event rows with ``log_id``, ``file_name`` and ``file_mtime_ms`` attached.

    The files of the logs in ``leave_out`` are not opened (a filter on file
    metadata).  A file that cannot be read to its end fails the job.
    """
    df = (spark.read.schema(S.EVENT_LOG_SCHEMA)
          .option("recursiveFileLookup", True)
          .option("ignoreCorruptFiles", False)
          .option("ignoreMissingFiles", False)
          .option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_bad")
          .json(logs_dir.rstrip("/")))
    name = F.col("_metadata.file_name")
    keep, log_id = _log_file_filter_and_id(F.col("_metadata.file_path"), name, logs_dir)
    if leave_out:
        keep = keep & ~log_id.isin(list(leave_out))
    return df.where(keep).select(
        "*",
        log_id.alias("log_id"),
        name.alias("file_name"),
        F.unix_millis(F.col("_metadata.file_modification_time")).alias("file_mtime_ms"),
    )


def scan_event_logs(spark: SparkSession, logs_dir: str, split: int = logsource.SPLIT) -> DataFrame:
    """Raw event rows as ``read_event_logs`` gives them, plus ``status``, in one pass over the files.

    ``status`` is null on events and set on one row per file (or range of a plain file),
    which holds no event.  Lines that are no JSON land in ``_bad``.
    """
    spark.dataSource.register(logsource.EventLogSource)
    return parsed_lines(spark.read.format(logsource.FORMAT).option("split", split).load(logs_dir.rstrip("/")))


def parsed_lines(rows: DataFrame) -> DataFrame:
    """Lines and status rows of the log sources -> event rows; what is no JSON lands in ``_bad``."""
    event = F.from_json("line", S.EVENT_LOG_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return rows.select(event.alias("e"), "log_id", "file_name", "file_mtime_ms", "status") \
               .select("e.*", "log_id", "file_name", "file_mtime_ms", "status")


def log_statuses(scanned: DataFrame) -> DataFrame:
    """Per log: ``readable``, ``still_open``, ``bad_lines``, ``events``, from one aggregate over ``scan_event_logs``."""
    return scanned.groupBy("log_id").agg(*status_aggs())


def status_aggs(streamed: bool = False) -> list:
    """Aggregates over scanned rows: whether all of a log's files could be read, whether it is still written, its malformed lines and events.

    In a stream a file has no status before it is complete, and a log is written until a row says that it has ended.
    """
    status = F.col("status")
    readable = status.isin(*logsource.READABLE, logstream.ENDED_ROW)
    still_open = ~F.coalesce(F.bool_or(status == logstream.ENDED_ROW), F.lit(False)) if streamed else F.coalesce(F.bool_or(status == "open"), F.lit(False))
    return [F.coalesce(F.bool_and(F.when(status.isNotNull(), readable)), F.lit(streamed)).alias("readable"),
            still_open.alias("still_open"),
            F.count_if(F.col("_bad").isNotNull()).alias("bad_lines"),
            F.count_if(F.col("Event").isNotNull()).alias("events")]


def undecodable_logs(spark: SparkSession, logs_dir: str) -> list[str]:
    """Ids of the logs with a file that cannot be read to its end, in order (names only reach the driver)."""
    broken = log_statuses(scan_event_logs(spark, logs_dir)).where(~F.col("readable"))
    return [r.log_id for r in broken.select("log_id").orderBy("log_id").collect()]


def list_event_logs(spark: SparkSession, logs_dir: str) -> DataFrame:
    """Every log (readable or not): ``log_id``, ``file_mtime_ms`` (latest part).

    A file listing only: the binary-file source does not read file contents
    when just the path and modification time are selected.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .load(logs_dir.rstrip("/")).select("path", "modificationTime"))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    keep, log_id = _log_file_filter_and_id(F.col("path"), name, logs_dir)
    return (files.where(keep)
            .groupBy(log_id.alias("log_id"))
            .agg(F.max(F.unix_millis("modificationTime")).alias("file_mtime_ms")))


def malformed_lines(logs: DataFrame) -> DataFrame:
    """Per log: lines that were not valid JSON (the reader's warnings) and valid events."""
    # Counting parsed events alongside keeps the query from touching only the
    # corrupt-record column, which Spark refuses on raw JSON.
    return logs.groupBy("log_id").agg(F.count_if(F.col("_bad").isNotNull()).alias("bad_lines"),
                                      F.count_if(F.col("Event").isNotNull()).alias("events"))


def log_run_events(logs: DataFrame, config: str) -> DataFrame:
    """Event rows -> run-event model (run key ``log_id``), valid lines only.

    Of a scan, the rows with a file's status or a malformed line stay too, with a null
    ``kind`` (no figure counts them) and the columns ``status``, ``_bad`` and ``Event``.
    """
    ev = F.col("Event")
    kind = None
    for event, k in EVENT_KINDS.items():
        kind = F.when(ev == event, F.lit(k)) if kind is None else kind.when(ev == event, F.lit(k))
    ts = (F.when(ev.isin("SparkListenerApplicationStart", "SparkListenerApplicationEnd"), F.col("Timestamp"))
          .when(ev == "SparkListenerTaskStart", F.col("`Task Info`.`Launch Time`"))
          .when(ev == "SparkListenerTaskEnd", F.col("`Task Info`.`Finish Time`")))
    srm = "`Task Metrics`.`Shuffle Read Metrics`"
    read = (F.coalesce(F.col(f"{srm}.`Remote Bytes Read`"), F.lit(0))
            + F.coalesce(F.col(f"{srm}.`Local Bytes Read`"), F.lit(0)))
    written = F.coalesce(F.col("`Task Metrics`.`Shuffle Write Metrics`.`Shuffle Bytes Written`"), F.lit(0))
    wanted, more = F.col("_bad").isNull() & ev.isin(*EVENT_KINDS), []
    if "status" in logs.columns:
        wanted, more = wanted | F.col("_bad").isNotNull() | F.col("status").isNotNull(), ["status", "_bad", "Event"]
    return logs.where(wanted).select(
        F.col("log_id"),
        F.lit(config).alias("config"),
        kind.alias("kind"),
        F.coalesce(ts, F.lit(0)).cast("bigint").alias("ts_ms"),
        F.coalesce(F.col("`Stage Info`.`Number of Tasks`"), F.lit(0)).cast("bigint").alias("n_tasks"),
        read.cast("bigint").alias("read_bytes"),
        written.cast("bigint").alias("write_bytes"),
        F.col("file_mtime_ms"), *more,
    )


def shuffle_by_job_group(logs: DataFrame) -> DataFrame:
    """Per log and job group: stages run, tasks and shuffle MiB read / written.

    Job-start events name their stages and carry the job group
    (``spark.jobGroup.id``); task-end events carry their stage and shuffle
    bytes.  Tasks are aggregated per (log, stage) first, then joined to the
    stage -> group rows, so the join sees one row per stage.
    """
    ok = logs.where(F.col("_bad").isNull())
    # A stage listed by several jobs (a reused shuffle) counts once per group.
    stages = (ok.where(F.col("Event") == "SparkListenerJobStart")
              .select("log_id",
                      F.col("Properties").getItem("spark.jobGroup.id").alias("job_group"),
                      F.explode("Stage IDs").alias("stage_id"))
              .distinct())
    srm = "`Task Metrics`.`Shuffle Read Metrics`"
    per_stage = (ok.where(F.col("Event") == "SparkListenerTaskEnd")
                 .groupBy("log_id", F.col("Stage ID").alias("stage_id"))
                 .agg(F.count(F.lit(1)).alias("tasks"),
                      F.sum(F.coalesce(F.col(f"{srm}.`Remote Bytes Read`"), F.lit(0))
                            + F.coalesce(F.col(f"{srm}.`Local Bytes Read`"), F.lit(0))).alias("read_bytes"),
                      F.sum(F.coalesce(F.col("`Task Metrics`.`Shuffle Write Metrics`.`Shuffle Bytes Written`"),
                                       F.lit(0))).alias("write_bytes")))
    return (stages.join(per_stage, ["log_id", "stage_id"], "left")
            .groupBy("log_id", "job_group")
            .agg(F.count_if(F.col("tasks").isNotNull()).alias("stages_run"),
                 F.coalesce(F.sum("tasks"), F.lit(0)).cast("bigint").alias("tasks"),
                 (F.coalesce(F.sum("read_bytes"), F.lit(0)) / F.lit(1048576)).alias("shuffle_read_mb"),
                 (F.coalesce(F.sum("write_bytes"), F.lit(0)) / F.lit(1048576)).alias("shuffle_write_mb")))
