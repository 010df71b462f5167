"""Adapters from the shared test tables to the inputs of the jobs.

The library's real inputs are accounting files, event logs and resource
samples (see ``jobs.py``, ``eventlogs.py``, ``samples.py``).  The test tables
are Parquet; these adapters derive the same shapes from them so every job runs
over whole tables and its work grows with them:

* ``jobs``        = lineitem joined to orders (one accounting row per line);
* ``run_events``  = events (one run per user, events mapped to log kinds);
* ``samples``     = click events (memory samples as text);
* ``line_jobs``   = the accounting columns that lineitem alone decides, for jobs
  that need no other (a join to orders would only shuffle).

Both sides keep only the columns they need, so the Parquet scans are pruned.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sacctlens.functions import enrich as E


# Only the columns the adapters use, with their stored types: the Parquet
# reader then needs no footer inference at analysis time and reads only these.
_SCHEMAS = {
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(_SCHEMAS[name]) if name in _SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lineitem(spark: SparkSession, sf_dir: str,
              ship_range: tuple[_dt.date, _dt.date] | None = None) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate")
    if ship_range is not None:
        lo, hi = ship_range
        li = li.where((F.col("l_shipdate") >= F.lit(_dt.datetime.combine(lo, _dt.time())).cast("timestamp_ntz"))
                      & (F.col("l_shipdate") < F.lit(_dt.datetime.combine(hi + _dt.timedelta(days=1), _dt.time()))
                         .cast("timestamp_ntz")))
    return li


def _line_columns() -> list:
    """The accounting columns that a line decides."""
    line = F.col("l_linenumber")
    partition = (F.when(F.col("l_returnflag") == "A", F.lit("normal-arm"))
                 .when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), F.lit("dev-a100-40"))
                 .when(F.col("l_returnflag") == "R", F.lit("normal-a100-80"))
                 .when(line == 7, F.lit(None).cast("string"))
                 .otherwise(F.lit("normal-x86")))
    tres = (F.when(line == 1, F.lit(None).cast("string"))
            .when(line % 2 == 0, F.concat(F.lit("cpu=8,gres/gpu="),
                                          (F.lit(1) + F.col("l_partkey") % 4).cast("string"),
                                          F.lit(",node=1")))
            .otherwise(F.lit("cpu=8,gres/gpu:a100=2,node=1")))
    end_date = F.col("l_shipdate").cast("date")
    return [
        F.col("l_orderkey").alias("job_id"),
        line.alias("line_no"),
        partition.alias("Partition"),
        F.floor("l_quantity").cast("bigint").alias("AllocCPUS"),
        tres.alias("AllocTRES"),
        F.floor("l_extendedprice").cast("bigint").alias("ElapsedRaw"),
        line.cast("bigint").alias("NNodes"),
        F.year(end_date).alias("year"),
        F.month(end_date).alias("month"),
    ]


def line_jobs(spark: SparkSession, sf_dir: str, ship_range: tuple[_dt.date, _dt.date] | None = None) -> DataFrame:
    """Accounting rows without account and state: lineitem only, no join."""
    return _lineitem(spark, sf_dir, ship_range).select(*_line_columns())


def accounting_rows(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Lines (a lineitem slice) joined to their orders -> the raw accounting columns."""
    od = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    j = lines.join(od, lines.l_orderkey == od.o_orderkey, "inner")
    line = F.col("l_linenumber")
    cust_digit = (F.col("o_custkey") % 10).cast("string")
    account = (F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.concat(F.lit("f2025"), cust_digit))
               .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit("ee2025"), cust_digit))
               .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("lab"))
               .otherwise(F.lit(None).cast("string")))
    state = (F.when(F.col("o_orderstatus") == "F", F.lit("COMPLETED"))
             .when(F.col("o_orderstatus") == "O",
                   F.concat(F.lit("CANCELLED by "), F.col("o_custkey").cast("string")))
             .when((F.col("o_orderstatus") == "P") & (line == 6), F.lit(None).cast("string"))
             .otherwise(F.lit("TIMEOUT")))
    columns = _line_columns()
    return j.select(*columns[:3], account.alias("Account"), state.alias("State"), *columns[3:])


def raw_jobs(spark: SparkSession, sf_dir: str,
             ship_range: tuple[_dt.date, _dt.date] | None = None) -> DataFrame:
    """Raw accounting rows (the seven job columns + ids + year, month).

    ``ship_range`` (inclusive dates) is applied to the raw timestamp column so
    it reaches the Parquet scan as a pushed filter and skips row groups.
    """
    return accounting_rows(spark, sf_dir, _lineitem(spark, sf_dir, ship_range))


def jobs(spark: SparkSession, sf_dir: str,
         ship_range: tuple[_dt.date, _dt.date] | None = None) -> DataFrame:
    """Enriched accounting rows from the test tables."""
    return E.enrich(raw_jobs(spark, sf_dir, ship_range))


# Event kinds of the run-event model and the test event types that play them.
EVENT_KIND = {
    "signup": "app_start",
    "purchase": "app_end",
    "error": "stage_submitted",
    "click": "task_start",
    "view": "task_end",
}


def _event_ms(ts: str = "ts"):
    # Milliseconds since the epoch of a TIMESTAMP_NTZ, independent of session zone.
    return F.expr(f"timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', `{ts}`)")


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> normalised run events (run = user, config = 'v' || user % 8)."""
    ev = _table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value", "props")
    kind_expr = None
    for src, dst in EVENT_KIND.items():
        cond = F.col("event_type") == src
        kind_expr = F.when(cond, F.lit(dst)) if kind_expr is None else kind_expr.when(cond, F.lit(dst))
    k = F.get_json_object("props", "$.k").cast("bigint")
    is_end = F.col("event_type") == "view"
    return ev.where(F.col("event_type").isin(*EVENT_KIND)).select(
        F.col("user_id").alias("run"),
        F.concat(F.lit("v"), (F.col("user_id") % 8).cast("string")).alias("config"),
        kind_expr.alias("kind"),
        _event_ms().alias("ts_ms"),
        F.when(F.col("event_type") == "error", k).alias("n_tasks"),
        F.when(is_end, F.floor(F.col("value") * 10) + k).alias("read_bytes"),
        F.when(is_end, F.floor(F.col("value") * 100)).alias("write_bytes"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Memory samples as text: every click event is one sample of its run."""
    ev = _table(spark, sf_dir, "events").select("user_id", "event_type", "value")
    return ev.where(F.col("event_type") == "click").select(
        F.col("user_id").alias("run"), F.floor(F.col("value") * 1048576).cast("string").alias("used_raw"))
