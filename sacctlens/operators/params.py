"""The report's parameter table and its macro-file lines.

The table holds 70 keys in a fixed order: window labels, month and year,
machine constants, day counts, and the six metrics for every cluster and
window (``<cluster><Metric><WindowSuffix>``).  Metrics come from
``report_windows`` (9 rows), labels and day counts from the report calendar
(3 rows); the rest are fixed values.  Nothing is collected to the driver.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sacctlens import schema as S
from sacctlens.functions import calendar as C
from sacctlens.functions import render
from sacctlens.operators import periods as P
from sacctlens.sources.local import local_rows

_PARAM_COLS = "key string, kind string, num_value double, text_value string, present boolean"

# Key suffix of each window tag, as SQL over the ``tag`` column.
_SUFFIX = "CASE tag " + " ".join(f"WHEN '{t}' THEN '{x}'" for t, x in S.TAG_SUFFIX.items()) + " END"
_NO_TEXT = "CAST(NULL AS STRING)"
_NO_NUM = "CAST(NULL AS DOUBLE)"


def _entry(key: str, kind: str, num: str, text: str) -> str:
    return f"named_struct('key', {key}, 'kind', '{kind}', 'num_value', {num}, 'text_value', {text})"


def _metric_rows(windows: DataFrame) -> DataFrame:
    entries = ", ".join(
        _entry(f"concat(lower(cluster), '{metric_key}', {_SUFFIX})",
               "float" if column.startswith("hours") else "int", f"CAST({column} AS DOUBLE)", _NO_TEXT)
        for metric_key, column in S.PARAM_METRICS.items())
    return windows.selectExpr("(completed_jobs + failed_jobs) > 0 AS present", f"inline(array({entries}))") \
                  .select("key", "kind", "num_value", "text_value", "present")


def _calendar_rows(cal: DataFrame) -> DataFrame:
    per_window = ", ".join([
        _entry(f"concat('reportPeriod', {_SUFFIX})", "text", _NO_NUM, "label"),
        _entry(f"concat('ndays', {_SUFFIX})", "int", "CAST(ndays AS DOUBLE)", _NO_TEXT),
    ])
    per_report = ", ".join([
        _entry("'reportMonth'", "text", _NO_NUM, C.MONTH_NAME_SQL),
        _entry("'reportYear'", "int", "CAST(year AS DOUBLE)", _NO_TEXT),
    ])
    rows = cal.selectExpr(f"inline(array({per_window}))", "TRUE AS present")
    month_rows = cal.where("tag = 'month'").selectExpr(f"inline(array({per_report}))", "TRUE AS present")
    return rows.unionByName(month_rows)


def _fixed_rows(spark) -> DataFrame:
    rows = [(f"{c.lower()}nodes", "int", float(n), None, True) for c, n in S.MACHINE_NODES.items()]
    rows += [("percentaviail", "float", S.AVAILABILITY_RATIO, None, True),
             ("eurohpcavail", "float", S.EUROHPC_SHARE, None, True)]
    rows += [(k, "text", None, v, True) for k, v in S.PARAM_TEX_EXPRESSIONS.items()]
    return local_rows(spark, rows, _PARAM_COLS)


def param_ordinal():
    """1-based position of ``key`` in the fixed key order (one SQL expression)."""
    keys = ", ".join(f"'{k}'" for k in S.PARAM_KEYS)
    return F.expr(f"CAST(array_position(array({keys}), key) AS INT)")


def report_params(jobs: DataFrame, year: int, month: int,
                  ytd_start: _dt.date | None = None, windows: DataFrame | None = None) -> DataFrame:
    """(ordinal, key, kind, num_value, text_value, present) — 70 rows in key order.

    ``windows`` may pass a precomputed window report (e.g. from a saved month
    grain, ``periods.windows_from_grain``); ``jobs`` is then not read.
    """
    spark = (windows if windows is not None else jobs).sparkSession
    windows = P.report_windows(jobs, year, month) if windows is None else windows
    cal = P.report_calendar(spark, year, month, ytd_start)
    rows = _metric_rows(windows).unionByName(_calendar_rows(cal)).unionByName(_fixed_rows(spark))
    return rows.select(param_ordinal().alias("ordinal"), "*")


def report_params_long(jobs: DataFrame, year: int, month: int,
                       ytd_start: _dt.date | None = None) -> DataFrame:
    """ordinal, key, num_value (numbers as double), text_value (labels, names, TeX)."""
    return report_params(jobs, year, month, ytd_start).select("ordinal", "key", "num_value", "text_value")


def value_text_sql(kind="kind", num="num_value", text="text_value", present="present",
                   num_text="_num_text") -> str:
    """Render a parameter value the way the macro file prints it (SQL expression).

    Integers print plainly, floats in shortest round-trip form (``num_text``,
    see ``render.with_float_text``); a metric of a cluster absent from the
    window keeps its default ``0``.
    """
    return (f"CASE WHEN {kind} = 'text' THEN {text} "
            f"WHEN {kind} = 'int' THEN CAST(CAST({num} AS BIGINT) AS STRING) "
            f"WHEN NOT {present} THEN '0' ELSE {num_text} END")


def report_tex_lines(jobs: DataFrame | None, year: int, month: int,
                     ytd_start: _dt.date | None = None, windows: DataFrame | None = None) -> DataFrame:
    """(ordinal, line) with ``\\def\\<key>{<value>}`` per parameter."""
    params = render.with_float_text(report_params(jobs, year, month, ytd_start, windows),
                                    "num_value", "_num_text")
    return params.selectExpr("ordinal", f"concat('\\\\def\\\\', key, '{{', {value_text_sql()}, '}}') AS line")
