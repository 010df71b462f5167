"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark code path: the adapters are re-stated as
SQL CTEs over the pre-registered test-table views.  Sums are cast to BIGINT
(DuckDB widens them to HUGEINT), integer columns are cast to the Spark types.
"""

from __future__ import annotations

from sacctlens import schema as S
from sacctlens.plans.queries import (ADAPTER_BASELINE, ADAPTER_CONFIG_ORDER, RECENT_RUNS, REPORT_MONTH,
                                     REPORT_YEAR)


def _jobs_cte(where: str = "") -> str:
    return f"""
raw AS (
  SELECT l_orderkey AS job_id, l_linenumber AS line_no,
    CASE WHEN l_returnflag = 'A' THEN 'normal-arm'
         WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'dev-a100-40'
         WHEN l_returnflag = 'R' THEN 'normal-a100-80'
         WHEN l_linenumber = 7 THEN NULL ELSE 'normal-x86' END AS Partition,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'f2025' || CAST(o_custkey % 10 AS VARCHAR)
         WHEN o_orderpriority = '3-MEDIUM' THEN 'ee2025' || CAST(o_custkey % 10 AS VARCHAR)
         WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'lab' ELSE NULL END AS Account,
    CASE WHEN o_orderstatus = 'F' THEN 'COMPLETED'
         WHEN o_orderstatus = 'O' THEN 'CANCELLED by ' || CAST(o_custkey AS VARCHAR)
         WHEN o_orderstatus = 'P' AND l_linenumber = 6 THEN NULL ELSE 'TIMEOUT' END AS State,
    CAST(floor(l_quantity) AS BIGINT) AS AllocCPUS,
    CASE WHEN l_linenumber = 1 THEN NULL
         WHEN l_linenumber % 2 = 0 THEN 'cpu=8,gres/gpu=' || CAST(1 + l_partkey % 4 AS VARCHAR) || ',node=1'
         ELSE 'cpu=8,gres/gpu:a100=2,node=1' END AS AllocTRES,
    CAST(floor(l_extendedprice) AS BIGINT) AS ElapsedRaw,
    CAST(l_linenumber AS BIGINT) AS NNodes,
    CAST(year(CAST(l_shipdate AS DATE)) AS INTEGER) AS year,
    CAST(month(CAST(l_shipdate AS DATE)) AS INTEGER) AS month
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey {where}
),
enriched AS (
  SELECT *,
    regexp_replace(State, 'CANCELLED(.*)', 'CANCELLED') AS estate,
    CASE WHEN State = 'COMPLETED' THEN 'COMPLETED' ELSE 'FAILED' END AS outcome,
    CASE WHEN contains(Partition, 'arm') THEN 'ARM'
         WHEN contains(Partition, 'a100') THEN 'GPU' ELSE 'AMD' END AS cluster,
    CASE WHEN starts_with(Account, 'f') THEN 'FCT'
         WHEN starts_with(Account, 'ee') THEN 'EHPC' ELSE 'LOCAL' END AS agency,
    CASE WHEN contains(Partition, 'a100') THEN CAST(ceil(AllocCPUS / 32) AS BIGINT)
         ELSE NNodes END AS old_vnodes,
    CASE WHEN contains(Partition, 'a100') THEN
           CASE WHEN AllocTRES IS NULL THEN NNodes
                WHEN regexp_matches(AllocTRES, 'gres/gpu=(\\d+)')
                  THEN TRY_CAST(regexp_extract(AllocTRES, 'gres/gpu=(\\d+)', 1) AS BIGINT)
                ELSE NNodes * 4 END
         ELSE NNodes END AS vnodes
  FROM raw
),
jobs AS (SELECT *, ElapsedRaw * vnodes AS job_seconds FROM enriched)"""


def _report_where(first_month: int = 1, last_month: int = REPORT_MONTH) -> str:
    nxt = f"{REPORT_YEAR + (last_month == 12)}-{last_month % 12 + 1:02d}-01"
    return (f"WHERE l_shipdate >= TIMESTAMP '{REPORT_YEAR}-{first_month:02d}-01' "
            f"AND l_shipdate < TIMESTAMP '{nxt}'")


_SIX = """
    COUNT(*) FILTER (WHERE outcome = 'COMPLETED') AS completed_jobs,
    COUNT(*) FILTER (WHERE outcome = 'FAILED') AS failed_jobs,
    COUNT(*) FILTER (WHERE agency <> 'LOCAL') AS jobs_nonlocal,
    CAST(COALESCE(SUM(job_seconds) FILTER (WHERE agency <> 'LOCAL'), 0) AS BIGINT) AS seconds_nonlocal,
    COUNT(*) FILTER (WHERE agency = 'EHPC') AS jobs_ehpc,
    CAST(COALESCE(SUM(job_seconds) FILTER (WHERE agency = 'EHPC'), 0) AS BIGINT) AS seconds_ehpc"""

_SIX_NAMES = ["completed_jobs", "failed_jobs", "jobs_nonlocal", "seconds_nonlocal", "jobs_ehpc", "seconds_ehpc"]
_HOURS = "CAST(seconds_nonlocal AS DOUBLE) / 3600 AS hours_nonlocal, CAST(seconds_ehpc AS DOUBLE) / 3600 AS hours_ehpc"


def _values(rows) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def _members(requests: str) -> str:
    """(report_year, report_month, tag, year, month): the month, the quarter up to it within its year, the year up to it."""
    return f"""SELECT y AS report_year, m AS report_month, 'month' AS tag, y AS year, m AS month FROM ({requests}) r(y, m)
  UNION ALL SELECT y, m, 'quarter', y, CAST(unnest(generate_series(greatest(1, m - 2), m)) AS INTEGER) FROM ({requests}) r(y, m)
  UNION ALL SELECT y, m, 'ytd', y, CAST(unnest(generate_series(1, m)) AS INTEGER) FROM ({requests}) r(y, m)"""


def _report_windows_ctes() -> str:
    spine = _values([(t, c) for t in S.TAGS for c in S.CLUSTERS])
    resum = ", ".join(f"CAST(SUM({m}) AS BIGINT) AS {m}" for m in _SIX_NAMES)
    filled = ", ".join(f"COALESCE(w.{m}, 0) AS {m}" for m in _SIX_NAMES)
    return f"""WITH {_jobs_cte(_report_where())},
grain AS (SELECT year, month, cluster, {_SIX} FROM jobs
          WHERE year = {REPORT_YEAR} AND month BETWEEN 1 AND {REPORT_MONTH} GROUP BY year, month, cluster),
members AS ({_members(f"SELECT {REPORT_YEAR}, {REPORT_MONTH}")}),
win AS (SELECT tag, cluster, {resum} FROM grain JOIN members USING (year, month) GROUP BY tag, cluster),
spine(tag, cluster) AS (VALUES {spine}),
rw AS (SELECT s.tag, s.cluster, {filled} FROM spine s LEFT JOIN win w USING (tag, cluster))"""


def _run_ctes() -> str:
    return """WITH ev AS (
  SELECT user_id AS run, 'v' || CAST(user_id % 8 AS VARCHAR) AS config,
    CASE event_type WHEN 'signup' THEN 'app_start' WHEN 'purchase' THEN 'app_end'
         WHEN 'error' THEN 'stage_submitted' WHEN 'click' THEN 'task_start'
         WHEN 'view' THEN 'task_end' END AS kind,
    epoch_us(ts) // 1000 AS ts_ms,
    CASE WHEN event_type = 'error' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS n_tasks,
    CASE WHEN event_type = 'view' THEN CAST(floor(value * 10) AS BIGINT)
                                      + CAST(json_extract_string(props, '$.k') AS BIGINT) END AS read_bytes,
    CASE WHEN event_type = 'view' THEN CAST(floor(value * 100) AS BIGINT) END AS write_bytes
  FROM events WHERE event_type IN ('signup', 'purchase', 'error', 'click', 'view')
),
agg AS (
  SELECT run, config,
    COALESCE(MIN(ts_ms) FILTER (WHERE kind = 'app_start'), 0) AS app_start_ms,
    COALESCE(MAX(ts_ms) FILTER (WHERE kind = 'app_end'), 0) AS app_end_ms,
    COUNT(*) FILTER (WHERE kind = 'stage_submitted') AS stages,
    CAST(COALESCE(SUM(n_tasks) FILTER (WHERE kind = 'stage_submitted'), 0) AS BIGINT) AS tasks,
    MIN(ts_ms) FILTER (WHERE kind = 'task_start' AND ts_ms <> 0) AS first_launch_ms,
    MAX(ts_ms) FILTER (WHERE kind = 'task_end' AND ts_ms <> 0) AS last_finish_ms,
    CAST(COALESCE(SUM(read_bytes) FILTER (WHERE kind = 'task_end'), 0) AS BIGINT) AS read_bytes,
    CAST(COALESCE(SUM(write_bytes) FILTER (WHERE kind = 'task_end'), 0) AS BIGINT) AS write_bytes
  FROM ev GROUP BY run, config
),
m0 AS (
  SELECT *, CASE WHEN app_end_ms > app_start_ms THEN CAST(app_end_ms - app_start_ms AS DOUBLE) / 1000
                 ELSE CAST(0 AS DOUBLE) END AS wall_time_s
  FROM agg
),
metrics AS (
  SELECT run, config, wall_time_s, stages, tasks,
    CAST(read_bytes AS DOUBLE) / 1048576 AS shuffle_read_mb,
    CAST(write_bytes AS DOUBLE) / 1048576 AS shuffle_write_mb,
    CASE WHEN first_launch_ms IS NOT NULL AND last_finish_ms IS NOT NULL AND wall_time_s > 0
         THEN greatest(CAST(0 AS DOUBLE), wall_time_s - CAST(last_finish_ms - first_launch_ms AS DOUBLE) / 1000)
         ELSE CAST(0 AS DOUBLE) END AS driver_time_s
  FROM m0
),
samples AS (
  SELECT user_id AS run,
    CAST(CAST(floor(value * 1048576) AS BIGINT) AS VARCHAR) AS used_raw
  FROM events WHERE event_type = 'click'
),
peaks AS (
  SELECT run, greatest(CAST(0 AS DOUBLE), COALESCE(MAX(TRY_CAST(used_raw AS DOUBLE)), CAST(0 AS DOUBLE)))
              / 1048576 AS peak_memory_mb
  FROM samples GROUP BY run
),
recent AS (
  SELECT config, run, CAST(ROW_NUMBER() OVER (PARTITION BY config ORDER BY rec DESC) AS INTEGER) AS run_no
  FROM (SELECT config, run,
               ROW_NUMBER() OVER (PARTITION BY config ORDER BY app_start_ms DESC, run ASC) AS rec
        FROM agg) WHERE rec <= """ + str(RECENT_RUNS) + """
),
bench AS (
  SELECT r.config, r.run_no, r.run, m.wall_time_s, m.stages, m.tasks, m.shuffle_read_mb,
         m.shuffle_write_mb, m.driver_time_s, COALESCE(p.peak_memory_mb, CAST(0 AS DOUBLE)) AS peak_memory_mb
  FROM recent r JOIN metrics m ON r.config = m.config AND r.run = m.run
  LEFT JOIN peaks p ON r.run = p.run
),
summary AS (
  SELECT config, COUNT(*) AS n_runs,
""" + ",\n".join(f"    ROUND(AVG({m}), 6) AS mean_{m}, ROUND(STDDEV_SAMP({m}), 6) AS std_{m}"
                 for m in S.RUN_METRIC_COLUMNS) + """
  FROM bench GROUP BY config
)"""


def _params_rows_sql() -> str:
    """CTEs ending in ``rows(key, kind, num_value, text_value, present)`` for the report month."""
    suffix = "CASE tag WHEN 'month' THEN '' WHEN 'quarter' THEN 'Trimester' ELSE 'Year' END"
    metric_vals = _values([(k, c) for k, c in S.PARAM_METRICS.items()])
    pick = " ".join(f"WHEN '{c}' THEN CAST({c} AS DOUBLE)" for c in S.PARAM_METRICS.values())
    fixed = [(f"{c.lower()}nodes", "int", float(n)) for c, n in S.MACHINE_NODES.items()]
    fixed += [("percentaviail", "float", S.AVAILABILITY_RATIO), ("eurohpcavail", "float", S.EUROHPC_SHARE)]
    fixed_sql = " UNION ALL ".join(
        f"SELECT '{k}' AS key, '{kind}' AS kind, CAST({v} AS DOUBLE) AS num_value, "
        f"CAST(NULL AS VARCHAR) AS text_value, TRUE AS present"
        for k, kind, v in fixed)
    tex_sql = " UNION ALL ".join(
        f"SELECT '{k}', 'text', CAST(NULL AS DOUBLE), '{v}', TRUE"
        for k, v in S.PARAM_TEX_EXPRESSIONS.items())
    y, m = REPORT_YEAR, REPORT_MONTH
    return _report_windows_ctes() + f""",
rwh AS (SELECT *, {_HOURS} FROM rw),
metric_keys(metric, col) AS (VALUES {metric_vals}),
cal AS (
  SELECT tag,
    CASE tag WHEN 'month' THEN make_date({y}, {m}, 1)
             WHEN 'quarter' THEN CAST(make_date({y}, {m}, 1) + INTERVAL 1 MONTH - to_months(least(3, {m})) AS DATE)
             ELSE make_date({y}, 1, 1) END AS start_date,
    last_day(make_date({y}, {m}, 1)) AS end_date,
    CAST(make_date({y}, {m}, 1) + INTERVAL 1 MONTH AS DATE) AS next_month
  FROM (VALUES ('month'), ('quarter'), ('ytd')) t(tag)
),
rows AS (
  {fixed_sql}
  UNION ALL {tex_sql}
  UNION ALL
  SELECT lower(cluster) || metric || {suffix},
    CASE WHEN col LIKE 'hours%' THEN 'float' ELSE 'int' END,
    CASE col {pick} END, CAST(NULL AS VARCHAR), (completed_jobs + failed_jobs) > 0
  FROM rwh CROSS JOIN metric_keys
  UNION ALL
  SELECT 'reportPeriod' || {suffix}, 'text', CAST(NULL AS DOUBLE),
         strftime(start_date, '%d/%m/%Y') || ' - ' || strftime(end_date, '%d/%m/%Y'), TRUE FROM cal
  UNION ALL
  SELECT 'ndays' || {suffix}, 'int', CAST(datediff('day', start_date, next_month) AS DOUBLE),
         CAST(NULL AS VARCHAR), TRUE FROM cal
  UNION ALL
  SELECT 'reportMonth', 'text', CAST(NULL AS DOUBLE), strftime(make_date({y}, {m}, 1), '%B'), TRUE
  UNION ALL
  SELECT 'reportYear', 'int', CAST({y} AS DOUBLE), CAST(NULL AS VARCHAR), TRUE
)"""


def _ordinal_sql() -> str:
    keys = ", ".join(f"'{k}'" for k in S.PARAM_KEYS)
    return f"CAST(list_position([{keys}], key) AS INTEGER)"


def _params_long_sql() -> str:
    return _params_rows_sql() + f"""
SELECT {_ordinal_sql()} AS ordinal, key, num_value, text_value FROM rows"""


def _tex_lines_sql() -> str:
    # DuckDB prints doubles in shortest round-trip form, as the macro file does.
    value = ("CASE WHEN kind = 'text' THEN text_value "
             "WHEN kind = 'int' THEN CAST(CAST(num_value AS BIGINT) AS VARCHAR) "
             "WHEN NOT present THEN '0' ELSE CAST(num_value AS VARCHAR) END")
    return _params_rows_sql() + f"""
SELECT {_ordinal_sql()} AS ordinal, '\\def\\' || key || '{{' || {value} || '}}' AS line FROM rows"""


def _all_months_sql() -> str:
    clusters = _values([(c,) for c in S.CLUSTERS])
    filled = ", ".join(f"COALESCE(g.{m}, 0) AS {m}" for m in _SIX_NAMES)
    w = "PARTITION BY year, cluster ORDER BY month"
    wins = ",\n    ".join(
        f"{m} AS month__{m}, "
        f"CAST(SUM({m}) OVER ({w} RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS quarter__{m}, "
        f"CAST(SUM({m}) OVER ({w} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS ytd__{m}"
        for m in _SIX_NAMES)
    parts = " UNION ALL ".join(
        f"SELECT year, month, '{t}' AS tag, cluster, "
        + ", ".join(f"{t}__{m} AS {m}" for m in _SIX_NAMES) + " FROM wide"
        for t in S.TAGS)
    return f"""WITH {_jobs_cte()},
grain AS (SELECT year, month, cluster, {_SIX} FROM jobs GROUP BY year, month, cluster),
bounds AS (SELECT min(make_date(year, month, 1)) AS lo, max(make_date(year, month, 1)) AS hi FROM jobs),
months AS (SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month
           FROM (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS d
                 FROM bounds)),
clusters(cluster) AS (VALUES {clusters}),
dense AS (SELECT m.year, m.month, c.cluster FROM months m CROSS JOIN clusters c),
filled AS (SELECT d.year, d.month, d.cluster, {filled}
           FROM dense d LEFT JOIN grain g ON d.year = g.year AND d.month = g.month AND d.cluster = g.cluster),
wide AS (SELECT year, month, cluster,
    {wins}
  FROM filled),
long AS ({parts})
SELECT *, {_HOURS} FROM long"""


def _reports_requested_sql() -> str:
    resum = ", ".join(f"CAST(SUM({m}) AS BIGINT) AS {m}" for m in _SIX_NAMES)
    filled = ", ".join(f"COALESCE(w.{m}, 0) AS {m}" for m in _SIX_NAMES)
    return f"""WITH {_jobs_cte()},
grain AS (SELECT year, month, cluster, {_SIX} FROM jobs GROUP BY year, month, cluster),
requests AS (SELECT DISTINCT year, month FROM jobs WHERE month IN (3, 6, 9, 12)),
members AS ({_members("SELECT year, month FROM requests")}),
win AS (SELECT report_year, report_month, tag, cluster, {resum} FROM members JOIN grain USING (year, month)
        GROUP BY report_year, report_month, tag, cluster),
spine AS (SELECT year, month, tag, cluster FROM requests, (VALUES ('month'), ('quarter'), ('ytd')) t(tag), (VALUES ('ARM'), ('AMD'), ('GPU')) c(cluster)),
long AS (SELECT s.year, s.month, s.tag, s.cluster, {filled} FROM spine s
         LEFT JOIN win w ON w.report_year = s.year AND w.report_month = s.month AND w.tag = s.tag AND w.cluster = s.cluster)
SELECT *, {_HOURS} FROM long"""


def _output_diff_sql() -> str:
    return f"""WITH {_jobs_cte()},
sep AS (
  SELECT cluster, CASE WHEN outcome = 'COMPLETED' THEN 'completed_jobs' ELSE 'failed_jobs' END AS metric,
         COUNT(*) AS value FROM jobs GROUP BY cluster, outcome
  UNION ALL
  SELECT cluster, 'jobs_nonlocal', COUNT(*) FROM jobs WHERE agency <> 'LOCAL' GROUP BY cluster
  UNION ALL
  SELECT cluster, 'seconds_nonlocal', CAST(COALESCE(SUM(job_seconds), 0) AS BIGINT)
    FROM jobs WHERE agency <> 'LOCAL' GROUP BY cluster
  UNION ALL
  SELECT cluster, 'jobs_ehpc', COUNT(*) FROM jobs WHERE agency = 'EHPC' GROUP BY cluster
  UNION ALL
  SELECT cluster, 'seconds_ehpc', CAST(COALESCE(SUM(job_seconds), 0) AS BIGINT)
    FROM jobs WHERE agency = 'EHPC' GROUP BY cluster
),
single AS (
  SELECT cluster, {_SIX} FROM jobs GROUP BY cluster
),
single_long AS (
  UNPIVOT single ON {", ".join(_SIX_NAMES)} INTO NAME metric VALUE value
),
l AS (SELECT cluster, metric, CAST(value AS BIGINT) AS value FROM sep WHERE value <> 0),
r AS (SELECT cluster, metric, CAST(value AS BIGINT) AS value FROM single_long WHERE value <> 0),
lo AS (SELECT COUNT(*) AS n FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r)),
ro AS (SELECT COUNT(*) AS n FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l))
SELECT lo.n AS left_only, ro.n AS right_only, (lo.n = 0 AND ro.n = 0) AS identical FROM lo, ro"""


def _display_sql() -> str:
    order = ", ".join(f"'{c}'" for c in ADAPTER_CONFIG_ORDER)

    def pm(m):
        return (f"printf('%.2f ± %.2f', COALESCE(mean_{m}, CAST(0 AS DOUBLE)), "
                f"COALESCE(std_{m}, CAST(0 AS DOUBLE)))")
    return f"""SELECT
  CAST(CASE WHEN list_position([{order}], config) > 0 THEN list_position([{order}], config) - 1
            ELSE {len(ADAPTER_CONFIG_ORDER)} END AS INTEGER) AS ordinal,
  config AS "Configuration",
  {pm("wall_time_s")} AS "Runtime (s)",
  printf('%.1f', COALESCE(mean_stages, CAST(0 AS DOUBLE))) AS "# Stages",
  printf('%.1f', COALESCE(mean_tasks, CAST(0 AS DOUBLE))) AS "# Tasks",
  {pm("shuffle_read_mb")} AS "Shuffle Read (MB)",
  {pm("shuffle_write_mb")} AS "Shuffle Write (MB)",
  {pm("peak_memory_mb")} AS "Peak Memory (MB)",
  {pm("driver_time_s")} AS "Driver Time (s)"
FROM summary"""


def oracle_sql() -> dict[str, str]:
    J = _jobs_cte()
    y, m = REPORT_YEAR, REPORT_MONTH
    needed = list(range(1, m + 1))               # the year up to the month holds the other windows
    job_cols = ("job_id, line_no, year, month, estate, outcome, cluster, agency, "
                "old_vnodes, vnodes, job_seconds")
    out = {
        "jobs_enriched": f"WITH {J} SELECT {job_cols} FROM jobs",
        "month_pruned_scan": f"""WITH {_jobs_cte(_report_where(min(needed), max(needed)))}
            SELECT year, month, COUNT(*) AS n_jobs FROM jobs
            WHERE year = {y} AND month IN ({", ".join(map(str, needed))}) GROUP BY year, month""",
        "union_months": f"""WITH {J}
            SELECT year, strftime(make_date(year, month, 1), '%b') AS period, COUNT(*) AS n_jobs
            FROM jobs GROUP BY year, period""",
        "state_histogram": f"""WITH {J}, h AS (SELECT estate, COUNT(*) AS n_jobs FROM jobs GROUP BY estate)
            SELECT estate, n_jobs, CAST(SUM(n_jobs) OVER () AS BIGINT) AS total_jobs FROM h""",
        "outcome_by_cluster": f"""WITH {J}
            SELECT cluster, outcome, COUNT(*) AS n_jobs FROM jobs GROUP BY cluster, outcome""",
        "usage_nonlocal": f"""WITH {J}, a AS (
            SELECT cluster, COUNT(*) AS jobs, CAST(COALESCE(SUM(job_seconds), 0) AS BIGINT) AS seconds
            FROM jobs WHERE agency <> 'LOCAL' GROUP BY cluster)
            SELECT cluster, jobs, seconds, CAST(seconds AS DOUBLE) / 3600 AS hours FROM a""",
        "usage_ehpc": f"""WITH {J}, a AS (
            SELECT cluster, COUNT(*) AS jobs, CAST(COALESCE(SUM(job_seconds), 0) AS BIGINT) AS seconds
            FROM jobs WHERE agency = 'EHPC' GROUP BY cluster)
            SELECT cluster, jobs, seconds, CAST(seconds AS DOUBLE) / 3600 AS hours FROM a""",
        "usage_by_agency_cluster": f"""WITH {J}
            SELECT agency, cluster, COUNT(*) AS jobs, CAST(COALESCE(SUM(job_seconds), 0) AS BIGINT) AS seconds
            FROM jobs GROUP BY agency, cluster""",
        "gpu_allocation_rules": f"""WITH {J}
            SELECT cluster, CAST(SUM(old_vnodes) AS BIGINT) AS sum_old_vnodes,
                   CAST(SUM(vnodes) AS BIGINT) AS sum_vnodes FROM jobs GROUP BY cluster""",
        "single_pass_metrics": f"""WITH {J}, g AS (
            SELECT year, month, cluster, {_SIX} FROM jobs GROUP BY year, month, cluster)
            SELECT *, {_HOURS} FROM g""",
        "refreshed_month_grain": f"""WITH {J}, g AS (
            SELECT year, month, cluster, {_SIX} FROM jobs GROUP BY year, month, cluster)
            SELECT *, {_HOURS} FROM g""",
        "report_windows": _report_windows_ctes() + f"\nSELECT *, {_HOURS} FROM rw",
        "report_all_months": _all_months_sql(),
        "period_calendar": f"""WITH {J},
            ym AS (SELECT DISTINCT year, month FROM raw),
            t AS (SELECT ym.year, ym.month, tg.tag FROM ym CROSS JOIN (VALUES ('month'), ('quarter'), ('ytd')) tg(tag)),
            c AS (SELECT year, month, tag,
                CASE tag WHEN 'month' THEN make_date(year, month, 1)
                         WHEN 'quarter' THEN CAST(make_date(year, month, 1) + INTERVAL 1 MONTH
                                                  - to_months(least(3, month)) AS DATE)
                         ELSE make_date(year, 1, 1) END AS start_date,
                last_day(make_date(year, month, 1)) AS end_date,
                CAST(make_date(year, month, 1) + INTERVAL 1 MONTH AS DATE) AS next_month
              FROM t)
            SELECT year, month, tag, start_date, end_date,
                   strftime(start_date, '%d/%m/%Y') || ' - ' || strftime(end_date, '%d/%m/%Y') AS label,
                   CAST(datediff('day', start_date, next_month) AS INTEGER) AS ndays,
                   CAST(datediff('day', start_date, next_month) AS INTEGER) * 24 AS hours
            FROM c""",
        "report_params_long": _params_long_sql(),
        "report_tex_lines": _tex_lines_sql(),
        "run_metrics": _run_ctes() + "\nSELECT * FROM metrics",
        "resource_peaks": _run_ctes() + """
            SELECT a.run, COALESCE(p.peak_memory_mb, CAST(0 AS DOUBLE)) AS peak_memory_mb
            FROM (SELECT DISTINCT run FROM ev) a LEFT JOIN peaks p ON a.run = p.run""",
        "recent_runs": _run_ctes() + "\nSELECT config, run, run_no FROM recent",
        "config_summary": _run_ctes() + "\nSELECT * FROM summary",
        "speedup_vs_baseline": _run_ctes() + f"""
            SELECT config, mean_wall_time_s AS mean_wall,
                   ROUND((SELECT mean_wall_time_s FROM summary WHERE config = '{ADAPTER_BASELINE}')
                         / mean_wall_time_s, 6) AS speedup
            FROM summary""",
        "output_diff": _output_diff_sql(),
        "reports_requested": _reports_requested_sql(),
        "merged_config_summary": _run_ctes() + "\nSELECT * FROM summary",
        "row_differences": f"""WITH {J}, both_sides AS (
            SELECT job_id, line_no, old_vnodes AS vnodes, 1 AS side FROM jobs
            UNION ALL SELECT job_id, line_no, vnodes, -1 FROM jobs)
            SELECT job_id, line_no, vnodes, CAST(SUM(side) AS BIGINT) AS surplus FROM both_sides
            GROUP BY job_id, line_no, vnodes HAVING SUM(side) <> 0""",
        "config_summary_display": _run_ctes() + "\n" + _display_sql(),
    }
    return out
