"""Run metrics from a real Spark event log (written by a child Spark application)."""

import os
import subprocess
import sys
import textwrap

from sacctlens.operators import runs as R
from sacctlens.sources import eventlogs as EL

CHILD = textwrap.dedent("""
    import sys
    from pyspark.sql import SparkSession, functions as F
    logdir = sys.argv[1]
    spark = (SparkSession.builder.master("local[2]")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", "file://" + logdir)
             .config("spark.sql.shuffle.partitions", "3")
             .config("spark.sql.adaptive.enabled", "false")
             .getOrCreate())
    df = spark.range(0, 20000, numPartitions=4).select((F.col("id") % 7).alias("k"), "id")
    df.groupBy("k").agg(F.sum("id")).collect()
    spark.stop()
""")


def test_real_event_log(spark, tmp_path):
    logdir = tmp_path / "events"
    logdir.mkdir()
    script = tmp_path / "child.py"
    script.write_text(CHILD)
    env = dict(os.environ)
    subprocess.run([sys.executable, str(script), str(logdir)], check=True, timeout=300, env=env,
                   stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    files = [f for _, _, fs in os.walk(logdir) for f in fs]
    assert any(f.startswith("events_") and f.endswith(".zstd") for f in files), files  # compressed, rolling
    logs = EL.read_event_logs(spark, str(logdir))
    events = EL.log_run_events(logs, "child")
    rows = R.run_metrics(events, keys=("log_id", "config")).collect()
    assert len(rows) == 1
    m = rows[0]
    # map stage (4 tasks) + reduce stage (3 tasks)
    assert m.stages == 2 and m.tasks == 7
    assert m.wall_time_s > 0 and 0 <= m.driver_time_s <= m.wall_time_s
    assert m.shuffle_write_mb > 0 and m.shuffle_read_mb > 0
    bad = EL.malformed_lines(logs).collect()[0]
    assert bad.bad_lines == 0 and bad.events > 10


def test_shuffle_by_job_group(spark, tmp_path):
    logdir = tmp_path / "events"
    logdir.mkdir()
    script = tmp_path / "child.py"
    script.write_text(CHILD.replace('df.groupBy("k").agg(F.sum("id")).collect()',
                                    'spark.sparkContext.setJobGroup("g1", "g1")\n'
                                    'df.groupBy("k").agg(F.sum("id")).collect()\n'
                                    'spark.sparkContext.setJobGroup("g2", "g2")\n'
                                    'spark.range(10).count()'))
    subprocess.run([sys.executable, str(script), str(logdir)], check=True, timeout=300,
                   stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    rows = {r.job_group: r for r in EL.shuffle_by_job_group(EL.read_event_logs(spark, str(logdir))).collect()}
    assert rows["g1"].stages_run == 2 and rows["g1"].tasks == 7
    assert rows["g1"].shuffle_write_mb > 0 and rows["g1"].shuffle_read_mb > 0
    assert rows["g2"].tasks >= 1
