"""Resource-monitor CSV files (``dstat_run_<n>.csv``) -> memory samples per run.

Each file has banner lines, a section-header row with a ``memory usage``
cell, a column-header row with ``used`` cells (repeated mid-file at times)
and numeric sample rows.  The memory column is the first exact ``used`` cell
at or after the ``memory usage`` section's offset (else the first ``used``).

Both header rows are recognisable by content, so no line order is needed.  A
first pass over the files reduces them to one small row per file (where its
memory column is); that index is broadcast if it is below ``BROADCAST_FILES``
files, and joined by shuffle otherwise.  The sample rows themselves are not
shuffled in the first case, however long a file is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sacctlens.sources.local import local_rows

#: Files whose column positions are handed to every task (about 100 bytes each).
BROADCAST_FILES = 10_000
FILE_PATTERN = r"dstat_run_(\d+)\.csv$"


def _cells(line):
    return F.transform(F.split(line, ","), lambda c: F.regexp_replace(F.trim(c), '^"|"$', ""))


def read_resource_samples(spark: SparkSession, dstat_dir: str) -> DataFrame:
    """(run_no int, used_raw string) for every row of every sample file."""
    lines = (spark.read.option("pathGlobFilter", "dstat_run_*.csv")
             .option("recursiveFileLookup", True).text(dstat_dir.rstrip("/")))
    rows = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.regexp_extract(F.col("_metadata.file_name"), FILE_PATTERN, 1).cast("int").alias("run_no"),
        _cells(F.col("value")).alias("cells"),
    )
    positions = F.sequence(F.lit(1), F.greatest(F.size("cells"), F.lit(1)))
    section = F.array_min(F.filter(positions, lambda i: F.lower(F.element_at("cells", i)).contains("memory usage")))
    used = F.filter(positions, lambda i: F.element_at("cells", i) == "used")
    index = (rows.select("file", section.alias("section_at"),
                         F.when(F.size(used) > 0, used).alias("used_at"))
             .groupBy("file")
             .agg(F.min("section_at").alias("section_at"), F.min("used_at").alias("used_at"))
             .where(F.col("section_at").isNotNull() & F.col("used_at").isNotNull()))
    column = F.coalesce(F.array_min(F.filter("used_at", lambda p: p >= F.col("section_at"))),
                        F.element_at("used_at", 1))
    found = index.select("file", column.alias("col_at")).limit(BROADCAST_FILES + 1).collect()
    if not found or len(found) > BROADCAST_FILES:
        located = rows.join(index.select("file", column.alias("col_at")), "file")
    else:
        located = rows.join(F.broadcast(local_rows(spark, [tuple(r) for r in found], "file string, col_at int")), "file")
    return located.select("run_no", F.try_element_at("cells", F.col("col_at")).alias("used_raw"))
