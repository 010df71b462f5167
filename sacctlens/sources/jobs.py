"""Job-accounting sources.

Two layouts:

* ``read_jobs`` — the raw monthly files ``jobs_<Mon>.txt`` (pipe separated,
  header row).  The month comes from the file name, the year is a parameter
  (the files do not carry one).  One listing (names only) decides what is read,
  with and without a choice of months: nested folders included, exact names
  only, one file per month, each file by its own header.
* ``write_jobs_parquet`` / ``read_jobs_parquet`` — the scalable layout: the
  same rows as Parquet partitioned by (year, month).  Reports then prune
  partitions from their (year, month) filters and read only the seven
  columns they use.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sacctlens import schema as S
from sacctlens.functions import calendar as C
from sacctlens.functions import enrich as E

# jobs_<Mon>.txt, plain or with the suffix of a codec that Spark reads.
CODECS = ("gz", "bz2", "zst", "zstd", "lz4", "snappy", "deflate")
FILE_PATTERN = rf"^jobs_([^.]*)\.txt(?:\.(?:{'|'.join(CODECS)}))?$"
FILE_GLOB = f"jobs_*.txt{{,{','.join('.' + c for c in CODECS)}}}"


def list_job_files(spark: SparkSession, datadir: str, months: Sequence[str] | None = None) -> dict[str, str]:
    """Month abbreviation -> path of its file, for all files below ``datadir``.

    Monthly files are few, so their names are gathered on the driver; contents
    are not read.  A file whose month is not ``Jan`` .. ``Dec``, and a month with
    two files (a copy, a second folder, a compressed twin), raise ``ValueError``,
    as either would give a wrong report; so does a selection without any file.
    Other names (``.bak``, notes) are not accounting files.
    """
    unknown = [m for m in months or () if m not in C.MONTH_ABBR]
    if unknown:
        raise ValueError(f"unknown month abbreviations: {unknown}")
    paths = [r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", FILE_GLOB).load(datadir.rstrip("/")).select("path").collect()]
    found: dict[str, str] = {}
    for path in sorted(paths):
        month = re.match(FILE_PATTERN, path.rsplit("/", 1)[-1])[1]
        if month not in C.MONTH_ABBR:
            raise ValueError(f"{path}: {month!r} is no month (Jan .. Dec)")
        if month in found:
            raise ValueError(f"two files for {month}: {found[month]} and {path}")
        found[month] = path
    chosen = {m: p for m, p in found.items() if not months or m in months}
    if not chosen:
        raise ValueError(f"no accounting file in {datadir} for {list(months) if months else 'any month'}")
    return chosen


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of one file: its first line."""
    line = spark.read.text(path).first()
    names = tuple(n.strip().strip('"') for n in line.value.split("|")) if line else ()
    missing = [c for c in S.JOB_COLUMNS if c not in names]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    return names


def _scans(spark: SparkSession, datadir: str, months: Sequence[str] | None, faults: bool) -> DataFrame:
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path in list_job_files(spark, datadir, months).values():
        by_header.setdefault(_header(spark, path), []).append(path)
    name = F.col("_metadata.file_name")
    typed = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in S.JOB_SCHEMA.fields]
    scans = []
    for header, paths in by_header.items():
        fields = [T.StructField(c, T.StringType()) for c in header]
        reader = spark.read.option("sep", "|").option("header", True).option("mode", "PERMISSIVE")
        extra = []
        if faults:
            # Rows of the wrong width are only noticed where all cells are parsed.
            reader = reader.option("columnNameOfCorruptRecord", RAW_LINE).option("columnPruning", False)
            fields.append(T.StructField(RAW_LINE, T.StringType()))
            extra = [_fault(len(header)).alias("fault"), F.col(RAW_LINE).alias("raw_line"),
                     F.struct(*[F.col(f"`{f.name}`") for f in S.JOB_SCHEMA.fields]).alias("cells")]
        rows = reader.schema(T.StructType(fields)).csv(paths)
        scans.append(rows.select(*typed, F.regexp_extract(name, FILE_PATTERN, 1).alias("period"), name.alias("source_file"), *extra))
    return reduce(DataFrame.unionByName, scans)


def _with_month(rows: DataFrame, year: int) -> DataFrame:
    return rows.select("*", F.lit(int(year)).alias("year"), C.month_from_abbr(F.col("period")).alias("month"))


def read_jobs(spark: SparkSession, datadir: str, year: int,
              months: Sequence[str] | None = None) -> DataFrame:
    """Raw accounting rows of ``datadir`` with ``year``, ``month``, ``period``, ``source_file``.

    ``months`` are abbreviations (``Jan`` .. ``Dec``); only their files are
    opened.  Columns are picked by each file's own header, in any order (extra
    columns are ignored and never parsed): files with equal headers are one scan,
    and the scans are unioned by name.  Numbers that do not parse become null.
    A compressed file is one task (codecs are not splittable).
    """
    return _with_month(_scans(spark, datadir, months, faults=False), year)


#: What is wrong with an accounting row, in the order in which it is told.
FAULTS = ("short", "long", "unparsable")
RAW_LINE = "_raw_line"


def _fault(width: int):
    """``short`` / ``long``: fewer or more cells than the header; ``unparsable``: a number that is none; else null."""
    cells = F.size(F.split(F.col(RAW_LINE), r"\|", -1))
    numbers = [f for f in S.JOB_SCHEMA.fields if not isinstance(f.dataType, T.StringType)]
    unparsable = reduce(lambda a, b: a | b, [
        F.col(f"`{f.name}`").isNotNull() & (F.trim(f"`{f.name}`") != "") & F.col(f"`{f.name}`").try_cast(f.dataType).isNull() for f in numbers])
    return (F.when(F.col(RAW_LINE).isNotNull() & (cells < width), F.lit("short"))
            .when(F.col(RAW_LINE).isNotNull() & (cells > width), F.lit("long"))
            .when(unparsable, F.lit("unparsable")))


def read_jobs_checked(spark: SparkSession, datadir: str, year: int, months: Sequence[str] | None = None) -> DataFrame:
    """As ``read_jobs`` (the same rows and values), plus ``fault`` (null: none), ``raw_line`` (rows of the wrong width) and ``cells`` (as text).

    Nothing is dropped: a report over these rows equals one over ``read_jobs``.
    ``quarantined`` keeps the faulty rows, ``count_faults`` counts them in the report's own pass.
    """
    return _with_month(_scans(spark, datadir, months, faults=True), year)


def quarantined(checked: DataFrame) -> DataFrame:
    """The faulty rows as they were read: source_file, period, fault, raw_line, cells."""
    return checked.where(F.col("fault").isNotNull()).select("source_file", "period", "fault", "raw_line", "cells")


def count_faults(checked: DataFrame) -> tuple[DataFrame, Callable[[], dict[str, dict[str, int]]]]:
    """The rows without the helper columns, observed on their way, and a function for the counts.

    After an action over the rows, the function gives {period: {rows, short, long,
    unparsable}} of the periods with rows; no further pass is made (observed metrics,
    four sums for each of the twelve months).
    """
    seen = Observation()
    sums = []
    for m in C.MONTH_ABBR:
        of = F.col("period") == m
        sums += [F.count_if(of).alias(f"{m}_rows"), *[F.count_if(of & (F.col("fault") == f)).alias(f"{m}_{f}") for f in FAULTS]]
    rows = checked.observe(seen, *sums).drop("fault", "raw_line", "cells")

    def counts() -> dict[str, dict[str, int]]:
        got = seen.get
        return {m: {k: got[f"{m}_{k}"] for k in ("rows", *FAULTS)} for m in C.MONTH_ABBR if got[f"{m}_rows"]}

    return rows, counts


def read_enriched_jobs(spark: SparkSession, datadir: str, year: int,
                       months: Sequence[str] | None = None) -> DataFrame:
    return E.enrich(read_jobs(spark, datadir, year, months))


def months_for_report(month: int) -> list[str]:
    """File months a report for ``month`` needs (all three windows)."""
    needed = sorted({m for ms in C.window_months(month).values() for m in ms})
    return [C.MONTH_ABBR[m - 1] for m in needed]


def write_jobs_parquet(raw: DataFrame, path: str, mode: str = "replace",
                       max_records_per_file: int = 20_000_000) -> None:
    """Store raw accounting rows as Parquet partitioned by (year, month).

    ``replace`` overwrites the months that ``raw`` has rows of and leaves all others
    (dynamic partition overwrite), so a second run, or a corrected month, doubles
    nothing; other modes are Spark's own.  A month without any row is left as it is.

    No shuffle: monthly input files already hold one month each, and Spark
    sorts each task's rows by the partition columns before writing.  There is
    deliberately no ``repartition("year", "month")`` — one busy month would
    then be written by a single task.  ``max_records_per_file`` bounds file
    sizes instead.
    """
    cols = S.JOB_COLUMNS + ["year", "month"]
    writer = raw.select(*cols).write.option("maxRecordsPerFile", max_records_per_file).partitionBy("year", "month")
    if mode == "replace":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    writer.parquet(path)


def read_jobs_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Enriched rows from the partitioned layout; filters on year/month prune partitions."""
    schema = T.StructType([*S.JOB_SCHEMA.fields, T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])
    return E.enrich(spark.read.schema(schema).parquet(path))
