"""Spark helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from sacctlens.session import checkpoint_dir


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a small table that one task writes.
ROWS_A_FILE = 1 << 14


def few(df: DataFrame, most: int | None) -> DataFrame:
    """Where about ``most`` short rows come at most, and these take fewer tasks than a shuffle has,
    the rows in so many partitions: written, a file costs more than the rows of a small table."""
    tasks = None if most is None else max(1, -(-most // ROWS_A_FILE))
    return df if tasks is None or tasks >= spread(df) else df.coalesce(tasks)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: the rows as a written table in the session's shared checkpoint folder.

    A table rather than ``checkpoint()``: a checkpointed frame carries the
    constraints of its plan along, and in loops these outgrow the driver.  Tables
    stay until the folder is cleaned.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/sacctlens-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's text, mod 5, is 0; rows without an id are held out too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def spread(df: DataFrame) -> int:
    """Partitions to shuffle into: the session's setting."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def unused(columns, *names: str) -> list[str]:
    """The names, each with underscores added until no column is called so (in any letter case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
