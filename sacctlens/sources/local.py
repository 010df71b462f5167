"""Small constant frames (report spines, window membership, fixed parameters).

Built as SQL ``VALUES`` so Catalyst sees a LocalRelation: it is folded into
the plan, broadcast for free and needs no tasks — unlike ``createDataFrame``
from Python lists, which plans a parallelised RDD scan.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, _dt.date):
        return f"DATE'{v.isoformat()}'"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def local_rows(spark: SparkSession, rows: Sequence[Sequence], ddl: str) -> DataFrame:
    """A LocalRelation with the given rows and ``name type, ...`` schema."""
    fields = [f.strip().split(None, 1) for f in ddl.split(",")]
    if not rows:
        raise ValueError("local_rows needs at least one row")
    cols = [f"c{i}" for i in range(len(fields))]
    values = ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in rows)
    select = ", ".join(f"CAST({c} AS {t}) AS `{n}`" for c, (n, t) in zip(cols, fields))
    return spark.sql(f"SELECT {select} FROM VALUES {values} AS t({', '.join(cols)})")
