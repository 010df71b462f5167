"""Plan text of a DataFrame, as ``DataFrame.explain`` prints it.

Used by the plan assertions in the tests and by the bench to count file
scans; after an action on the same DataFrame the adaptive plan shown is the
final one.
"""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def final_plan_text(df: DataFrame) -> str:
    """The executed adaptive plan without its ``Initial Plan`` section."""
    return plan_text(df).split("== Initial Plan ==")[0]
