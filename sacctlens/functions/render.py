"""Number-to-text rendering that matches how the report file prints numbers.

The report prints integers plainly and floating-point values in their shortest
round-trip form, switching to exponent notation only below 1e-4 or from 1e16
on (``116148.0675``, ``0.0002777777777777778``, ``12345678.5``, ``1e+16``).
Spark's ``cast(double as string)`` switches to ``E`` notation outside
[1e-3, 1e7) and, on JDK 17, is not always the shortest form.  ``with_float_text``
picks the shortest ``%.ke`` text that parses back to the same double and lays
it out with string functions only, so it stays a JVM expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fixed_text(c: Column, digits: int) -> Column:
    """``c`` with ``digits`` decimals, rounded like C / Python ``%.Nf``.

    ``format_number`` rounds half-even on the exact binary value (as printf
    does); ``format_string('%.2f')`` rounds the shortest decimal form half-up
    and disagrees on ties (0.125 -> 0.13, 1.005 -> 1.01).  The grouping commas
    of ``format_number`` are removed.
    """
    return F.regexp_replace(F.format_number(c.cast("double"), digits), ",", "")


def with_float_text(df: DataFrame, source: str, out: str) -> DataFrame:
    """Add ``out`` = ``source`` (double) printed in shortest round-trip form.

    Staged as successive projections: the shortest-form search runs once per
    row and its parts are parsed once, which keeps each generated method far
    below the JVM's 64 KB limit (one nested expression would re-expand the
    search in every branch).  Each stage is one SQL expression list.
    """
    v = f"CAST(`{source}` AS DOUBLE)"
    # 1. Shortest "%.ke" form (k = 0..16) that parses back to the same double.
    tries = ", ".join(
        f"CASE WHEN try_cast(format_string('%.{k}e', {v}) AS DOUBLE) = {v} "
        f"THEN format_string('%.{k}e', {v}) END" for k in range(17))
    finite = f"{v} IS NOT NULL AND NOT isnan({v}) AND abs({v}) != double('inf')"
    pattern = "'^(-?)([0-9])(?:[.]([0-9]+))?e([+-][0-9]+)$'"
    keep = [f"`{c}`" for c in df.columns]
    staged = df.selectExpr(*keep, f"CASE WHEN {finite} THEN coalesce({tries}) END AS _ft_s")
    # 2. Sign, leading digit, fraction digits, exponent.
    staged = staged.selectExpr(
        *keep,
        f"regexp_extract(_ft_s, {pattern}, 1) AS _ft_sign",
        f"regexp_extract(_ft_s, {pattern}, 2) AS _ft_lead",
        f"regexp_extract(_ft_s, {pattern}, 3) AS _ft_frac",
        f"CAST(regexp_extract(_ft_s, {pattern}, 4) AS INT) AS _ft_exp",
        f"{v} AS _ft_v")
    staged = staged.selectExpr("*", "concat(_ft_lead, _ft_frac) AS _ft_digits")
    # 3. Positional layout for 1e-4 <= |v| < 1e16, exponent form otherwise.
    n = "length(_ft_digits)"
    small = "concat('0.', repeat('0', -_ft_exp - 1), _ft_digits)"
    big = (f"CASE WHEN {n} <= _ft_exp + 1 THEN concat(_ft_digits, repeat('0', _ft_exp + 1 - {n}), '.0') "
           f"ELSE concat(substring(_ft_digits, 1, _ft_exp + 1), '.', substring(_ft_digits, _ft_exp + 2)) END")
    mantissa = "CASE WHEN _ft_frac = '' THEN _ft_lead ELSE concat(_ft_lead, '.', _ft_frac) END"
    sci = (f"concat({mantissa}, 'e', CASE WHEN _ft_exp < 0 THEN '-' ELSE '+' END, "
           f"format_string('%02d', abs(_ft_exp)))")
    body = (f"CASE WHEN _ft_exp >= -4 AND _ft_exp < 0 THEN {small} "
            f"WHEN _ft_exp >= 0 AND _ft_exp < 16 THEN {big} ELSE {sci} END")
    text = ("CASE WHEN _ft_v IS NULL THEN CAST(NULL AS STRING) "
            "WHEN isnan(_ft_v) THEN 'nan' "
            "WHEN _ft_v = double('inf') THEN 'inf' WHEN _ft_v = double('-inf') THEN '-inf' "
            f"ELSE concat(_ft_sign, {body}) END")
    return staged.selectExpr(*keep, f"{text} AS `{out}`")
