"""Sinks: macro file, comparison table (CSV / LaTeX), summary documents (JSON).

All outputs are small by construction (70 parameter lines, one row per
configuration), so each is written as a single ordered part file; the data
never passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sacctlens import schema as S
from sacctlens.sources.local import local_rows


def write_lines(lines: DataFrame, path: str, order: str | tuple[str, ...] = "ordinal", column: str = "line",
                mode: str = "overwrite") -> None:
    """Write one text line per row in ``order`` as a single part file."""
    order = (order,) if isinstance(order, str) else order
    (lines.repartition(1).sortWithinPartitions(*order).select(column)
          .write.mode(mode).text(path))


def write_params_tex(tex_lines: DataFrame, path: str) -> None:
    """The ``\\def\\key{value}`` macro file (from ``report_tex_lines``)."""
    write_lines(tex_lines, path)


def write_summary_csv(display: DataFrame, path: str) -> None:
    """The comparison table as CSV with header, in display order."""
    cols = [c for c in display.columns if c != "ordinal"]
    (display.repartition(1).sortWithinPartitions("ordinal", "Configuration").select(*cols)
            .write.mode("overwrite").option("header", True).csv(path))


def _tex_escape(c):
    return F.regexp_replace(c, r"([&%$#_{}])", "\\\\$1")


def latex_table_lines(display: DataFrame, caption: str = S.TABLE_CAPTION, label: str = S.TABLE_LABEL) -> DataFrame:
    """(section, ordinal, name, line) rows of a booktabs table; head 0, body 1, foot 2.

    The body follows the display order; unknown configurations, which share
    the last ordinal, follow their name.
    """
    spark = display.sparkSession
    cols = [c for c in display.columns if c != "ordinal"]
    header = " & ".join(c.replace("#", "\\#").replace("%", "\\%") for c in cols) + " \\\\"
    head = ["\\begin{table}", f"\\caption{{{caption}}}", f"\\label{{{label}}}",
            "\\begin{tabular}{" + "l" * len(cols) + "}", "\\toprule", header, "\\midrule"]
    foot = ["\\bottomrule", "\\end{tabular}", "\\end{table}"]
    body = display.select(F.lit(1).alias("section"), F.col("ordinal").cast("int").alias("ordinal"), F.col("Configuration").alias("name"),
                          F.concat(F.concat_ws(" & ", *[_tex_escape(F.col(f"`{c}`")) for c in cols]),
                                   F.lit(" \\\\")).alias("line"))
    rows = [(section, i, "", line) for section, lines in ((0, head), (2, foot)) for i, line in enumerate(lines)]
    fixed = local_rows(spark, rows, "section int, ordinal int, name string, line string")
    return fixed.unionByName(body)


def write_summary_latex(display: DataFrame, path: str, **kw) -> None:
    write_lines(latex_table_lines(display, **kw), path, order=("section", "ordinal", "name"))


def write_summary_documents(docs: DataFrame, path: str) -> None:
    """One JSON document per configuration (``path/config=<name>/part-*.json``).

    Documents are read back in multi-line mode (which also accepts pretty-printed
    files), where a file holds exactly one document — hence one file per
    configuration.
    """
    (docs.repartition("config").write.mode("overwrite")
         .partitionBy("config").json(path))
