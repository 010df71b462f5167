"""Mixing sources to target weights by systematic sampling.

Each source's target comes from its weight (water filling under a cap of
``max_copies`` times its size).  Inside a source every document expects
target / size copies; documents are laid on a line of expected copies, shifted
by one random offset, and a document is emitted once for each integer boundary
that falls into its stretch.  The line is ordered by document size, so each size
class is sampled at the same rate and the words taken stay within about one
document of the target.

The line is never one task: its prefix sums are taken on three levels (source,
document size, ``SLICES`` hash slices), and only the rows of one slice of one
size are numbered together.

Defined results: a null or empty text has size 0 and takes 0 words; null sources
form one source, last in order; equal rows are equal documents and each gets its
own stretch; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from sacctlens.llm.common import materialize

#: Weights by rank of the source, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Words wanted, as a share of all words.
SHARE = 1.5
MAX_COPIES = 2
WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix"
#: Expected copies are whole multiples of 2^-24, so that prefix sums are exact.
UNIT = 1 << 24
#: Hex digits of the hash that name a slice: 256 slices.
SLICE_DIGITS = 2


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size (words) and the hash that orders equal sizes."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    ).withColumn("h", F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).cast("binary")))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES) -> DataFrame:
    """source, source_size -> target: one row per source, all windows over that list.

    With caps c = max_copies * size, the level that meets the total solves
    sum(min(c, level * w)) = total; sources are tried in order of c / w, and the
    first that is not filled at the level left for it gives the level (past it the
    level only falls, so it is the largest such level).
    """
    every = Window.orderBy("source_null", "source").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ordered = Window.orderBy("source_null", "source")
    up = Window.orderBy("ratio", "source_null", "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(ordered) - 1) % len(weights) + 1)
    return (
        sizes.withColumn("source_null", F.col("source").isNull())
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(max_copies)))
        .withColumn("total", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("filled", F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("open_w", F.sum("weight").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.coalesce("filled", F.lit(0.0))) / F.col("open_w"))
        .withColumn("level", F.max(F.when(F.col("ratio") >= F.col("level"), F.col("level"))).over(every))
        .select("source", "source_size", "weight",
                F.when(F.col("level").isNull(), F.col("cap"))
                .otherwise(F.least("cap", F.col("level") * F.col("weight"))).alias("target"))
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    rows = materialize(sized(docs, id_col, text_col, source_col))
    slice_of = F.substring("h", 1, SLICE_DIGITS)
    cells = rows.groupBy("source", "size", slice_of.alias("slice")).agg(F.count(F.lit(1)).alias("n"))
    by_size = cells.groupBy("source", "size").agg(F.sum("n").alias("n"))
    sources = by_size.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    targets = source_targets(sources, weights, share, max_copies)
    before = Window.unboundedPreceding
    size_line = by_size.select(
        "source", "size", F.coalesce(F.sum("n").over(
            Window.partitionBy("source").orderBy("size").rowsBetween(before, -1)), F.lit(0)).alias("size_before"))
    cell_line = cells.select(
        "source", "size", "slice", F.coalesce(F.sum("n").over(
            Window.partitionBy("source", "size").orderBy("slice").rowsBetween(before, -1)), F.lit(0)).alias("slice_before"))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(SEED + ":source:"), F.coalesce("source", F.lit("\u0000"))).cast("binary")), 1, 6), 16, 10)
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT)).otherwise(F.lit(0))
    line = (
        _join(_join(cell_line, size_line, "source", "size"), targets, "source")
        .select("source", "size", "slice", "source_size", "target",
                (F.col("size_before") + F.col("slice_before")).alias("before"),
                rate.cast("long").alias("rate"), offset.cast("long").alias("offset")))
    placed = rows.withColumn("slice", slice_of).withColumn("nth", F.row_number().over(
        Window.partitionBy("source", "size", "slice").orderBy("h", "doc_id")).cast("long"))
    end = (F.col("before") + F.col("nth")) * F.col("rate") + F.col("offset")
    whole = lambda x: F.shiftright(x, UNIT.bit_length() - 1)
    copies = whole(end) - whole(end - F.col("rate"))
    return (
        _join(placed, line, "source", "size", "slice")
        .select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"))
        .withColumn("taken", F.col("copies") * F.col("size")))


def _join(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Inner join on keys of which ``source`` may be null."""
    right = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = [left[k].eqNullSafe(right[f"_{k}"]) if k == "source" else left[k] == right[f"_{k}"] for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return left.join(right, cond).drop(*[f"_{k}" for k in keys])


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus itself: the documents' rows, each as often as it is taken.

    The copies join back on the id alone where ids are unique; rows that share an
    id share their copies' total through their order within the id.
    """
    plan = mix(docs, **options).filter("copies > 0").select("doc_id", "copies")
    each = Window.partitionBy("doc_id")
    plan = plan.withColumn("_n", F.row_number().over(each.orderBy("copies")))
    mine = docs.withColumn("_n", F.row_number().over(each.orderBy(F.lit(0))))
    got = mine.alias("d").join(plan.alias("p"), F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d._n") == F.col("p._n")))
    return got.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(*[F.col(f"d.{c}") for c in docs.columns], "copy")
