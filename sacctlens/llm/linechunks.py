"""Line dedup over all repeated runs of lines.

A text's lines are split at newlines.  Every run of two or more lines that occurs
earlier (by document id, then place) goes, wherever it begins and ends; its first
occurrence stays.  It is enough to look at each line with the last visible line before
it and the blank ones between, and at each blank line with what follows up to the next
visible one: such units are runs themselves, and every longer run with a visible line
consists of them.  Units are grouped by hash; only members of groups that repeat send
their bytes, and grouping by the bytes themselves is the comparison.  A run that
overlaps its own first occurrence (a line three times in a row) keeps the lines they
share.

With ``window`` and ``divisor``, content-defined chunks take the place of the units: a
rolling hash over the last ``window`` line hashes closes a chunk wherever it is 0
modulo ``divisor``, and chunks of two or more lines that repeat as a whole go.

Hot chunks are safe: both groupings combine before they shuffle, and what joins
back is one row per distinct chunk; the occurrences' side of that join may be split.

Defined results: a null text stays null; an empty text has one empty line; runs
without any visible character are never removed; ids decide the order, null ids
last; rows equal in id and text are one document and share their result, rows that
share an id but not a text are ordered by the text's hash; other columns ride along
unchanged in ``dedup`` and are ignored by ``line_chunks``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sacctlens.llm.common import materialize, unused
from sacctlens.llm.textkit import SMALL_STEP, buffers, lean, mix, span_hashes, steps

WINDOW = 2
DIVISOR = 3
MIN_LINES = 2


def chunk_edges(text_rows: pa.Array, window: int = WINDOW, divisor: int = DIVISOR):
    """Byte buffer, row offsets, line starts and ends, line offsets of rows, and
    the line numbers at which chunks begin with their row (closed by a last edge)."""
    buf, offs = buffers(text_rows)
    breaks = np.flatnonzero(buf == 10)
    # Each row has one line more than newlines.
    per_row = np.searchsorted(breaks, offs)
    n = len(offs) - 1
    line_offs = per_row + np.arange(n + 1)
    starts, ends = np.empty(line_offs[-1], np.int64), np.empty(line_offs[-1], np.int64)
    row_first = line_offs[:-1]
    inner = np.ones(len(starts), bool)
    inner[row_first] = False
    starts[row_first] = offs[:-1]
    starts[inner] = breaks + 1
    last = np.zeros(len(starts), bool)
    last[line_offs[1:] - 1] = True
    ends[last] = offs[1:]
    ends[~last] = breaks
    hashes = span_hashes(buf, starts, ends)
    rolling = hashes.copy()
    number = np.arange(len(starts)) - np.repeat(row_first, np.diff(line_offs))      # within its text
    for back in range(1, window):
        at = np.flatnonzero(number >= back)
        rolling[at] = mix(rolling[at]) ^ hashes[at - back]
    cut = mix(rolling) % np.uint64(divisor) == 0  # closes a chunk after this line
    cut |= last
    begins = np.flatnonzero(np.concatenate(([True], cut[:-1]))) if len(cut) else np.zeros(0, np.int64)
    return buf, offs, starts, ends, line_offs, begins


def line_units(visible: np.ndarray, line_offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First lines and stops of the runs that every repeated run with a visible line consists of.

    Each line from the last visible line before it, and each blank line up to the
    next visible one, within its text.
    """
    n = len(visible)
    lines, row = np.arange(n), np.repeat(np.arange(len(line_offs) - 1), np.diff(line_offs))
    back = np.concatenate(([-1], np.maximum.accumulate(np.where(visible, lines, -1))[:-1]))
    ahead = np.minimum.accumulate(np.where(visible, lines, n)[::-1])[::-1]
    up = np.flatnonzero(back >= line_offs[row])
    down = np.flatnonzero(~visible & (ahead < line_offs[row + 1]))
    return np.concatenate((back[up], down)), np.concatenate((up, ahead[down])) + 1


def _identity(id_col: str, text_col: str):
    return [F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text")]


def line_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int | None = None, divisor: int = DIVISOR) -> DataFrame:
    """doc_id, text_hash, first_line, n_lines, h1, h2, lo, hi, at: the units of all lines, or the multi-line chunks.

    lo and hi are the byte range in the text, at is where a unit's lines start.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("first_line", pa.int32()), ("n_lines", pa.int32()),
                        ("h1", pa.int64()), ("h2", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("at", pa.list_(pa.int64()))])

    @lean
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in steps(batch, most=SMALL_STEP):
                part = batch.slice(lo, hi - lo)
                buf, offs, starts, ends, line_offs, begins = chunk_edges(part.column("text"), window or WINDOW, divisor)
                if not len(begins):
                    continue
                seen = np.concatenate(([0], np.cumsum(buf > 0x20)))
                if window is None:
                    begins, stops = line_units(seen[ends] > seen[starts], line_offs)
                else:
                    stops = np.concatenate((begins[1:], [len(starts)]))
                row = np.searchsorted(line_offs, begins, side="right") - 1
                a, b = starts[begins], ends[stops - 1]
                keep = (stops - begins >= MIN_LINES) & (seen[b] > seen[a])
                row, a, b, begins, stops = row[keep], a[keep], b[keep], begins[keep], stops[keep]
                size = stops - begins if window is None else np.zeros(len(begins), np.int64)
                edges = np.concatenate(([0], np.cumsum(size)))
                lines = np.repeat(begins - edges[:-1], size) + np.arange(edges[-1])
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(row)), part.column("text_hash").take(pa.array(row)),
                    pa.array((begins - line_offs[row]).astype(np.int32)), pa.array((stops - begins).astype(np.int32)),
                    pa.array(span_hashes(buf, a, b, 1).view(np.int64)), pa.array(span_hashes(buf, a, b, 2).view(np.int64)),
                    pa.array(a - offs[row]), pa.array(b - offs[row]),
                    pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(starts[lines] - np.repeat(offs[row], size)))], schema=schema)

    return docs.select(*_identity(id_col, text_col)).filter("text is not null").mapInArrow(
        chunks, "doc_id long, text_hash long, first_line int, n_lines int, h1 long, h2 long, lo long, hi long, at array<long>")


def repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int | None = None, divisor: int = DIVISOR) -> DataFrame:
    """doc_id, text_hash, first_line, n_lines, lo, hi of what to remove: lines (perhaps more than once), or chunks."""
    found = materialize(line_chunks(docs, id_col, text_col, window, divisor))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "first_line")
    # Hash groups that repeat; most chunks end here without sending their bytes.
    again = found.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h1", "h2")
    here = materialize(found.join(again, ["h1", "h2"], "left_semi").select("doc_id", "text_hash", "first_line", "n_lines", "h1", "h2", "lo", "hi", "at"))
    ranges = here.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("lo", "hi", "at", "first_line", "n_lines")).alias("chunks"))
    texts = docs.select(*_identity(id_col, text_col)).filter("text is not null")
    owners = (texts.join(ranges.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"}),
                         F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))).select("doc_id", "text_hash", "text", "chunks"))
    body = (owners.withColumn("raw", F.col("text").cast("binary")).withColumn("c", F.explode("chunks"))
            .select("doc_id", "text_hash", "c.*", F.substring("raw", F.col("c.lo").cast("int") + 1, (F.col("c.hi") - F.col("c.lo")).cast("int")).alias("body")))
    body = materialize(body)
    # Written before it is joined back, so that the join may split a hot chunk's occurrences.
    first = materialize(body.groupBy("body").agg(F.min(place).alias("first")))
    later = body.join(first, "body").filter(~F.col("first").eqNullSafe(place))
    if window is None:
        own = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.text_hash") == F.col("text_hash"))
        shared = F.when(own, F.greatest(F.lit(0), F.col("first.first_line") + F.col("n_lines") - F.col("first_line"))).otherwise(F.lit(0))
        later = (later.withColumn("shared", shared).select("*", F.posexplode("at").alias("k", "start")).filter("k >= shared")
                 .select("doc_id", "text_hash", (F.col("first_line") + F.col("k")).alias("first_line"), F.lit(1).alias("n_lines"), F.col("start").alias("lo"),
                         F.when(F.col("k") + 1 < F.col("n_lines"), F.get("at", F.col("k") + 1) - 1).otherwise(F.col("hi")).alias("hi")))
    return later.select("doc_id", "text_hash", "first_line", "n_lines", "lo", "hi")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int | None = None, divisor: int = DIVISOR,
          counts: tuple[str, str] = ("n_lines", "n_removed_lines")) -> DataFrame:
    """The documents' own columns with the text cleaned, plus two counts of lines.

    A column that bears the name of a count is replaced; ``counts`` renames them.
    """
    cut_id, cut_hash, cuts, removed, cleaned = unused([*docs.columns, *counts], "_cut_id", "_cut_hash", "_cuts", "_cut_lines", "_cleaned")
    gone = (repeated_chunks(docs, id_col, text_col, window, divisor)
            .groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias(cuts),
                                                F.collect_set(F.struct("lo", "n_lines")).alias("counted"))
            .select(F.col("doc_id").alias(cut_id), F.col("text_hash").alias(cut_hash), cuts,
                    F.aggregate("counted", F.lit(0), lambda n, x: n + x["n_lines"]).cast("long").alias(removed)))
    joined = docs.join(gone, F.col(id_col).cast("long").eqNullSafe(F.col(cut_id)) & (F.xxhash64(text_col) == F.col(cut_hash)), "left")
    raw = F.col(text_col).cast("binary")
    size = F.octet_length(text_col).cast("long")
    # What is kept lies between the cuts; a cut takes one newline with it.
    edges = F.concat(F.array(F.struct(F.lit(-1).cast("long").alias("lo"), F.lit(-1).cast("long").alias("hi"))), F.col(cuts),
                     F.array(F.struct((size + 1).alias("lo"), (size + 1).alias("hi"))))
    spans = F.transform(F.sequence(F.lit(1), F.size(cuts) + 1),
                        lambda i: F.struct((F.element_at(edges, i)["hi"] + 1).alias("a"), (F.element_at(edges, i + 1)["lo"] - 1).alias("b")))
    kept = F.transform(F.filter(spans, lambda s: s["b"] >= s["a"]),
                       lambda s: F.substring(raw, s["a"].cast("int") + 1, (s["b"] - s["a"]).cast("int")).cast("string"))
    text = F.when(F.col(cuts).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    lines = F.when(F.col(text_col).isNotNull(), F.length(F.col(text_col)) - F.length(F.translate(F.col(text_col), "\n", "")) + 1).otherwise(F.lit(0))
    return joined.withColumns({counts[0]: lines.cast("long"), counts[1]: F.coalesce(removed, F.lit(0)).cast("long"), cleaned: text}).select(
        *[F.col(cleaned).alias(c) if c == text_col else F.col(c) for c in docs.columns if c not in counts], *counts)
