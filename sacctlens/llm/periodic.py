"""Periodic runs of words, found with an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q (words q apart are
equal), at least ``least`` words and ``times`` * q words long, that no neighbouring
word extends keeping period q.  ``collapse`` keeps the first q words of every run.

Method, per step of about 2 MB of text, all its texts at once in numpy:

* words become numbers (equal words of a text are compared byte by byte); prefix
  doubling sorts the suffixes, re-sorting only those still tied.  Texts whose suffixes
  all differ within their first 2^k <= needed words leave early: a run makes the
  suffixes at its start and one period later share max(least, times * q) - q words;
* neighbours' common prefixes: a value is at most one less than its predecessor's in
  text order, so only places whose preceding words differ are compared;
* branching tandems: each common-prefix value splits its interval of the suffix array
  in two sides.  For every suffix i of the smaller side, the inverse array tells whether
  i + depth or i - depth lies on the other side; then a square of that depth starts at
  the smaller of the two and no word prolongs it.  The sides nest, so all checks
  together are O(n log n), and no tree is built;
* squares are rotated to the left while the preceding words agree, and squares of
  one stretch merge into a run with the smallest of their periods.

Every text is worked on by one task as a whole; nothing is shuffled.

Defined results: a null or empty text has no words, no runs and an empty collapsed
text; words are maximal runs of characters other than space and 0x09-0x0D; repeated
rows count each; a column that bears the name of a result is replaced, all others
ride along unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sacctlens.llm.textkit import buffers, span_hashes, steps, word_spans

LEAST = 24
TIMES = 3
STEP_BYTES = 2 << 20
#: Words compared for all pairs at once before the few remaining pairs are compared one by one.
TOGETHER = 64
#: Rounds of pointer jumping before the few remaining places walk one by one.
JUMPS = 32

RUNS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())]))


def _same_words(buf: np.ndarray, a0: np.ndarray, b0: np.ndarray, size: np.ndarray) -> bool:
    """Whether the byte spans at ``a0`` and ``b0``, of equal sizes, all hold the same bytes."""
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[:len(buf)] = buf
    eight = np.ndarray(shape=(len(buf) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    at = 0
    while len(size):
        rest = np.minimum(size - at, 8).astype(np.uint64)
        unused = (np.uint64(64) - rest * np.uint64(8))
        if ((eight[a0 + at] ^ eight[b0 + at]) << unused).any():
            return False
        at += 8
        more = size > at
        a0, b0, size = a0[more], b0[more], size[more]
    return True


def word_numbers(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Numbers that are equal exactly where the words are equal."""
    seed, size = 0, ends - starts
    while True:
        h = span_hashes(buf, starts, ends, seed)
        order = np.argsort(h)
        h = h[order]
        equal = np.flatnonzero(h[1:] == h[:-1]) if len(h) else np.zeros(0, np.int64)
        a, b = order[equal], order[equal + 1]
        if (size[a] == size[b]).all() and _same_words(buf, starts[a], starts[b], size[a]):
            number = np.empty(len(h), np.int64)
            number[order] = np.cumsum(np.concatenate(([False], h[1:] != h[:-1])))
            return number
        seed += 1


def _dense(order: np.ndarray, changes: np.ndarray) -> np.ndarray:
    """Ranks by place: the position of the first member of each place's group."""
    first = np.maximum.accumulate(np.where(changes, np.arange(len(order)), 0))
    rank = np.empty(len(order), np.int64)
    rank[order] = first
    return rank


def _pair_order(major: np.ndarray, minor: np.ndarray) -> np.ndarray:
    bits = int(minor.max(initial=0) + 1).bit_length()
    if bits + int(major.max(initial=0)).bit_length() <= 63:
        return np.argsort((major << bits) | minor)
    return np.lexsort((minor, major))


def suffix_array(number: np.ndarray, row: np.ndarray, stop: np.ndarray, needed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in order within their rows, their inverse, and whether each place's row stays.

    ``number`` are the words, ``row`` their rows in ascending order and ``stop`` where
    each word's row ends.  With ``needed`` above 0, sorting ends at a depth of at most
    ``needed`` words, and the rows stay of which suffixes agree to that depth.
    """
    n = len(number)
    order = _pair_order(row, number)
    changes = np.ones(n, bool)
    changes[1:] = (row[order][1:] != row[order][:-1]) | (number[order][1:] != number[order][:-1])
    rank = _dense(order, changes)
    depth = 1
    while True:
        # Members of groups of two or more, by place in the suffix array.
        tied = np.zeros(n, bool)
        tied[:-1] |= ~changes[1:]
        tied[1:] |= ~changes[1:]
        at = np.flatnonzero(tied)
        if not len(at) or (needed and depth * 2 > needed):
            left = np.zeros(int(row[-1]) + 1 if n else 0, bool)
            left[row[order[at]]] = True
            return order, rank, left[row]
        who = order[at]
        ahead = who + depth
        follow = np.where(ahead < stop[who], rank[np.minimum(ahead, n - 1)] + 1, 0)
        group = rank[who]
        by = _pair_order(group, follow)
        order[at] = who[by]
        group, follow = group[by], follow[by]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])
        changes[at] = fresh
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        rank[order[at]] = at[first]
        depth *= 2


def _extend(number: np.ndarray, a: int, b: int, end: int) -> int:
    """How many words from ``a`` and ``b`` on agree before ``end`` (of b's row; a < b)."""
    got, width = 0, 256
    while b + got < end:
        x, y = number[a + got:min(a + got + width, end)], number[b + got:min(b + got + width, end)]
        differs = np.flatnonzero(x[:len(y)] != y)
        if len(differs):
            return got + int(differs[0])
        got += len(y)
        width *= 2
    return got


def common_prefixes(number: np.ndarray, row: np.ndarray, stop: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix with its predecessor in ``order`` (0 across rows)."""
    n = len(number)
    before = np.full(n, -1, np.int64)
    ok = row[order[1:]] == row[order[:-1]]
    before[order[1:][ok]] = order[:-1][ok]
    place = np.arange(n)
    has = before >= 0
    # The value at a place whose preceding word equals the predecessor's is one less than the value before it.
    inner = np.zeros(n, bool)
    inner[1:] = has[1:] & (row[1:] == row[:-1])
    inner[1:] &= before[1:] > 0
    at = np.flatnonzero(inner)
    inner[at] = (row[before[at] - 1] == row[at]) & (number[before[at] - 1] == number[at - 1])
    fixed = np.flatnonzero(has & ~inner)
    value = np.zeros(n, np.int64)
    mine, other, got = fixed, before[fixed], 0
    while len(mine) and got < TOGETHER:
        low, high = np.minimum(mine, other) + got, np.maximum(mine, other) + got
        same = high < stop[mine]
        same[same] = number[low[same]] == number[high[same]]
        value[mine[~same]] = got
        mine, other, got = mine[same], other[same], got + 1
    for m, o in zip(mine.tolist(), other.tolist()):
        low, high = min(m, o), max(m, o)
        value[m] = got + _extend(number, low + got, high + got, int(stop[m]))
    last = np.maximum.accumulate(np.where(inner, -1, place))
    value = np.where(inner, value[last] - (place - last), value)
    out = np.zeros(n, np.int64)
    out[:] = value[order]
    return out


def _bounds(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place: the previous place with a smaller value and the next with a value not above (-1 and n where none)."""
    def previous(v: np.ndarray, strict: bool) -> np.ndarray:
        # Invariant: everything strictly between p[j] and j would not stop j.
        n = len(v)
        p = np.arange(n) - 1
        padded = np.concatenate((v, [np.iinfo(np.int64).min]))       # index -1 stops everything
        open_ = np.arange(n)
        for _ in range(JUMPS):
            seen = padded[p[open_]]
            open_ = open_[seen >= v[open_] if strict else seen > v[open_]]
            if not len(open_):
                return p
            p[open_] = p[p[open_]]
        for j in open_.tolist():
            k, mine = int(p[j]), v[j]
            while k >= 0 and (v[k] >= mine if strict else v[k] > mine):
                k = int(p[k])
            p[j] = k
        return p

    n = len(lcp)
    return previous(lcp, True), n - 1 - previous(lcp[::-1], False)[::-1]


def branching_squares(order: np.ndarray, rank: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and depths of all squares that the next word does not prolong.

    ``lcp[j]`` joins the suffixes at j - 1 and j.  The sides of place j are the suffixes
    from the previous smaller value on to j - 1, and from j on to before the next value
    that is not above; a pair of suffixes meets at exactly one place.
    """
    n = len(order)
    left, right = _bounds(lcp)
    at = np.flatnonzero(lcp > 0)
    lo, hi = np.maximum(left[at], 0), right[at]              # sides [lo, at) and [at, hi)
    less = at - lo <= hi - at
    begin, end = np.where(less, lo, at), np.where(less, at, hi)
    far_lo, far_hi = np.where(less, at, lo), np.where(less, hi, at)
    size = end - begin
    starts, depths = [], []
    edges = np.concatenate(([0], np.cumsum(size)))
    step = 1 << 20
    cut = 0
    while cut < len(at):
        upto = max(cut + 1, int(np.searchsorted(edges, edges[cut] + step, side="right")) - 1)
        s = slice(cut, upto)
        of = np.repeat(np.arange(cut, upto), size[s])
        i = order[begin[of] + (np.arange(len(of)) - (edges[of] - edges[cut]))]
        depth = lcp[at[of]]
        for sign in (1, -1):
            j = i + sign * depth
            inside = (j >= 0) & (j < n)
            where = rank[np.where(inside, j, 0)]
            hit = inside & (where >= far_lo[of]) & (where < far_hi[of])
            starts.append(np.minimum(i[hit], j[hit]))
            depths.append(depth[hit])
        cut = upto
    return (np.concatenate(starts), np.concatenate(depths)) if starts else (np.zeros(0, np.int64),) * 2


def _agree_before(number: np.ndarray, first: np.ndarray, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Leftmost start that keeps the period: rotate while the words before agree."""
    out = start.copy()
    open_, got = np.arange(len(start)), 0
    while len(open_) and got < TOGETHER:
        k = out[open_] - 1
        ok = k >= first[open_]
        ok[ok] = number[k[ok]] == number[k[ok] + depth[open_[ok]]]
        open_ = open_[ok]
        out[open_] -= 1
        got += 1
    for m in open_.tolist():
        k, q, low, width = int(out[m]), int(depth[m]), int(first[m]), 256
        while k > low:
            a = max(low, k - width)
            differs = np.flatnonzero(number[a:k] != number[a + q:k + q])
            if len(differs):
                k = a + int(differs[-1]) + 1
                break
            k, width = a, width * 2
        out[m] = k
    return out


def find_runs(number: np.ndarray, word_offs: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, start (in its row), length and period of all runs, by row, start and period."""
    none = (np.zeros(0, np.int64),) * 4
    counts = np.diff(word_offs)
    row = np.repeat(np.arange(len(counts)), counts)
    if not len(number):
        return none
    # Two suffixes of a run share its length less one period: (1 - 1 / times) of it at least.
    needed = max(1, least - least // times)
    stop = word_offs[1:][row]
    _, _, stays = suffix_array(number, row, stop, needed)
    # The rows that may hold runs, put together anew.
    keep = np.flatnonzero(stays)
    if not len(keep):
        return none
    base = keep.copy()
    number, rows = number[keep], row[keep]
    ids, row = np.unique(rows, return_inverse=True)
    firsts = np.searchsorted(rows, ids)
    first = firsts[row]
    stop = np.append(firsts[1:], len(number))[row]
    order, rank, _ = suffix_array(number, row, stop, 0)
    lcp = common_prefixes(number, row, stop, order)
    start, depth = branching_squares(order, rank, lcp)
    # Rows are apart in the suffix array, and a common prefix of 1 or more never joins two of them.
    end = start + 2 * depth
    start = _agree_before(number, first[start], start, depth)
    long_enough = (end - start >= least) & (end - start >= times * depth)
    start, end, depth = start[long_enough], end[long_enough], depth[long_enough]
    by = np.lexsort((depth, end, start))
    start, end, depth = start[by], end[by], depth[by]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, depth = start[fresh], end[fresh], depth[fresh]
    place = base[start] - word_offs[ids[row[start]]] if len(start) else start
    return ids[row[start]] if len(start) else start, place, end - start, depth


def _batch(texts: pa.Array, least: int, times: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Word counts, runs and collapsed texts of a step's texts."""
    buf, offs = buffers(texts)
    starts, ends, word_offs = word_spans(buf, offs)
    row, start, length, period = find_runs(word_numbers(buf, starts, ends), word_offs, least, times)
    n = len(offs) - 1
    per_row = np.searchsorted(row, np.arange(n + 1))
    items = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], ["start", "length", "period"])
    runs = pa.ListArray.from_arrays(pa.array(per_row.astype(np.int32)), items)
    # What a run covers after its first period goes.
    delta = np.zeros(len(starts) + 1, np.int64)
    np.add.at(delta, word_offs[row] + start + period, 1)
    np.add.at(delta, word_offs[row] + start + length, -1)
    kept = np.flatnonzero(np.cumsum(delta[:-1]) == 0)
    size = ends[kept] - starts[kept] + 1                     # a word and the space after it
    edges = np.concatenate(([0], np.cumsum(size)))
    out = np.full(int(edges[-1]), 0x20, np.uint8)
    inner = np.ones(len(out), bool)
    inner[edges[1:] - 1] = False
    at = np.arange(len(out)) - np.repeat(edges[:-1] - starts[kept], size)
    out[inner] = buf[at[inner]]
    upto = np.searchsorted(kept, word_offs)
    bounds = edges[upto]
    raw = out.tobytes()
    texts_out = [raw[a:max(a, b - 1)].decode() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    return pa.array(np.diff(word_offs)), runs, pa.array(texts_out, pa.string())


def collapse(docs: DataFrame, text_col: str = "text", least: int = LEAST, times: int = TIMES,
             names: tuple[str, str, str] = ("n_words", "runs", "collapsed")) -> DataFrame:
    """The documents' columns (without the text), the number of words, all runs, and the words that stay, joined by a space."""
    others = [f for f in docs.schema.fields if f.name != text_col and f.name not in names]
    schema = T.StructType([*others, T.StructField(names[0], T.LongType()), T.StructField(names[1], RUNS), T.StructField(names[2], T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            for lo, hi in steps(batch, text_col, STEP_BYTES):
                part = batch.slice(lo, hi - lo)
                found = _batch(part.column(at), least, times)
                yield pa.RecordBatch.from_arrays([*[part.column(k) for k in range(part.num_columns) if k != at], *found],
                                                 names=[*[f.name for f in others], *names])

    return docs.select(*[f.name for f in others], text_col).mapInArrow(work, schema)


def repeat_tail(text: Column, doc_id: Column) -> Column:
    """The text with its words from a on replaced by repeats of the first p of them, where crc32 of the id says so.

    h = crc32(decimal id), g = floor(h / 10): with h % 10 = 0 and n > 0 words, word
    i >= a becomes word a + (i - a) % p, where a = g % n and p = 1 + floor((n - a) / (3 + g % 8)).
    Other texts stay as they are; so do those without an id.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = F.lit(1).cast("long") + F.floor((n - a) / (F.lit(3) + g % 8))
        return F.array_join(F.transform(w, lambda _, i: F.get(w, F.when(i < a, i.cast("long")).otherwise(a + (i - a) % p).cast("int"))), " ")

    # The words are split once: a lambda over a one-element array holds them.
    planted = F.element_at(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(text)), 1)
    return F.when(text.isNotNull() & doc_id.isNotNull() & (h % 10 == 0), planted).otherwise(text)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_runs, the run of the greatest exponent and the digests of all runs and of the collapsed text.

    The greatest exact length / period wins, then the smallest start, then the smallest
    period; without a run its four columns are null.
    """
    def better(best: Column, r: Column) -> Column:
        # Runs come by start and period, so an equal exponent does not replace.
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    one = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    best = F.aggregate("runs", F.lit(None).cast(one), better)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        F.col(id_col).alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
