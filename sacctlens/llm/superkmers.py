"""Substring dedup over windows of words with super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document.  The minimiser of a
window is its run of ``M`` words with the smallest hash (leftmost on ties).
Consecutive windows that share a minimiser occurrence form a super-k-mer, which
travels as one packed string to the bucket of its minimiser.  Equal windows have
equal minimisers, so each bucket can count its windows alone: they are sorted by
hash and neighbours are compared byte by byte.  Buckets are grouped into parts of
about ``PART_RUNS`` super-k-mers, packed and compressed per part.

A minimiser with more than ``HOT_RUNS`` super-k-mers (at most ``HOT_MOST`` of them
by the way the threshold grows with the corpus, so the list is safe to send to
every task) is split by window instead: a task decides windows that repeat within
the task at once, and sends one packed string per distinct window to the window's
own bucket.  The result is the same; only the road differs.

Defined results: a null or empty text has no words; texts shorter than a window
lose nothing; rows equal in id and text are separate documents of equal content,
so all their windows repeat; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from sacctlens.llm.common import materialize
from sacctlens.llm.textkit import SPACE, STEP_BYTES, buffers, mix, span_hashes, steps, word_spans

WINDOW = 35
M = 4
PART_RUNS = 50_000
HOT_RUNS = 10_000
HOT_MOST = 1_000_000
#: Distinct hot windows a task remembers before it starts anew.
REMEMBERED = 100_000
NO_ID = -(1 << 63)
#: Compression of what travels.
LEVEL = 3


def canonical(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of the texts with their words joined by one space."""
    buf, offs = buffers(column)
    if not len(buf):
        return buf, offs
    solid = ~SPACE[buf]
    keep = solid.copy()
    keep[1:] |= solid[:-1]          # the first space after a word
    full = offs[1:] > offs[:-1]
    first = offs[:-1][full]
    keep[first] = solid[first]      # not across rows
    at = np.concatenate(([0], np.cumsum(keep)))
    out = np.where(solid, buf, 0x20).astype(np.uint8)[keep]
    edges = at[offs]
    # A row's last kept byte may be a space: drop it.
    ends = edges[1:][edges[1:] > edges[:-1]] - 1
    drop = ends[out[ends] == 0x20]
    if len(drop):
        mask = np.ones(len(out), bool)
        mask[drop] = False
        edges = np.concatenate(([0], np.cumsum(mask)))[edges]
        out = out[mask]
    return out, edges


def minimiser_runs(hashes: np.ndarray, rows: np.ndarray, window: int = WINDOW, m: int = M):
    """First window, last window and minimiser hash of each super-k-mer; windows are word numbers."""
    n, span = len(hashes), window - m + 1
    none = np.zeros(0, np.int64)
    if n < window:
        return none, none, np.zeros(0, np.uint64)
    g = hashes[:n - m + 1].copy()
    for j in range(1, m):
        g = mix(g) ^ hashes[j:n - m + 1 + j]
    g = mix(g)
    best, width = np.arange(len(g)), 1
    while width < span:
        step = min(width, span - width)
        left, right = best[:len(best) - step], best[step:]
        best = np.where(g[right] < g[left], right, left)
        width += step
    end = np.repeat(rows[1:], np.diff(rows))
    at = np.flatnonzero(np.arange(n) + window <= end)
    if not len(at):
        return none, none, np.zeros(0, np.uint64)
    place = best[at]
    new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1))))
    last = np.concatenate((new[1:], [len(at)])) - 1
    return at[new], at[last], g[place[new]]


def window_hashes(hashes: np.ndarray, window: int) -> np.ndarray:
    """A 64-bit hash of each run of ``window`` words, by prefix sums of a power series."""
    n = len(hashes)
    if n < window:
        return np.zeros(0, np.uint64)
    base, inverse = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
    power = np.full(n, base, np.uint64)
    power[0] = 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * np.cumprod(power, dtype=np.uint64), dtype=np.uint64, out=total[1:])
    power = np.full(n - window + 1, inverse, np.uint64)
    power[0] = 1
    return mix((total[window:] - total[:n - window + 1]) * np.cumprod(power, dtype=np.uint64))


def same_bytes(buf: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether buf[a:a+size] equals buf[b:b+size], for many spans at once."""
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[:len(buf)] = buf
    eight = np.ndarray(shape=(len(buf) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    ok = np.ones(len(a), bool)
    live, at = np.arange(len(a)), 0
    while len(live):
        left = size[live] - at
        shift = (np.uint64(8) * (8 - np.minimum(left, 8)).astype(np.uint64))
        differ = ((eight[a[live] + at] ^ eight[b[live] + at]) << shift) != 0
        ok[live[differ]] = False
        live, at = live[~differ & (left > 8)], at + 8
    return ok


def repeated_windows(buf: np.ndarray, lo: np.ndarray, hi: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which byte spans occur more than once: sort by hash, compare neighbours exactly."""
    order = np.argsort(hashes, kind="stable")
    h = hashes[order]
    pair = np.flatnonzero(h[1:] == h[:-1])
    out = np.zeros(len(lo), bool)
    if not len(pair):
        return out
    a, b = order[pair], order[pair + 1]
    size = hi[a] - lo[a]
    ok = (size == hi[b] - lo[b])
    ok[ok] = same_bytes(buf, lo[a[ok]], lo[b[ok]], size[ok])
    out[a[ok]] = out[b[ok]] = True
    for value in np.unique(h[pair[~ok]]):   # a hash collision: group these by their bytes
        seen: dict[bytes, list[int]] = {}
        for k in order[np.searchsorted(h, value):np.searchsorted(h, value, side="right")]:
            seen.setdefault(buf[lo[k]:hi[k]].tobytes(), []).append(int(k))
        for members in seen.values():
            out[members] = len(members) > 1
    return out


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... for each run of ``count`` numbers."""
    total = int(count.sum())
    return np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(total)


def _pack(doc, check, start, sizes, body: bytes, marks: np.ndarray) -> bytes:
    head = np.array([len(doc), len(marks)], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=LEVEL).compress(b"".join((
        head, doc.astype("<i8").tobytes(), check.astype("<i4").tobytes(), start.astype("<i4").tobytes(), sizes.astype("<i4").tobytes(),
        marks.astype("<i8").tobytes(), body)))


def _unpack(blob: bytes):
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, k = np.frombuffer(raw, "<i8", 2)
    at, parts = 16, []
    for kind, count, width in (("<i8", n, 8), ("<i4", n, 4), ("<i4", n, 4), ("<i4", n, 4), ("<i8", 4 * k, 8)):
        parts.append(np.frombuffer(raw, kind, count, at))
        at += int(count) * width
    return *parts, np.frombuffer(raw, np.uint8, -1, at)


class _Task:
    """The state of one map task: parts, hot minimisers, hot windows met so far."""

    def __init__(self, parts: int, hot: np.ndarray, window: int, m: int):
        self.parts, self.hot, self.window, self.m = parts, hot, window, m
        self.met: dict[bytes, tuple | None] = {}

    def blobs(self, part: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
        buf, offs = canonical(part.column("text"))
        starts, ends, rows = word_spans(buf, offs)
        hashes = span_hashes(buf, starts, ends)
        first, last, low = minimiser_runs(hashes, rows, self.window, self.m)
        ids, checks = part.column("doc_id").to_numpy(zero_copy_only=False), part.column("check").to_numpy(zero_copy_only=False)
        marks = np.zeros((0, 4), np.int64)
        if len(self.hot) and len(low):
            at = np.minimum(np.searchsorted(self.hot, low), len(self.hot) - 1)
            hot = self.hot[at] == low
            if hot.any():
                windows = _ranges(first[hot], last[hot] - first[hot] + 1)
                wh = window_hashes(hashes, self.window)[windows]
                lone, marks = self.hot_windows(buf, starts, ends, rows, windows, wh, ids, checks)
                first = np.concatenate((first[~hot], windows[lone]))
                last = np.concatenate((last[~hot], windows[lone]))
                low = np.concatenate((low[~hot], wh[lone]))
        if not len(first) and not len(marks):
            return
        to = (mix(low) >> np.uint64(8)).astype(np.int64) % self.parts
        order = np.argsort(to, kind="stable")
        first, last, to = first[order], last[order], to[order]
        row = np.searchsorted(rows, first, side="right") - 1
        a, b = starts[first], ends[last + self.window - 1]
        where = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1]))) if len(to) else np.zeros(0, np.int64)
        # Decided marks ride along with the part of their document.
        home = (mix(marks[:, 0].astype(np.uint64)) % np.uint64(self.parts)).astype(np.int64)
        targets = np.union1d(to[where], home)
        edges = np.append(where, len(to))
        index = {int(to[w]): (int(w), int(edges[k + 1])) for k, w in enumerate(where)}
        for p in targets.tolist():
            lo, hi = index.get(p, (0, 0))
            s = slice(lo, hi)
            size = b[s] - a[s]
            body = buf[_ranges(a[s], size)].tobytes() if hi > lo else b""
            yield p, _pack(ids[row[s]], checks[row[s]], first[s] - rows[row[s]], size, body, marks[home == p])

    def hot_windows(self, buf, starts, ends, rows, windows, wh, ids, checks):
        """Numbers of the windows to send (first met in this task), and marks of the others."""
        row = np.searchsorted(rows, windows, side="right") - 1
        lo, hi = starts[windows], ends[windows + self.window - 1]
        mark = lambda k: (int(ids[row[k]]), int(checks[row[k]]), int(windows[k] - rows[row[k]]), int(windows[k] - rows[row[k]]) + self.window)
        twice = repeated_windows(buf, lo, hi, wh)
        order = np.argsort(wh, kind="stable")
        send, marks = [], []
        begin = np.flatnonzero(np.concatenate(([True], wh[order][1:] != wh[order][:-1])))
        whole = set(order[begin].tolist())
        for k in range(len(windows)):
            if k not in whole and twice[k]:
                marks.append(k)         # repeats here; the first of its hash stands for it
                continue
            body = buf[lo[k]:hi[k]].tobytes()
            if len(self.met) >= REMEMBERED:
                self.met = {}
            if body in self.met:
                marks.append(k)
                if self.met[body] is not None:
                    marks.append(self.met[body])
                    self.met[body] = None
            else:
                self.met[body] = None if twice[k] else mark(k)
                send.append(k)
                if twice[k]:
                    marks.append(k)
        out = [m if isinstance(m, tuple) else mark(m) for m in marks]
        return np.array(send, np.int64), np.array(out, np.int64).reshape(-1, 4)


def _count_part(table: pa.Table, window: int) -> pa.Table:
    """Marks (doc_id, check, lo, hi in words) of the repeated windows of one part."""
    pieces = [_unpack(b.as_py()) for b in table.column("blob")]
    doc, check, start, size, marks, body = (np.concatenate([p[i] for p in pieces]) for i in range(6))
    marks = marks.reshape(-1, 4)
    offs = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
    starts, ends, rows = word_spans(body, offs)
    count = np.diff(rows) - window + 1
    windows = _ranges(rows[:-1], count) if len(count) else np.zeros(0, np.int64)
    out = [marks]
    if len(windows):
        wh = window_hashes(span_hashes(body, starts, ends), window)[windows]
        again = repeated_windows(body, starts[windows], ends[windows + window - 1], wh)
        run = np.repeat(np.arange(len(count)), count)
        k = np.flatnonzero(again)
        if len(k):
            new = np.concatenate(([True], (k[1:] != k[:-1] + 1) | (run[k[1:]] != run[k[:-1]])))
            head, tail = k[new], k[np.append(np.flatnonzero(new)[1:] - 1, len(k) - 1)]
            r = run[head]
            word = lambda x: windows[x] - rows[r] + start[r]
            out.append(np.column_stack((doc[r], check[r], word(head), word(tail) + window)).astype(np.int64))
    got = np.concatenate(out)
    return pa.table({"doc_id": pa.array(got[:, 0]), "check": pa.array(got[:, 1].astype(np.int32)),
                     "lo": pa.array(got[:, 2].astype(np.int32)), "hi": pa.array(got[:, 3].astype(np.int32))})


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"),
                       F.hash(F.col(text_col)).alias("check"), F.col(text_col).alias("text"))


def hot_minimisers(texts: DataFrame, window: int, m: int, hot_runs: int) -> tuple[int, np.ndarray]:
    """Number of super-k-mers, and the sorted hashes of the hot minimisers."""
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for lo, hi in steps(batch):
                buf, offs = buffers(batch.column("text").slice(lo, hi - lo))
                starts, ends, rows = word_spans(buf, offs)
                low, n = np.unique(minimiser_runs(span_hashes(buf, starts, ends), rows, window, m)[2], return_counts=True)
                total += int(n.sum())
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(n), bool)), pa.array(low.view(np.int64)), pa.array(n.astype(np.int64))], names=["whole", "low", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([True]), pa.array([0]), pa.array([total])], names=["whole", "low", "n"])

    found = materialize(texts.select("text").mapInArrow(counts, "whole boolean, low long, n long")
                        .groupBy("whole", "low").agg(F.sum("n").alias("n")).filter(F.col("whole") | (F.col("n") > hot_runs)))
    total = sum(r.n for r in found.filter("whole").collect())
    hot = found.filter(~F.col("whole") & (F.col("n") > max(hot_runs, total // HOT_MOST))).select("low").collect()
    return total, np.sort(np.array([r.low for r in hot], np.int64).view(np.uint64))


def repeated_spans(docs: DataFrame, window: int = WINDOW, m: int = M, id_col: str = "doc_id", text_col: str = "text",
                   hot_runs: int = HOT_RUNS, part_runs: int = PART_RUNS) -> DataFrame:
    """doc_id, check, lo, hi: word ranges covered by windows that occur elsewhere too (ranges may overlap)."""
    m = min(m, window)
    texts = _texts(docs, id_col, text_col)
    total, hot = hot_minimisers(texts, window, m, hot_runs)
    parts = max(1, -(-total // part_runs))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = _Task(parts, hot, window, m)
        for batch in batches:
            for lo, hi in steps(batch):
                got = list(task.blobs(batch.slice(lo, hi - lo)))
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in got], pa.int32()), pa.array([b for _, b in got], pa.binary())], names=["part", "blob"])

    packed = texts.mapInArrow(send, "part int, blob binary")
    return packed.groupBy("part").applyInArrow(lambda t: _count_part(t, window), "doc_id long, check int, lo int, hi int")


def remove_repeats(docs: DataFrame, window: int = WINDOW, m: int = M, id_col: str = "doc_id", text_col: str = "text",
                   hot_runs: int = HOT_RUNS, part_runs: int = PART_RUNS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept (the words kept, joined by one space)."""
    spans = repeated_spans(docs, window, m, id_col, text_col, hot_runs, part_runs)
    cuts = (spans.groupBy("doc_id", "check").agg(F.collect_list("lo").alias("lo"), F.collect_list("hi").alias("hi"))
            .withColumnsRenamed({"doc_id": "_id", "check": "_check"}))

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            body = pa.array([zip_.compress(x.as_buffer()) if x.is_valid else None for x in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("check"), body], names=["doc_id", "check", "body"])

    # The texts meet their cuts compressed: they are most of what this shuffle moves.
    texts = _texts(docs, id_col, text_col).mapInArrow(shrink, "doc_id long, check int, body binary")
    joined = texts.join(cuts, (F.col("doc_id") == F.col("_id")) & (F.col("check") == F.col("_check")), "left").select("doc_id", "body", "lo", "hi")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            # A step's worth of texts at a time; sizes are read from the frames.
            size = np.cumsum([zstandard.frame_content_size(x.as_py()) if x.is_valid else 0 for x in batch.column("body")])
            edges = np.unique(np.concatenate(([0], np.searchsorted(size, np.arange(STEP_BYTES, size[-1] if len(size) else 0, STEP_BYTES)) + 1, [len(size)])))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                part = batch.slice(a, b - a)
                text = pa.array([unzip.decompress(x.as_py()) if x.is_valid else None for x in part.column("body")], pa.large_binary()).cast(pa.large_string())
                buf, offs = canonical(text)
                starts, ends, rows = word_spans(buf, offs)
                removed, digests, kept = [], [], []
                los, his = part.column("lo"), part.column("hi")
                for i in range(len(part)):
                    raw, gone = buf[offs[i]:offs[i + 1]].tobytes(), 0
                    if los[i].is_valid:
                        n = int(rows[i + 1] - rows[i])
                        depth = np.zeros(n + 1, np.int64)
                        np.add.at(depth, los[i].values.to_numpy(), 1)
                        np.add.at(depth, his[i].values.to_numpy(), -1)
                        keep = np.cumsum(depth)[:n] == 0
                        gone = int(n - keep.sum())
                        edge = np.flatnonzero(np.diff(np.concatenate(([False], keep, [False])).astype(np.int8)))
                        at = starts[rows[i]:rows[i + 1]] - offs[i]
                        to = ends[rows[i]:rows[i + 1]] - offs[i]
                        raw = b" ".join(raw[at[x]:to[y - 1]] for x, y in zip(edge[::2], edge[1::2]))
                    removed.append(gone)
                    digests.append(hashlib.sha256(raw).hexdigest())
                    kept.append(raw.decode())
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(np.diff(rows).astype(np.int64)), pa.array(removed, pa.int64()), pa.array(digests),
                    pa.array(kept)], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    out = joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
