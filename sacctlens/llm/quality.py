"""Quality classifier: a factorisation machine over words and text structure.

Features of a text: its words hashed into ``BUCKETS`` slots (1 + log of the
count, scaled to unit length), statistics of its structure, and its length as
metadata (the text's own bytes, words and lines).  The score is

    w0 + sum(w_i x_i) + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

through a sigmoid; the last sum is the identity that makes all pairwise
interactions linear in the number of features.

Fitting uses at most ``SAMPLE_ROWS`` labelled documents (those with the smallest
hash of their id: a documented bound), whose features the driver fits with
mini-batches.  Scoring is one pass over all documents without a shuffle.

Defined results: a null text is an empty text, scored by its structure alone;
labels other than 0 and 1, null labels and labels without a document teach
nothing; rows of both tables without an id are held out; a document labelled twice
counts twice; without any label every score is 0.5; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sacctlens.llm.common import held_out
from sacctlens.llm.linechunks import chunk_edges
from sacctlens.llm.textkit import blobs, buffers, record, span_hashes, steps, word_spans

BUCKETS = 1 << 15
RANK = 8
SAMPLE_ROWS = 6000
EPOCHS = 12
BATCH = 64
RATE = 0.05
DECAY = 1e-5
THRESHOLD = 0.3

STATISTICS = ("log_bytes", "log_words", "log_lines", "bytes_per_word", "words_per_line", "letters", "upper", "digits",
              "spaces", "marks", "high_bytes", "marks_alone", "words_all_upper", "words_end_marked", "distinct_words", "top_word",
              "same_as_before", "lines_again")

_KIND = np.zeros(256, np.uint8)  # 1 lower, 2 upper, 3 digit, 4 space, 5 mark, 6 byte of a non-ASCII letter
_KIND[33:127] = 5
_KIND[ord("a"):ord("z") + 1] = 1
_KIND[ord("A"):ord("Z") + 1] = 2
_KIND[ord("0"):ord("9") + 1] = 3
_KIND[[0x20, 9, 10, 11, 12, 13]] = 4
_KIND[128:] = 6


def _sums(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return (total[edges[1:]] - total[edges[:-1]]).astype(np.float64)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row offsets, feature numbers and values of the word part, and the statistics."""
    buf, offs = buffers(texts)
    starts, ends, rows = word_spans(buf, offs)
    n = len(offs) - 1
    hashes = span_hashes(buf, starts, ends)
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(rows))
    slot = (hashes >> np.uint64(40)).astype(np.int64) % BUCKETS
    key, count = np.unique(doc * BUCKETS + slot, return_counts=True)
    owner, idx = key // BUCKETS, key % BUCKETS
    val = 1 + np.log(count)
    ptr = np.searchsorted(owner, np.arange(n + 1))
    norm = np.sqrt(np.bincount(owner, weights=val * val, minlength=n))
    val = val / norm[owner] if len(owner) else val
    kind = _KIND[buf]
    by = lambda k: _sums(kind == k, offs)
    lower, upper, digit, space, mark, high = (by(k) for k in range(1, 7))
    words, size = np.diff(rows).astype(np.float64), np.diff(offs).astype(np.float64)
    lines = _sums(buf == 10, offs) + 1
    below = lambda k: np.concatenate(([0], np.cumsum(kind == k)))
    marks_in = below(5)
    marks_in = marks_in[ends] - marks_in[starts]
    uppers_in = below(2)
    uppers_in = uppers_in[ends] - uppers_in[starts]
    small_in = below(1)
    small_in = small_in[ends] - small_in[starts]
    alone = _sums(marks_in == ends - starts, rows)
    shout = _sums((uppers_in > 1) & (small_in == 0), rows)
    marked = _sums(marks_in >= 2, rows)
    per_word, per_byte = np.maximum(words, 1), np.maximum(size, 1)
    most = np.zeros(n)
    np.maximum.at(most, owner, count)
    again = np.zeros(len(hashes), bool)
    if len(hashes):
        again[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    *_, line_starts, line_ends, line_rows, _ = chunk_edges(texts)
    line_doc = np.repeat(np.arange(n), np.diff(line_rows))
    line_hash = span_hashes(buf, line_starts, line_ends)
    distinct_lines = np.bincount(np.unique(np.stack((line_doc.astype(np.uint64), line_hash)), axis=1)[0].astype(np.int64), minlength=n)
    stats = np.column_stack((
        np.log1p(size), np.log1p(words), np.log1p(lines), size / per_word, words / lines, (lower + upper + high) / per_byte,
        upper / per_byte, digit / per_byte, space / per_byte, mark / per_byte, high / per_byte, alone / per_word,
        shout / per_word, marked / per_word, np.diff(ptr) / per_word, most / per_word,
        _sums(again, rows) / per_word, 1 - distinct_lines / lines))
    return ptr, idx, val, stats


class Machine:
    """Parameters of the machine and of the statistics' scaling."""

    def __init__(self, w0, w, v, mean, scale):
        self.w0, self.w, self.v, self.mean, self.scale = w0, w, v, mean, scale

    def scores(self, ptr, idx, val, stats) -> np.ndarray:
        extra = np.clip((stats - self.mean) / self.scale, -4, 4)
        xv, x2, lin = (_row_sums(a, ptr) for a in (val[:, None] * self.v[idx], (val[:, None] * self.v[idx]) ** 2, (val * self.w[idx])[:, None]))
        ve, we = self.v[BUCKETS:], self.w[BUCKETS:]
        xv, x2 = xv + extra @ ve, x2 + extra ** 2 @ ve ** 2
        z = self.w0 + lin[:, 0] + extra @ we + 0.5 * (xv ** 2 - x2).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _row_sums(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    out = np.zeros((len(ptr) - 1, values.shape[1]))
    full = np.flatnonzero(ptr[1:] > ptr[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, ptr[full], axis=0)
    return out


def fit(ptr, idx, val, stats, label, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Mini-batch Adagrad on the log loss."""
    rng = np.random.default_rng(seed)
    mean, scale = stats.mean(axis=0), stats.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    extra = np.clip((stats - mean) / scale, -4, 4)
    total = BUCKETS + stats.shape[1]
    w, v = np.zeros(total), rng.normal(0, 0.05, (total, RANK))
    rate = min(max(label.mean(), 1e-3), 1 - 1e-3)
    w0 = float(np.log(rate / (1 - rate)))
    gw, gv, g0 = np.full(total, 1e-6), np.full((total, RANK), 1e-6), 1e-6
    dense = np.arange(BUCKETS, total)
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for at in range(0, len(order), BATCH):
            rows = order[at:at + BATCH]
            sizes = ptr[rows + 1] - ptr[rows]
            take = np.concatenate([np.arange(ptr[r], ptr[r + 1]) for r in rows])
            i = np.concatenate((idx[take], np.tile(dense, len(rows))))
            x = np.concatenate((val[take], extra[rows].ravel()))
            r = np.concatenate((np.repeat(np.arange(len(rows)), sizes), np.repeat(np.arange(len(rows)), len(dense))))
            vx = x[:, None] * v[i]
            xv = np.column_stack([np.bincount(r, vx[:, f], len(rows)) for f in range(RANK)])
            z = w0 + np.bincount(r, x * w[i], len(rows)) + 0.5 * ((xv ** 2).sum(1) - np.bincount(r, (vx ** 2).sum(1), len(rows)))
            g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label[rows]) / len(rows)
            d0 = g.sum()
            g0 += d0 * d0
            w0 -= RATE * d0 / np.sqrt(g0)
            seen, back = np.unique(i, return_inverse=True)
            gx = g[r] * x
            dw = np.bincount(back, gx, len(seen)) + DECAY * w[seen]
            gw[seen] += dw * dw
            w[seen] -= RATE * dw / np.sqrt(gw[seen])
            dv = np.column_stack([np.bincount(back, gx * (xv[r, f] - vx[:, f]), len(seen)) for f in range(RANK)]) + DECAY * v[seen]
            gv[seen] += dv * dv
            v[seen] -= RATE * dv / np.sqrt(gv[seen])
    return Machine(w0, w, v, mean, scale)


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine | None:
    """Fit on a bounded sample of documents with a 0/1 label; None without any."""
    marked = (labels.select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("label"))
              .filter("label_id is not null and label in (0, 1)")
              .orderBy(F.xxhash64("label_id"), "label_id", "label").limit(sample_rows))
    rows = docs.select(F.col("doc_id"), F.col("text")).join(marked, F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "label")
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("idx", pa.binary()), ("val", pa.binary()), ("stats", pa.binary())])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in steps(batch):
                part = batch.slice(lo, hi - lo)
                ptr, idx, val, stats = features(part.column("text"))
                cut = range(len(ptr) - 1)
                yield record(schema, doc_id=part.column("doc_id").cast(pa.int64()), label=part.column("label").cast(pa.int32()),
                             idx=blobs(idx[ptr[i]:ptr[i + 1]].astype("<u2").tobytes() for i in cut),
                             val=blobs(val[ptr[i]:ptr[i + 1]].astype("<f4").tobytes() for i in cut),
                             stats=blobs(stats[i].tobytes() for i in cut))

    got = rows.mapInArrow(packed, "doc_id long, label int, idx binary, val binary, stats binary").collect()
    if not got:
        return None
    got.sort(key=lambda r: (r.doc_id, r.label, bytes(r.idx), bytes(r.stats)))
    parts = [np.frombuffer(r.idx, "<u2") for r in got]
    ptr = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    return fit(ptr, np.concatenate(parts).astype(np.int64), np.concatenate([np.frombuffer(r.val, "<f4") for r in got]).astype(np.float64),
               np.array([np.frombuffer(r.stats) for r in got]), np.array([r.label for r in got], np.float64))


def score(docs: DataFrame, machine: Machine | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in steps(batch):
                part = batch.slice(lo, hi - lo)
                got = machine.scores(*features(part.column("text"))) if machine is not None else np.full(len(part), 0.5)
                yield record(schema, doc_id=part.column("doc_id"), score=got)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(scored, "doc_id long, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from the rows that are not held out."""
    machine = learn(docs.filter(~held_out(F.col("doc_id"))), labels.filter(~held_out(F.col("doc_id"))))
    return score(docs, machine).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
