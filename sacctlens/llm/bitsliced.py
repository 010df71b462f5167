"""Exact top-k inner products with a bit-sliced index.

The candidates are cut into blocks of rows.  A block stores, for every
dimension, one bitmap per bit of the value (offset to be non-negative).  A query
adds the slices with bitmap arithmetic: every set bit of a query weight puts the
slices of its dimension, shifted, into columns, and carry-save adders (three
bitmaps in, sum and carry out) reduce each column, all rows of the block at
once, 64 to a machine word.  The sum's slices are then scanned from the most
significant one downward, keeping the rows surely among the best k and those
still tied; rows tied at the boundary are resolved exactly by smaller id.  The
blocks' best k meet in a window per query.

Queries travel in chunks to every block (a stated query set against all rows, in
blocks); nothing is broadcast, and no block or chunk outgrows its row count.

Defined results: vectors that are null, empty, or hold null or non-finite
components take no part, nor do rows without an id; vectors meet only vectors
of their own length; ranks follow the exact integer scores, whatever their size, and a
score beyond a long shows as the nearest long; quantised components are limited to
+-2^56 (a component of 2.8e14); a query never meets rows that carry its own id;
repeated rows are candidates each, and equal queries count once.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sacctlens.llm.textkit import record

BLOCK_ROWS = 16384
CHUNK_QUERIES = 256
SCALE = 256
SCORE = pa.decimal128(38, 0)
#: Products of two components, summed over 2^14 dimensions, stay below 10^38.
LIMIT = 1 << 56
LONG = (-(1 << 63), (1 << 63) - 1)


def quantised(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id, x (array<long>): floor(256 * component) of the rows that take part."""
    v = F.col(vec_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vectors.filter(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~bad).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(v, lambda x: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), _floored(x.cast("double") * SCALE)))).alias("x"),
        F.size(v).alias("n_dim"))


def _floored(x):
    """floor as a long; numbers beyond a long (whose floor Spark's cast would wrap) as its bounds."""
    return F.when(x >= float(1 << 62), F.lit(1 << 62)).when(x <= -float(1 << 62), F.lit(-(1 << 62))).otherwise(F.floor(x).cast("long"))


def slices_of(values: np.ndarray, low: np.ndarray, bits: int) -> np.ndarray:
    """[dims, bits, words] bitmaps of values - low; rows are bits of 64-bit words."""
    rows, dims = values.shape
    words = -(-rows // 64)
    out = np.zeros((dims, bits, words * 8), np.uint8)
    shifted = (values - low).astype(np.uint64).T
    for b in range(bits):
        packed = np.packbits(((shifted >> np.uint64(b)) & np.uint64(1)).astype(bool), axis=1, bitorder="little")
        out[:, b, :packed.shape[1]] = packed
    return out.view("<u8")


def add_slices(slices: np.ndarray, weights: np.ndarray, flipped: np.ndarray) -> list[np.ndarray]:
    """Slices of sum(|w_d| * v_d), least significant first.

    v_d is the stored value where w_d > 0, and its complement where w_d < 0.
    """
    columns: dict[int, list[np.ndarray]] = {}
    dims, bits, _ = slices.shape
    for shift in range(int(np.abs(weights).max(initial=0)).bit_length()):
        has = (np.abs(weights) >> shift) & 1 == 1
        plus, minus = slices[has & (weights > 0)], flipped[has & (weights < 0)]
        for b in range(bits):
            columns.setdefault(shift + b, []).extend((plus[:, b], minus[:, b]))
    result, at = [], 0
    while columns:
        parts = [x for x in columns.pop(at, []) if len(x)]
        if parts:
            m = np.concatenate(parts)
            while len(m) >= 3:
                n = len(m) // 3
                a, b, c = m[:n], m[n:2 * n], m[2 * n:3 * n]
                ab = a ^ b
                columns.setdefault(at + 1, []).append((a & b) | (c & ab))
                m = np.concatenate((ab ^ c, m[3 * n:]))
            if len(m) == 2:
                columns.setdefault(at + 1, []).append(m[:1] & m[1:])
                m = m[:1] ^ m[1:]
            result.append(m[0])
        else:
            result.append(np.zeros(slices.shape[2], "<u8"))
        at += 1
    return result


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def top_rows(total: list[np.ndarray], alive: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k largest sums among ``alive``; ties go to the lower row number."""
    sure, tied = np.zeros_like(alive), alive
    need = min(k, _count(alive))
    for s in reversed(total):
        high = tied & s
        n = _count(high)
        if n >= need:
            tied = high
            if n == need:
                break
        else:
            sure, tied, need = sure | high, tied & ~s, need - n
    rows = lambda m: np.flatnonzero(np.unpackbits(m.view(np.uint8), bitorder="little"))
    return np.concatenate((rows(sure), rows(tied)[:need]))


def scores_of(values: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products: 64-bit integers, or Python's where those might not do."""
    most = int(np.abs(values).max(initial=0)) * sum(map(abs, query.tolist()))
    return values @ query if most <= LONG[1] else values.astype(object) @ query.astype(object)


def search_block(ids: np.ndarray, values: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """Query number, vec_id and score of each query's best k rows of one block."""
    order = np.argsort(ids, kind="stable")
    ids, values = ids[order], values[order].astype(np.int64)
    low = values.min(axis=0)
    bits = max(1, int((values - low).max()).bit_length())
    slices = slices_of(values, low, bits)
    flipped = ~slices
    rows = len(ids)
    full = np.zeros(slices.shape[2] * 64, np.uint8)
    full[:rows] = 1
    exists = np.packbits(full, bitorder="little").view("<u8")
    out = []
    for nth, (qid, q) in enumerate(zip(query_ids, queries.astype(np.int64))):
        alive = exists
        lo, hi = np.searchsorted(ids, qid), np.searchsorted(ids, qid, side="right")
        if hi > lo:
            own = np.zeros(len(full), np.uint8)
            own[lo:hi] = 1
            alive = exists & ~np.packbits(own, bitorder="little").view("<u8")
        best = top_rows(add_slices(slices, q, flipped), alive, k)
        out.append((np.full(len(best), nth), ids[best], scores_of(values[best], q)))
    return tuple(np.concatenate(c) for c in zip(*out))


def as_decimals(scores: np.ndarray) -> pa.Array:
    """Integers of any size as a decimal column."""
    if scores.dtype != object:
        return pa.array(scores, pa.int64()).cast(SCORE)
    return pa.array([Decimal(int(x)) for x in scores], SCORE)


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
           block_rows: int = BLOCK_ROWS, chunk_queries: int = CHUNK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best rows, ties to the smaller id."""
    rows = quantised(vectors, id_col, vec_col)
    asked = quantised(queries, id_col, vec_col).distinct().withColumn("q_hash", F.xxhash64("x"))
    n_blocks = max(1, -(-rows.count() // block_rows))
    n_chunks = max(1, -(-asked.count() // chunk_queries))
    put = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    columns = ("n_dim", "block", "chunk", "vec_id", "x", "q_hash")
    # The pair (block, chunk) is the unit of work; both sides travel to it.
    held = (rows.withColumns({"block": put(n_blocks), "chunk": all_of(n_chunks), "q_hash": F.lit(None).cast("long")})
            .select(*columns, F.lit(False).alias("asks")))
    asking = (asked.withColumns({"chunk": put(n_chunks), "block": all_of(n_blocks)})
              .select(*columns, F.lit(True).alias("asks")))
    unit = held.unionByName(asking).groupBy("n_dim", "block", "chunk")
    schema = pa.schema([("query_id", pa.int64()), ("q_hash", pa.int64()), ("vec_id", pa.int64()), ("score", SCORE)])

    def solve(t: pa.Table) -> pa.Table:
        x = t.column("x").combine_chunks()
        matrix = x.flatten().to_numpy().reshape(len(x), -1) if len(x) else np.zeros((0, 1), np.int64)
        asks, ids = t.column("asks").to_numpy(), t.column("vec_id").to_numpy()
        if asks.all() or not asks.any():
            return schema.empty_table()
        at, vec_id, score = search_block(ids[~asks], matrix[~asks], ids[asks], matrix[asks], k)
        q_hash = t.column("q_hash").combine_chunks().filter(pa.array(asks)).to_numpy()
        return pa.Table.from_batches([record(schema, query_id=ids[asks][at], q_hash=q_hash[at], vec_id=vec_id, score=as_decimals(score))])

    found = unit.applyInArrow(solve, "query_id long, q_hash long, vec_id long, score decimal(38,0)")
    best = Window.partitionBy("query_id", "q_hash").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", F.greatest(F.lit(LONG[0]), F.least(F.lit(LONG[1]), F.col("score"))).cast("long").alias("score")))
